"""KPI formulas.

``ctr`` and ``cvr`` are fractions on rows and percents (``*_pct``) on totals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtally.functions.numeric import as_col, ratio, ratio_any_sign, round_half_up


def ctr(clicks: Column | str = "clicks", impressions: Column | str = "impressions") -> Column:
    return ratio(clicks, impressions)


def cpc(spend: Column | str = "spend", clicks: Column | str = "clicks") -> Column:
    return ratio(spend, clicks)


def cvr(conversions: Column | str = "conversions", clicks: Column | str = "clicks") -> Column:
    return ratio(conversions, clicks)


def cpm(spend: Column | str = "spend", impressions: Column | str = "impressions") -> Column:
    return ratio(spend, impressions) * 1000


def cpa(spend: Column | str = "spend", conversions: Column | str = "conversions", zero_as_null: bool = True) -> Column:
    """Cost per conversion; without conversions it is NULL, or 0 on request."""
    conv = as_col(conversions).cast("double")
    defined = F.when(conv > 0, as_col(spend).cast("double") / conv)
    return defined if zero_as_null else F.coalesce(defined, F.lit(0.0))


def row_kpis() -> list[Column]:
    """The five row KPIs in output order."""
    return [
        ctr().alias("ctr"),
        cpc().alias("cpc"),
        cpm().alias("cpm"),
        cvr().alias("cvr"),
        cpa().alias("cpa"),
    ]


def cpm_rounded(spend: Column | str, impressions: Column | str) -> Column:
    return round_half_up(cpm(spend, impressions), 2)


def roi(revenue: Column | str, spend: Column | str) -> Column:
    """Return on investment in percent, 0 without spend."""
    return ratio(as_col(revenue).cast("double") - as_col(spend).cast("double"), spend) * 100


def roi_rounded(revenue: Column | str, spend: Column | str) -> Column:
    return round_half_up(roi(revenue, spend), 2)


def roas_rounded(revenue: Column | str, spend: Column | str) -> Column:
    return round_half_up(ratio(revenue, spend), 2)


def cost_per_conversion(spend: Column | str, conversions: Column | str) -> Column:
    return round_half_up(ratio(spend, conversions), 2)


def performance_ratios(cpc_cpm: bool = False) -> list[Column]:
    """Ratios over the summed metrics of a group (percent for ctr, cvr and roi).

    Expects ``impressions clicks conversions spend revenue`` and treats only a
    zero or null denominator as "no value", so a negative one divides.
    """
    i, c, v = F.col("impressions"), F.col("clicks"), F.col("conversions")
    s, r = F.col("spend"), F.col("revenue")
    out = [
        (ratio_any_sign(c, i) * 100).alias("ctr_pct"),
        (ratio_any_sign(v, c) * 100).alias("cvr_pct"),
        ratio_any_sign(s, v).alias("cpa"),
        ratio_any_sign(r, s).alias("roas"),
        (ratio_any_sign(r - s, s) * 100).alias("roi_pct"),
    ]
    if cpc_cpm:
        out += [ratio_any_sign(s, c).alias("cpc"), (ratio_any_sign(s, i) * 1000).alias("cpm")]
    return out
