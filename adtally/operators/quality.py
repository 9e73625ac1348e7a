"""Row KPIs, quality scores and the scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.config import AD_COLUMNS, QualityRules
from adtally.functions.kpi import row_kpis
from adtally.operators.stats import cpa_median, join_groups

RULES = QualityRules()


def add_kpis(ads: DataFrame) -> DataFrame:
    """All columns plus ctr, cpc, cpm, cvr (0 when undefined) and cpa (NULL when undefined)."""
    return ads.select("*", *row_kpis())


def additive_score(rules: QualityRules = RULES) -> str:
    """SQL text of the 0..4 score, one point per rule met; a missing cpa meets no rule."""
    met = [
        f"ctr >= {rules.min_ctr}D",
        f"cvr >= {rules.min_cvr}D",
        "conversions > 0 AND cpa <= cpa_median",
        f"conversions >= {rules.min_conversions}D",
    ]
    return " + ".join(f"CASE WHEN {m} THEN 1 ELSE 0 END" for m in met)


def additive_label(rules: QualityRules = RULES) -> str:
    return (
        f"CASE WHEN quality_score >= {rules.good_at} THEN 'good' "
        f"WHEN quality_score = {rules.average_at} THEN 'average' ELSE 'bad' END"
    )


def tiered_score(rules: QualityRules = RULES) -> str:
    """SQL text: 3 when ctr, cvr and cpa rules all hold, 2 when any does, else 1.

    A NULL cpa can neither complete the three nor stand in for one of them.
    """
    met = [f"ctr >= {rules.min_ctr}D", f"cvr >= {rules.min_cvr}D", "cpa <= cpa_median"]
    return f"CASE WHEN {' AND '.join(met)} THEN 3D WHEN {' OR '.join(met)} THEN 2D ELSE 1D END"


TIERED_LABEL = "CASE WHEN quality_score = 3 THEN 'good' WHEN quality_score = 2 THEN 'average' ELSE 'bad' END"


def label_quality(
    kpis: DataFrame,
    mode: str = "additive",
    median: str | float = "exact",
    by: Sequence[str] = (),
    rules: QualityRules = RULES,
) -> DataFrame:
    """Add ``quality_score`` and ``quality_label``. ``median`` may also be a number that is known already.

    The cpa threshold is the median of the whole frame, or of each ``by`` group:
    files landed together but judged each on its own are scored in one job.
    """
    if mode not in ("additive", "tiered"):
        raise ValueError(f"mode must be 'additive' or 'tiered', got {mode!r}")
    if isinstance(median, float):
        rows = kpis.withColumn("cpa_median", F.lit(median))
    elif by:
        rows = join_groups(kpis, cpa_median(kpis, median, by), by)
    else:
        rows = kpis.withColumn("cpa_median", cpa_median(kpis, median).scalar())
    score, label = (additive_score(rules), additive_label(rules)) if mode == "additive" else (tiered_score(rules), TIERED_LABEL)
    # The label refers to the score beside it: one projection, not two.
    return rows.selectExpr(*[f"`{c}`" for c in kpis.columns], f"{score} AS quality_score", f"{label} AS quality_label")


def score_ads(
    ads: DataFrame,
    mode: str = "additive",
    median: str = "exact",
    by: Sequence[str] = (),
    rules: QualityRules = RULES,
) -> DataFrame:
    """The 17 scored columns, behind the ``by`` columns if any."""
    extra = [c for c in by if c not in AD_COLUMNS]
    return label_quality(add_kpis(ads.select(*extra, *AD_COLUMNS)), mode, median, by, rules)
