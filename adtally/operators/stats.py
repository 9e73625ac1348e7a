"""Whole-table and per-group statistics attached to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.functions.numeric import round_half_up
from adtally.operators.order_stats import exact_median


def table_stats(df: DataFrame, aggs: dict[str, str]) -> Column:
    """One struct of aggregates (SQL texts by name) over the whole frame, usable as a constant.

    It is a scalar subquery: the plan stays lazy, no join and no window over
    fact rows is needed, and identical subqueries run once.
    """
    fields = ", ".join(f"{sql} AS {name}" for name, sql in aggs.items())
    return df.agg(F.expr(f"struct({fields})")).scalar()


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows beside what ``groups`` holds for their ``by`` columns; null keys meet null keys."""
    names = {c: f"_by_{c}" for c in by}
    same = F.lit(True)
    for c, other in names.items():
        same = same & F.col(c).eqNullSafe(F.col(other))
    return rows.join(groups.withColumnsRenamed(names), same, how).drop(*names.values())


def with_stats(df: DataFrame, aggs: dict[str, str], by: Sequence[str] = (), shared: Sequence[str] = ()) -> DataFrame:
    """Attach a struct ``_stats`` of aggregates of the whole frame, or of each ``by`` group.

    ``shared`` names further columns for the
    statistics to read: with the same columns alive, the statistics and the rows
    come from one aggregation over the facts instead of one each.
    """
    if not by:
        return df.withColumn("_stats", table_stats(df, aggs | {f"_read_{c}": f"max({c})" for c in shared}))
    fields = ", ".join(f"{sql} AS {name}" for name, sql in aggs.items())
    return join_groups(df, df.groupBy(*by).agg(F.expr(f"struct({fields}) AS _stats")), by)


def cpa_median(
    kpis: DataFrame, median: str = "exact", by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Median cpa as ``by..., cpa_median``; without any cpa it is 0.

    ``median="exact"`` finds the true middle; ``"approx"`` uses the built-in
    sketch with rank error ``1 / accuracy`` in one pass.
    """
    by = list(by)
    if median == "approx":
        middle = F.coalesce(F.percentile_approx("cpa", 0.5, accuracy), F.lit(0.0)).alias("cpa_median")
        return kpis.groupBy(*by).agg(middle)
    if median != "exact":
        raise ValueError(f"median must be 'exact' or 'approx', got {median!r}")
    found = exact_median(kpis, "cpa", by).withColumnRenamed("median", "cpa_median")
    if not by:
        return found.agg(F.coalesce(F.max("cpa_median"), F.lit(0.0)).alias("cpa_median"))
    groups = kpis.select(*by).distinct()
    return join_groups(groups, found, by, "left").na.fill(0.0, ["cpa_median"])


def range_stats(name: str, value: str) -> dict[str, str]:
    """The statistics :func:`minmax` needs; the span of a constant is null."""
    return {f"lo_{name}": f"min({value})", f"span_{name}": f"nullif(max({value}) - min({value}), 0D)"}


def minmax(name: str, value: str, degenerate: float) -> str:
    """SQL text scaling a value to 0..1 within ``_stats``; a constant or unknown range gives ``degenerate``."""
    lo, span = f"_stats.lo_{name}", f"_stats.span_{name}"
    return f"CASE WHEN {span} > 0 THEN ({value} - {lo}) / {span} ELSE {degenerate}D END"


def risk_level(campaigns: DataFrame, medium_above: float = 40.0, high_above: float = 80.0) -> DataFrame:
    """Sample standard deviation of campaign ROI and the risk it stands for.

    One campaign has no deviation, which reads as low risk.
    """
    spread = campaigns.agg(F.stddev_samp("roi_pct").alias("roi_std"))
    level = (
        F.when(F.col("roi_std") > high_above, F.lit("high"))
        .when(F.col("roi_std") > medium_above, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    return spread.select(round_half_up(F.col("roi_std"), 6).alias("roi_std"), level.alias("risk_level"))


def efficiency_score(kpis: DataFrame, currency_rate: float = 1.0) -> DataFrame:
    """0..100 score from overall ``roas`` and ``cpa``.

    ``cpa`` is divided by ``currency_rate`` first, so money converted earlier is
    compared in its original unit; rate 0 counts cpa as 0.
    """
    cpa_unit = F.col("cpa") / currency_rate if currency_rate else F.lit(0.0)
    gain = 1.0 - F.exp(-F.greatest(F.lit(0.0), F.col("roas")) / 2.0)
    cost = 1.0 / (1.0 + F.greatest(F.lit(0.0), cpa_unit) / 30.0)
    return kpis.select(F.bround(gain * cost * 100.0, 0).cast("int").alias("efficiency_score"))
