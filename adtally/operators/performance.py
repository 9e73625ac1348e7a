"""Group performance, charts and the daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.config import METRICS, FunnelDefaults
from adtally.functions.kpi import performance_ratios
from adtally.functions.numeric import exact_sum, is_integral, ratio_any_sign, round_half_up, round_total
from adtally.functions.text import trend_text
from adtally.operators.cleaning import lenient_date

FUNNEL = FunnelDefaults()
TREND_METRICS = ["ctr", "cvr", "roas", "roi"]


def _sums(df: DataFrame) -> list[Column]:
    """Sums of the five metrics; a metric the frame lacks is 0."""
    return [
        (exact_sum(df, m) if m in df.columns else F.lit(0.0)).alias(m) for m in METRICS
    ]


def _typed_sums(df: DataFrame, source: DataFrame) -> DataFrame:
    """Null sums become 0, decimals become double, whole numbers stay bigint."""
    out = {}
    for m in METRICS:
        whole = m in source.columns and is_integral(source.schema[m].dataType)
        out[m] = F.coalesce(F.col(m), F.lit(0)).cast("bigint" if whole else "double")
    return df.withColumns(out)


def performance(ads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums and ratios of sums (ctr, cvr, roi in percent) per key; null keys are left out."""
    keys = list(keys)
    rows = ads.na.drop(subset=keys)
    grouped = _typed_sums(rows.groupBy(*keys).agg(*_sums(rows)), ads)
    return grouped.select(*keys, *METRICS, *performance_ratios())


LEVELS = {
    "platform": ["platform"],
    "segment": ["platform", "age_group"],
    "campaign": ["campaign_id"],
    "overall": [],
}


def performance_levels(ads: DataFrame) -> DataFrame:
    """Performance of every platform, segment and campaign and of everything, from one pass.

    Rows are ``level, name, ads_count``, the sums and the ratios. The facts are
    first summed per campaign, platform and age group; only those sums are
    regrouped per level. Groups with a null key are left out.
    """
    keys = ["campaign_id", "platform", "age_group"]
    fine = ads.groupBy(*keys).agg(F.count("*").alias("ads_count"), *_sums(ads))
    sums = [F.sum(c).alias(c) for c in ["ads_count", *METRICS]]
    level = (
        "CASE WHEN grouping(campaign_id) = 0 THEN 'campaign' WHEN grouping(age_group) = 0 THEN 'segment' "
        "WHEN grouping(platform) = 0 THEN 'platform' ELSE 'overall' END AS level"
    )
    grouped = fine.groupingSets(list(LEVELS.values()), *keys).agg(*sums, F.expr(level))
    name = (
        "CASE level WHEN 'campaign' THEN campaign_id WHEN 'platform' THEN platform "
        "WHEN 'segment' THEN platform || ' | ' || age_group ELSE 'all' END AS name"
    )
    named = _typed_sums(grouped, ads).selectExpr("level", name, "ads_count", *METRICS)
    return named.where(F.col("name").isNotNull()).select("*", *performance_ratios())


def by_segment(ads: DataFrame) -> DataFrame:
    """Performance per ``platform | age group``."""
    return performance(ads, ["platform", "age_group"]).select(
        F.concat_ws(" | ", "platform", "age_group").alias("segment"),
        *METRICS,
        "ctr_pct",
        "cvr_pct",
        "cpa",
        "roas",
        "roi_pct",
    )


def kpi_by_dimension(scored: DataFrame, dimension: str = "campaign_id", top_n: int | None = 12) -> DataFrame:
    """Mean row ctr and cvr and summed spend per label, highest spend first.

    A dimension the frame lacks gives an empty table.
    """
    if dimension not in scored.columns:
        return scored.limit(0).select(
            F.lit("").alias("label"), F.lit(0.0).alias("ctr"), F.lit(0.0).alias("cvr"), F.lit(0.0).alias("spend")
        )
    grouped = scored.groupBy(F.coalesce(F.col(dimension).cast("string"), F.lit("")).alias("label")).agg(
        round_half_up(F.avg(F.coalesce("ctr", F.lit(0.0))), 6).alias("ctr"),
        round_half_up(F.avg(F.coalesce("cvr", F.lit(0.0))), 6).alias("cvr"),
        round_total(scored, "spend", 2).alias("spend"),
    )
    ranked = grouped.orderBy(F.desc("spend"), "label")
    return ranked if top_n is None else ranked.limit(top_n)


def kpi_by_age(scored: DataFrame) -> DataFrame:
    return kpi_by_dimension(scored.where(F.length("age_group") > 0), "age_group", None)


def kpi_by_gender(scored: DataFrame) -> DataFrame:
    return kpi_by_dimension(scored, "gender", None)


def pack_chart(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Fold a chart's rows into one row of parallel arrays.

    Only for charts cut to a few rows: all of them meet in one row.
    """
    position = F.row_number().over(Window.orderBy(*order))
    packed = rows.withColumn("_p", position).agg(
        F.array_sort(F.collect_list(F.struct("_p", *rows.columns))).alias("_rows")
    )
    return packed.select(*[F.col("_rows")[c].alias(c) for c in rows.columns])


def ctr_heatmap(ads: DataFrame, platforms: Sequence[str] | None = None) -> DataFrame:
    """Click rate in percent, one row per age group and one column per platform.

    Combinations without data are 0. Named platforms keep the plan to one pass
    and the schema fixed; otherwise Spark looks the names up first.
    """
    rows = ads.na.drop(subset=["platform", "age_group"])
    grouped = rows.groupBy("age_group").pivot("platform", list(platforms) if platforms else None)
    heat = grouped.agg(ratio_any_sign(exact_sum(rows, "clicks"), exact_sum(rows, "impressions")) * 100)
    return heat.na.fill(0.0)


def conversion_funnel(kpis: DataFrame, defaults: FunnelDefaults = FUNNEL) -> DataFrame:
    """Impressions, clicks and conversions the total spend buys at the overall rates."""

    def positive_or(name: str, default: float) -> Column:
        return F.when(F.col(name) > 0, F.col(name)).otherwise(F.lit(default))

    impressions = F.greatest(F.lit(0.0), F.col("total_spend") / positive_or("cpm", defaults.cpm) * 1000.0)
    rated = kpis.select(
        impressions.alias("i"),
        (positive_or("ctr_pct", defaults.ctr_pct) / 100.0).alias("ctr"),
        (positive_or("cvr_pct", defaults.cvr_pct) / 100.0).alias("cvr"),
    )
    clicks = F.greatest(F.lit(0.0), F.col("i") * F.col("ctr"))
    stages = [
        ("impressions", F.col("i")),
        ("clicks", clicks),
        ("conversions", F.greatest(F.lit(0.0), clicks * F.col("cvr"))),
    ]
    rows = [
        F.struct(F.lit(n).alias("position"), F.lit(s).alias("stage"), F.bround(c, 0).cast("bigint").alias("volume"))
        for n, (s, c) in enumerate(stages, 1)
    ]
    return rated.select(F.inline(F.array(*rows)))


def daily_series(ads: DataFrame, date_column: str = "date") -> DataFrame:
    """Sums and ratios per calendar date that has data, oldest first; unreadable dates are dropped."""
    dated = ads.withColumn("date", lenient_date(F.col(date_column))).where(F.col("date").isNotNull())
    daily = _typed_sums(dated.groupBy("date").agg(*_sums(dated)), dated)
    ratios = performance_ratios()
    return daily.select(
        "date",
        *METRICS,
        ratios[0].alias("ctr"),
        ratios[1].alias("cvr"),
        ratios[3].alias("roas"),
        ratios[4].alias("roi"),
    ).orderBy("date")


def kpi_trends(daily: DataFrame, window_days: int = 7) -> DataFrame:
    """Mean of the last days with data against the days before, as arrow text per KPI.

    Empty when there are fewer than two windows of days.
    """
    last = daily.orderBy(F.desc("date")).limit(2 * window_days)
    # At most two windows of days are numbered here.
    numbered = last.withColumn("n", F.row_number().over(Window.orderBy(F.desc("date"))))
    recent = F.col("n") <= window_days
    means = numbered.agg(
        F.count("*").alias("days"),
        *[F.avg(F.when(recent, F.col(m))).alias(f"{m}_cur") for m in TREND_METRICS],
        *[F.avg(F.when(~recent, F.col(m))).alias(f"{m}_prev") for m in TREND_METRICS],
    ).where(F.col("days") == 2 * window_days)
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            round_half_up(F.col(f"{m}_cur"), 6).alias("current"),
            round_half_up(F.col(f"{m}_prev"), 6).alias("previous"),
            trend_text(F.col(f"{m}_cur"), F.col(f"{m}_prev")).alias("trend"),
        )
        for m in TREND_METRICS
    ]
    return means.select(F.inline(F.array(*rows)))


def spend_vs_revenue(daily: DataFrame) -> DataFrame:
    return daily.select("date", "spend", "revenue")


def platforms_by_roi(platforms: DataFrame) -> DataFrame:
    return platforms.orderBy(F.desc("roi_pct"), "platform")
