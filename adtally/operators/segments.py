"""Segment (campaign x age group) features, scores, actions and budget shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.config import RECOMMENDATION_COLUMNS, SegmentWeights
from adtally.functions.numeric import exact_sum, exact_sum_sql, rounded
from adtally.functions.text import explanation
from adtally.operators.stats import minmax, range_stats, with_stats
from adtally.sources.workdir import written

WEIGHTS = SegmentWeights()
MEASURES = ["ads_count", "total_spent", "total_conversions", "avg_ctr", "avg_cvr", "avg_cpa", "good_ratio"]


def eligible(scored: DataFrame) -> DataFrame:
    """Rows that belong to a segment: a campaign and a known age group."""
    return scored.where("length(trim(campaign_id)) > 0 AND length(trim(age_group)) > 0 AND age_group <> 'unknown'")


def segment_features(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, sums, mean KPIs and the two derived features of each segment."""
    rows = eligible(scored)
    grouped = rows.groupBy(*by, "campaign_id", "age_group").agg(
        F.count("*").alias("ads_count"),
        exact_sum(rows, "spend").cast("double").alias("total_spent"),
        exact_sum(rows, "conversions").cast("double").alias("total_conversions"),
        F.expr("avg(ctr) AS avg_ctr"),
        F.expr("avg(cvr) AS avg_cvr"),
        F.expr("avg(cpa) AS avg_cpa"),
        F.expr("avg(CASE WHEN quality_label = 'good' THEN 1D ELSE 0D END) AS good_ratio"),
    )
    return grouped.selectExpr(
        "*",
        "CASE WHEN total_spent > 0 THEN total_conversions / total_spent ELSE 0D END AS conversion_per_spend",
        "CASE WHEN avg_cpa > 0 THEN 1D / avg_cpa ELSE 0D END AS cpa_inverse",
    )


def normalize_features(features: DataFrame, weights: SegmentWeights = WEIGHTS, by: Sequence[str] = ()) -> DataFrame:
    """Add ``norm_*``: each feature scaled over all segments, 0.5 for a constant one."""
    ranges: dict[str, str] = {}
    for name in weights.features:
        ranges |= range_stats(name, name)
    rows = with_stats(features, ranges, by, MEASURES)
    return rows.selectExpr("* EXCEPT (_stats)", *[f"{minmax(n, n, 0.5)} AS norm_{n}" for n in weights.features])


def score_segments(normalized: DataFrame, weights: SegmentWeights = WEIGHTS) -> DataFrame:
    """Add the weighted score, rounded to 6 digits, and the action it leads to.

    The thresholds look at the rounded score, both inclusive.
    """
    score = " + ".join(f"norm_{n} * {w}D" for n, w in weights.features.items())
    action = (
        f"CASE WHEN recommendation_score >= {weights.increase_at}D THEN 'increase_budget' "
        f"WHEN recommendation_score >= {weights.keep_at}D THEN 'keep_and_test' ELSE 'reduce_budget' END"
    )
    # A score lies between 0 and 1, so plain flooring is safe. The action refers
    # to the score beside it.
    return normalized.selectExpr(
        "*", f"floor(({score}) * 1e6D + 0.5D) / 1e6D AS recommendation_score", f"{action} AS suggested_action"
    )


def recommend(
    scored: DataFrame,
    weights: SegmentWeights = WEIGHTS,
    by: Sequence[str] = (),
    ordered: bool = True,
) -> DataFrame:
    """The 14-column recommendation table, best score first.

    With ``by`` every group of files is normalised and shared out on its own. The features, one
    row per segment, are written once to the shared folder: ranges, totals and rows all read
    them there, and the ads are scored and aggregated a single time.
    """
    features = written(segment_features(scored, by), "segments")
    actions = score_segments(normalize_features(features, weights, by), weights)
    rows = with_stats(actions, {"total": f"cast({exact_sum_sql('recommendation_score')} AS double)"}, by, MEASURES)
    weight = "CASE WHEN _stats.total > 0 THEN recommendation_score / _stats.total ELSE 0D END"
    made = {
        "segment_id": "concat_ws('|', campaign_id, age_group)",
        "recommended_weight": f"floor(({weight}) * 1e6D + 0.5D) / 1e6D",
    }
    made |= {c: rounded(c, 4) for c in ("total_spent", "total_conversions")}
    made |= {c: rounded(c, 6) for c in ("avg_ctr", "avg_cvr", "avg_cpa", "good_ratio", "conversion_per_spend")}
    table = rows.selectExpr(*by, *[f"{made.get(c, c)} AS {c}" for c in RECOMMENDATION_COLUMNS])
    return table.orderBy(F.desc("recommendation_score"), "segment_id") if ordered else table


def explain(recommendations: DataFrame) -> DataFrame:
    """Add the ``explanation`` sentence."""
    return recommendations.withColumn("explanation", explanation())


def explain_one(recommendations: DataFrame, segment_id: str) -> DataFrame:
    """Explanation of one segment; empty when the segment does not exist."""
    return explain(recommendations.where(F.col("segment_id") == segment_id)).select(
        "segment_id", "campaign_id", "age_group", "suggested_action", "recommendation_score", "explanation"
    )
