"""Schema, thresholds and weights shared by the operators.

Every operator takes its settings as an argument; the values here are the
defaults. Nothing reads environment variables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: the ad fact schema -------------------------------------
AD_SCHEMA = T.StructType(
    [
        T.StructField("ad_id", T.LongType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("platform", T.StringType()),
        T.StructField("age_group", T.StringType()),
        T.StructField("impressions", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("conversions", T.LongType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)
AD_COLUMNS = AD_SCHEMA.fieldNames()
METRICS = ["impressions", "clicks", "conversions", "spend", "revenue"]
KPI_COLUMNS = ["ctr", "cpc", "cpm", "cvr", "cpa"]
SCORED_COLUMNS = AD_COLUMNS + KPI_COLUMNS + ["quality_score", "quality_label"]
RECOMMENDATION_COLUMNS = [
    "segment_id",
    "campaign_id",
    "age_group",
    "ads_count",
    "total_spent",
    "total_conversions",
    "avg_ctr",
    "avg_cvr",
    "avg_cpa",
    "good_ratio",
    "conversion_per_spend",
    "recommendation_score",
    "recommended_weight",
    "suggested_action",
]
CLEANING_REQUIRED = [
    "ad_id",
    "campaign_id",
    "impressions",
    "clicks",
    "spend",
    "conversions",
]
QUALITY_LABELS = ["good", "average", "bad"]
ACTIONS = ["increase_budget", "keep_and_test", "reduce_budget"]

# Defaults for columns a raw file may lack. ``ad_id`` is generated instead.
AD_DEFAULTS = {
    "campaign_id": "",
    "date": "",
    "platform": "unknown",
    "age_group": "unknown",
    "impressions": 0.0,
    "clicks": 0.0,
    "conversions": 0.0,
    "spend": 0.0,
    "revenue": 0.0,
}
# Defaults for columns a scored file may lack before segments are built.
SCORED_DEFAULTS = {
    "campaign_id": "",
    "age_group": "unknown",
    "spend": 0.0,
    "conversions": 0.0,
    "ctr": 0.0,
    "cvr": 0.0,
    "cpa": 0.0,
    "quality_label": "average",
}

# Explanation sentences, by suggested action; anything else reads as "keep".
ACTION_TEXT = {
    "increase_budget": "Tang ngan sach do hieu qua tong hop cao",
    "reduce_budget": "Giam ngan sach do hieu qua tong hop thap",
    "keep_and_test": "Giu ngan sach va tiep tuc A/B test",
}
# --- end of fixed values --------------------------------------------------


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the row quality score."""

    min_ctr: float = 0.01
    min_cvr: float = 0.02
    min_conversions: float = 1.0
    good_at: int = 3
    average_at: int = 2


@dataclass(frozen=True)
class SegmentWeights:
    """Feature weights and action thresholds of the segment score."""

    features: dict = field(
        default_factory=lambda: {
            "avg_ctr": 0.2,
            "avg_cvr": 0.3,
            "conversion_per_spend": 0.25,
            "good_ratio": 0.15,
            "cpa_inverse": 0.1,
        }
    )
    increase_at: float = 0.7
    keep_at: float = 0.45


@dataclass(frozen=True)
class ReallocationWeights:
    """Weights of the platform reallocation score; cpa counts against it."""

    roas: float = 0.45
    roi: float = 0.35
    cvr: float = 0.20
    cpa: float = 0.25


@dataclass(frozen=True)
class FunnelDefaults:
    """Rates the funnel falls back to when the data gives none."""

    cpm: float = 50000.0
    ctr_pct: float = 2.0
    cvr_pct: float = 3.0


REVENUE_PER_CONVERSION = 10.0

# --- fixed values: sentences of insights and trends
INSIGHT_TEXTS = {
    "dataset_scale": "Dataset scale: %,d rows",
    "overall": "Overall CTR: %s%% | CVR: %s%%",
    "best_platform": "Best platform (ROAS): %s → %sx",
    "cost_risk": "Cost risk platform (CPA): %s → %s",
    "top_campaign": "Top campaign to scale: %s (ROAS %sx)",
    "negative_roi": "Negative ROI: prioritize budget + targeting optimization",
}
TREND_STABLE = "→ Ổn định"
# --- end of fixed values
