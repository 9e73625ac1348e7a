"""Budget plans, platform reallocation, picks and insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.config import INSIGHT_TEXTS, ReallocationWeights
from adtally.functions.numeric import exact_sum, exact_sum_sql, round_half_up
from adtally.functions.text import currency_sql, explanation, fixed_sql
from adtally.operators.filters import first_rows
from adtally.operators.performance import kpi_by_dimension, performance_levels
from adtally.operators.rollups import quality_distribution, summary
from adtally.operators.segments import explain
from adtally.operators.stats import minmax, range_stats, with_stats

WEIGHTS = ReallocationWeights()


def top_segments(recommendations: DataFrame, limit: int = 20) -> DataFrame:
    """Best segments with explanation and the ``total`` number of matches."""
    return explain(first_rows(recommendations, [F.desc("recommendation_score"), "segment_id"], limit))


def with_actions(scored: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Scored ads beside the score and action of their segment.

    A segment may hold a large part of all ads. Spark broadcasts the
    recommendations if they measure small and splits hot segments if not.
    """
    chosen = recommendations.select("campaign_id", "age_group", "recommendation_score", "suggested_action")
    return scored.join(chosen, ["campaign_id", "age_group"])


def budget_plan(recommendations: DataFrame, total_budget: float | Column, top_n: int = 10) -> DataFrame:
    """Split a budget over the best ``top_n`` segments in proportion to their weights.

    Equal shares when all weights are 0. ``expected_conversions`` is null without
    a positive cpa. The explanation shows the segment's own figures.
    """
    picked = recommendations.orderBy(F.desc("recommendation_score"), "segment_id").limit(top_n)
    budget = total_budget if isinstance(total_budget, Column) else F.lit(float(total_budget))
    # The window sees the picked rows only, ``top_n`` at most.
    weight = (
        "CASE WHEN sum(cast(recommended_weight AS decimal(18,6))) OVER () > 0 THEN recommended_weight "
        "/ cast(sum(cast(recommended_weight AS decimal(18,6))) OVER () AS double) ELSE 1D / count(*) OVER () END"
    )
    allocated = picked.withColumn("_weight", F.expr(weight)).withColumn("_allocated", budget * F.col("_weight"))
    expected = F.when(F.col("avg_cpa") > 0, round_half_up(F.col("_allocated") / F.col("avg_cpa"), 4))
    return allocated.select(
        "segment_id",
        "campaign_id",
        "age_group",
        "suggested_action",
        "recommendation_score",
        round_half_up(F.col("_weight"), 6).alias("weight"),
        round_half_up(F.col("_allocated"), 2).alias("allocated_budget"),
        expected.alias("expected_conversions"),
        explanation().alias("explanation"),
    ).orderBy(F.desc("recommendation_score"), "segment_id")


def plan_totals(plan: DataFrame, total_budget: float | Column) -> DataFrame:
    """Budget, number of segments and expected conversions; zeros for an empty plan."""
    budget = total_budget if isinstance(total_budget, Column) else F.lit(float(total_budget))
    expected = F.coalesce(F.sum(F.col("expected_conversions").cast("decimal(20,4)")).cast("double"), F.lit(0.0))
    return plan.agg(
        F.count("*").alias("segments_used"), round_half_up(expected, 4).alias("expected_total_conversions")
    ).select(round_half_up(budget, 2).alias("total_budget"), "segments_used", "expected_total_conversions")


def reallocate(platforms: DataFrame, total_spend: float | None = None, weights: ReallocationWeights = WEIGHTS) -> DataFrame:
    """Score platforms against each other and share the spend out by score.

    A constant measure counts as 1 for all; scores below 0 count as 0, and when
    all are 0 every platform gets the same. Without ``total_spend`` the spend of
    the platforms is redistributed.
    """
    measures = {"roas": "greatest(roas, 0D)", "roi": "roi_pct", "cvr": "cvr_pct", "cpa": "cpa"}
    ranges: dict[str, str] = {}
    for name, value in measures.items():
        ranges |= range_stats(name, value)
    rows = with_stats(platforms, ranges | {"spend": f"cast({exact_sum_sql('spend')} AS double)"})
    n = {name: minmax(name, value, 1.0) for name, value in measures.items()}
    gain = f"{weights.roas}D * {n['roas']} + {weights.roi}D * {n['roi']} + {weights.cvr}D * {n['cvr']}"
    # Rounded so that the shares can be added up exactly.
    raw = f"floor(greatest({gain} - {weights.cpa}D * {n['cpa']}, 0D) * 1e12D + 0.5D) / 1e12D"
    budget = "_stats.spend" if total_spend is None else f"{float(total_spend)!r}D"
    scored = rows.selectExpr("* EXCEPT (_stats)", f"{raw} AS _score", f"{budget} AS _budget")
    summed = with_stats(scored, {"total": "sum(cast(_score AS decimal(20,12)))", "n": "count(*)"})
    share = "CASE WHEN _stats.total = 0 THEN 1D / _stats.n ELSE _score / cast(_stats.total AS double) END"
    return summed.selectExpr(
        "platform",
        "spend",
        "roas",
        "roi_pct",
        "cpa",
        "cvr_pct",
        "ctr_pct",
        "CASE WHEN _stats.total = 0 THEN 1D ELSE _score END AS score",
        f"({share}) * _budget AS recommended_spend",
        f"({share}) * _budget - spend AS delta",
    )


def top_reallocations(reallocation: DataFrame, limit: int = 10) -> DataFrame:
    return reallocation.orderBy(F.desc("delta"), "platform").limit(limit)


def top_campaigns_by_roas(campaigns: DataFrame, limit: int = 12) -> DataFrame:
    return (
        campaigns.select("campaign_id", "roas", "conversions", "roi_pct")
        .orderBy(F.desc("roas"), F.desc("conversions"), "campaign_id")
        .limit(limit)
    )


def _best(level: str, *ranking: str) -> str:
    """SQL text of the row of a level that comes first by ``ranking`` ascending, then by name.

    ``min_by`` keeps one row per task, where a sort would move the table.
    """
    row = "struct(name, conversions, ctr_pct, cvr_pct, cpa, roas, roi_pct)"
    return f"min_by({row}, struct({', '.join(ranking)}, name)) FILTER (WHERE level = '{level}')"


def _messages(df: DataFrame, required: str, rows: list[tuple[str, ...]]) -> DataFrame:
    """Unfold one row into numbered messages; those whose ``required`` field is null are left out."""
    fields = [f"struct({i} AS position, {', '.join(r)})" for i, r in enumerate(rows, 1)]
    return df.selectExpr(f"inline(array({', '.join(fields)}))").where(F.col(required).isNotNull()).orderBy("position")


def optimization_picks(ads: DataFrame) -> DataFrame:
    """Best and worst platform, segment and campaign with their figures.

    Ordered as ``position`` 1..6: platform to raise, platform to cut, segment to
    favour, segment to de-risk, campaign to scale, campaign to pause.
    """
    best = {
        "p1": _best("platform", "-roas", "-roi_pct"),
        "p2": _best("platform", "-cpa", "roi_pct"),
        "s1": _best("segment", "-roas", "-cvr_pct"),
        "s2": _best("segment", "-cpa", "roi_pct"),
        "c1": _best("campaign", "-roas", "-conversions"),
        "c2": _best("campaign", "roi_pct", "roas"),
    }
    row = performance_levels(ads).agg(*[F.expr(f"{sql} AS {pick}") for pick, sql in best.items()])

    def figure(pick: str, name: str) -> str:
        texts = {
            "roas": f"concat('ROAS ', {fixed_sql(f'{pick}.roas', 2)}, 'x')",
            "roi": f"concat('ROI ', {fixed_sql(f'{pick}.roi_pct', 1)}, '%')",
            "cpa": f"concat('CPA ', {currency_sql(f'{pick}.cpa')})",
            "ctr": f"concat('CTR ', {fixed_sql(f'{pick}.ctr_pct', 2)}, '%')",
            "cvr": f"concat('CVR ', {fixed_sql(f'{pick}.cvr_pct', 2)}, '%')",
            "conversions": f"concat('Conversions ', format_string('%,d', cast({pick}.conversions AS bigint)))",
        }
        return texts[name]

    def shown(kind: str, pick: str, *figures: str) -> tuple[str, str, str]:
        detail = " || ' | ' || ".join(figure(pick, f) for f in figures)
        return f"'{kind}' AS kind", f"{pick}.name AS name", f"{detail} AS detail"

    return _messages(
        row,
        "name",
        [
            shown("increase_platform", "p1", "roas", "roi", "cpa"),
            shown("reduce_platform", "p2", "cpa", "roi", "cvr"),
            shown("prioritize_segment", "s1", "cvr", "roas", "ctr"),
            shown("derisk_segment", "s2", "cpa", "roi"),
            shown("scale_campaign", "c1", "roas", "conversions"),
            shown("pause_campaign", "c2", "roi", "roas", "cpa"),
        ],
    )


def insights(ads: DataFrame) -> DataFrame:
    """Key findings as ``position, kind, message`` rows."""
    whole = "FILTER (WHERE level = 'overall')"
    row = performance_levels(ads).agg(
        F.expr(f"coalesce(max(ads_count) {whole}, 0) AS n"),
        *[F.expr(f"coalesce(max({c}) {whole}, 0D) AS {c}") for c in ("ctr_pct", "cvr_pct", "roi_pct")],
        F.expr(f"{_best('platform', '-roas')} AS best"),
        F.expr(f"{_best('platform', '-cpa')} AS risk"),
        F.expr(f"{_best('campaign', '-roas', '-conversions')} AS top"),
    )
    figures = {
        "dataset_scale": ["n"],
        "overall": [fixed_sql("ctr_pct", 2), fixed_sql("cvr_pct", 2)],
        "best_platform": ["best.name", fixed_sql("best.roas", 2)],
        "cost_risk": ["risk.name", currency_sql("risk.cpa")],
        "top_campaign": ["top.name", fixed_sql("top.roas", 2)],
    }
    needs = {"best_platform": "best IS NOT NULL", "cost_risk": "risk IS NOT NULL", "top_campaign": "top IS NOT NULL", "negative_roi": "roi_pct < 0"}
    texts = {
        kind: f"CASE WHEN {needs.get(kind, 'true')} THEN format_string('{text}'{''.join(', ' + f for f in figures.get(kind, []))}) END"
        for kind, text in INSIGHT_TEXTS.items()
    }
    return _messages(row, "message", [(f"'{k}' AS kind", f"{t} AS message") for k, t in texts.items()])


def report_plan(scored: DataFrame, recommendations: DataFrame, top_n: int = 10) -> DataFrame:
    """Budget plan that redistributes everything spent so far."""
    spent = F.coalesce(F.round(exact_sum(scored, "spend"), 4).cast("double"), F.lit(0.0))
    return budget_plan(recommendations, scored.agg(spent).scalar(), top_n)


def report(scored: DataFrame, recommendations: DataFrame, top_n: int = 10) -> dict[str, DataFrame]:
    """The parts of the combined report.

    Hand in written tables: each part is a job of its own, and none of them
    should score the ads again.
    """
    return {
        "summary": summary(scored),
        "quality_distribution": quality_distribution(scored),
        "campaign_kpi": kpi_by_dimension(scored),
        "recommendation_count": recommendations.agg(F.count("*").alias("recommendation_count")),
        "recommendations": explain(recommendations),
        "recommendation_plan": report_plan(scored, recommendations, top_n),
    }
