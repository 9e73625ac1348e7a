import pytest
from pyspark.sql import functions as F

from adtally.operators import filters, performance, planning, quality, rollups, segments, stats
from conftest import column


def spread(make_ads, n=24):
    rows = [
        dict(campaign_id=f"C{i % 4}", age_group=["18-24", "25-34", "unknown", ""][i % 3], platform=["P1", "P2", None][i % 3],
             date=f"2026-04-{i % 20 + 1:02d}", clicks=50 + i, conversions=i % 5, spend=5.0 + i, revenue=3.0 * i)
        for i in range(n)
    ]
    return make_ads(*rows)


def test_additive_rules_and_labels(make_ads):
    df = quality.score_ads(
        make_ads(
            {},  # ctr, cvr, conversions and the cheapest cpa
            dict(spend=90.0),  # cpa equal to the median
            dict(clicks=5, conversions=0),  # nothing
            dict(clicks=100, conversions=0),  # ctr only
            dict(clicks=100, conversions=1, spend=500.0),  # ctr and conversions
        )
    )
    assert [(r.quality_score, r.quality_label) for r in df.orderBy("ad_id").collect()] == [
        (4, "good"), (4, "good"), (0, "bad"), (1, "bad"), (2, "average"),
    ]


def test_no_conversions_anywhere_means_median_zero(make_ads):
    df = make_ads(dict(conversions=0), dict(conversions=0))
    kpis = quality.add_kpis(df)
    assert stats.cpa_median(kpis).first().cpa_median == 0.0
    assert stats.cpa_median(kpis, "approx").first().cpa_median == 0.0
    assert column(quality.score_ads(df), "quality_label") == ["bad", "bad"]


def test_tiered_null_cpa(make_ads):
    df = quality.score_ads(
        make_ads({}, dict(spend=99.0), dict(conversions=0), dict(clicks=5, conversions=0)), mode="tiered"
    )
    assert column(df.orderBy("ad_id"), "quality_score") == [3.0, 2.0, 2.0, 1.0]


def test_modes_are_checked(make_ads):
    with pytest.raises(ValueError):
        quality.score_ads(make_ads({}), mode="other")
    with pytest.raises(ValueError):
        quality.score_ads(make_ads({}), median="other")


def test_batches_are_scored_apart(make_ads):
    df = make_ads(*[dict(spend=s) for s in (1.0, 2.0, 3.0, 100.0, 200.0, 300.0)])
    df = df.withColumn("batch_id", F.when(F.col("ad_id") <= 3, "a").otherwise("b"))
    together = quality.score_ads(df, by=["batch_id"])
    for batch in ("a", "b"):
        alone = quality.score_ads(df.where(F.col("batch_id") == batch))
        both = together.where(F.col("batch_id") == batch).drop("batch_id")
        assert sorted(map(tuple, both.collect())) == sorted(map(tuple, alone.collect()))
        recs = segments.recommend(together, by=["batch_id"]).where(F.col("batch_id") == batch).drop("batch_id")
        assert recs.collect() == segments.recommend(alone).collect()


def test_segments_leave_out_unknown_ages_and_blank_campaigns(make_ads):
    scored = quality.score_ads(
        make_ads({}, dict(age_group="unknown"), dict(age_group="  "), dict(campaign_id=" "), dict(age_group=None))
    )
    assert column(segments.recommend(scored), "segment_id") == ["C1|18-24"]


def test_constant_features_score_half(make_ads):
    row = segments.recommend(quality.score_ads(make_ads({}))).first()
    assert (row.recommendation_score, row.suggested_action, row.recommended_weight) == (0.5, "keep_and_test", 1.0)


def test_recommendation_invariants(make_ads):
    recs = segments.recommend(quality.score_ads(spread(make_ads))).collect()
    assert sum(r.recommended_weight for r in recs) == pytest.approx(1, abs=1e-5)
    scores = [(-r.recommendation_score, r.segment_id) for r in recs]
    assert scores == sorted(scores)
    for r in recs:
        action = "increase_budget" if r.recommendation_score >= 0.7 else (
            "keep_and_test" if r.recommendation_score >= 0.45 else "reduce_budget")
        assert r.suggested_action == action


def test_score_boundaries_are_inclusive(spark):
    names = ["avg_ctr", "avg_cvr", "conversion_per_spend", "good_ratio", "cpa_inverse"]
    rows = [tuple([v] * 5) for v in (0.7, 0.6999999, 0.45, 0.4499994)]
    df = spark.createDataFrame(rows, ", ".join(f"norm_{n} double" for n in names))
    assert column(segments.score_segments(df), "suggested_action") == [
        "increase_budget", "increase_budget", "keep_and_test", "reduce_budget",
    ]


def plan_input(spark, rows):
    return spark.createDataFrame(
        rows,
        "segment_id string, campaign_id string, age_group string, suggested_action string, recommendation_score double, "
        "recommended_weight double, avg_cpa double, avg_cvr double, good_ratio double",
    )


def test_plan_shares_ties_and_expected_conversions(spark):
    recs = plan_input(
        spark,
        [("b", "C", "A", "keep_and_test", 0.6, 0.3, 2.0, 0.1, 1.0), ("a", "C", "A", "keep_and_test", 0.6, 0.1, None, 0.1, 1.0),
         ("c", "C", "A", "keep_and_test", 0.1, 0.6, 1.0, 0.1, 1.0)],
    )
    plan = planning.budget_plan(recs, 1000.0, top_n=2)
    rows = plan.collect()
    assert [(r.segment_id, r.weight, r.allocated_budget, r.expected_conversions) for r in rows] == [
        ("a", 0.25, 250.0, None), ("b", 0.75, 750.0, 375.0),
    ]
    assert "avg_cpa=2.00" in rows[1].explanation
    totals = planning.plan_totals(plan, 1000.0).first()
    assert tuple(totals) == (1000.0, 2, 375.0)


def test_plan_without_weights_shares_equally_and_empty_plan(spark):
    recs = plan_input(spark, [(s, "C", "A", "keep_and_test", 0.0, 0.0, 0.0, 0.0, 0.0) for s in "xyzw"])
    assert column(planning.budget_plan(recs, 100.0), "allocated_budget") == [25.0] * 4
    empty = planning.budget_plan(recs.limit(0), 100.0)
    assert tuple(planning.plan_totals(empty, 100.0).first()) == (100.0, 0, 0.0)


def test_report_redistributes_what_was_spent(make_ads):
    scored = quality.score_ads(spread(make_ads))
    recs = segments.recommend(scored)
    parts = planning.report(scored, recs)
    spent = parts["summary"].first().total_spent
    assert sum(column(parts["recommendation_plan"], "allocated_budget")) == pytest.approx(spent, abs=0.1)
    assert parts["recommendation_count"].first()[0] == parts["recommendations"].count() == recs.count()
    assert parts["quality_distribution"].count() == 3 and parts["campaign_kpi"].count() == 4


def test_reallocation_deltas_cancel(make_ads):
    out = planning.reallocate(performance.performance(spread(make_ads), ["platform"])).collect()
    assert sum(r.delta for r in out) == pytest.approx(0, abs=1e-9)


def test_reallocation_of_equal_platforms(make_ads):
    platforms = performance.performance(make_ads({}, dict(platform="P2")), ["platform"])
    out = planning.reallocate(platforms, 100.0).collect()
    # Constant measures count as 1 each: .45 + .35 + .20 - .25.
    assert [(round(r.score, 6), r.recommended_spend) for r in out] == [(0.75, 50.0), (0.75, 50.0)]


def test_performance_skips_null_keys_and_missing_metrics(make_ads):
    ads = make_ads({}, dict(platform=None)).drop("revenue")
    rows = performance.performance(ads, ["platform"]).collect()
    assert [(r.platform, r.revenue, r.roas, r.roi_pct, r.cpa) for r in rows] == [("P1", 0.0, 0.0, -100.0, 1.0)]


def test_levels_equal_the_single_tables(make_ads):
    ads = spread(make_ads)
    levels = performance.performance_levels(ads)
    for level, table in (
        ("platform", performance.performance(ads, ["platform"])),
        ("campaign", performance.performance(ads, ["campaign_id"])),
        ("segment", performance.by_segment(ads)),
    ):
        rows = levels.where(F.col("level") == level).drop("level", "ads_count")
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, table.collect()))
    whole = levels.where("level = 'overall'").first()
    assert (whole.ads_count, whole.spend) == (24, rollups.overall_kpis(ads).first().total_spend)


def test_chart_top_n_missing_dimension_and_arrays(make_ads):
    scored = quality.add_kpis(make_ads(dict(spend=1.0), dict(campaign_id="C2"), dict(campaign_id="C3", spend=10.0)))
    top = performance.kpi_by_dimension(scored, top_n=2)
    assert column(top, "label") == ["C2", "C3"]
    packed = performance.pack_chart(top, [F.desc("spend"), "label"]).first()
    assert (packed.label, packed.spend) == (["C2", "C3"], [10.0, 10.0])
    assert performance.kpi_by_gender(scored).collect() == []


def test_heatmap_fills_gaps_and_finds_platforms(make_ads):
    ads = make_ads({}, dict(platform="P2", age_group="25-34"), dict(platform=None))
    rows = {r.age_group: (r.P1, r.P2) for r in performance.ctr_heatmap(ads).collect()}
    assert rows == {"18-24": (10.0, 0.0), "25-34": (0.0, 10.0)}
    assert performance.ctr_heatmap(ads, ["P2"]).columns == ["age_group", "P2"]


def test_funnel_falls_back_to_default_rates(make_ads):
    kpis = rollups.overall_kpis(make_ads(dict(impressions=0, clicks=0, conversions=0, spend=100000.0)))
    assert column(performance.conversion_funnel(kpis), "volume") == [2000, 40, 1]


def test_daily_series_drops_bad_dates(make_ads):
    daily = performance.daily_series(make_ads({}, dict(date="2026-13-40"), dict(date=None), dict(date="2026-03-01")))
    assert [str(r.date) for r in daily.collect()] == ["2026-03-01", "2026-04-01"]


def test_trends_need_two_windows_of_days(make_ads):
    days = [dict(date=f"2026-04-{d:02d}", clicks=100 if d <= 7 else 150) for d in range(1, 15)]
    assert performance.kpi_trends(performance.daily_series(make_ads(*days[1:]))).collect() == []
    rows = {r.metric: r.trend for r in performance.kpi_trends(performance.daily_series(make_ads(*days))).collect()}
    assert (rows["ctr"], rows["roas"]) == ("↑ 50.0%", "→ Ổn định")


def test_summary_of_nothing_and_revenue_fallback(make_ads):
    empty = rollups.summary(quality.score_ads(make_ads({}).limit(0))).first()
    assert set(empty.asDict().values()) == {0}
    scored = quality.score_ads(make_ads(dict(revenue=0.0), dict(revenue=None)))
    assert rollups.summary(scored).first().total_revenue == 200.0
    assert rollups.advanced_summary(scored).first().total_revenue == 200.0
    folded = rollups.with_distribution_map(rollups.summary(scored)).first()
    assert folded.quality_distribution == {"good": 2, "average": 0, "bad": 0}


def test_means_treat_null_as_zero_except_cpa(spark):
    scored = spark.createDataFrame(
        [(1.0, 1, 1, 1.0, 0.5, 0.5, 2.0, 2.0, 4.0, "GOOD"), (1.0, 1, 1, 1.0, None, None, None, None, None, "bad"),
         (1.0, 1, 1, 1.0, 0.5, 0.5, 2.0, 2.0, 0.0, "bad")],
        "spend double, impressions long, conversions long, revenue double, ctr double, cvr double, cpc double, cpm double, "
        "cpa double, quality_label string",
    )
    plain, advanced = rollups.summary(scored).first(), rollups.advanced_summary(scored).first()
    assert (plain.avg_ctr, plain.avg_cpa, plain.good, plain.bad) == (0.333333, 2.0, 1, 2)
    assert (advanced.avg_ctr, advanced.avg_cpa) == (0.3333, 4.0)


def test_filters(make_ads):
    scored = quality.score_ads(make_ads({}, dict(conversions=0), dict(age_group="65+ X", spend=99.0)))
    assert filters.filter_ads(scored, age_group="65+ x").count() == 1
    assert filters.filter_ads(scored, quality_label="GOOD").count() == 2
    assert filters.filter_ads(scored, max_cpa=1e9).count() == 2
    assert filters.filter_ads(scored, min_ctr=0.0).count() == 3
    assert filters.filter_ads(scored, campaign_id="c1").count() == 0
    recs = segments.recommend(scored)
    assert filters.filter_segments(recs, age_group="65+ x").count() == 0
    assert filters.filter_segments(recs, suggested_action=recs.first().suggested_action.upper()).count() >= 1


def test_first_rows_and_pages(spark):
    df = spark.range(10)
    assert [tuple(r) for r in filters.first_rows(df, [F.desc("id")], 2).collect()] == [(9, 10), (8, 10)]
    assert [tuple(r) for r in filters.page_rows(df, ["id"], page=2, page_size=4).collect()] == [(4, 10), (5, 10), (6, 10), (7, 10)]
    assert filters.page_rows(df, ["id"], page=-1, page_size=0).count() == 1
    assert filters.page_rows(spark.range(1500), ["id"], page_size=1200).count() == 1200


def test_pages_after_a_row_continue_the_listing(spark):
    df = spark.range(20).selectExpr("id", "id div 3 AS t")
    whole = [r.id for r in df.orderBy(F.desc("t"), F.desc("id")).collect()]
    assert [r.id for r in filters.rows_after(df, "t", "id", 5, 16, 4).collect()] == whole[4:8]


def test_contract(make_ads):
    scored = quality.score_ads(make_ads({}))
    recs = segments.recommend(scored)
    assert set(column(rollups.contract_violations(scored, recs), "violations")) == {0}
    broken = scored.withColumn("quality_label", F.lit(None).cast("string"))
    bad = {r.rule: r.violations for r in rollups.contract_violations(broken, recs.limit(0)).collect()}
    assert bad == {"scored_not_empty": 0, "label_domain": 1, "recommendations_not_empty": 1, "action_domain": 0,
                   "weight_not_negative": 0}


def test_quality_distribution_keeps_absent_labels(make_ads):
    rows = rollups.quality_distribution(quality.score_ads(make_ads({}))).collect()
    assert [(r.label, r.value) for r in rows] == [("good", 1), ("average", 0), ("bad", 0)]


def test_filter_options(make_ads):
    scored = quality.score_ads(make_ads({}, dict(campaign_id=""), dict(age_group=None)))
    rows = rollups.filter_options(scored, segments.recommend(scored)).collect()
    assert [tuple(r) for r in rows] == [
        ("age_groups", "18-24"), ("campaign_ids", "C1"), ("quality_labels", "good"), ("suggested_actions", "keep_and_test"),
    ]


@pytest.mark.parametrize(("rois", "want"), [([5.0], "low"), ([0.0, 100.0], "medium"), ([0.0, 200.0], "high"), ([1.0, 2.0], "low")])
def test_risk(spark, rois, want):
    df = spark.createDataFrame([(r,) for r in rois], "roi_pct double")
    assert stats.risk_level(df).first().risk_level == want


def test_efficiency_uses_the_original_currency(spark):
    kpis = spark.createDataFrame([(2.0, 30.0)], "roas double, cpa double")
    assert stats.efficiency_score(kpis).first()[0] == 32
    assert stats.efficiency_score(kpis.withColumn("cpa", F.col("cpa") * 25000), 25000).first()[0] == 32
    assert stats.efficiency_score(kpis, 0).first()[0] == 63


def test_picks_and_insights(make_ads):
    ads = make_ads(
        dict(platform="A", campaign_id="C1", revenue=50.0), dict(platform="B", campaign_id="C2", conversions=1, revenue=5.0)
    )
    picks = planning.optimization_picks(ads).collect()
    assert [(p.position, p.name) for p in picks] == [
        (1, "A"), (2, "B"), (3, "A | 18-24"), (4, "B | 18-24"), (5, "C1"), (6, "C2"),
    ]
    assert picks[0].detail == "ROAS 5.00x | ROI 400.0% | CPA 1 ₫"
    found = planning.insights(ads).collect()
    assert [r.kind for r in found] == ["dataset_scale", "overall", "best_platform", "cost_risk", "top_campaign"]
    poor = make_ads(dict(revenue=1.0))
    assert planning.insights(poor).collect()[-1].kind == "negative_roi"
    none = poor.limit(0)
    assert planning.optimization_picks(none).collect() == []
    assert column(planning.insights(none), "message") == ["Dataset scale: 0 rows", "Overall CTR: 0.00% | CVR: 0.00%"]


def test_ties_are_broken_by_key(make_ads):
    ads = make_ads(dict(platform="B"), dict(platform="A", campaign_id="C0"))
    assert [p.name for p in planning.optimization_picks(ads).collect() if p.position in (1, 5)] == ["A", "C0"]


def test_profile_and_distinct(make_ads):
    df = make_ads({}, dict(platform=None, date="2026-05-02"))
    row = rollups.profile(df).first()
    assert (row.row_count, row.column_count, row.missing_platform, row.missing_spend) == (2, 10, 1, 0)
    assert (row.min_date, row.max_date) == ("2026-04-01", "2026-05-02")
    assert rollups.distinct_counts(df).first().distinct_platform == 1
    assert rollups.distinct_counts(df, approximate=True).first().distinct_campaign_id == 1
