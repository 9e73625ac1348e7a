"""Ready-made queries over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.config import AD_COLUMNS, AD_SCHEMA, METRICS, RECOMMENDATION_COLUMNS
from adtally.functions import kpi, text
from adtally.functions.numeric import round_columns, total
from adtally.operators import (
    accounts,
    cleaning,
    filters,
    models,
    order_stats,
    performance,
    planning,
    quality,
    registry,
    rollups,
    segments,
    stats,
)
from adtally.plans import jobs, views
from adtally.sources import readers, runlog, writers
from adtally.sources.workdir import new_folder, written
from adtally.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUDGET = 10000.0


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def scored(spark: SparkSession, d: str, mode: str = "additive") -> DataFrame:
    return quality.score_ads(views.ads(spark, d), mode)


def recommendations(spark: SparkSession, d: str) -> DataFrame:
    return segments.recommend(scored(spark, d), ordered=False)


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """Ads as if each month had been landed as a file of its own."""
    return views.ads(spark, d).withColumn("batch_id", F.date_format("date", "yyyy-MM"))


def repaired(spark: SparkSession, d: str) -> DataFrame:
    """The dirty ads with unreadable numbers as 0; blank campaigns, unknown ages, null platforms and bad dates stay.

    They are written once: what reads them mentions each number many times, and every mention would read its text again.
    """
    ads = cleaning.coerce_metrics(views.dirty_ads(spark, d))
    return written(ads.withColumns({c: F.col(c).cast("bigint") for c in ("impressions", "clicks", "conversions")}), "repaired")


# --- scans, repair, cleaning


@query
def scan_ads(spark, d):
    path = writers.write_csv(views.ads(spark, d), new_folder(spark, "ads-csv"))
    return readers.read_ads_csv(spark, path)


@query
def landed_rows(spark, d):
    source = writers.write_csv(views.ads(spark, d), new_folder(spark, "upload"))
    return readers.read_ads_csv(spark, writers.land_file(spark, source, new_folder(spark, "landed")))


@query
def newest_batch(spark, d):
    path = new_folder(spark, "batches")
    writers.append_batch(views.ads(spark, d).where("clicks > 100"), path, "20260101")
    writers.append_batch(views.ads(spark, d), path, "20260102")
    return readers.read_latest_batch(spark, path).select(*AD_COLUMNS)


@query
def newest_file(spark, d):
    """The larger of two exports, written after the smaller one; an export's parts are one file."""
    path = new_folder(spark, "exports")
    writers.write_csv(views.ads(spark, d).where("clicks > 100"), f"{path}/first")
    writers.write_csv(views.ads(spark, d), f"{path}/second")
    return readers.read_newest_file(spark, f"{path}/*/*.csv", AD_SCHEMA)


@query
def asset_freshness(spark, d):
    """Whether each table is there, without its age; one is not."""
    assets = {name: f"{d}/{name}.parquet" for name in ("lineitem", "orders", "no_such_table")}
    return readers.freshness(spark, assets).select("asset", "exists", F.col("age_minutes").isNull().alias("no_age"))


@query
def typed_scored_ads(spark, d):
    return readers.typed_scored(views.dirty_ads(spark, d).withColumn("quality_score", F.concat("clicks", F.lit(".7"))))


@query
def canonicalize_missing(spark, d):
    return cleaning.canonicalize(views.ads(spark, d).select("ad_id", "campaign_id", "clicks", "spend"))


@query
def coerce_numeric(spark, d):
    return cleaning.coerce_metrics(views.dirty_ads(spark, d)).select("ad_id", *METRICS)


@query
def coerce_clip(spark, d):
    return cleaning.coerce_metrics(views.dirty_ads(spark, d), clip=True).select("ad_id", *METRICS)


@query
def convert_currency(spark, d):
    return cleaning.convert_currency(views.dirty_ads(spark, d), 25000).select("ad_id", "spend", "revenue")


@query
def clean_required(spark, d):
    return cleaning.clean(views.dirty_ads(spark, d))


@query
def cleaning_report(spark, d):
    return cleaning.cleaning_report(views.dirty_ads(spark, d))


@query
def dedupe_ads(spark, d):
    return cleaning.dedupe(views.ads(spark, d))


@query
def profile_dataset(spark, d):
    return rollups.profile(views.dirty_ads(spark, d))


@query
def distinct_counts(spark, d):
    return rollups.distinct_counts(views.ads(spark, d))


@query
def typed_table(spark, d):
    typed = writers.typed_table(views.dirty_ads(spark, d))
    return typed.withColumns({c: F.col(c).cast("double") for c in ("spend", "revenue")})


@query
def typed_load_counts(spark, d):
    path = new_folder(spark, "typed-table")
    writers.typed_table(views.ads(spark, d)).write.parquet(path)
    return writers.load_counts(spark.read.parquet(path))


@query
def quality_contract(spark, d):
    s = written(scored(spark, d), "scored")
    return rollups.contract_violations(s, segments.recommend(s, ordered=False))


@query
def export_roundtrip(spark, d):
    recs = segments.recommend(scored(spark, d))
    first = writers.export(recs, new_folder(spark, "export"), "parquet")
    written = spark.read.parquet(first)
    out = written.withColumn("format", F.lit("parquet"))
    for fmt in ("csv", "json"):
        path = writers.export(written, new_folder(spark, "export"), fmt)
        back = spark.read.schema(written.schema).format(fmt).option("header", True).load(path)
        out = out.unionByName(back.withColumn("format", F.lit(fmt)))
    return out


@query
def stage_run_log(spark, d):
    out = new_folder(spark, "stages")
    jobs.run_pipeline(spark, views.ads(spark, d), out)
    runs = runlog.read_runs(spark, f"{out}/metadata")
    return runs.select("stage", "status", F.explode("counts").alias("counter", "value"))


@query
def latest_stage(spark, d):
    out = new_folder(spark, "stages")
    jobs.run_pipeline(spark, views.ads(spark, d), out, "cleaning")
    jobs.run_pipeline(spark, views.ads(spark, d), out, "features")
    last = runlog.latest_status(spark, f"{out}/metadata")
    return last.select("status", "record.stage", F.col("record.counts")["total_records"].alias("total_records"), F.col("record.counts")["with_cpa"].alias("with_cpa"))


@query
def upload_log_after_append(spark, d):
    """Entries of two uploads, each with the rows that its rebuild wrote."""
    log = new_folder(spark, "upload-log")
    for name, ads in (("all.csv", views.ads(spark, d)), ("facebook.csv", views.ads(spark, d).where("platform = 'Facebook'"))):
        counts = jobs.rebuild(spark, ads, new_folder(spark, "rebuild"), "20260101")
        jobs.append_upload_log(jobs.upload_log_row(spark, counts, name, f"uploads/{name}", "analyst", "ann"), log)
    return spark.read.parquet(log).drop("uploaded_at")


@query
def single_stages(spark, d):
    out = new_folder(spark, "stages")
    jobs.run_pipeline(spark, views.ads(spark, d), out, "cleaning")
    jobs.run_pipeline(spark, views.ads(spark, d), out, "features")
    return spark.read.parquet(f"{out}/features_engineered").select("ad_id", "clicks", "cpa")


@query
def rebuild_upload(spark, d):
    out = new_folder(spark, "rebuild")
    jobs.rebuild(spark, views.ads(spark, d), out, "20260101")
    return spark.read.parquet(f"{out}/budget_recommendations").select(*RECOMMENDATION_COLUMNS)


@query
def segment_report_csv(spark, d):
    told = segments.explain(recommendations(spark, d)).select(*writers.SEGMENT_REPORT)
    path = writers.write_report(told, writers.SEGMENT_REPORT, new_folder(spark, "report"))
    return spark.read.schema(told.schema).option("header", True).csv(path)


@query
def kpi_row_csv(spark, d):
    """The KPI row as a file of one line below its header."""
    row = rollups.overall_kpis(views.ads(spark, d))
    path = writers.write_csv(row, new_folder(spark, "kpi-row"), single_file=True)
    return spark.read.schema(row.schema).option("header", True).csv(path)


# --- KPIs, quality, formats


@query
def row_kpis(spark, d):
    return quality.add_kpis(views.ads(spark, d))


@query
def kpi_scalars(spark, d):
    return views.ads(spark, d).select(
        "ad_id",
        kpi.cpm_rounded("spend", "impressions").alias("cpm"),
        kpi.roi_rounded("revenue", "spend").alias("roi"),
        kpi.roas_rounded("revenue", "spend").alias("roas"),
        kpi.cost_per_conversion("spend", "conversions").alias("cost_per_conversion"),
    )


@query
def overall_kpis(spark, d):
    return rollups.overall_kpis(views.ads(spark, d))


@query
def quality_additive(spark, d):
    return scored(spark, d).select("ad_id", "cpa", "quality_score", "quality_label")


@query
def quality_tiered(spark, d):
    return scored(spark, d, "tiered").select("ad_id", "cpa", "quality_score", "quality_label")


@query
def scored_ads(spark, d):
    return scored(spark, d)


@query
def cpa_median(spark, d):
    return round_columns(stats.cpa_median(quality.add_kpis(views.ads(spark, d))), 9, "cpa_median")


@query
def cpa_median_approx(spark, d):
    return stats.cpa_median(quality.add_kpis(views.ads(spark, d)), "approx")


@query
def cpa_median_approx_check(spark, d):
    """Whether the sketched median stands within its promised rank error of the middle."""
    kpis = quality.add_kpis(views.ads(spark, d)).where("cpa is not null")
    middle = stats.cpa_median(kpis, "approx").scalar()
    below, upto = F.count_if(F.col("cpa") < F.col("m")), F.count_if(F.col("cpa") <= F.col("m"))
    share = kpis.select("cpa", middle.alias("m")).agg(below.alias("lo"), upto.alias("hi"), F.count("*").alias("n"))
    slack = F.col("n") * 1e-4 + 1
    return share.select(((F.col("lo") <= F.col("n") / 2 + slack) & (F.col("hi") >= F.col("n") / 2 - slack)).alias("within_error"))


@query
def batch_quality(spark, d):
    rows = quality.score_ads(monthly(spark, d), by=["batch_id"])
    counts = rows.groupBy("batch_id").agg(
        F.count("*").alias("ads_count"),
        *[F.count_if(F.col("quality_label") == n).alias(f"{n}_count") for n in ("good", "average", "bad")],
    )
    medians = stats.cpa_median(quality.add_kpis(monthly(spark, d)), by=["batch_id"])
    return round_columns(counts.join(medians, "batch_id"), 9, "cpa_median")


@query
def batch_quality_dirty(spark, d):
    """Ads judged by platform, those without one as a group of their own."""
    ads = repaired(spark, d)
    rows = quality.score_ads(ads, by=["platform"])
    counts = rows.groupBy("platform").agg(
        F.count("*").alias("ads_count"),
        *[F.count_if(F.col("quality_label") == n).alias(f"{n}_count") for n in ("good", "average", "bad")],
    )
    medians = stats.cpa_median(quality.add_kpis(ads), by=["platform"])
    return round_columns(stats.join_groups(counts, medians, ["platform"]), 9, "cpa_median")


@query
def small_money_totals(spark, d):
    tiny = views.ads(spark, d).select("campaign_id", (F.col("spend") * 1e-9).alias("tiny"))
    sums = tiny.groupBy("campaign_id").agg(total(tiny, "tiny").alias("tiny"))
    return round_columns(sums, 12, "tiny")


@query
def batch_recommendations(spark, d):
    rows = quality.score_ads(monthly(spark, d), by=["batch_id"])
    return segments.recommend(rows, by=["batch_id"], ordered=False)


@query
def explain_segments(spark, d):
    return segments.explain(recommendations(spark, d)).select("segment_id", "explanation")


@query
def explain_one_segment(spark, d):
    return segments.explain_one(recommendations(spark, d), "CAMP_003|25-34")


@query
def format_metrics(spark, d):
    return quality.add_kpis(views.ads(spark, d)).select(
        "ad_id",
        text.human_number("impressions").alias("impressions"),
        text.human_number("spend").alias("spend"),
        text.human_number(F.col("revenue") * 1e4).alias("revenue"),
        text.percent_text(F.col("ctr") * 100).alias("ctr"),
        text.currency_text(F.col("spend") * 25000.0 + 0.5).alias("amount"),
    )


@query
def format_timestamps(spark, d):
    return views.sessions(spark, d).select(
        "session_token", text.zoned_text("created_at").alias("started"), text.zoned_text("expires_at").alias("expires")
    )


@query
def valid_age_band(spark, d):
    return views.ads(spark, d).select("ad_id", "age_group", text.is_age_band("age_group").alias("valid"))


# --- filters and listings


@query
def filter_ads(spark, d):
    return filters.filter_ads(scored(spark, d), "CAMP_003", "25-34", "GOOD", min_ctr=0.02, max_cpa=5.0)


@query
def filter_segments(spark, d):
    return filters.filter_segments(recommendations(spark, d), "CAMP_003", suggested_action="REDUCE_BUDGET")


@query
def list_ads(spark, d):
    found = written(filters.filter_ads(scored(spark, d), quality_label="Average"), "matches")
    return filters.first_rows(found, AD_COLUMNS, 100)


@query
def search_upload_logs(spark, d):
    found = filters.contains_text(views.upload_logs(spark, d), uploader_name=" 00%1 ", file_name="_O_1")
    return filters.page_rows(found, [F.desc("uploaded_at"), F.desc("id")])


@query
def upload_logs_page(spark, d):
    return filters.page_rows(views.upload_logs(spark, d), [F.desc("uploaded_at"), F.desc("id")], page=3)


@query
def upload_logs_after(spark, d):
    last = F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))
    return filters.rows_after(views.upload_logs(spark, d), "uploaded_at", "id", last, 5000, 50)


@query
def list_users(spark, d):
    return accounts.list_users(views.users(spark, d), active=True, role="Analyst", search="1")


@query
def sessions_with_users(spark, d):
    return accounts.sessions_with_users(views.sessions(spark, d), views.users(spark, d), active=True)


@query
def list_sessions(spark, d):
    return accounts.list_sessions(views.sessions(spark, d), views.users(spark, d), active=True, offset=20)


@query
def user_online_status(spark, d):
    return accounts.user_status(views.users(spark, d), views.sessions(spark, d))


@query
def users_online(spark, d):
    return accounts.users_online(views.users(spark, d), views.sessions(spark, d))


@query
def users_offline(spark, d):
    return accounts.users_offline(views.users(spark, d), views.sessions(spark, d))


@query
def account_kpis(spark, d):
    return accounts.account_kpis(views.users(spark, d), views.sessions(spark, d))


@query
def last_login(spark, d):
    return accounts.last_login(views.sessions(spark, d))


@query
def ads_with_action(spark, d):
    s = written(scored(spark, d), "scored")
    return planning.with_actions(s, segments.recommend(s, ordered=False)).select(
        "ad_id", "campaign_id", "age_group", "quality_label", "recommendation_score", "suggested_action"
    )


# --- rollups


@query
def campaign_aggregation(spark, d):
    means = ["avg_ctr", "avg_cpc", "avg_cpm", "avg_cvr", "avg_cpa", "avg_quality_score"]
    return round_columns(rollups.campaign_rollup(scored(spark, d, "tiered")), 6, *means)


@query
def age_aggregation(spark, d):
    means = ["avg_ctr", "avg_cpc", "avg_cpm", "avg_cvr", "avg_cpa"]
    return round_columns(rollups.age_rollup(quality.add_kpis(views.ads(spark, d))), 6, *means)


@query
def summary(spark, d):
    return rollups.summary(scored(spark, d))


@query
def summary_filtered(spark, d):
    return rollups.summary(filters.filter_ads(scored(spark, d), "CAMP_005", quality_label="bad"))


@query
def summary_no_match(spark, d):
    return rollups.summary(filters.filter_ads(scored(spark, d), "no such campaign"))


@query
def advanced_summary(spark, d):
    return rollups.advanced_summary(quality.add_kpis(views.ads(spark, d)))


@query
def ctr_by_platform_age(spark, d):
    return rollups.ctr_by(views.ads(spark, d))


@query
def cvr_by_age(spark, d):
    return rollups.cvr_by(views.ads(spark, d))


@query
def clicks_by_age(spark, d):
    return rollups.clicks_by(views.ads(spark, d))


@query
def quality_distribution(spark, d):
    return rollups.quality_distribution(scored(spark, d))


@query
def filter_options(spark, d):
    s = written(scored(spark, d), "scored")
    return rollups.filter_options(s, segments.recommend(s, ordered=False))


@query
def campaign_ranking(spark, d):
    return rollups.campaign_ranking(performance.performance(views.ads(spark, d), ["campaign_id"]))


@query
def ranking_with_gaps(spark, d):
    """Campaigns without a known return share the last rank."""
    rows = performance.performance(views.ads(spark, d), ["campaign_id"])
    roi = F.when(F.col("campaign_id") == "CAMP_001", F.lit(float("nan"))).when(F.col("campaign_id") != "CAMP_002", F.col("roi_pct"))
    return order_stats.global_rank(rows.select("campaign_id", roi.alias("roi")), "roi", "place").select("campaign_id", "place")


@query
def cpc_vs_cvr_by_campaign(spark, d):
    return rollups.cpc_vs_cvr(performance.performance(views.ads(spark, d), ["campaign_id"]))


@query
def risk_level(spark, d):
    return stats.risk_level(performance.performance(views.ads(spark, d), ["campaign_id"]))


@query
def efficiency_score(spark, d):
    return stats.efficiency_score(rollups.overall_kpis(views.ads(spark, d)))


# --- performance and charts


@query
def perf_platform(spark, d):
    return performance.performance(views.ads(spark, d), ["platform"])


@query
def platforms_dirty(spark, d):
    return performance.performance(repaired(spark, d), ["platform"])


@query
def perf_campaign(spark, d):
    return performance.performance(views.ads(spark, d), ["campaign_id"])


@query
def perf_segment(spark, d):
    return performance.by_segment(views.ads(spark, d))


@query
def roi_by_platform(spark, d):
    return performance.platforms_by_roi(performance.performance(views.ads(spark, d), ["platform"]))


@query
def kpi_by_campaign(spark, d):
    return performance.kpi_by_dimension(quality.add_kpis(views.ads(spark, d)))


@query
def kpi_by_platform(spark, d):
    return performance.kpi_by_dimension(filters.filter_ads(scored(spark, d), quality_label="good"), "platform")


@query
def kpi_by_age(spark, d):
    return performance.kpi_by_age(quality.add_kpis(views.ads(spark, d)))


@query
def ctr_heatmap(spark, d):
    return performance.ctr_heatmap(views.ads(spark, d), views.PLATFORMS)


@query
def conversion_funnel(spark, d):
    return performance.conversion_funnel(rollups.overall_kpis(views.ads(spark, d)))


@query
def daily_series(spark, d):
    return performance.daily_series(views.ads(spark, d))


@query
def daily_dirty(spark, d):
    return performance.daily_series(repaired(spark, d))


@query
def spend_vs_revenue_daily(spark, d):
    return performance.spend_vs_revenue(performance.daily_series(views.ads(spark, d)))


@query
def kpi_trends(spark, d):
    return performance.kpi_trends(performance.daily_series(views.ads(spark, d)))


# --- segments and budgets


@query
def segment_features(spark, d):
    names = ["avg_ctr", "avg_cvr", "avg_cpa", "good_ratio", "cpa_inverse"]
    return round_columns(segments.segment_features(scored(spark, d)), 6, *names)


@query
def segments_dirty(spark, d):
    names = ["avg_ctr", "avg_cvr", "avg_cpa", "good_ratio", "cpa_inverse", "conversion_per_spend"]
    return round_columns(segments.segment_features(quality.score_ads(repaired(spark, d))), 6, *names)


@query
def segment_normalized(spark, d):
    names = [f"norm_{n}" for n in segments.WEIGHTS.features]
    normalized = segments.normalize_features(segments.segment_features(scored(spark, d)))
    return round_columns(normalized.select("campaign_id", "age_group", *names), 6, *names)


@query
def segment_actions(spark, d):
    normalized = segments.normalize_features(segments.segment_features(scored(spark, d)))
    return segments.score_segments(normalized).select(
        "campaign_id", "age_group", "recommendation_score", "suggested_action"
    )


@query
def budget_recommendations(spark, d):
    return segments.recommend(scored(spark, d))


@query
def top_segments(spark, d):
    kept = filters.filter_segments(recommendations(spark, d), suggested_action="keep_and_test")
    return planning.top_segments(kept)


@query
def budget_plan(spark, d):
    return planning.budget_plan(recommendations(spark, d), BUDGET)


@query
def budget_plan_totals(spark, d):
    return planning.plan_totals(planning.budget_plan(recommendations(spark, d), BUDGET), BUDGET)


@query
def report_plan(spark, d):
    s = written(scored(spark, d), "scored")
    return planning.report_plan(s, segments.recommend(s, ordered=False))


@query
def combined_report(spark, d):
    """All parts of the report as one list of figures."""
    s = written(scored(spark, d), "scored")
    parts = planning.report(s, written(segments.recommend(s, ordered=False), "recommendations"))

    def figures(part: str, item, value):
        return parts[part].select(F.lit(part).alias("part"), item.alias("item"), value.cast("double").alias("value"))

    return (
        figures("summary", F.lit("total_ads"), F.col("total_ads"))
        .union(figures("summary", F.lit("total_spent"), F.col("total_spent")))
        .union(figures("campaign_kpi", F.col("label"), F.col("spend")))
        .union(figures("recommendation_count", F.lit("segments"), F.col("recommendation_count")))
        .union(figures("recommendations", F.col("segment_id"), F.col("recommendation_score")))
        .union(figures("recommendation_plan", F.col("segment_id"), F.col("allocated_budget")))
    )


@query
def platform_reallocation(spark, d):
    platforms = performance.performance(views.ads(spark, d), ["platform"])
    return round_columns(planning.reallocate(platforms), 6, "recommended_spend", "delta")


@query
def reallocation_top(spark, d):
    platforms = performance.performance(views.ads(spark, d), ["platform"])
    return round_columns(planning.top_reallocations(planning.reallocate(platforms), 3), 6, "recommended_spend", "delta")


@query
def optimization_picks(spark, d):
    return planning.optimization_picks(views.ads(spark, d))


@query
def insights(spark, d):
    return planning.insights(views.ads(spark, d))


@query
def high_roi_campaigns(spark, d):
    return rollups.high_roi_campaigns(views.ads(spark, d))


@query
def top_roi_campaigns(spark, d):
    return rollups.top_profit_campaigns(views.ads(spark, d))


@query
def top_campaigns_roas(spark, d):
    return planning.top_campaigns_by_roas(performance.performance(views.ads(spark, d), ["campaign_id"]))


# --- registry


@query
def active_dataset(spark, d):
    return registry.active_dataset(views.datasets(spark, d))


@query
def dataset_history(spark, d):
    return registry.dataset_history(views.datasets(spark, d))


@query
def dataset_state(spark, d):
    return registry.dataset_state(views.dataset_events(spark, d))


@query
def latest_runs(spark, d):
    return registry.latest_runs(views.runs(spark, d))


@query
def dashboard_overview(spark, d):
    row = registry.dashboard_overview(rollups.summary(scored(spark, d)), views.datasets(spark, d))
    ids = F.transform("dataset_history", lambda x: x["id"].cast("string"))
    return row.select(
        "total_records",
        "has_data",
        F.col("summary.good").alias("good"),
        F.col("active_dataset.id").alias("active_id"),
        F.concat_ws(",", ids).alias("history_ids"),
    )


# --- models and streams


@query
def classifier_train_summary(spark, d):
    return models.summary_row(spark, models.train_classifier(scored(spark, d), new_folder(spark, "model")))


@query
def classifier_predictions(spark, d):
    rows = written(scored(spark, d), "scored")
    model = models.train_classifier(rows, new_folder(spark, "model")).model
    return models.predict_effectiveness(model, rows.select("ad_id", *models.CLASSIFIER_FEATURES))


@query
def predictor_train_summary(spark, d):
    return models.summary_row(spark, models.train_predictor(quality.add_kpis(views.ads(spark, d)), new_folder(spark, "model")))


@query
def predictor_predictions(spark, d):
    rows = written(quality.add_kpis(views.ads(spark, d)), "kpis")
    model = models.train_predictor(rows, new_folder(spark, "model")).model
    return models.predict_conversions(model, rows.select("ad_id", *models.PREDICTOR_FEATURES))


@query
def predictor_residuals_check(spark, d):
    """Least squares leaves residuals that add up to 0 and are orthogonal to every feature, relative to their sizes."""
    rows = written(quality.add_kpis(views.ads(spark, d)), "kpis")
    model = models.train_predictor(rows, new_folder(spark, "model")).model
    return models.residual_check(model, rows)


@query
def classifier_check(spark, d):
    """Rows, and rows whose probabilities do not add up to 1 or whose label is not the likeliest."""
    rows = written(scored(spark, d), "scored")
    model = models.train_classifier(rows, new_folder(spark, "model")).model
    found = models.predict_effectiveness(model, rows.select("ad_id", *models.CLASSIFIER_FEATURES))
    p = F.col("probabilities")
    odd = (F.abs(F.aggregate(F.map_values(p), F.lit(0.0), lambda t, x: t + x) - 1) > 1e-9) | (F.element_at(p, F.col("prediction_label")) < F.col("confidence"))
    return found.agg(F.count("*").alias("row_count"), F.count_if(odd).alias("odd_rows"))


@query
def rule_baseline_metrics(spark, d):
    return models.rule_metrics(quality.add_kpis(views.ads(spark, d)))


@query
def model_eval(spark, d):
    rows = written(quality.add_kpis(views.ads(spark, d)), "kpis")
    return models.evaluate(rows, models.train_conversion_model(rows, new_folder(spark, "model")))


@query
def model_top_features(spark, d):
    rows = quality.add_kpis(views.ads(spark, d))
    return models.top_features(spark, models.train_conversion_model(rows, new_folder(spark, "model")))


@query
def stream_landing_kpis(spark, d):
    source = writers.write_csv(views.ads(spark, d), new_folder(spark, "landing"))
    out, state = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    stream = landing.with_row_kpis(landing.stream_ads(spark, source))
    landing.append_available(stream, out, state).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_daily_platform(spark, d):
    schema = views.table(spark, d, "lineitem").schema
    facts = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    out, state = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    landing.append_available(views.ads_of(facts), out, state).awaitTermination()
    return landing.daily_platform(spark.read.parquet(out))
