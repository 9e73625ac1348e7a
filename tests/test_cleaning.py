import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally.operators import cleaning
from adtally.operators.columns import detect_roles, with_roles


def test_missing_columns_are_named_before_any_job(spark):
    df = spark.createDataFrame([(1, 2)], "ad_id int, clicks int")
    with pytest.raises(cleaning.MissingColumnsError, match="campaign_id"):
        cleaning.clean(df)


def test_canonicalize_adds_defaults_and_unique_ids(spark):
    df = cleaning.canonicalize(spark.range(50).repartition(4).select(F.col("id").alias("clicks")))
    rows = df.collect()
    assert len({r.ad_id for r in rows}) == 50 and min(r.ad_id for r in rows) >= 1
    assert (rows[0].platform, rows[0].age_group, rows[0].campaign_id, rows[0].spend) == ("unknown", "unknown", "", 0.0)


def test_scored_defaults_differ(spark):
    row = cleaning.canonicalize_scored(spark.range(1)).first()
    assert (row.quality_label, row.cpa, row.ctr) == ("average", 0.0, 0.0)
    assert "ad_id" not in row.asDict()


def test_coercion_keeps_or_clips_negatives(spark):
    df = spark.createDataFrame([("abc", "-5", None)], "clicks string, spend string, revenue double")
    kept, clipped = cleaning.coerce_metrics(df).first(), cleaning.coerce_metrics(df, clip=True).first()
    assert (kept.clicks, kept.spend, kept.revenue) == (0.0, -5.0, 0.0)
    assert (clipped.clicks, clipped.spend, clipped.revenue) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize(("rate", "want"), [(25000, 50000.0), (0, 2.0), (1, 2.0), (-3, 2.0)])
def test_currency(spark, rate, want):
    df = spark.createDataFrame([(2.0,)], "spend double")
    assert cleaning.convert_currency(df, rate).first().spend == want


def test_cleaning_report_agrees_with_cleaning(make_ads):
    df = make_ads({}, dict(spend=None), dict(campaign_id=None), dict(revenue=None))
    row = cleaning.cleaning_report(df).first()
    assert (row.initial_count, row.final_count, row.removed_rows) == (4, 2, 2)
    assert cleaning.clean(df).count() == 2


def test_dedupe_keeps_the_smallest_or_the_chosen_row(make_ads):
    df = make_ads(dict(ad_id=1, spend=3.0), dict(ad_id=1, spend=1.0), dict(ad_id=2))
    assert sorted((r.ad_id, r.spend) for r in cleaning.dedupe(df).collect()) == [(1, 1.0), (2, 10.0)]
    latest = cleaning.dedupe(df, keep=[F.desc("spend")])
    assert sorted((r.ad_id, r.spend) for r in latest.collect()) == [(1, 3.0), (2, 10.0)]


def test_typed_rows(spark):
    df = spark.createDataFrame(
        [("7", "C", "2026-13-40", "P", "A", "10.9", "x", "3", "1.25", "")],
        "ad_id string, campaign_id string, date string, platform string, age_group string, impressions string, "
        "clicks string, conversions string, spend string, revenue string",
    )
    row = cleaning.to_typed(df).first()
    assert (row.ad_id, row.date, row.impressions, row.clicks, row.spend, row.revenue) == (7, None, 10, None, 1.25, None)


@pytest.mark.parametrize(
    ("text", "want"),
    [("2026-04-01", dt.date(2026, 4, 1)), ("2026-04-01 10:00:00", dt.date(2026, 4, 1)), ("2026-13-40", None), ("", None)],
)
def test_lenient_date(spark, text, want):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(cleaning.lenient_date(F.col("d"))).first()[0] == want


def test_roles_by_header():
    headers = ["Day", "Channel", "Campaign Name", "Age", "Impressions", "Clicks", "conversion_rate", "Conversions",
               "cost_per_click", "Cost", "Sales"]
    assert list(detect_roles(headers).values()) == [
        "Day", "Channel", "Campaign Name", "Age", "Impressions", "Clicks", "Conversions", "Cost", "Sales",
    ]


def test_roles_match_substrings_in_file_order():
    roles = detect_roles(["page", "last_update", "CPC", "spend_total"])
    assert (roles["age_group"], roles["date"], roles["spend"], roles["clicks"]) == ("page", "last_update", "spend_total", None)


def test_with_roles_projects_under_role_names(spark):
    df = spark.createDataFrame([("TikTok", 5.0)], "Channel string, Cost double")
    assert with_roles(df).columns == ["platform", "spend"]
