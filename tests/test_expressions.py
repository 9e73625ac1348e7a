import pytest
from pyspark.sql import functions as F

from adtally.functions import kpi, text
from adtally.functions.numeric import exact_sum, number_or_null, ratio_any_sign, round_columns, round_half_up, total


def one(spark, column, **values):
    kinds = {int: "long", float: "double", str: "string"}
    fields = ", ".join(f"{n} {kinds.get(type(v), 'double')}" for n, v in values.items()) or "x long"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], fields).select(column.alias("r")).first()["r"]


def test_undefined_ratios_are_zero_but_cpa_is_null(make_ads):
    row = make_ads(dict(impressions=0, clicks=0, conversions=0)).select("*", *kpi.row_kpis()).first()
    assert (row.ctr, row.cpc, row.cpm, row.cvr) == (0.0, 0.0, 0.0, 0.0)
    assert row.cpa is None


def test_row_kpis(make_ads):
    row = make_ads({}).select("*", *kpi.row_kpis()).first()
    assert (row.ctr, row.cpc, row.cpm, row.cvr, row.cpa) == (0.1, 0.1, 10.0, 0.1, 1.0)


def test_cpa_zero_mode(spark):
    c = kpi.cpa("s", "c", zero_as_null=False)
    assert one(spark, c, s=5.0, c=0) == 0.0


@pytest.mark.parametrize("fn", [kpi.cpm_rounded, kpi.roas_rounded, kpi.cost_per_conversion, kpi.roi_rounded])
def test_rounded_kpis_without_denominator(spark, fn):
    assert one(spark, fn("a", "b"), a=5.0, b=0.0) == 0.0
    assert one(spark, fn("a", "b"), a=5.0, b=-1.0) == 0.0


def test_rounded_kpis(spark):
    assert one(spark, kpi.cpm_rounded("a", "b"), a=1.0, b=3000.0) == 0.33
    assert one(spark, kpi.roi_rounded("a", "b"), a=1.0, b=3.0) == -66.67
    assert one(spark, kpi.roas_rounded("a", "b"), a=2.0, b=3.0) == 0.67


def test_negative_denominator_divides_only_in_ratio_any_sign(spark):
    assert one(spark, ratio_any_sign("a", "b"), a=4.0, b=-2.0) == -2.0
    assert one(spark, ratio_any_sign("a", "b"), a=4.0, b=0.0) == 0.0
    assert one(spark, ratio_any_sign("a", "b"), a=None, b=2.0) == 0.0


@pytest.mark.parametrize(
    ("value", "digits", "want"),
    [(0.1234565, 6, 0.123457), (1.5, 0, 2.0), (-1.234, 2, -1.23), (None, 2, None), (1e300, 6, 1e300)],
)
def test_round_half_up(spark, value, digits, want):
    assert one(spark, round_half_up("v", digits), v=value) == want
    assert round_columns(spark.createDataFrame([(value,)], "v double"), digits, "v").first()["v"] == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("12", 12.0), (" 1.5 ", 1.5), ("-3e2", -300.0), ("abc", None), ("", None), ("1.5d", None), ("0x10", None), ("inf", None)],
)
def test_number_text(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(number_or_null(F.col("s"), df.schema["s"].dataType)).first()[0] == want


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, -0.7, 1e9 + 0.01, 0.015] * 50
    a = spark.createDataFrame([(v,) for v in values], "x double")
    b = spark.createDataFrame([(v,) for v in reversed(values)], "x double")
    sums = [float(df.repartition(3).agg(exact_sum(df, "x")).first()[0]) for df in (a, b)]
    assert sums[0] == sums[1] == pytest.approx(sum(values), abs=1e-6)


def test_totals_of_nothing(spark):
    df = spark.createDataFrame([], "x double, n long")
    row = df.agg(total(df, "x").alias("x"), total(df, "n").alias("n")).first()
    assert (row.x, row.n) == (0.0, 0)


@pytest.mark.parametrize(
    ("value", "want"),
    [(0.0, "0"), (None, "0"), (999.5, "999.50"), (1500.0, "1.5K"), (2_500_000.0, "2.5M"), (-12345.6, "-12,345.60")],
)
def test_human_number(spark, value, want):
    assert one(spark, text.human_number("v"), v=value) == want


def test_percent_and_currency(spark):
    assert one(spark, text.percent_text("v"), v=12.345) == "12.35%"
    assert one(spark, text.percent_text("v"), v=None) == "0%"
    assert one(spark, text.currency_text("v"), v=1234567.5) == "1,234,568 ₫"
    assert one(spark, text.currency_text("v"), v=2.5) == "2 ₫"
    assert one(spark, text.currency_text("v"), v=None) == "0 ₫"
    assert one(spark, text.currency_text("v", 2), v=1234.5) == "1,234.50 ₫"


@pytest.mark.parametrize(
    ("cur", "prev", "want"),
    [(1.0, 1.0, "→ Ổn định"), (1.0, None, "→ Ổn định"), (3.0, 2.0, "↑ 50.0%"), (1.0, 2.0, "↓ 50.0%"), (1.0, 0.0, "↓ 0.0%"),
     (-1.0, -2.0, "↑ 50.0%")],
)
def test_trend_text(spark, cur, prev, want):
    assert one(spark, text.trend_text(F.col("c"), F.col("p")), c=cur, p=prev) == want


def test_zoned_text(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-01 20:00:00' AS t, '2026-01-01T20:00:00' AS s, '' AS e, 'junk' AS j")
    row = df.select(
        text.zoned_text("t"), text.zoned_text("t", "America/New_York"), text.zoned_text_from_string("s"),
        text.zoned_text_from_string("e"), text.zoned_text_from_string("j"), text.zoned_text(F.lit(None)),
    ).first()
    assert list(row) == [
        "2026-01-02 03:00:00 +0700", "2026-01-01 15:00:00 -0500", "2026-01-02 03:00:00 +0700", "-", "junk", "-",
    ]


@pytest.mark.parametrize(("v", "want"), [("18-24", True), ("65+", False), ("a-b", False), ("1-2-3", False)])
def test_age_band(spark, v, want):
    assert one(spark, text.is_age_band("v"), v=v) is want


def test_gender(spark):
    assert [one(spark, text.is_gender("v"), v=v) for v in ("m", "F", "x")] == [True, True, False]


def test_explanation(spark):
    e = text.explanation("a", "cpa", "cvr", "good", "score")
    df = spark.createDataFrame(
        [("increase_budget", 1.234, 0.12345, 0.5, 0.81), ("other", None, None, None, None), ("reduce_budget", 0.0, 0.1, 1.0, 0.2)],
        "a string, cpa double, cvr double, good double, score double",
    )
    assert [r[0] for r in df.select(e).collect()] == [
        "Tang ngan sach do hieu qua tong hop cao; avg_cpa=1.23, avg_cvr=0.1235, good_ratio=0.50, score=0.8100",
        "Giu ngan sach va tiep tuc A/B test; avg_cvr=0.0000, good_ratio=0.00, score=0.0000",
        "Giam ngan sach do hieu qua tong hop thap; avg_cvr=0.1000, good_ratio=1.00, score=0.2000",
    ]
