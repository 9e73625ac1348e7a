"""Cases in which rows or digits used to go missing."""

import pytest

from adtally.config import AD_COLUMNS
from adtally.functions.numeric import exact_sum
from adtally.operators import accounts, cleaning, quality
from adtally.operators.order_stats import global_rank, roc_area
from adtally.sources import readers, writers
from adtally.streaming import landing


def test_a_landed_file_of_many_parts_keeps_every_row(spark, tmp_path):
    source = tmp_path / "big.csv"
    source.write_text(",".join(AD_COLUMNS) + "\n" + "".join(f"{i},C,2026-04-01,P,A,1,1,1,1,1\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        target = writers.land_file(spark, str(source), str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    ads = readers.read_ads_csv(spark, target)
    assert len(ads.inputFiles()) > 3 and ads.select("ad_id").distinct().count() == ads.count() == 3000


def test_ads_without_a_batch_are_scored(make_ads):
    ads = make_ads(*[dict(platform=p) for p in ("A", "A", None, None, "B")])
    assert quality.score_ads(ads, by=["platform"]).count() == 5


def test_small_and_odd_amounts_add_up(spark):
    df = spark.createDataFrame([(4e-7,)] * 1000 + [(float("inf"),), (float("nan"),), (None,)], "x double")
    assert float(df.agg(exact_sum(df, "x")).first()[0]) == pytest.approx(4e-4, abs=1e-15)


def test_ranks_hold_rows_without_a_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("d", float("nan"))], "id string, v double")
    assert {r.id: r.place for r in global_rank(df, "v", "place").collect()} == {"b": 1, "a": 2, "c": 3, "d": 3}


def test_scores_that_crowd_at_one_end_have_an_exact_area(spark):
    rows = [(1 - 2.0**-i, i % 3 % 2) for i in range(30, 50)] + [(1.0, 1), (0.0, 0)]
    pairs = [(p, n) for p, y in rows for n, z in rows if y == 1 and z == 0]
    want = sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs)
    assert roc_area(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()[0] == pytest.approx(want)


def test_rows_without_a_key_are_no_copies(make_ads):
    ads = make_ads(dict(ad_id=None), dict(ad_id=None), dict(ad_id=7), dict(ad_id=7))
    assert cleaning.dedupe(ads).count() == 3


def test_users_of_one_name_all_show_their_sessions(spark):
    users = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id long, username string")
    sessions = spark.createDataFrame([(f"t{i}", i, f"2026-01-0{i}", True) for i in (1, 2, 3)], "session_token string, user_id long, created_at string, is_active boolean")
    found = accounts.list_sessions(sessions, users, username="x", limit=2000).collect()
    assert {r.session_token for r in found} == {"t1", "t2"} and found[0].total == 2


def test_days_of_late_files_are_whole(spark, make_ads, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for month in ("07", "04", "05"):
        make_ads(*[dict(date=f"2026-{month}-{d:02d}") for d in range(1, 29)]).coalesce(1).write.mode("append").option("header", True).csv(source)
    landing.append_available(landing.stream_ads(spark, source, files_per_batch=1), out, state).awaitTermination()
    assert landing.daily_platform(spark.read.parquet(out)).count() == 84


def test_a_value_beyond_bigint_is_no_wrong_sum(spark):
    df = spark.createDataFrame([(9.2e18,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert float(df.agg(exact_sum(df, "x")).first()[0]) == 9.2e18
    for far in (1e30, -1e30, 2.0**63):
        rows = df.union(spark.createDataFrame([(far,)], "x double"))
        with pytest.raises(Exception, match="beyond bigint"):
            rows.agg(exact_sum(rows, "x")).collect()
