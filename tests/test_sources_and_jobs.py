import os

import pytest
from pyspark.sql import functions as F

from adtally.config import AD_COLUMNS, AD_SCHEMA, RECOMMENDATION_COLUMNS, SCORED_COLUMNS
from adtally.operators import quality, segments
from adtally.plans import jobs
from adtally.sources import readers, runlog, workdir, writers
from adtally.streaming import landing


@pytest.fixture
def ads(make_ads):
    return make_ads({}, dict(campaign_id="C2", spend=4.5), dict(age_group="25-34", conversions=0), dict(spend=None))


def test_csv_round_trip_keeps_bad_lines(spark, tmp_path):
    lines = [",".join(AD_COLUMNS), "1,C,2026-04-01,P,A,10,1,1,1.5,2.5", "x,C,2026-04-01,P,A,10,1,1,1.5,2.5"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rows = readers.read_ads_csv(spark, str(tmp_path / "*.csv"), keep_corrupt=True).cache().collect()
    assert [(r.ad_id, r[readers.CORRUPT]) for r in rows] == [(1, None), (None, lines[2])]


def test_reports_hold_the_named_columns_in_one_file(spark, ads, tmp_path):
    recs = segments.explain(segments.recommend(quality.score_ads(ads)))
    path = writers.write_report(recs, writers.SEGMENT_REPORT, str(tmp_path / "r"))
    back = readers.read_text_csv(spark, path)
    assert back.columns == writers.SEGMENT_REPORT and back.count() == recs.count()
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def test_export_formats(spark, ads, tmp_path):
    for fmt in writers.FORMATS:
        path = writers.export(ads, str(tmp_path), fmt)
        back = spark.read.schema(ads.schema).format(fmt).option("header", True).load(path)
        assert sorted(back.collect()) == sorted(ads.collect())
    with pytest.raises(ValueError, match="xml"):
        writers.export(ads, str(tmp_path), "xml")


def test_batches_are_kept_and_the_newest_is_read(spark, ads, tmp_path):
    path = str(tmp_path / "t")
    writers.append_batch(ads.limit(1), path, "20260101_000000")
    writers.append_batch(ads, path, "20260201_000000")
    writers.append_batch(ads, path, "20260201_000000")
    assert spark.read.parquet(path).count() == 5
    assert readers.read_latest_batch(spark, path).count() == 4


def test_newest_file_and_lineage(spark, tmp_path):
    import os

    for i, name in enumerate(("old", "new")):
        f = tmp_path / f"{name}.csv"
        f.write_text(",".join(AD_COLUMNS) + f"\n{i},C,2026-04-01,P,A,1,1,1,1,1\n")
        os.utime(f, (1_700_000_000 + i * 100,) * 2)
    assert [r.ad_id for r in readers.read_newest_file(spark, str(tmp_path), AD_SCHEMA).collect()] == [1]
    landed = readers.read_landed(spark, str(tmp_path)).collect()
    assert sorted((r.ad_id, r.source_file) for r in landed) == [(0, "old.csv"), (1, "new.csv")]


def test_newest_file_of_many_parts(spark, ads, tmp_path):
    """The parts of the newest write are one file, parts that an earlier write left beside them are none of it."""
    old, path = ads.limit(1).withColumn("ad_id", F.lit(-1).cast("bigint")), str(tmp_path / "x")
    old.write.option("header", True).csv(path)
    os.utime(next((tmp_path / "x").glob("*.csv")), (1_700_000_000,) * 2)
    ads.repartition(3, "ad_id").write.mode("append").option("header", True).csv(path)
    got = readers.read_newest_file(spark, f"{tmp_path}/*/*.csv", AD_SCHEMA)
    assert sorted(r.ad_id for r in got.collect()) == sorted(r.ad_id for r in ads.collect())


def test_landing_copies_under_the_uploaded_name(spark, tmp_path):
    source = tmp_path / "x.csv"
    source.write_text(",".join(AD_COLUMNS) + "\n1,C,2026-04-01,P,A,1,1,1,1,1\n")
    target = writers.land_file(spark, str(source), str(tmp_path / "raw"))
    assert target.endswith("uploaded_x.csv")
    assert readers.read_ads_csv(spark, target).count() == 1


def test_freshness(spark, ads, tmp_path):
    ads.write.parquet(str(tmp_path / "there"))
    fresh = readers.freshness(spark, {"a": str(tmp_path / "there"), "b": str(tmp_path / "missing")})
    rows = {r.asset: r for r in fresh.collect()}
    assert rows["a"].exists and 0 <= rows["a"].age_minutes < 10 and not rows["b"].exists
    assert readers.all_ready(fresh).first()[0] is False
    assert readers.all_ready(fresh.where("asset = 'a'")).first()[0] is True


def test_typed_table_load(spark, ads):
    writers.load_table(ads, "ads_campaigns_test")
    table = spark.table("ads_campaigns_test")
    assert dict(table.dtypes)["spend"] == "decimal(15,2)"
    assert tuple(writers.load_counts(table).first()) == (4, 2, 2, 1)


def test_typed_results_from_text(spark):
    text = spark.createDataFrame([("s", "3.9", "x")], "segment_id string, ads_count string, avg_cpa string")
    row = readers.typed_recommendations(text).first()
    assert (row.segment_id, row.campaign_id, row.ads_count, row.avg_cpa) == ("s", "", 3, None)


def test_sources_with_different_columns_stack(spark):
    both = readers.union_sources([spark.range(1).toDF("id"), spark.range(1).withColumn("x", F.lit(1))])
    assert sorted(r.x or 0 for r in both.collect()) == [0, 1]


def test_work_folder_comes_from_the_session(spark):
    root = spark.conf.get(workdir.CHECKPOINT_CONF)
    a, b = workdir.new_folder(spark, "x"), workdir.new_folder(spark, "x")
    assert a.startswith(root) and a != b


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_full_run(spark, ads, tmp_path, fmt):
    out = str(tmp_path / "out")
    records = jobs.run_pipeline(spark, ads, out, fmt=fmt)
    assert [r["stage"] for r in records] == ["data_cleaning", "feature_engineering", "aggregation"]
    assert records[0]["counts"] == {"initial_count": 4, "final_count": 3, "removed_rows": 1}
    assert records[1]["counts"] == {"total_records": 3, "with_cpa": 2}
    assert records[2]["counts"] == {"campaign_count": 2, "age_groups": 2}
    assert readers.read_text_csv(spark, f"{out}/features_engineered").columns == SCORED_COLUMNS or fmt == "parquet"
    status = runlog.latest_status(spark, f"{out}/metadata").first()
    assert (status.status, status.record.stage) == ("READY", "aggregation")


def test_single_stages_continue_and_unknown_ones_fail(spark, ads, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_pipeline(spark, ads, out, "cleaning")
    jobs.run_pipeline(spark, ads, out, "features")
    assert jobs.run_pipeline(spark, ads, out, "aggregation")[0]["counts"]["campaign_count"] == 2
    with pytest.raises(ValueError, match="nonsense"):
        jobs.run_pipeline(spark, ads, out, "nonsense")


def test_failures_are_recorded_and_raised(spark, ads, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="spend"):
        jobs.run_pipeline(spark, ads.drop("spend"), out)
    record = runlog.latest_status(spark, f"{out}/metadata").first().record
    assert (record.status, record.stage) == ("FAILED", "pipeline_error") and "spend" in record.error


def test_no_runs_yet(spark, tmp_path):
    assert runlog.latest_status(spark, str(tmp_path / "none")).first().status == "NO_DATA"
    with pytest.raises(ValueError):
        runlog.append_record(spark, str(tmp_path / "none"), nonsense=1)


def test_rebuild_appends_a_batch_and_logs_it(spark, ads, tmp_path):
    out = str(tmp_path / "out")
    counts = jobs.rebuild(spark, ads, out, "b1")
    assert counts == {"batch_id": "b1", "scored_rows": 4, "segment_rows": 3}
    jobs.rebuild(spark, ads.limit(2), out, "b2")
    assert readers.read_latest_batch(spark, f"{out}/ad_quality").count() == 2
    recs = spark.read.parquet(f"{out}/budget_recommendations")
    assert recs.columns == [*RECOMMENDATION_COLUMNS, "batch_id"]
    log = str(tmp_path / "log")
    jobs.append_upload_log(jobs.upload_log_row(spark, counts, "f.csv", "/x/f.csv", "analyst", "me"), log)
    assert spark.read.parquet(log).first().segment_rows == 3
    with pytest.raises(ValueError, match="platform"):
        jobs.rebuild(spark, ads.drop("platform"), out)


def test_stream_takes_new_files_once(spark, make_ads, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = landing.with_row_kpis(landing.stream_ads(spark, source, files_per_batch=1))
        landing.append_available(stream, out, state).awaitTermination()
        return sorted((r.ad_id, r.ctr) for r in spark.read.parquet(out).collect())

    make_ads({}).write.option("header", True).csv(source)
    assert run() == [(1, 0.1)]
    make_ads(dict(ad_id=2, clicks=0)).write.mode("append").option("header", True).csv(source)
    assert run() == run() == [(1, 0.1), (2, 0.0)]


def test_stream_days_close_behind_the_watermark(spark, make_ads, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    days = [dict(date="2026-04-01"), dict(date="2026-04-01"), dict(date="2026-04-02"), dict(date="2026-04-05")]
    make_ads(*days).coalesce(1).write.option("header", True).csv(source)
    landing.append_available(landing.closed_days(landing.stream_ads(spark, source)), out, state).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted((str(r.date), r.platform, r.clicks, r.spend) for r in rows) == [
        ("2026-04-01", "P1", 200, 20.0), ("2026-04-02", "P1", 100, 10.0),
    ]
