"""Batch jobs: clean, score and aggregate; rebuild the analysis of landed files.

Stages hand over through written tables. A lost executor repeats tasks of one
stage only, and no stage recomputes the one before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adtally.config import AD_COLUMNS, CLEANING_REQUIRED, KPI_COLUMNS
from adtally.operators import cleaning, quality, rollups, segments, stats
from adtally.sources import readers, runlog, writers

STAGES = ("cleaning", "features", "aggregation")


def _write(df: DataFrame, path: str, fmt: str) -> str:
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    return path


def _read(spark: SparkSession, path: str, fmt: str, scored: bool = False) -> DataFrame:
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    return readers.typed_scored(readers.read_text_csv(spark, path)) if scored else readers.read_ads_csv(spark, path)


def clean_stage(raw: DataFrame, path: str, fmt: str) -> dict[str, int]:
    """Write the complete rows; before and after are counted while they are written."""
    cleaning.require_columns(raw, CLEANING_REQUIRED)
    complete = F.lit(True)
    for name in CLEANING_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    seen = Observation("cleaning")
    ads = cleaning.canonicalize(raw)
    watched = ads.observe(seen, F.count(F.lit(1)).alias("initial_count"), F.count_if(complete).alias("final_count"))
    _write(cleaning.drop_incomplete(watched).select(*AD_COLUMNS), path, fmt)
    counts = dict(seen.get)
    return counts | {"removed_rows": counts["initial_count"] - counts["final_count"]}


def features_stage(ads: DataFrame, path: str, fmt: str, mode: str, median: str) -> tuple[dict[str, int], float]:
    kpis = quality.add_kpis(cleaning.canonicalize(ads).select(*AD_COLUMNS))
    seen = Observation("features")
    # Found once: the value on record is the one the labels were judged by.
    middle = float(stats.cpa_median(kpis, median).first()["cpa_median"])
    scored = quality.label_quality(kpis, mode, middle)
    watched = scored.observe(
        seen, F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("cpa").isNotNull()).alias("with_cpa")
    )
    _write(watched, path, fmt)
    return dict(seen.get), middle


def aggregation_stage(scored: DataFrame, campaigns: str, ages: str, fmt: str) -> dict[str, int]:
    counts = {}
    for name, table, path in (
        ("campaign_count", rollups.campaign_rollup(scored), campaigns),
        ("age_groups", rollups.age_rollup(scored), ages),
    ):
        seen = Observation(name)
        _write(table.observe(seen, F.count(F.lit(1)).alias(name)), path, fmt)
        counts |= seen.get
    return counts


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame | str,
    out: str,
    stages: str | Sequence[str] = "full",
    fmt: str = "parquet",
    mode: str = "tiered",
    median: str = "approx",
) -> list[dict]:
    """Run all stages, or the named ones, and return their run records.

    ``raw`` is a frame or a CSV path. A single stage reads what its predecessor
    left in ``out``. A failure is recorded and raised again.
    """
    wanted = STAGES if stages == "full" else ((stages,) if isinstance(stages, str) else tuple(stages))
    unknown = [s for s in wanted if s not in STAGES]
    if unknown:
        raise ValueError(f"Unknown pipeline type: {unknown}")
    out = out.rstrip("/")
    log, run_id = f"{out}/metadata", uuid.uuid4().hex
    cleaned, features = f"{out}/cleaned_data", f"{out}/features_engineered"
    campaigns, ages = f"{out}/campaign_aggregation", f"{out}/age_aggregation"
    source = raw if isinstance(raw, str) else None
    records: list[dict] = []

    def done(stage: str, **values) -> None:
        record = runlog.append_record(
            spark, log, run_id=run_id, seq=len(records), stage=stage, status="SUCCESS", **values
        )
        records.append(record)

    try:
        if "cleaning" in wanted:
            frame = readers.read_ads_csv(spark, raw) if isinstance(raw, str) else raw
            counts = clean_stage(frame, cleaned, fmt)
            done("data_cleaning", input_path=source, outputs={"cleaned": cleaned}, counts=counts)
        if "features" in wanted:
            counts, middle = features_stage(_read(spark, cleaned, fmt), features, fmt, mode, median)
            done(
                "feature_engineering",
                input_path=cleaned,
                outputs={"features": features},
                counts=counts,
                cpa_median=middle,
                features_added=KPI_COLUMNS + ["quality_score", "quality_label"],
            )
        if "aggregation" in wanted:
            counts = aggregation_stage(_read(spark, features, fmt, scored=True), campaigns, ages, fmt)
            done("aggregation", input_path=features, outputs={"campaigns": campaigns, "ages": ages}, counts=counts)
    except Exception as e:
        runlog.append_record(
            spark, log, run_id=run_id, seq=len(records), stage="pipeline_error", status="FAILED",
            input_path=source, error=str(e),
        )
        raise
    return records


def rebuild(spark: SparkSession, raw: DataFrame, out: str, batch_id: str | None = None) -> dict[str, int | str]:
    """Score an upload and rebuild its recommendations as a new batch.

    All ten columns must be there. Unreadable numbers count as 0 and negatives
    stay. Returns the batch id with the numbers of rows and segments written.
    """
    cleaning.require_columns(raw, AD_COLUMNS)
    batch = batch_id or writers.batch_stamp()
    ads = cleaning.coerce_metrics(raw).withColumns({c: F.col(c).cast("string") for c in ("campaign_id", "age_group")})
    out = out.rstrip("/")
    counts: dict[str, int | str] = {"batch_id": batch}

    def write(df: DataFrame, folder: str, count: str) -> DataFrame:
        seen = Observation(count)
        path = writers.append_batch(df.observe(seen, F.count(F.lit(1)).alias(count)), f"{out}/{folder}", batch)
        counts.update(seen.get)
        return spark.read.parquet(path).where(F.col("batch_id") == batch)

    scored = write(quality.score_ads(ads), "ad_quality", "scored_rows")
    write(segments.recommend(scored, ordered=False), "budget_recommendations", "segment_rows")
    return counts


def upload_log_row(
    spark: SparkSession, counts: dict, file_name: str, file_path: str, uploader_role: str, uploader_name: str
) -> DataFrame:
    """The log entry of an upload, to append with :func:`append_upload_log`."""
    fields = "file_name string, file_path string, scored_rows int, segment_rows int, uploader_role string, uploader_name string"
    row = (file_name, file_path, counts["scored_rows"], counts["segment_rows"], uploader_role, uploader_name)
    return spark.createDataFrame([row], fields).withColumn("uploaded_at", F.current_timestamp())


def append_upload_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)
