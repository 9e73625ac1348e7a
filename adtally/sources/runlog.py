"""Run records: one JSON row per stage, appended."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("input_path", T.StringType()),
        T.StructField("outputs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("cpa_median", T.DoubleType()),
        T.StructField("features_added", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)


def append_record(spark: SparkSession, path: str, **values) -> dict:
    """Append one record; unknown fields are an error, absent ones null."""
    unknown = set(values) - set(RUN_SCHEMA.fieldNames())
    if unknown:
        raise ValueError(f"not part of a run record: {sorted(unknown)}")
    record = {f: None for f in RUN_SCHEMA.fieldNames()} | values
    record["timestamp"] = record["timestamp"] or datetime.now(timezone.utc).isoformat()
    row = tuple(record[f] for f in RUN_SCHEMA.fieldNames())
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").json(path)
    return record


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).json(path)


def latest_status(spark: SparkSession, path: str) -> DataFrame:
    """``status`` READY with the newest record, or NO_DATA."""
    try:
        runs = read_runs(spark, path)
    except Exception as e:  # Spark reports a missing path while it plans
        if "PATH_NOT_FOUND" not in str(e):
            raise
        runs = spark.createDataFrame([], RUN_SCHEMA)
    last = F.max_by(F.struct(*RUN_SCHEMA.fieldNames()), F.struct("timestamp", "seq"))
    return runs.agg(last.alias("record")).select(
        F.when(F.col("record").isNull(), F.lit("NO_DATA")).otherwise(F.lit("READY")).alias("status"), "record"
    )
