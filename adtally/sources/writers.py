"""Sinks: CSV reports, exports, appended batches, typed tables, landed files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.config import AD_SCHEMA
from adtally.operators.cleaning import to_typed

FORMATS = ("parquet", "csv", "json")


def batch_stamp(now: datetime | None = None) -> str:
    """UTC time of a batch, sortable as text."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S_%f")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Overwrite a folder of CSV parts with header.

    ``single_file`` funnels everything through one task: for small aggregates only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def export(df: DataFrame, folder: str, fmt: str = "parquet", stamp: str | None = None) -> str:
    """Write to ``folder/export_<UTC time>`` and return that path."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    path = f"{folder.rstrip('/')}/export_{stamp or batch_stamp()}"
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def append_batch(df: DataFrame, path: str, batch_id: str) -> str:
    """Append one batch; earlier batches stay. A rerun of the same batch replaces only itself."""
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return path


def write_report(df: DataFrame, columns: Sequence[str], path: str, single_file: bool = False) -> str:
    """Report CSV: the named columns in order, all others left out."""
    return write_csv(df.select(*columns), path, single_file)


# --- fixed values: columns of the two report files
SEGMENT_REPORT = [
    "segment_id", "campaign_id", "age_group", "suggested_action", "recommendation_score", "recommended_weight",
    "avg_cpa", "avg_cvr", "good_ratio", "explanation",
]
PLAN_REPORT = [
    "segment_id", "campaign_id", "age_group", "suggested_action", "recommendation_score", "weight",
    "allocated_budget", "expected_conversions", "explanation",
]
# --- end of fixed values


def typed_table(ads: DataFrame) -> DataFrame:
    """Ads in the warehouse types: money as decimal(15,2), counts as bigint."""
    typed = to_typed(ads)
    return typed.select(
        *[
            F.col(f.name).try_cast("decimal(15,2)").alias(f.name) if f.name in ("spend", "revenue") else F.col(f.name)
            for f in AD_SCHEMA.fields
        ]
    )


def load_table(ads: DataFrame, table: str) -> None:
    """Replace a catalog table with the typed ads."""
    typed_table(ads).write.mode("overwrite").format("parquet").saveAsTable(table)


def load_jdbc(ads: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8) -> None:
    """Replace a database table with the typed ads.

    ``numPartitions`` bounds the open connections; ``truncate`` keeps the table's
    own types and indexes.
    """
    (
        typed_table(ads)
        .write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", 5000)
        .option("numPartitions", connections)
        .jdbc(url, table, properties=properties)
    )


def load_counts(table: DataFrame) -> DataFrame:
    """What a load is checked by: rows and distinct campaigns, ages and platforms."""
    return table.agg(
        F.count("*").alias("row_count"),
        F.countDistinct("campaign_id").alias("campaigns"),
        F.countDistinct("age_group").alias("age_groups"),
        F.countDistinct("platform").alias("platforms"),
    )


def land_file(spark: SparkSession, source: str, landing: str) -> str:
    """Copy a raw CSV into the landing folder, all values as text, marked ``uploaded_<name>``.

    A large file becomes many parts. Each part carries the header, so that readers which
    skip the first line of a file lose no row.
    """
    name = source.rstrip("/").rsplit("/", 1)[-1]
    target = f"{landing.rstrip('/')}/uploaded_{name}"
    rows = spark.read.option("header", True).option("inferSchema", False).csv(source)
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)
    return target
