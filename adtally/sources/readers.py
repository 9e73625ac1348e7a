"""Scans of raw files, stage outputs, registry tables and their freshness."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.config import AD_SCHEMA
from adtally.functions.numeric import number_or_null

# --- fixed values: column kinds of the two result tables
SCORED_TEXT = ["ad_id", "campaign_id", "date", "platform", "age_group", "quality_label"]
SCORED_NUMBERS = [
    "impressions", "clicks", "conversions", "spend", "revenue", "ctr", "cpc", "cpm", "cvr", "cpa", "quality_score",
]
SCORED_WHOLE = ["quality_score"]
RECOMMENDATION_TEXT = ["segment_id", "campaign_id", "age_group", "suggested_action"]
RECOMMENDATION_NUMBERS = [
    "ads_count", "total_spent", "total_conversions", "avg_ctr", "avg_cvr", "avg_cpa", "good_ratio",
    "conversion_per_spend", "recommendation_score", "recommended_weight",
]
RECOMMENDATION_WHOLE = ["ads_count"]
# --- end of fixed values

CORRUPT = "_corrupt_record"
#: A part of a Spark write: its number, then the id that all parts of the write share.
SPARK_PART = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def read_ads_csv(spark: SparkSession, path: str | list[str], keep_corrupt: bool = False) -> DataFrame:
    """CSV with header in the ad schema, from any Hadoop path, directory or glob.

    The schema is given, so there is no extra pass to infer it. A value that does
    not fit reads as null; ``keep_corrupt`` adds the raw line of such rows.
    """
    schema = T.StructType(AD_SCHEMA.fields + ([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []))
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def read_text_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV of unknown layout: header names, every value as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_landed(spark: SparkSession, landing: str, schema: T.StructType = AD_SCHEMA) -> DataFrame:
    """All files of a landing folder with the ``source_file`` each row came from."""
    rows = spark.read.schema(schema).option("header", True).csv(landing)
    return rows.withColumn("source_file", F.col("_metadata.file_name"))


def _typed_text(df: DataFrame, text: list[str], numbers: list[str], whole: list[str]) -> DataFrame:
    def number(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("bigint" if name in whole else "double").alias(name)
        value = number_or_null(F.col(name), df.schema[name].dataType)
        return (value.try_cast("bigint") if name in whole else value).alias(name)

    def string(name: str) -> Column:
        present = F.col(name).cast("string") if name in df.columns else F.lit(None)
        return F.coalesce(present, F.lit("")).alias(name)

    return df.select(*[string(c) for c in text], *[number(c) for c in numbers])


def typed_scored(df: DataFrame) -> DataFrame:
    """Scored ads from text: bad numbers null, missing text empty, score truncated."""
    return _typed_text(df, SCORED_TEXT, SCORED_NUMBERS, SCORED_WHOLE)


def typed_recommendations(df: DataFrame) -> DataFrame:
    return _typed_text(df, RECOMMENDATION_TEXT, RECOMMENDATION_NUMBERS, RECOMMENDATION_WHOLE)


def read_latest_batch(spark: SparkSession, path: str, batch_column: str = "batch_id") -> DataFrame:
    """Every file of the newest batch of an appended, batch-partitioned table.

    The batch is a partition column, so only its folder is read.
    """
    table = spark.read.parquet(path)
    newest = table.agg(F.max(batch_column)).scalar()
    return table.where(F.col(batch_column) == newest)


def read_newest_file(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the CSV file changed last, for folders without batches; of files changed at once, the last by path.

    The file is chosen from the listing, so no other file is opened. Parts that one Spark write left in a
    folder (``part-<number>-<id of the write>``) are one file. A folder without files gives no rows.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "modificationTime")
    newest = listed.orderBy(F.desc("modificationTime"), F.desc("path")).first()
    if newest is None:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", True)
    folder, _, name = newest["path"].rpartition("/")
    if part := SPARK_PART.match(name):
        return reader.option("pathGlobFilter", f"part-*-{part[1]}*").csv(folder)
    return reader.csv(newest["path"])


def freshness(spark: SparkSession, assets: dict[str, str]) -> DataFrame:
    """Per asset path: exists, last change (UTC) and age in minutes.

    File listings are the only thing read: the binary source lists modification
    times without opening the content column.
    """
    schema = "asset string, path string, last_modified timestamp"
    out = spark.createDataFrame([], schema)
    for asset, path in assets.items():
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("ignoreMissingFiles", True)
        )
        try:
            files = listed.load(path).select("modificationTime")
        except Exception as e:  # Spark reports a missing path while it plans
            if "PATH_NOT_FOUND" not in str(e):
                raise
            files = spark.createDataFrame([], "modificationTime timestamp")
        out = out.unionByName(
            files.agg(F.max("modificationTime").alias("last_modified")).select(
                F.lit(asset).alias("asset"), F.lit(path).alias("path"), "last_modified"
            )
        )
    age = (F.unix_micros(F.current_timestamp()) - F.unix_micros("last_modified")) / 60e6
    return out.select(
        "asset",
        "path",
        F.col("last_modified").isNotNull().alias("exists"),
        "last_modified",
        F.round(age, 2).alias("age_minutes"),
    )


def all_ready(fresh: DataFrame) -> DataFrame:
    return fresh.agg(F.coalesce(F.bool_and("exists"), F.lit(True)).alias("all_required_assets_ready"))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_column: str | None = None,
    bounds: tuple[int, int] = (0, 0),
    partitions: int = 1,
) -> DataFrame:
    """Registry table from a database, split over several connections if a column is named."""
    if split_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=split_column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=properties,
    )


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Several files of the same kind as one frame; columns may be missing in some."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
