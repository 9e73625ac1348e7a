"""Structured Streaming jobs over a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.config import AD_SCHEMA
from adtally.functions.kpi import row_kpis
from adtally.functions.numeric import exact_sum_sql


def stream_ads(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """New CSV files of a landing folder in the ad schema."""
    reader = spark.readStream.schema(AD_SCHEMA).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(landing)


def with_row_kpis(ads: DataFrame) -> DataFrame:
    """Row KPIs only: quality needs the median of a finished batch."""
    return ads.select("*", *row_kpis())


def closed_days(ads: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Metric sums per calendar day and platform, for readers that want each day once and final.

    ``lateness`` is how long a day stays open for late rows; a day is emitted
    once and its state dropped when the watermark has passed its end. Open days are
    missing and later rows are not counted: :func:`daily_platform` has both.
    """
    # Midnight UTC whatever the session zone, so that windows are calendar days.
    timed = ads.withColumn("event_ts", F.timestamp_seconds(F.unix_date("date") * F.lit(86400)))
    return (
        timed.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 day"), "platform")
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"),
            F.expr(exact_sum_sql("spend")).cast("double").alias("spend"),
            F.expr(exact_sum_sql("revenue")).cast("double").alias("revenue"),
        )
        .select(
            F.date_from_unix_date((F.unix_seconds("window.start") / 86400).cast("int")).alias("date"),
            "platform", "impressions", "clicks", "conversions", "spend", "revenue",
        )
    )


def daily_platform(landed: DataFrame) -> DataFrame:
    """Metric sums per calendar day and platform over all rows that a stream has landed.

    The stream only appends rows, so neither the order of files nor a late one loses any.
    With ``landed`` cut to the dates that new files touch, only their days are built anew.
    """
    return landed.groupBy("date", "platform").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.expr(exact_sum_sql("spend")).cast("double").alias("spend"),
        F.expr(exact_sum_sql("revenue")).cast("double").alias("revenue"),
    )


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything there is now into parquet, then stop.

    The checkpoint folder must be shared: a restart continues from it without
    repeating or losing a file.
    """
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
