"""The given tables seen as ads, users, sessions, upload logs and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLATFORMS = ["Facebook", "Google Ads", "TikTok", "Instagram", "LinkedIn", "Programmatic"]
AGES = ["13-17", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _one_of(names: list[str], key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names[:-1]))
    return f"CASE {key} % {len(names)} {cases} ELSE '{names[-1]}' END"


def ads(spark: SparkSession, folder: str) -> DataFrame:
    return ads_of(table(spark, folder, "lineitem"))


def ads_of(lineitem: DataFrame) -> DataFrame:
    """One ad per line item, for a static or a streaming table."""
    clicks = "floor(l_extendedprice * l_discount)"
    return lineitem.selectExpr(
        "l_orderkey * 10 + l_linenumber AS ad_id",
        "concat('CAMP_', lpad(cast(l_suppkey % 12 + 1 AS string), 3, '0')) AS campaign_id",
        "cast(l_shipdate AS date) AS date",
        f"{_one_of(PLATFORMS, 'l_partkey')} AS platform",
        f"{_one_of(AGES, 'l_orderkey')} AS age_group",
        "cast(floor(l_extendedprice) AS bigint) AS impressions",
        f"cast({clicks} AS bigint) AS clicks",
        f"cast(floor({clicks} * l_tax) AS bigint) AS conversions",
        "floor(l_extendedprice * 0.5e0) / 100 AS spend",
        "floor(l_extendedprice * l_quantity * 0.02e0) / 100 AS revenue",
    )


def dirty_ads(spark: SparkSession, folder: str) -> DataFrame:
    """The same ads as raw text with gaps, junk and negative amounts in it."""
    clicks = "floor(l_extendedprice * l_discount)"
    money = "cast(cast({} AS decimal(15,2)) AS string)"
    return table(spark, folder, "lineitem").selectExpr(
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS ad_id",
        "CASE WHEN l_discount = 0.1 THEN NULL WHEN l_discount = 0.09 THEN '  ' "
        "ELSE concat('CAMP_', lpad(cast(l_suppkey % 12 + 1 AS string), 3, '0')) END AS campaign_id",
        "CASE WHEN l_linenumber = 6 THEN '2026-13-40' ELSE cast(cast(l_shipdate AS date) AS string) END AS date",
        f"CASE WHEN l_quantity = 1 THEN NULL ELSE {_one_of(PLATFORMS, 'l_partkey')} END AS platform",
        f"CASE WHEN l_quantity = 2 THEN 'unknown' ELSE {_one_of(AGES, 'l_orderkey')} END AS age_group",
        "CASE WHEN l_tax = 0 THEN 'n/a' ELSE cast(cast(floor(l_extendedprice) AS bigint) AS string) END AS impressions",
        f"CASE WHEN l_linenumber = 5 THEN '' ELSE cast(cast({clicks} AS bigint) AS string) END AS clicks",
        f"CASE WHEN l_linenumber = 4 THEN NULL ELSE cast(cast(floor({clicks} * l_tax) AS bigint) AS string) END AS conversions",
        "CASE WHEN l_returnflag = 'R' THEN concat('-', " + money.format("floor(l_extendedprice * 0.5e0) / 100") + ") "
        "WHEN l_linenumber = 3 THEN concat(' ', " + money.format("floor(l_extendedprice * 0.5e0) / 100") + ", ' ') "
        "ELSE " + money.format("floor(l_extendedprice * 0.5e0) / 100") + " END AS spend",
        "CASE WHEN l_linenumber = 2 THEN '1.5d' ELSE "
        + money.format("floor(l_extendedprice * l_quantity * 0.02e0) / 100") + " END AS revenue",
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        "c_custkey AS id",
        "lower(c_name) AS username",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'MACHINERY' THEN 'analyst' "
        "WHEN 'HOUSEHOLD' THEN 'guest' ELSE 'user' END AS role",
        "c_acctbal > 0 AS is_active",
    )


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "concat('jti-', cast(event_id AS string)) AS session_token",
        "user_id",
        "event_type AS user_agent",
        "ts AS created_at",
        "ts + interval '60' minute AS expires_at",
        "value < 40 AS is_active",
    )


def _uploads(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))


_FILE_NAME = "concat('campaigns_', lower(o_orderstatus), '_', cast(o_orderkey % 100 AS string), '.csv') AS file_name"


def upload_logs(spark: SparkSession, folder: str) -> DataFrame:
    return _uploads(spark, folder).selectExpr(
        "o_orderkey AS id",
        "o_orderdate AS uploaded_at",
        _FILE_NAME,
        "cast(floor(o_totalprice / 100) AS int) AS scored_rows",
        "cast(o_orderkey % 84 AS int) AS segment_rows",
        "lower(c_name) AS uploader_name",
    )


def datasets(spark: SparkSession, folder: str) -> DataFrame:
    return _uploads(spark, folder).selectExpr(
        "o_orderkey AS id",
        _FILE_NAME,
        "lower(c_name) AS uploaded_by",
        "o_orderstatus = 'O' AS active",
        "cast(floor(o_totalprice / 100) AS int) AS scored_rows",
        "cast(o_orderkey % 84 AS int) AS segment_rows",
        "o_orderdate AS created_at",
    )


def dataset_events(spark: SparkSession, folder: str) -> DataFrame:
    """Lifecycle events: orders switch the customer's data set on or off."""
    return table(spark, folder, "orders").selectExpr(
        "o_custkey AS dataset_id",
        "CASE o_orderstatus WHEN 'O' THEN 'activate' WHEN 'F' THEN 'upload' ELSE 'deactivate' END AS action",
        "o_orderdate AS event_time",
        "o_orderkey AS seq",
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Job run records: one per event."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS id",
        "event_type AS job",
        "CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "ts AS completed_at",
        "cast(user_id AS bigint) AS row_count",
    )
