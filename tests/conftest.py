from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("adtally-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AD_FIELDS = (
    "ad_id long, campaign_id string, date string, platform string, age_group string, "
    "impressions long, clicks long, conversions long, spend double, revenue double"
)


@pytest.fixture(scope="session")
def make_ads(spark):
    """Frame of ads from partial dicts; what is left out gets a plain value."""
    base = dict(
        ad_id=1, campaign_id="C1", date="2026-04-01", platform="P1", age_group="18-24",
        impressions=1000, clicks=100, conversions=10, spend=10.0, revenue=20.0,
    )

    def make(*rows: dict):
        names = list(base)
        data = [tuple((base | {"ad_id": i} | r)[n] for n in names) for i, r in enumerate(rows, 1)]
        return spark.createDataFrame(data, AD_FIELDS)

    return make


def column(df, name):
    return [r[name] for r in df.collect()]
