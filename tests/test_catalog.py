"""Registered queries against their SQL; set ALL_QUERIES=1 for every one of them."""

import datetime as dt
import decimal
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from adtally.plans import catalog

DATA = Path("/root/testdata/sf0.001")
QUICK = [
    "coerce_clip", "clean_required", "row_kpis", "quality_tiered", "batch_quality", "list_ads", "sessions_with_users",
    "campaign_ranking", "perf_segment", "daily_series", "kpi_trends", "ctr_heatmap", "optimization_picks",
    "platform_reallocation", "budget_plan", "dataset_state", "stage_run_log", "rule_baseline_metrics",
    "newest_file", "asset_freshness", "latest_stage", "upload_log_after_append", "kpi_row_csv",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else QUICK
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sql, name):
    df = entry.queries()[name](spark, str(DATA))
    cursor = sql.execute(entry.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())


def test_every_statement_belongs_to_a_query():
    from adtally.plans.checks import SQL

    assert set(SQL) <= set(entry.queries())


def test_entry_schema(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "segment_id" and df.count() > 0


@pytest.mark.parametrize("gone", ["public_tokenizers", "regex", "adtally.llm", "corpus_pipeline"])
def test_other_queries_stay_when_a_package_of_the_training_data_operators_is_missing(gone):
    code = f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; from adtally.plans.catalog import QUERIES; assert e.queries() == QUERIES and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, check=True)


def test_repaired_ads_are_parsed_once(spark):
    """What reads them reads numbers, not the text they were made of."""
    files = catalog.repaired(spark, str(DATA)).inputFiles()
    assert files and all("/repaired-" in f for f in files)
