"""Dataset registry: active dataset, history, lifecycle events, run records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_dataset(datasets: DataFrame) -> DataFrame:
    """The newest active dataset, or no row."""
    return datasets.where("active").orderBy(F.desc("created_at"), F.desc("id")).limit(1)


def dataset_history(datasets: DataFrame, limit: int = 10) -> DataFrame:
    return datasets.orderBy(F.desc("created_at"), F.desc("id")).limit(max(1, int(limit)))


def dataset_state(events: DataFrame) -> DataFrame:
    """Datasets with their ``active`` flag after all lifecycle events.

    ``events`` holds ``dataset_id, action, event_time, seq``. An upload or an
    activation makes that dataset the only active one and a deactivation leaves
    none, so the last event of all decides, and at most one flag is set. The
    last event is a single row found by partial aggregation.
    """
    last = events.agg(
        F.max_by(F.struct("dataset_id", "action"), F.struct("event_time", "seq")).alias("last")
    ).scalar()
    latest = events.groupBy("dataset_id").agg(
        F.max_by(F.struct("action", "event_time"), F.struct("event_time", "seq")).alias("e")
    )
    is_active = (F.col("dataset_id") == last["dataset_id"]) & (last["action"] != "deactivate")
    return latest.select(
        "dataset_id",
        F.col("e.action").alias("last_action"),
        F.col("e.event_time").alias("last_event_time"),
        F.coalesce(is_active, F.lit(False)).alias("active"),
    )


def lifecycle_event(datasets: DataFrame, action: str, seq: int = 0) -> DataFrame:
    """Rows to append to the event table for the given datasets."""
    if action not in ("upload", "activate", "deactivate"):
        raise ValueError(f"unknown action: {action!r}")
    return datasets.select(
        F.col("id").alias("dataset_id"),
        F.lit(action).alias("action"),
        F.current_timestamp().alias("event_time"),
        F.lit(seq).alias("seq"),
    )


def has_data(datasets: DataFrame, upload_logs: DataFrame) -> bool:
    """True when a dataset is active or anything was ever uploaded; reads at most one row of each."""
    return not datasets.where("active").limit(1).isEmpty() or not upload_logs.limit(1).isEmpty()


def latest_runs(runs: DataFrame) -> DataFrame:
    """Last record of each job, by completion time."""
    rest = [c for c in runs.columns if c != "job"]
    last = F.max_by(F.struct(*rest), F.struct("completed_at", "id"))
    return runs.groupBy("job").agg(last.alias("r")).select("job", "r.*")


def dashboard_overview(summary_row: DataFrame, datasets: DataFrame) -> DataFrame:
    """Summary, data flag, active dataset and the last five datasets in one row."""
    record = F.struct(*datasets.columns)
    # Five rows at most, so they fit in one array.
    recent = dataset_history(datasets, 5).agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("created_at", "id", record.alias("d"))))).alias("h")
    )
    history = recent.select(F.transform("h", lambda x: x["d"]))
    active = active_dataset(datasets).select(record.alias("d"))
    return summary_row.select(
        F.struct(*summary_row.columns).alias("summary"),
        F.col("total_ads").alias("total_records"),
        (F.col("total_ads") > 0).alias("has_data"),
        active.scalar().alias("active_dataset"),
        history.scalar().alias("dataset_history"),
    )
