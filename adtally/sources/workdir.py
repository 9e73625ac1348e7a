"""Shared scratch folders for written intermediates."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
OWN_FOLDER = "adtally-scratch"


def work_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Without the setting, a folder beside the warehouse is taken: the warehouse has to be
    shared as well. It is removed when the program ends.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = f"{warehouse.rpartition('/')[0]}/{OWN_FOLDER}-{uuid.uuid4().hex}"
    spark.conf.set(CHECKPOINT_CONF, root)
    atexit.register(remove_folder, spark, root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the work root; nothing is ever overwritten there."""
    return f"{work_root(spark)}/adtally/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through its file system, if the session is still there."""
    if spark.sparkContext._jsc is not None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: nothing before it runs again.

    ``group_rows``: rows of a row group at most. Readers hold a few thousand rows at once, but never
    more than a row group, so very wide rows are written in small ones.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**{"parquet.block.row.count.limit": group_rows} if group_rows else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
