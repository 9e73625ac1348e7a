"""Written intermediates in the shared folder, and the vectorised row sources of the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm.wordhash import give_back
from adtally.sources.workdir import written

__all__ = ["bound_batches", "map_batches", "parts_for", "table", "text_megabytes", "written"]
TARGET_MB = 48
#: Bytes of rows that go to a Python task at once; the JVM and the task each hold a batch or two of that size.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_megabytes(docs: DataFrame, column: str = "text") -> float:
    """Size of all texts, one cheap aggregation over the whole column."""
    total = docs.agg(F.sum(F.octet_length(column)).alias("b")).first()["b"]
    return (total or 0) / 1e6


def parts_for(megabytes: float, per_part: float = TARGET_MB) -> int:
    """Number of hash ranges such that each holds about ``per_part`` MB of text's entries."""
    return max(8, int(megabytes / per_part) + 1)


def bound_batches(spark: SparkSession) -> None:
    """Have the session send batches of about ``BATCH_BYTES`` to Python tasks; a smaller setting of its own stays.

    It stays set, because what an operator returns runs later.
    """
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_CONF))
    if now > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` in batches of bounded bytes; a task that has ended keeps no memory in its worker."""
    bound_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)
