"""Token counts by rank-synchronous array merging.

Each task turns a slice of its texts into distinct pre-tokens held as one ragged
array, and merges all of them in step (``bpe.RankMerger``). Nothing is shuffled.

Defined cases: null and empty texts have 0 tokens and 0 bytes; repeated rows and
null ids stay one row each; very long texts are merged in parts cut between words;
strings of special tokens count as one token each; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.bpe import rank_counter
from adtally.llm.wordhash import slices, text_bytes

SLICE_BYTES = 4 << 20


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    ``vocabulary``: path of a word-level byte-pair file, the same on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = rank_counter(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                _, ends = text_bytes(part.column("text"))
                tokens = count([t or "" for t in part.column("text").to_pylist()])
                columns = [part.column("id"), pa.array(np.diff(ends), pa.int64()), pa.array(tokens, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
