"""Which hashes occur at more than one place: packed entries, one shuffle, no group per hash.

A task packs the hashes of a slice of rows by hash range, one row of arrays for each
range. Hashes that occur twice within the slice are settled there: their places are
answered at once and only the bare hash travels on, so a hash that a third of all rows
share sends one entry per slice, not one per row. Each range is then read by one task,
whose size follows from the number of ranges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.wordhash import pack64, unpack

PACKED = "part int, hash binary, more binary, known binary, known_more binary, key binary, n binary, place binary, settled_key binary, settled_n binary, settled_place binary"
FIELDS = [f.split(" ")[0] for f in PACKED.split(", ")]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of each run of equal values, and the runs' lengths."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(keys)))


def _repeated(hashes: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings equal hashes together; in it, True for those that are not alone, and for each first one."""
    order = np.lexsort((more, hashes)) if more.any() else np.argsort(hashes, kind="stable")
    h, m = hashes[order], more[order]
    same = (h[1:] == h[:-1]) & (m[1:] == m[:-1])
    again = np.concatenate([[False], same])[: len(h)]
    return order, again | np.concatenate([same, [False]])[: len(h)], ~again


def _places(key: np.ndarray, place: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Entries that follow each other by key: keys once, with the number of their places."""
    first, n = _runs(key)
    return pack64(key[first]), pack64(n.astype(np.uint32)), pack64(place.astype(np.uint32))


def packed(hashes: np.ndarray, more: np.ndarray, key: np.ndarray, place: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of PACKED for one slice; ``key`` and ``place`` say where each hash stands."""
    order, twice, first = _repeated(hashes, more)
    lone = np.sort(order[~twice])
    settled = np.sort(order[twice])
    known = order[twice & first]
    rows = []

    def part_of(h):
        return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)

    groups = [(lone, part_of(hashes[lone])), (known, part_of(hashes[known])), (settled, (key[settled].astype(np.uint64) % np.uint64(parts)).astype(np.int64))]
    sorted_groups = []
    for index, part in groups:
        by = np.argsort(part, kind="stable")
        sorted_groups.append((index[by], np.searchsorted(part[by], np.arange(parts + 1))))
    for p in range(parts):
        a, b, c = (index[bound[p] : bound[p + 1]] for index, bound in sorted_groups)
        if len(a) + len(b) + len(c):
            rows.append((p, pack64(hashes[a]), pack64(more[a]), pack64(hashes[b]), pack64(more[b]), *_places(key[a], place[a]), *_places(key[c], place[c])))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], FIELDS)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    def joined(column, kind):
        return np.concatenate([unpack(b, kind) for b in group[column]])

    hashes = np.concatenate([joined("hash", np.uint64), joined("known", np.uint64)])
    more = np.concatenate([joined("more", np.uint32), joined("known_more", np.uint32)])
    key, place = np.repeat(joined("key", np.int64), joined("n", np.uint32)), joined("place", np.uint32)
    lone = len(key)
    # A settled hash stands for two places: one entry of it is enough to settle the others.
    twice_known = np.arange(len(hashes)) >= lone
    order, twice, first = _repeated(hashes, more)
    group_no = np.cumsum(first) - 1
    settled = np.bincount(group_no, weights=twice_known[order]) > 0 if len(group_no) else np.zeros(0, bool)
    hit = order[twice | settled[group_no]] if len(group_no) else order
    hit = hit[hit < lone]
    key = np.concatenate([key[hit], np.repeat(joined("settled_key", np.int64), joined("settled_n", np.uint32))])
    place = np.concatenate([place[hit], joined("settled_place", np.uint32)])
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    first, n = _runs(key)
    return pd.DataFrame({"key": key[first], "places": [place[a : a + k].tobytes() for a, k in zip(first, n, strict=True)]})


def repeated_places(entries: DataFrame) -> DataFrame:
    """``key`` and ``places`` (an array of packed 32-bit numbers) of every hash that occurs at least twice."""
    answers = entries.groupBy("part").applyInPandas(_answer, "key long, places binary")
    return answers.groupBy("key").agg(F.collect_list("places").alias("places"))


def places(packed_places: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(packed_places or []), np.uint32).astype(np.int64)


def each_batch(step):
    """The mapping over a task's batches that ``step`` makes of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from step(batch)

    return run


def map_rows(df: DataFrame, schema: str, step) -> DataFrame:
    """``step`` turns each batch of rows into an iterator of batches."""
    return df.mapInArrow(each_batch(step), schema)
