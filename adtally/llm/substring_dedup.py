"""Removal of repeated word windows, found through difference-cover anchors.

A window of ``length`` words is repeated if its word sequence starts at more than one
place of the table. Only windows of ``length - period + 1`` words that start at cover
positions modulo ``period`` are hashed at first. A difference cover has, for any two
starts i and j, a shift below the period that brings both to cover positions; so two
equal windows share an equal anchor at the same shift. Places with a repeated anchor
are extended: all full windows that can hold such an anchor are hashed, with 96 bits,
and compared. Words covered by a repeated window go.

Both comparisons use ``repeats``: one shuffle of packed hashes each, no pairs, and no
task that holds all places of one hash. Texts are shuffled by row, not by content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm import repeats
from adtally.llm.store import parts_for, text_megabytes
from adtally.llm.wordhash import Words, slices, text_bytes, window_hashes

#: Perfect difference sets, and the period each belongs to.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The longest period whose anchors keep two fifths of the window, as a mask of its cover positions."""
    period = max(p for p in COVERS if length - p + 1 >= max(1, 2 * length // 5))
    mask = np.zeros(period, bool)
    mask[list(COVERS[period])] = True
    return period, mask


def _spans(at: np.ndarray, before: int, after: int, size: int) -> np.ndarray:
    """True for positions from ``at - before`` up to but without ``at + after``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, np.maximum(at - before, 0), 1)
    np.add.at(edge, np.minimum(at + after, size), -1)
    return np.cumsum(edge[:-1]) > 0


def _marked(words: Words, marks: pa.Array, before: int, after: int) -> np.ndarray:
    """Words near the marked places of their row."""
    out = np.zeros(len(words), bool)
    for i, packed in enumerate(marks.to_pylist()):
        if packed:
            lo, hi = words.first[i], words.first[i + 1]
            out[lo:hi] = _spans(repeats.places(packed), before, after, hi - lo)
    return out


def _kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each row, joined by one space."""
    start, end = words.start[keep], words.end[keep]
    size = end - start + 1
    at = np.cumsum(size) - size
    index = np.repeat(start - at, size) + np.arange(int(size.sum()))
    out = np.append(words.raw, 32)[index].astype(np.uint8)
    stop = at + size - 1
    out[stop] = 32
    kept = np.concatenate([[0], np.cumsum(keep)])[words.first]
    some = np.diff(kept) > 0
    chop = stop[kept[1:][some] - 1]  # the space after a row's last word
    out = np.delete(out, chop)
    total = np.concatenate([[0], np.cumsum(size)])
    ends = total[kept] - np.concatenate([[0], np.cumsum(some)])
    return pa.StringArray.from_buffers(len(kept) - 1, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes()))


def remove_repeats(docs: DataFrame, length: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``n_words``, ``n_removed`` and ``kept_text`` of every row.

    Words are runs without U+0020 and U+0009 to U+000D, unchanged. Windows are judged on the input.
    Defined cases: null and empty texts have no words and an empty kept text; texts shorter than a
    window stay whole; repeated rows, with or without the same id, repeat each other's windows and
    stay as rows; very long texts are handled alone; an empty table gives no rows; other columns
    are not read.
    """
    period, cover = cover_for(length)
    short = length - period + 1
    parts = parts_for(text_megabytes(docs, text_column))
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).withColumn("key", F.xxhash64("id", "text"))

    def anchors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            words = Words(*text_bytes(part.column("text")))
            row = words.rows()
            place = np.arange(len(words)) - words.first[row]
            at = np.flatnonzero(words.window_starts(short) & cover[place % period])
            hashes = window_hashes(words.hashes(1), short, 1)[at]
            key = part.column("key").to_numpy()[row[at]]
            yield repeats.packed(hashes, np.zeros(len(at), np.uint32), key, place[at], parts)

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            words = Words(*text_bytes(part.column("text")))
            at = np.flatnonzero(_marked(words, part.column("places"), period - 1, 1) & words.window_starts(length))
            row = words.rows()[at]
            first = window_hashes(words.hashes(2), length, 2)[at]
            second = (window_hashes(words.hashes(3), length, 3)[at] >> np.uint64(32)).astype(np.uint32)
            key = part.column("key").to_numpy()[row]
            yield repeats.packed(first, second, key, at - words.first[row], parts)

    def removal(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(batch, "text"):
            words = Words(*text_bytes(part.column("text")))
            gone = _marked(words, part.column("places"), 0, length)
            removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
            columns = [part.column("id"), pa.array(np.diff(words.first), pa.int64()), pa.array(np.diff(removed), pa.int64()), _kept_texts(words, ~gone)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_text"])

    shared = repeats.repeated_places(repeats.map_rows(rows.select("key", "text"), repeats.PACKED, anchors))
    # Both joins read the same columns of ``rows``, so that its texts are shuffled once.
    near = rows.join(shared.hint("shuffle_hash"), "key").select("id", "key", "text", "places")
    found = repeats.repeated_places(repeats.map_rows(near, repeats.PACKED, windows))
    judged = rows.join(found.hint("shuffle_hash"), "key", "left").select("id", "key", "text", "places")
    out = repeats.map_rows(judged, f"id {id_type}, n_words long, n_removed long, kept_text string", removal)
    return out.withColumnRenamed("id", id_column)
