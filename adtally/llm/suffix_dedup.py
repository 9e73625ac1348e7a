"""Removal of repeated byte strings: suffixes sorted by buckets, long ties settled by a cover sample.

A byte goes if a string of ``length`` bytes covers it that also starts earlier in the table. The
suffixes of all texts would have to be sorted by their first ``length`` bytes for this; equal
neighbours are the repeats. Done at once that is one entry per byte, so it is done blockwise:

1. **Cover sample.** Only suffixes at positions of a difference cover modulo ``period`` are ranked
   at first, by their next ``length - period + 1`` bytes. For any two starts a shift below the
   period brings both to cover positions, so equal strings have an equal ranked suffix at the same
   shift. Only a string through a cover suffix that has company can be repeated.
2. **Sample ranks of long ties.** A cover suffix with company is ranked again, by all bytes that a
   string through it can reach (its context). A suffix whose context is not the first of its rank
   settles every string through it: all of them stand earlier, at the first place of that rank.
   Of the other strings through a cover suffix only those may be repeated that have a part around it
   in common with another context: the bytes that all strings of one third of the shifts hold.
3. **Buckets.** What is left are strings near the ends of matches. Their suffixes are dealt to
   buckets by the leading hash of their first ``length`` bytes; a task sorts one bucket at a time
   and keeps the earliest of each run of equal ones.

Order among suffixes is that of hashes, as only equal neighbours matter, not which comes first in
the alphabet. Texts are shuffled once, into blocks by hash of the row; a block's entries travel as
bare hashes in the order of its rows, answers come back as bits in that order, and equal strings
within a block are settled there, so that a string in a third of all rows travels once per block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.store import parts_for, text_megabytes
from adtally.llm.wordhash import CHUNK, _byte_values, _odd, _powers, mix, pack64, text_bytes, unpack

U64 = np.uint64
BLOCK_MB, BUCKET_MB = 6, 48
#: Perfect difference sets, and the period each belongs to.
COVERS = {
    1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}
ZONES = 3
ANSWER = "stage int, block long, part int, open binary, later binary"
ENTRY = "part int, block long, lead binary, rest binary, more binary, ids array<{kind}>, keys array<long>, n binary"


def cover_for(length: int) -> tuple[int, np.ndarray]:
    """The longest period that leaves cover suffixes a quarter of the length, and its cover positions."""
    period = max(p for p in COVERS if length - p + 1 >= max(1, length // 4))
    return period, np.array(COVERS[period], np.int64)


def string_hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Hash of ``raw[start:start+size]`` for each (ascending) start."""
    out = np.empty(len(start), U64)
    if not len(start):
        return out
    most = int(size.max())
    values = _byte_values(seed, False)
    up, down = _powers(seed, 1, CHUNK + most)
    odd, at = U64(_odd(seed, 2)), 0
    while at < len(start):
        base = int(start[at])
        to = int(np.searchsorted(start, base + CHUNK))
        stop = int((start[at:to] + size[at:to]).max())
        total = np.zeros(stop - base + 1, U64)
        np.cumsum(values[raw[base:stop]] * up[: stop - base], out=total[1:])
        s = start[at:to] - base
        out[at:to] = mix((total[s + size[at:to]] - total[s]) * down[s] + size[at:to].astype(U64) * odd)
        at = to
    return out


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & U64(0xFFFFFFFF)).astype(np.uint32)


class Block:
    """The whole texts of some rows, in order of id, and what is known of their suffixes."""

    def __init__(self, table: pa.Table, length: int):
        table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("key", "ascending")], null_placement="at_end"))
        self.number = table.column("block")[0].as_py() if len(table) else 0
        self.ids, self.keys = table.column("id").combine_chunks(), table.column("key").combine_chunks()
        self.raw, self.ends = text_bytes(table.column("text").combine_chunks())
        self.length, (self.period, cover) = length, cover_for(length)
        self.short = length - self.period + 1
        size = np.diff(self.ends)
        most = int(size.max()) if len(size) else 0
        pattern = (np.arange(0, most + self.period, self.period)[:, None] + cover).ravel()
        held = np.searchsorted(pattern, np.where(size >= length, size - self.short + 1, 0))
        self.place = np.concatenate([np.zeros(0, np.int64), *(pattern[:k] + a for k, a in zip(held.tolist(), self.ends.tolist(), strict=False) if k)])
        self.anchor = string_hashes(self.raw, self.place, np.full(len(self.place), self.short), 21)
        self.distinct, self.code, self.times = np.unique(self.anchor, return_inverse=True, return_counts=True)

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right") - 1

    def _entries(self, at: np.ndarray, lead: np.ndarray, low: np.ndarray, rest: np.ndarray, parts: int, more: np.ndarray | None = None) -> list[tuple]:
        """Entries in order of place, a row for each part: their hashes and how many each document has."""
        part, row, out = _part_of(lead, parts), self.row_of(at), []
        order = np.argsort(part, kind="stable")
        bound = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bound)).tolist():
            mine = order[bound[p] : bound[p + 1]]
            docs, n = np.unique(row[mine], return_counts=True)
            extra = None if more is None else pack64(more[:, mine].ravel())
            out.append((p, pack64(low[mine]), pack64(rest[mine]), extra, self.ids.take(pa.array(docs)).to_pylist(), self.keys.take(pa.array(docs)).to_pylist(), pack64(n.astype(np.uint32))))
        return out

    def _answers(self, answers: pa.Table, stage: int, name: str, part: np.ndarray, lines: int = 1) -> np.ndarray:
        """Lines of bits for entries in the order of (part, place), put back into the order of place."""
        out = np.zeros((lines, len(part)), bool)
        order, counts = np.argsort(part, kind="stable"), np.bincount(part)
        bound = np.concatenate([[0], np.cumsum(counts)])
        mine = answers.filter(pc.equal(answers.column("stage"), stage))
        for p, bits in zip(mine.column("part").to_pylist(), mine.column(name).to_pylist(), strict=True):
            got = np.unpackbits(np.frombuffer(bits, np.uint8), count=lines * int(counts[p]))
            out[:, order[bound[p] : bound[p + 1]]] = got.reshape(lines, -1).astype(bool)
        return out

    def sample_entries(self, parts: int) -> list[tuple]:
        """Stage 1: each distinct cover suffix once, and whether it occurs twice here."""
        bound = np.searchsorted(_part_of(self.distinct, parts), np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(bound)).tolist():
            mine = slice(bound[p], bound[p + 1])
            rows.append((p, pack64(_low(self.distinct[mine])), None, np.packbits(self.times[mine] > 1).tobytes(), None, None, None))
        return rows

    def rank(self, answers: pa.Table, parts: int) -> None:
        """Cover suffixes with company, their contexts, and the first here of each context."""
        shared = self._answers(answers, 1, "open", _part_of(self.distinct, parts))[0][self.code]
        self.at, self.lead = self.place[shared], self.anchor[shared]
        row = self.row_of(self.at)
        self.lo, self.hi = np.maximum(self.at - self.period + 1, self.ends[row]), np.minimum(self.at + self.length, self.ends[row + 1])
        self.context = mix(string_hashes(self.raw, self.lo, self.hi - self.lo, 22) + (self.at - self.lo).astype(U64))
        self.first = _firsts(self.lead, self.context)

    def zones(self, at: np.ndarray) -> np.ndarray:
        """For each third of the shifts, a hash of what all strings with such a shift hold of the bytes around ``at``."""
        row, out = self.row_of(at), np.empty((ZONES, len(at)), np.uint32)
        for t in range(ZONES):
            least, most = self.shifts(t)
            lo, hi = np.maximum(at - least, self.ends[row]), np.minimum(at - most + 1 + self.length, self.ends[row + 1])
            out[t] = _low(string_hashes(self.raw, lo, hi - lo, 25))
        return out

    def shifts(self, zone: int) -> tuple[int, int]:
        return zone * self.period // ZONES, (zone + 1) * self.period // ZONES

    def context_entries(self, parts: int) -> list[tuple]:
        """Stage 2: the first suffix of each context."""
        at, lead = self.at[self.first], self.lead[self.first]
        return self._entries(at, lead, _low(lead), self.context[self.first], parts, self.zones(at))

    def leave(self, answers: pa.Table, parts: int) -> None:
        """Bytes settled by sample ranks, and the strings that are left to sort."""
        part = _part_of(self.lead[self.first], parts)
        later, near = np.ones(len(self.at), bool), np.zeros((ZONES, len(self.at)), bool)
        later[self.first] = self._answers(answers, 2, "later", part)[0]
        near[:, self.first] = self._answers(answers, 2, "open", part, ZONES)
        self.edge = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(self.edge, self.lo[later], 1)
        np.add.at(self.edge, self.hi[later], -1)
        whole = np.zeros(len(self.raw) + 1, np.int8)  # starts of whole strings
        size = np.diff(self.ends)
        some = size >= self.length
        np.add.at(whole, self.ends[:-1][some], 1)
        np.add.at(whole, self.ends[1:][some] - self.length + 1, -1)
        open_ = np.cumsum(whole[:-1], dtype=np.int8) > 0
        wanted = np.zeros(len(self.raw) + 1, np.int32)
        for t in range(ZONES):
            least, most = self.shifts(t)
            np.add.at(wanted, np.maximum(self.at[near[t]] - most + 1, 0), 1)
            np.add.at(wanted, np.maximum(self.at[near[t]] - least + 1, 0), -1)
        np.add.at(wanted, self.lo[later], -(1 << 20))  # settled
        np.add.at(wanted, self.at[later] + 1, 1 << 20)
        open_ &= np.cumsum(wanted[:-1]) > 0
        self.left = np.flatnonzero(open_)
        n = np.full(len(self.left), self.length)
        self.string, self.more = string_hashes(self.raw, self.left, n, 23), (string_hashes(self.raw, self.left, n, 24) >> U64(32)).astype(np.uint32)
        self.first_left = _firsts(self.string, self.more)

    def string_entries(self, parts: int) -> list[tuple]:
        """Stage 3: the first of each string that is left."""
        f = self.first_left
        return self._entries(self.left[f], self.string[f], self.string[f], self.more[f], parts)

    def removed(self, answers: pa.Table, parts: int) -> np.ndarray:
        """True for each byte that goes."""
        later = np.ones(len(self.left), bool)
        later[self.first_left] = self._answers(answers, 3, "later", _part_of(self.string[self.first_left], parts))[0]
        np.add.at(self.edge, self.left[later], 1)
        np.add.at(self.edge, self.left[later] + self.length, -1)
        return np.cumsum(self.edge[:-1]) > 0


def _firsts(lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """True for the first of all entries with equal hashes."""
    order = np.lexsort((rest, lead))
    new = np.ones(len(order), bool)
    new[1:] = (lead[order][1:] != lead[order][:-1]) | (rest[order][1:] != rest[order][:-1])
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _entry_table(rows: list[tuple], block: int, kind: pa.DataType) -> pa.Table:
    c = list(zip(*rows, strict=True)) or [[]] * 7
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(kind), pa.list_(pa.int64()), pa.binary()]
    part, *rest = (pa.array(x, k) for x, k in zip(c, kinds, strict=True))
    return pa.Table.from_arrays([part, pa.array([block] * len(rows), pa.int64()), *rest], ["part", "block", "lead", "rest", "more", "ids", "keys", "n"])


def _answer_table(table: pa.Table, stage: int, sizes: list[int], near: np.ndarray, later: np.ndarray) -> pa.Table:
    """Answers to the rows of ``table``, which hold ``sizes`` entries: lines of bits each."""
    stop = np.cumsum(sizes)
    bits = [[np.packbits(x[..., b - n : b].ravel()).tobytes() for n, b in zip(sizes, stop.tolist(), strict=True)] for x in (near, later)]
    m = len(table)
    return pa.Table.from_arrays([pa.array([stage] * m, pa.int32()), table.column("block").combine_chunks(), table.column("part").combine_chunks(), *(pa.array(b, pa.binary()) for b in bits)], ["stage", "block", "part", "open", "later"])


def _answer_sample(table: pa.Table) -> pa.Table:
    """Which cover suffixes of a part have company anywhere."""
    leads = [unpack(x, np.uint32) for x in table.column("lead").to_pylist()]
    sizes = [len(x) for x in leads]
    twice = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table.column("more").to_pylist(), sizes, strict=True)]).astype(bool)
    _, code, times = np.unique(np.concatenate(leads), return_inverse=True, return_counts=True)
    many = times > 1
    many[code[twice]] = True
    return _answer_table(table, 1, sizes, many[code], np.zeros(len(code), bool))


def _several(lead: np.ndarray, zone: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """True for entries that share lead and zone with one of another rest."""
    order = np.lexsort((rest, zone, lead))
    lead, zone, rest = lead[order], zone[order], rest[order]
    head = np.concatenate([[True], (lead[1:] != lead[:-1]) | (zone[1:] != zone[:-1])])
    group = np.cumsum(head) - 1
    out = np.empty(len(order), bool)
    out[order] = (np.bincount(group, weights=head | np.concatenate([[True], rest[1:] != rest[:-1]])) > 1)[group]
    return out


def _answer_sorted(stage: int, lead_kind, rest_kind) -> Callable[[pa.Table], pa.Table]:
    """Sorts one bucket: which entries are not the earliest of their run, and which have a part in common with another run."""

    def run(table: pa.Table) -> pa.Table:
        leads = [unpack(x, lead_kind) for x in table.column("lead").to_pylist()]
        sizes = [len(x) for x in leads]
        lead, rest = np.concatenate(leads), np.concatenate([unpack(x, rest_kind) for x in table.column("rest").to_pylist()])
        docs = pa.table({"id": table.column("ids").combine_chunks().flatten(), "key": table.column("keys").combine_chunks().flatten()})
        rank = np.empty(len(docs), np.int64)
        rank[pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("key", "ascending")], null_placement="at_end").to_numpy()] = np.arange(len(docs))
        rank = np.repeat(rank, np.concatenate([unpack(x, np.uint32) for x in table.column("n").to_pylist()]))
        order = np.lexsort((rank, rest, lead))
        later = np.empty(len(order), bool)
        later[order] = ~np.concatenate([[True], (lead[order][1:] != lead[order][:-1]) | (rest[order][1:] != rest[order][:-1])])
        if stage == 3:
            return _answer_table(table, stage, sizes, later[:0], later)
        zones = np.concatenate([unpack(x, np.uint32).reshape(ZONES, -1) for x in table.column("more").to_pylist()], axis=1)
        near = np.array([_several(lead, zone, rest) for zone in zones])
        return _answer_table(table, stage, sizes, near, later)

    return run


def remove_repeated_bytes(docs: DataFrame, length: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``n_bytes``, ``n_removed``, ``removed`` (spans of bytes that go: start, end) and ``kept`` (bytes) of every row.

    Texts are UTF-8 bytes, earlier means a smaller id, then an earlier start; strings are judged on
    the input. Defined cases: null and empty texts have no bytes and keep none; texts shorter than
    ``length`` stay whole; a null id is later than any other; rows of one id are ordered by a hash of
    their text, and repeated rows keep one of them; a cut may fall inside a character, so
    ``kept`` is binary; a block holds its texts whole, so memory follows the longest text beyond
    ``BLOCK_MB``; an empty table gives no rows; other columns are not read. Strings are told apart
    by 96 bits or more.
    """
    megabytes = text_megabytes(docs, text_column)
    blocks, parts = int(megabytes / BLOCK_MB) + 1, parts_for(megabytes, BUCKET_MB)
    kind = docs.schema[id_column].dataType.simpleString()
    key = F.xxhash64(id_column, text_column)
    rows = docs.select(F.col(id_column).alias("id"), key.alias("key"), F.col(text_column).alias("text"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"))
    # Every pass groups the same columns of ``rows`` by block: the texts are shuffled once.
    texts = rows.groupBy("block")
    entry = ENTRY.format(kind=kind)

    def entries(block: Block, found: list[tuple]) -> pa.Table:
        return _entry_table(found, block.number, block.ids.type)

    def sample(table: pa.Table) -> pa.Table:
        block = Block(table, length)
        return entries(block, block.sample_entries(parts))

    def contexts(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(table, length)
        block.rank(answers, parts)
        return entries(block, block.context_entries(parts))

    def strings(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(table, length)
        block.rank(answers, parts)
        block.leave(answers, parts)
        return entries(block, block.string_entries(parts))

    def result(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(table, length)
        block.rank(answers, parts)
        block.leave(answers, parts)
        gone = block.removed(answers, parts)
        return _kept(block, gone)

    first = texts.applyInArrow(sample, entry).groupBy("part").applyInArrow(_answer_sample, ANSWER).repartition("block")
    second = texts.cogroup(first.groupBy("block")).applyInArrow(contexts, entry).groupBy("part").applyInArrow(_answer_sorted(2, np.uint32, U64), ANSWER).repartition("block")
    third = texts.cogroup(first.union(second).groupBy("block")).applyInArrow(strings, entry).groupBy("part").applyInArrow(_answer_sorted(3, U64, np.uint32), ANSWER).repartition("block")
    schema = f"id {kind}, n_bytes long, n_removed long, removed array<struct<start: long, end: long>>, kept binary"
    out = texts.cogroup(first.union(second).union(third).groupBy("block")).applyInArrow(result, schema)
    return out.withColumnRenamed("id", id_column)


def _kept(block: Block, gone: np.ndarray) -> pa.Table:
    ends = block.ends
    begin = gone & ~np.concatenate([[False], gone[:-1]])[: len(gone)]
    begin[ends[:-1][ends[:-1] < len(gone)]] |= gone[ends[:-1][ends[:-1] < len(gone)]]
    stop = gone & ~np.concatenate([gone[1:], [False]])[: len(gone)]
    last = ends[1:][ends[1:] > 0] - 1
    stop[last] |= gone[last]
    a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    row = block.row_of(a)
    spans = pa.StructArray.from_arrays([pa.array(a - ends[row]), pa.array(b - ends[row])], ["start", "end"])
    offsets = np.searchsorted(row, np.arange(len(ends)))
    removed = np.concatenate([[0], np.cumsum(gone)])[ends]
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends - removed).astype(np.int32).tobytes()), pa.py_buffer(block.raw[~gone].tobytes())])
    columns = [block.ids, pa.array(np.diff(ends)), pa.array(np.diff(removed)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), kept]
    return pa.Table.from_arrays(columns, ["id", "n_bytes", "n_removed", "removed", "kept"])
