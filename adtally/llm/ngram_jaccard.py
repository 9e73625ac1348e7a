"""Documents whose word n-gram sets are similar, by a blocked product of the incidence matrix.

The matrix has a row for each distinct set (documents with equal sets are one row) and
a column for each n-gram. Columns have one global order: those that a sketch of fixed
size counts rarely come first. A set of size n needs only its first
``n - ceil(t * n) + 1`` columns, because two sets of similarity t share one of these.
One task multiplies one block of columns: it adds up how many columns each pair of
sets shares. Summed over blocks, a pair stays only if these columns and the rest of
the smaller side can still reach the similarity. What stays is multiplied out exactly, again
by blocks (``_overlaps``): pairs around one hub share a cell, each set enters a cell once, cut into
blocks of columns, and the overlaps of a pair are added up over the blocks.

A column that many sets share would give all pairs among them. Columns of more than
``block`` sets instead compare every set with one of them, the column's first set.
What that leaves in different components is compared with a few other sets of the
column, and only then with all that sizes and parity signatures leave. No link between
different components is lost, and no group is paired out. Many pairs are multiplied out in turns,
each set's strongest first: what lies in one component by then needs no product.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.components import connected_components
from adtally.llm.repeats import each_batch
from adtally.llm.store import map_batches, parts_for, text_megabytes, written
from adtally.llm.wordhash import Words, give_back, mix, pack64, slices, text_bytes, unpack, window_hashes

BLOCK = 16
#: Bytes of text whose sets are made at a time: for cards, and for columns, which travel by slice.
CARD_BYTES, COLUMN_BYTES = 1 << 20, 2 << 20
SKETCH_BITS, SKETCH_SLICES, FAN_IN = 20, 16, 64
FILTER_BITS, FILTER_SLICES = 24, 64
#: Bits of signatures made at a time.
SIGN_BITS = 1 << 20
DELEGATES, DELEGATE_ROUNDS = 4, 2
#: More pairs than ``FEW_PAIRS`` are multiplied out in turns: each set's strongest pair, at most so often, then all the rest.
FEW_PAIRS, STRONGEST_TURNS = 10_000, 3
#: Blocks of columns and pairs of a cell in the exact product; entries compared at a time.
COLUMN_BITS, CELL_PAIRS, CELL_ENTRIES = 3, 20_000, 1 << 19
COLUMN_BLOCKS = 1 << COLUMN_BITS
PERCENT = 80
U64 = np.uint64


class Sets:
    """Distinct n-gram hashes of each row of a slice, rows one after the other."""

    def __init__(self, text: pa.Array, size: int):
        words = Words(*text_bytes(text))
        hashes = words.hashes(11, lower=True)
        row = words.rows()
        at = words.window_starts(size)
        grams, owner = [window_hashes(hashes, size, 12)[at]], [row[at]]
        count = np.diff(words.first)
        for k in range(1, size):  # a text of fewer words is one n-gram
            short = np.flatnonzero(count == k)
            if len(short):
                grams.append(window_hashes(hashes, k, 12 + k)[words.first[short]])
                owner.append(short)
        gram, owner = np.concatenate(grams), np.concatenate(owner)
        order = np.lexsort((gram, owner))
        gram, owner = gram[order], owner[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        self.gram, self.owner = gram[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(text) + 1))
        self.count = np.diff(self.first)
        total = np.concatenate([[U64(0)], np.cumsum(mix(self.gram ^ U64(0x5BF03635)), dtype=U64)])
        #: Fingerprint of each set, the same for equal sets; rows without n-grams have none.
        self.print = mix((total[self.first[1:]] - total[self.first[:-1]]) + self.count.astype(U64)).view(np.int64)

    def signs(self) -> pa.Array:
        """Parity signature of each set: bit j says whether an odd number of its n-grams fall on j.

        A signature has two to four bits for each n-gram, so it tells large sets apart as well as small ones.
        """
        width = sign_bits(self.count)
        start = np.concatenate([[0], np.cumsum(width)])
        words = np.zeros(start[-1] // 64, np.int64)
        lo = 0
        while lo < len(width):  # a bounded number of bits at a time, or one set
            hi = max(int(np.searchsorted(start, start[lo] + SIGN_BITS, side="right")) - 1, lo + 1)
            own = slice(self.first[lo], self.first[hi])
            row = self.owner[own]
            bit = start[row] - start[lo] + (self.gram[own] & (width[row] - 1).astype(U64)).astype(np.int64)
            odd = (np.bincount(bit, minlength=start[hi] - start[lo]) & 1).astype(np.uint8)
            words[start[lo] // 64 : start[hi] // 64] = np.packbits(odd).view(np.int64)
            lo = hi
        return pa.ListArray.from_arrays(pa.array(start // 64, pa.int32()), pa.array(words))


def sign_bits(count: np.ndarray) -> np.ndarray:
    """Width of the signature of sets of these sizes: a power of two, 64 at least; none for the empty set."""
    exponent = np.frexp(np.maximum(2 * count - 1, 1).astype(np.float64))[1]
    return np.where(count > 0, np.left_shift(np.int64(1), np.maximum(exponent, 6).astype(np.int64)), 0)


def prefix_sizes(count: np.ndarray, percent: int) -> np.ndarray:
    return np.where(count > 0, count - (percent * count + 99) // 100 + 1, 0)


def _cards(rows: DataFrame, size: int, id_type: str) -> DataFrame:
    """A row for each document, and the task's sketch of n-gram counts in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in slices(batch, "text", CARD_BYTES):
                sets = Sets(part.column("text"), size)
                sketch += np.bincount((sets.gram >> U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
                none, n = pa.nulls(len(part), pa.int32()), len(part)
                columns = [part.column("id"), part.column("key"), pa.array(sets.count, pa.int64()), pa.array(sets.print, mask=sets.count == 0), sets.signs(), none, none, pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        if kind is not None:
            block = TaskContext.get().partitionId()
            data = [zlib.compress(x.tobytes(), 1) for x in np.split(sketch, SKETCH_SLICES)]
            m = SKETCH_SLICES
            columns = [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())), pa.array(range(m), pa.int32()), pa.array([block] * m, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "key", "n", "set_id", "signs", "slice", "block", "data"]
    return map_batches(rows, run, f"id {id_type}, key long, n long, set_id long, signs array<long>, slice int, block int, data binary")


def _sum_sketches(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(d), np.int64) for d in group["data"])
    return pd.DataFrame({"slice": [group["slice"].iloc[0]], "block": [group["block"].iloc[0] // FAN_IN], "data": [zlib.compress(total.tobytes(), 1)]})


def _levels(sketches: DataFrame) -> np.ndarray:
    """Binary magnitude of each counter: 2**SKETCH_BITS bytes, whatever the data's size."""
    blocks = (sketches.agg(F.max("block").alias("b")).first()["b"] or 0) + 1
    while True:
        sketches = sketches.groupBy("slice", F.floor(F.col("block") / FAN_IN).alias("to")).applyInPandas(_sum_sketches, "slice int, block int, data binary")
        blocks = -(-blocks // FAN_IN)
        if blocks == 1:
            break
    out = np.zeros((SKETCH_SLICES, (1 << SKETCH_BITS) // SKETCH_SLICES), np.int64)
    for r in sketches.collect():
        out[r["slice"]] = np.frombuffer(zlib.decompress(bytes(r["data"])), np.int64)
    return np.frexp(np.maximum(out.ravel(), 1).astype(np.float64))[1].astype(np.uint8)


def _columns(rows: DataFrame, size: int, percent: int, parts: int, levels) -> DataFrame:
    """First columns of each distinct set, packed by column range."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        level = levels.value
        for part in slices(batch, "text", COLUMN_BYTES):
            sets = Sets(part.column("text"), size)
            _, one = np.unique(sets.print, return_index=True)
            once = np.zeros(len(part), bool)
            once[one] = True
            order = np.lexsort((sets.gram, level[(sets.gram >> U64(64 - SKETCH_BITS)).astype(np.int64)], sets.owner))
            place = np.arange(len(order)) - sets.first[sets.owner]
            at = order[(place < prefix_sizes(sets.count, percent)[sets.owner]) & once[sets.owner]]
            gram, owner = sets.gram[at], sets.owner[at]
            block = ((gram >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
            by = np.argsort(block, kind="stable")
            gram, owner = gram[by], owner[by]
            bound = np.searchsorted(block[by], np.arange(parts + 1))
            out = []
            for p in np.flatnonzero(np.diff(bound)).tolist():
                g, o = gram[bound[p] : bound[p + 1]], owner[bound[p] : bound[p + 1]]
                start = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]]))
                n = np.diff(np.append(start, len(o)))
                out.append((p, pack64(g), pack64(sets.print[o[start]]), pack64(n.astype(np.uint32)), pack64(sets.count[o[start]].astype(np.uint32))))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["part", "gram", "set_id", "n", "size"])

    return map_batches(rows, each_batch(step), "part int, gram binary, set_id binary, n binary, size binary")


def _multiply(percent: int, most: int):
    """Product of one block of columns: pairs of sets with the number of columns they share."""

    def product(group: pd.DataFrame) -> pd.DataFrame:
        def joined(column, kind):
            return np.concatenate([unpack(b, kind) for b in group[column]])

        n = joined("n", np.uint32)
        gram, sid, size = joined("gram", np.uint64), np.repeat(joined("set_id", np.int64), n), np.repeat(joined("size", np.uint32), n).astype(np.int64)
        order = np.lexsort((sid, gram))
        gram, sid, size = gram[order], sid[order], size[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (sid[1:] != sid[:-1])
        gram, sid, size = gram[new], sid[new], size[new]
        start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
        length = np.diff(np.append(start, len(gram)))
        a, b, few, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m in range(2, most + 1):
            at = start[length == m]
            for i in range(m - 1):
                for j in range(i + 1, m):
                    x, y = at + i, at + j
                    close = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                    a.append(x[close])
                    b.append(y[close])
                    few.append(np.ones(int(close.sum()), np.int64))
                    many.append(np.zeros(int(close.sum()), np.int64))
        wide = length > most
        hub, member = np.repeat(start[wide], length[wide]), np.flatnonzero(np.repeat(wide, length))
        for left, right in ((hub, member), (member, member)):  # the second counts each set's wide columns
            a.append(left)
            b.append(right)
            few.append(np.zeros(len(left), np.int64))
            many.append(np.ones(len(left), np.int64))
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = pd.DataFrame({"a": sid[a], "b": sid[b], "na": size[a], "nb": size[b], "few": np.concatenate(few), "many": np.concatenate(many)})
        # A hub meets itself in both lists; its own wide columns are counted once.
        pairs = pairs.drop(pairs.index[: len(pairs) - len(member)][(pairs["a"].to_numpy() == pairs["b"].to_numpy())[: len(pairs) - len(member)]])
        return pairs.groupby(["a", "b", "na", "nb"], as_index=False, sort=False).sum()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = product(group)
        give_back()
        return out

    return run


def _reach(overlap: Column, percent: int, a: str = "na", b: str = "nb") -> Column:
    """Whether sets of these sizes with this overlap are similar: 100 * i >= percent * union."""
    return (100 + percent) * overlap >= percent * (F.col(a) + F.col(b))


def _rest(n: str, percent: int) -> Column:
    """Columns of a set beyond its first ones."""
    return F.floor((percent * F.col(n) + 99) / 100) - 1


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << FILTER_BITS))


def _key_filter(keys: DataFrame) -> np.ndarray:
    """Bits of the slots that ``keys`` fall into: 2**FILTER_BITS bits, whatever the data's size."""
    width = (1 << FILTER_BITS) // FILTER_SLICES

    def bits(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(width, np.uint8)
        marks[group["slot"].to_numpy() % width] = 1
        return pd.DataFrame({"slice": [group["slice"].iloc[0]], "data": [np.packbits(marks).tobytes()]})

    slots = keys.select(_slot(F.col("key")).alias("slot")).distinct().withColumn("slice", F.floor(F.col("slot") / width))
    out = np.zeros((FILTER_SLICES, width // 8), np.uint8)
    for r in slots.groupBy("slice").applyInPandas(bits, "slice long, data binary").collect():
        out[r["slice"]] = np.frombuffer(bytes(r["data"]), np.uint8)
    return out.ravel()


def _full_sets(rows: DataFrame, size: int, keys: DataFrame) -> DataFrame:
    """Whole sets of the rows with one of ``keys`` (and of a few others), a row for each block of columns.

    The keys reach the tasks as a filter of fixed size, so that no text is shuffled. What passes
    beside them is not joined with anything later on.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_key_filter(keys))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        slot = batch.column("slot").to_numpy()
        wanted = (shared.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1
        for part in slices(batch.filter(pa.array(wanted.astype(bool))), "text", COLUMN_BYTES):
            sets = Sets(part.column("text"), size)
            # n-grams of a set are in order: a block is a stretch of them
            stretch = sets.owner * COLUMN_BLOCKS + (sets.gram >> U64(64 - COLUMN_BITS)).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]])) if len(stretch) else np.zeros(0, np.int64)
            stop = np.append(start[1:], len(stretch))
            data = sets.gram.tobytes()
            grams = pa.array([data[8 * x : 8 * y] for x, y in zip(start.tolist(), stop.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(sets.print[sets.owner[start]]), pa.array((stretch[start] % COLUMN_BLOCKS).astype(np.int32)), grams], ["set_id", "columns", "grams"])

    picked = rows.select(_slot(F.col("key")).alias("slot"), "text")
    return map_batches(picked, each_batch(step), "set_id long, columns int, grams binary")


def _cells(pairs: DataFrame) -> DataFrame:
    """``pairs`` with a cell of about ``CELL_PAIRS`` pairs each.

    The pairs of one neighbourhood (hubs whose smallest neighbour is the same set) go together, so
    that a set enters few cells; one with many pairs is split by its members.
    """
    cells = pairs.count() // CELL_PAIRS + 1
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    near = both.groupBy("node").agg(F.min("other").alias("other")).select(F.col("node").alias("a"), F.least("node", "other").alias("near"))
    placed = pairs.join(near.hint("shuffle_hash"), "a")
    large = placed.groupBy("near").agg(F.count("*").alias("n")).where(F.col("n") > CELL_PAIRS).select("near", F.floor(F.col("n") / CELL_PAIRS + 1).alias("split"))
    share = F.pmod(F.xxhash64("b", F.lit(7)), F.coalesce("split", F.lit(1)))
    return placed.join(large, "near", "left").select(*pairs.columns, F.pmod(F.xxhash64("near", share), F.lit(cells)).alias("cell"))


def _overlaps_in_cell(sets: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """How many n-grams of one block of columns the pairs of a cell share."""
    grams = [np.frombuffer(g, U64) for g in sets["grams"]]
    length = np.fromiter(map(len, grams), np.int64, len(grams))
    gram = np.concatenate([np.zeros(0, U64), *grams])
    known, owner = np.unique(sets["set_id"].to_numpy(np.int64), return_inverse=True)
    distinct, code = np.unique(gram, return_inverse=True)
    width = max(len(distinct), 1)
    entry = np.unique(np.repeat(owner, length) * width + code)  # a set may have been written twice
    first = np.searchsorted(entry, np.arange(len(known) + 1) * width)
    ends = []
    for c in ("a", "b"):
        at = np.minimum(np.searchsorted(known, pairs[c].to_numpy(np.int64)), max(len(known) - 1, 0))
        there = known[at] == pairs[c].to_numpy(np.int64) if len(known) else np.zeros(len(pairs), bool)
        ends.append((at, np.where(there, first[np.minimum(at + 1, len(first) - 1)] - first[at], 0)))
    (a, n), (b, m) = ends
    n = np.where(m > 0, n, 0)
    shared = np.zeros(len(pairs), np.int64)
    total = np.concatenate([[0], np.cumsum(n)])
    lo = 0
    while lo < len(pairs):  # a bounded number of entries at a time
        hi = max(int(np.searchsorted(total, total[lo] + CELL_ENTRIES, side="right")) - 1, lo + 1)
        k = n[lo:hi]
        pair = np.repeat(np.arange(lo, hi), k)
        place = first[a[pair]] + np.arange(len(pair)) - np.repeat(np.cumsum(k) - k, k)
        sought = b[pair] * width + entry[place] % width
        found = np.minimum(np.searchsorted(entry, sought), max(len(entry) - 1, 0))
        shared += np.bincount(pair[entry[found] == sought] if len(pair) else pair, minlength=len(pairs))
        lo = hi
    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "na": pairs["na"], "nb": pairs["nb"], "i": shared})


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with ``i``, the number of n-grams that both full sets hold, added up over blocks of columns.

    Hints keep the plan the same at every size: sets are dealt to their cells by shuffles, each
    n-gram once for each cell its set enters.
    """
    asked = written(_cells(pairs), "asked")
    enter = asked.select(F.col("a").alias("set_id"), "cell").union(asked.select("b", "cell")).distinct()
    held = sets.join(enter.hint("shuffle_hash"), "set_id").select("cell", "columns", "set_id", "grams")
    by_block = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(COLUMN_BLOCKS - 1)))).withColumnRenamed("cell", "of")
    counts = held.groupBy("cell", "columns").cogroup(by_block.groupBy("of", "block")).applyInPandas(_overlaps_in_cell, "a long, b long, na long, nb long, i long")
    return counts.groupBy("a", "b", "na", "nb").agg(F.sum("i").alias("i"))


def _strongest(pairs: DataFrame) -> DataFrame:
    """Of each set's pairs the one of most ``weight`` (the smallest partner among equals): at most as many pairs as sets."""
    rest = [F.col(c) for c in ("na", "nb")]
    ends = [pairs.select(F.col(x).alias("node"), F.struct((-F.col("weight")).alias("w"), F.col(y).alias("other"), "a", "b", *rest).alias("pair")) for x, y in (("a", "b"), ("b", "a"))]
    return ends[0].union(ends[1]).groupBy("node").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b", "pair.na", "pair.nb").distinct()


def _similar_pairs(pairs: DataFrame, sets: DataFrame, percent: int, links: DataFrame | None = None) -> DataFrame:
    """Similar pairs that connect all sets which ``links`` and the similar ones of ``pairs`` connect.

    A pair inside a component adds nothing to it. So a large group of near copies, whose sets each meet many hubs,
    takes about one product a set; every pair between components is multiplied out.
    """
    found = []
    for turn in range(STRONGEST_TURNS + 1):
        last = turn == STRONGEST_TURNS or pairs.count() <= FEW_PAIRS
        asked = pairs if last else written(_strongest(pairs), "strongest")
        similar = written(_overlaps(asked.select("a", "b", "na", "nb"), sets).where(_reach(F.col("i"), percent)).select("a", "b"), "similar")
        found.append(similar)
        if last:
            break
        links = similar if links is None else links.union(similar)
        labels = connected_components(links)
        of_a, of_b = (labels.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")) for c in ("a", "b"))
        apart = pairs.join(asked.select("a", "b"), ["a", "b"], "left_anti").join(of_a, "a", "left").join(of_b, "b", "left")
        pairs = written(apart.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select(*pairs.columns), "rest")
        if pairs.isEmpty():
            break
    return reduce(DataFrame.union, found)


def _folded(signs: Column, words: Column, halvings: int) -> Column:
    """``signs`` brought to ``words`` words: a signature of half the width is its halves' exclusive or."""
    for k in reversed(range(halvings)):
        half = F.shiftleft(words, k)
        halves = F.zip_with(F.slice(signs, F.lit(1), half), F.slice(signs, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        signs = F.when(F.size(signs) > half, halves).otherwise(signs)
    return signs


def _can_reach(percent: int, n: str, m: str) -> Column:
    """Whether the signatures ``sx`` and ``sy`` leave sets of these sizes similar.

    Two sets differ in at least as many n-grams as their signatures differ in bits, and similar
    ones in at most (100 - percent) / (100 + percent) of their sizes' sum. The wider signature is
    folded to the narrower one; sizes that can be similar need so many halvings at most.
    """
    halvings = math.ceil(math.log2(100 / percent))
    words = F.least(F.size("sx"), F.size("sy"))
    x, y = (_folded(F.col(c), words, halvings) for c in ("sx", "sy"))
    differ = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, c: t + c)
    return (100 + percent) * differ <= (100 - percent) * (F.col(n) + F.col(m))


def _met(x: DataFrame, y: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components around one hub that may be similar."""
    close = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    met = x.join(y, "hub").where((F.col("of_x") != F.col("of_y")) & close & _can_reach(percent, "n", "m"))
    swap = F.col("x") > F.col("y")
    return met.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(swap, F.col("m")).otherwise(F.col("n")).alias("na"), F.when(swap, F.col("n")).otherwise(F.col("m")).alias("nb")
    ).distinct()


def _join_around_hubs(base: DataFrame, signs: DataFrame, links: DataFrame, verified, percent: int) -> DataFrame:
    """Labels of all links, with those among sets of wide columns that are not linked with the column's first set.

    ``base``: hub, x and n of every set x in a wide column of a hub; ``signs``: x and its signature sx,
    which only the rows that meet others carry along.
    First such a set meets a few others of its star, some of them not linked with the hub either:
    most find their component there, and the work is linear. The rest meets all sets of other
    components in the star that sizes and signatures leave. ``verified`` keeps the similar
    pairs that connect what ``links`` has not.
    """
    labels = connected_components(links)
    other = {"x": "y", "n": "m", "of_x": "of_y", "sx": "sy"}
    for turn in range(DELEGATE_ROUNDS + 1):
        of = labels.withColumnRenamed("node", "x").withColumnRenamed("label", "of_x")
        of_hub = labels.withColumnRenamed("node", "hub").withColumnRenamed("label", "of_hub")
        star = base.join(of, "x", "left").join(of_hub, "hub", "left").withColumns({"of_x": F.coalesce("of_x", "x"), "of_hub": F.coalesce("of_hub", "hub")})
        star = written(star.select("hub", "x", "n", "of_x", "of_hub"), "star")
        apart = star.where("of_x <> of_hub").drop("of_hub")
        if apart.isEmpty():
            break
        if turn < DELEGATE_ROUNDS:
            row = F.struct("x", "n", "of_x")
            seeds = range(turn * DELEGATES, (turn + 1) * DELEGATES)
            chosen = [F.min(F.struct(F.xxhash64("x", F.lit(j)).alias("h"), row.alias("r"))) for j in seeds]
            chosen += [F.min(F.when(F.col("of_x") != F.col("of_hub"), F.struct(F.xxhash64("x", F.lit(j)).alias("h"), row.alias("r")))) for j in seeds]
            picked = star.groupBy("hub").agg(F.array_compact(F.array(*chosen))["r"].alias("rows")).select("hub", F.explode(F.array_distinct("rows")).alias("r")).select("hub", "r.*")
        else:
            picked = star.drop("of_hub")
        met = written(_met(apart.join(signs, "x"), picked.join(signs, "x").withColumnsRenamed(other), percent), "met")
        if met.isEmpty():
            continue
        late = written(verified(met.withColumn("weight", F.lit(0)), links), "late")
        if not late.isEmpty():
            links = links.union(late)
            labels = connected_components(links)
    return labels


def similar_sets(
    docs: DataFrame, size: int = 5, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK
) -> DataFrame:
    """Per row: id, ``key`` (hash of id and text), ``n_shingles``, ``set_id``, ``component`` and ``component_id``.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of ``size``-word
    shingles over A-Z lower-cased words. ``component_id``: smallest id that links reach.
    Defined cases: texts of fewer words are one shingle; null, empty and blank texts have no set,
    no component, and link with nothing (their ``component_id`` is their own id); rows with equal
    sets are linked; a null id counts as larger than any other; an empty table gives no rows;
    other columns are not read. Sets and shingles are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    parts = parts_for(text_megabytes(docs, text_column), 24)
    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    made = written(_cards(rows, size, id_type), "cards")
    cards = made.where("slice is null").select("id", "key", "n", "set_id")
    levels = spark.sparkContext.broadcast(_levels(made.where("slice is not null").select("slice", "block", "data")))

    product = _columns(rows.select("text"), size, percent, parts, levels).groupBy("part").applyInPandas(_multiply(percent, block), "a long, b long, na long, nb long, few long, many long")
    shared = written(product.groupBy("a", "b", "na", "nb").agg(F.sum("few").alias("few"), F.sum("many").alias("many")), "shared")
    wide = shared.where("a = b")
    in_a, in_b = wide.select("a", F.col("many").alias("wide_a")), wide.select(F.col("a").alias("b"), F.col("many").alias("wide_b"))
    pairs = shared.where("a <> b").join(in_a, "a", "left").join(in_b, "b", "left")
    most = F.col("few") + F.least(F.coalesce("wide_a", F.lit(0)), F.coalesce("wide_b", F.lit(0)))
    possible = F.least(most + F.greatest(_rest("na", percent), _rest("nb", percent)), F.col("na"), F.col("nb"))
    chosen = written(pairs.where((F.col("many") > 0) | _reach(possible, percent)).select("a", "b", "na", "nb", "many", (F.col("few") + F.col("many")).alias("weight")), "pairs")

    signs = written(made.where("set_id is not null").groupBy("set_id").agg(F.first("signs").alias("signs")), "signs")
    sx, sy = (signs.select(F.col("set_id").alias(c), F.col("signs").alias(n)) for c, n in (("a", "sx"), ("b", "sy")))
    likely = chosen.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).join(sx, "a").join(sy, "b").where(_can_reach(percent, "na", "nb"))
    likely = written(likely.select("a", "b", "na", "nb", "weight"), "likely")

    def verified(pairs: DataFrame, links: DataFrame | None = None) -> DataFrame:
        """Pairs whose full sets are similar, as many as connect what all of them connect."""
        needed = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        holders = cards.where("set_id is not null").groupBy("set_id").agg(F.min("key").alias("key")).join(needed, "set_id")
        sets = written(_full_sets(rows.select("key", "text"), size, holders.select("key")), "sets")
        return _similar_pairs(pairs, sets, percent, links)

    links = written(verified(likely), "links")
    base = chosen.where("many > 0").select(F.col("a").alias("hub"), F.col("b").alias("x"), F.col("nb").alias("n"))
    labels = _join_around_hubs(base, signs.select(F.col("set_id").alias("x"), F.col("signs").alias("sx")), links, verified, percent)

    member = cards.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("label", "set_id"))
    least = member.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    out = member.join(least, "component", "left")
    return out.select(
        F.col("id").alias(id_column), "key", F.col("n").alias("n_shingles"), "set_id", "component", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )


def keep_one_each(docs: DataFrame, size: int = 5, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id. Rows without a set stay."""
    found = similar_sets(docs, size, percent, id_column, text_column)
    first = found.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col(id_column).isNull().alias("last"), F.col(id_column).alias("id"), "key")).alias("kept"))
    blank = found.where("component is null").select("key").distinct()
    kept = first.select(F.col("kept.key").alias("_key"), F.lit(True).alias("_one")).union(blank.select(F.col("key"), F.lit(False)))
    joined = docs.withColumn("_key", F.xxhash64(id_column, text_column)).join(kept.hint("shuffle_hash"), "_key")
    once = joined.where("_one").dropDuplicates(["_key"])  # rows that repeat id and text
    return once.union(joined.where(~F.col("_one"))).drop("_key", "_one")
