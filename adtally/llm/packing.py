"""Packing of documents into sequences: configuration program over the length histogram.

1. Texts become ids, each document ends with one separator id, longer ones are cut
   (``cut_documents``). Only lengths, places and checksums leave the task.
2. The histogram of lengths, at most one count per length up to the capacity, goes to
   the driver. ``plan_sequences`` chooses configurations (how many pieces of which
   lengths share a sequence) by multiplicative weights: each length has a price that
   falls as it gets covered and rises from epoch to epoch where its sequences were worth too
   little; a knapsack dynamic program finds the dearest configurations. Their amounts cover
   every piece, and the prices give a lower bound of the sequences (``Plan.bound``).
   Amounts are rounded down, and what is left is covered once more in whole numbers.
   Configurations that are not full enough are given up for best fit, largest length first, again by
   histogram: none of them, the least full, all but full ones, or all, whichever ends with the fewest sequences.
3. Every piece gets a number among those of its length (a count per task and length,
   no window over pieces), and the plan's runs turn that number into a sequence and
   an offset. The runs are bounded by the capacity, not by the data.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.bpe import id_encoder
from adtally.llm.store import map_batches, written
from adtally.llm.wordhash import slices

SLICE_BYTES = 1 << 20
PIECES = "piece int, start long, length long, ids_crc32 long, block int, nth long"
RUNS = ["length", "low", "high", "sequence", "each", "place"]
PRICE_FALL = 4.0
#: Share of what a configuration could still take that it gets in one round.
STEP = 0.5
#: What counts as nothing left of a length.
COVERED = 1e-3
#: The program ends within this part of the lower bound, or after so many epochs (rounds); how far prices follow what was lacking.
GAP, ROUNDS, PRICE_RISE = 0.001, 6, 0.5
#: How full a sequence must be for its configuration to stay: the choices tried. The last leaves everything to best fit.
FILLS = (0.0, 0.99, 1.0, 2.0)


def cut_documents(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of every document: at most ``capacity`` ids each, all but the first of a cut one full.

    ``block`` and ``nth`` number the pieces of one length within one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_encoder(vocabulary)
        context = TaskContext.get()
        block = context.partitionId() if context else 0
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, start = encode([t or "" for t in part.column("text").to_pylist()])
                ids = np.insert(ids, start[1:], end_id).astype("<u4")
                start = start + np.arange(len(start))
                size = np.diff(start)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = size - (pieces - 1) * capacity
                begin = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                at = start[row] + begin
                data = memoryview(ids).cast("B")
                crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order], side="left")
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - first
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    part.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(row), block), pa.int32()), pa.array(nth, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "block", "nth"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(rows, run, f"id {kind}, {PIECES}")


@dataclass
class Plan:
    """``runs``: pieces of one length, by number from ``low`` below ``high``, ``each`` to a sequence.

    ``bound``: sequences that any packing needs; ``programmed``: pieces placed by the program's configurations.
    """

    runs: list[tuple[int, int, int, int, int, int]]  # length, low, high, sequence, each, offset
    sequences: int
    bound: float = 0.0
    programmed: int = 0


def plan_sequences(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> Plan:
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[n] for n in lengths.tolist()], np.int64)
    amounts, price, bound = _solved(lengths, demand, capacity, rounds)
    whole = {config: int(amount) for config, amount in amounts.items() if amount >= 1}
    more, _ = _cover(lengths, demand - _pieces_of(whole, lengths), capacity, price, whole=True)
    for config, times in more.items():
        whole[config] = whole.get(config, 0) + times
    best, programmed, uses = None, 0, {}
    for fill in FILLS:
        full = {config: times for config, times in whole.items() if sum(n * k for n, k in config) >= fill * capacity}
        left = demand - _pieces_of(full, lengths)
        rest = _best_fit(lengths, left, capacity)
        total = sum(full.values()) + sum(times for _, times in rest)
        if best is None or total < best:
            best, programmed, uses = total, int(demand.sum() - left.sum()), defaultdict(int, full)
            for config, times in rest:
                uses[config] += times
    runs, number, taken = [], 0, dict.fromkeys(lengths.tolist(), 0)
    for config, times in uses.items():
        offset = 0
        for n, k in config:
            runs.append((n, taken[n], taken[n] + times * k, number, k, offset))
            taken[n] += times * k
            offset += n * k
        number += times
    return Plan(runs, number, bound, programmed)


def _pieces_of(uses: dict[tuple, int], lengths: np.ndarray) -> np.ndarray:
    """How many pieces of each length these configurations take."""
    flat = [(n, k * times) for config, times in uses.items() for n, k in config]
    if not flat:
        return np.zeros(len(lengths), np.int64)
    n, k = np.array(flat, np.int64).T
    out = np.zeros(len(lengths), np.int64)
    np.add.at(out, np.searchsorted(lengths, n), k)
    return out


def _solved(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int) -> tuple[dict[tuple, float], np.ndarray, float]:
    """Fractional amounts of configurations that cover every piece, the prices they were found by, and a lower bound.

    An epoch covers everything by the dearest configurations. A length that ended in configurations
    worth less than a sequence was too cheap: its price is multiplied by what they lacked, and the
    next epoch starts from there. Epochs end when the amounts are within ``GAP`` of the bound, or when one gains less than that.
    """
    price = lengths / capacity
    bound = float((lengths * demand).sum() / capacity)
    kept, kept_price = {}, price
    for epoch in range(rounds):
        amounts, dearest = _cover(lengths, demand, capacity, price)
        bound = max(bound, float((demand * price).sum() / dearest)) if dearest else bound
        used, before = sum(amounts.values()), sum(kept.values())
        if epoch == 0 or used < before:
            kept, kept_price = amounts, price
        if min(used, before or used) <= (1 + GAP) * bound or (epoch and used > (1 - GAP) * before):
            break
        lack, weight = np.zeros(len(lengths)), np.zeros(len(lengths))
        for config, amount in amounts.items():
            at = np.searchsorted(lengths, [n for n, _ in config])
            each = np.array([k for _, k in config]) * amount
            lack[at] += each * np.log(max(float((price[at] * [k for _, k in config]).sum()), 1e-9))
            weight[at] += each
        price = price * np.exp(-PRICE_RISE * lack / np.maximum(weight, 1e-9))
    return kept, kept_price, bound


def _cover(lengths: np.ndarray, demand: np.ndarray, capacity: int, start: np.ndarray, whole: bool = False) -> tuple[dict[tuple, float], float]:
    """Amounts of the dearest configurations for all pieces, and what the dearest one is worth at the prices of the start.

    Prices fall with the share that is covered. In a round they are fixed, and its one knapsack
    table gives the dearest configuration around each length that is still open, the longest first.
    ``whole`` takes whole numbers only.
    """
    covered = np.zeros(len(lengths))
    amounts: dict[tuple, float] = defaultdict(int if whole else float)
    dearest = 0.0
    least = 1 if whole else COVERED
    while True:
        open_ = np.flatnonzero(demand - covered >= least)
        if not len(open_):
            return amounts, dearest
        price = start[open_] * np.exp(-PRICE_FALL * covered[open_] / demand[open_])
        best, pick = _knapsack(lengths[open_], price, capacity)
        dearest = dearest or float(best[capacity])
        size, left = lengths[open_].tolist(), (demand - covered)[open_].tolist()
        for i in range(len(size) - 1, -1, -1):
            if left[i] < least:
                continue
            config = Counter(_traced(pick, size, capacity - size[i]))
            config[i] += 1
            room = min(left[j] / k for j, k in config.items())
            if room < least:
                if i < len(size) - 1:
                    continue
                # The longest length always goes: alone with what is there of the rest.
                config = Counter({j: min(k, int(left[j])) if whole else k for j, k in config.items() if left[j] >= least})
                room = min(left[j] / k for j, k in config.items())
            step = max(int(room * STEP), 1) if whole else max(room * STEP, min(room, 1.0))
            amounts[tuple((size[j], k) for j, k in sorted(config.items()))] += step
            for j, k in config.items():
                left[j] -= step * k
        covered[open_] = demand[open_] - np.array(left)


def _knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """For each room the price of the dearest pieces that fit, and one of them: a position in ``lengths``, or -1 for less room."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(int(lengths[0]), capacity + 1):
        gain = best[room - lengths[: fits[room]]] + price[: fits[room]]
        i = int(gain.argmax())
        if gain[i] > best[room - 1]:
            best[room], pick[room] = gain[i], i
        else:
            best[room] = best[room - 1]
    return best, pick.tolist()


def _traced(pick: list[int], lengths: list[int], room: int) -> list[int]:
    """Positions, with repeats, of the dearest pieces for this room."""
    chosen = []
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            chosen.append(pick[room])
            room -= lengths[pick[room]]
    return chosen


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, largest first, over counts: sequences with equal content are handled together."""
    by_gap: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)
    for n, count in zip(lengths[::-1].tolist(), left[::-1].tolist(), strict=True):
        while count > 0:
            gap = min((g for g, x in by_gap.items() if g >= n and x), default=None)
            if gap is None:
                each = min(capacity // n, count)
                times = count // each
                by_gap[capacity - each * n].append((((n, each),), times))
            else:
                config, there = by_gap[gap].pop()
                each = min(gap // n, count)
                times = min(there, count // each)
                if times < there:
                    by_gap[gap].append((config, there - times))
                by_gap[gap - each * n].append(((*config, (n, each)), times))
            count -= times * each
    return [x for group in by_gap.values() for x in group]


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """One row per piece with its sequence and place there; sequences hold at most ``capacity`` ids.

    Defined cases: a null or empty text is one piece of the separator alone; repeated rows and
    rows without an id are packed one by one; very long texts become many full pieces; pieces of
    equal length are interchangeable; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    pieces = written(cut_documents(docs, vocabulary, capacity, end_id, id_column, text_column), "pieces")
    counts = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(histogram, capacity, rounds)
    # One row for each length and task; the window's groups hold one row per task.
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # As an Arrow table the runs are a local relation; a list of rows would start Python workers of its own on the executors.
    runs = spark.createDataFrame(pa.table([pa.array(x, pa.int64()) for x in zip(*plan.runs, strict=True)] or [pa.array([], pa.int64())] * len(RUNS), RUNS))
    numbered = pieces.join(base, ["length", "block"]).withColumn("number", F.col("base") + F.col("nth"))
    placed = numbered.join(F.broadcast(runs), "length").where("number >= low and number < high")
    within = F.col("number") - F.col("low")
    return placed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + within % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
