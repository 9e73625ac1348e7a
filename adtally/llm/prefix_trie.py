"""Prefix trie of conversations: counts and subtree sums of every distinct sequence of first turns.

1. ``number_turns`` sorts turns by range and numbers them; from then on a turn is three hashes
   and the size of its text.
2. Conversations are dealt to shards by hash, very long ones in segments of ``SEGMENT`` turns, so
   that a shard is bounded even if one conversation holds a third of all rows. A shard enumerates
   the distinct digests of its prefixes, gives each a slot by a minimal perfect hash
   (``NodeTable``), scatters its conversations into flat arrays over slots, and adds them up
   through the parent-slot array, deepest nodes first. A node leaves a shard as one row, however
   many of its conversations pass there.
3. Sums over shards give each node's members and its smallest member, the owner. A node is owned
   once, so its own weight (saved bytes, being a leaf, being a child) enters in the owner's shard
   alone: local subtree sums, again through the parent-slot array, add up to the global ones. What
   a conversation owns in later segments enters at the last turn of each earlier one.
4. The ids of conversations that end at a node are sorted by range, packed into strings of
   ``CHUNK`` ids, and hashed as a stream in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.store import written
from adtally.llm.wordhash import mix

SEGMENT = 50_000
SHARD_ROWS = 100_000
CHUNK = 4096
U64 = np.uint64
#: Odd multipliers of the two lanes of a digest.
LANES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
LOCAL = (
    "segment long, shard long, slot long, parent_slot long, depth long, d1 long, d2 long, n_convs long, first long, "
    "has_child boolean, n_bytes long, ghost boolean, proof long, conv long, through boolean"
)
ENTERED = "d1 long, d2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


class NodeTable:
    """Minimal perfect hash of distinct digests: as many slots as digests.

    On each level the digests that have a place to themselves get the next slots; the others go on
    to the next level. A slot keeps its digest, so ``find`` compares before it answers.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = np.empty(len(a), U64), np.empty(len(a), U64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        waiting, given = np.arange(len(a)), 0
        while len(waiting):
            width = 2 * len(waiting) + 1
            at = self._place(a[waiting], b[waiting], len(self.levels), width)
            alone = np.bincount(at, minlength=width) == 1
            rank = given + np.cumsum(alone) - 1
            placed = alone[at]
            slot = rank[at[placed]]
            self.a[slot], self.b[slot] = a[waiting[placed]], b[waiting[placed]]
            self.levels.append((alone, rank))
            given += len(slot)
            waiting = waiting[~placed]

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, width: int) -> np.ndarray:
        return (mix(a ^ mix(b + U64(level * 2 + 1))) % U64(width)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.a)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for digests that are not in the table."""
        out = np.full(len(a), -1, np.int64)
        waiting = np.arange(len(a))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(a[waiting], b[waiting], level, len(alone))
            hit = alone[at]
            slot, who = rank[at[hit]], waiting[hit]
            same = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            out[who[same]] = slot[same]
            waiting = waiting[~hit]
        return out


def number_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``position`` (from 1), three hashes and ``n_bytes`` of every turn.

    Order: turn, null first; ties by role and text. Null roles and texts are empty; repeated rows are
    turns of their own; rows without a conversation id belong to no conversation and are left out;
    an empty table gives no rows; other columns are not read. One sort by range numbers even a
    conversation that fills many tasks.
    """
    said = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )
    hashed = said.withColumns({f"t{k}": F.xxhash64(F.lit(k), "role", "text", F.length("role")) for k in (1, 2, 3)} | {"n_bytes": F.octet_length("text").cast("long")})
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    placed = hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "t1", "t2", "t3", "n_bytes", F.monotonically_increasing_id().alias("at"))
    placed = written(placed.withColumn("piece", F.shiftright("at", 33)), "turns")
    pieces = placed.groupBy("conv_id", "piece").agg(F.min("at").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("conv_id", "piece", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least") + 1).alias("shift"))
    return placed.join(offsets, ["conv_id", "piece"]).select("conv_id", (F.col("at") + F.col("shift")).alias("position"), "t1", "t2", "t3", "n_bytes")


def _powers(base: int, position: np.ndarray) -> np.ndarray:
    """base**position modulo 2**64."""
    least = int(position.min())
    up = np.full(int(position.max()) - least + 1, base, U64)
    up[0] = pow(base, least, 1 << 64)
    return np.cumprod(up, dtype=U64)[position - least]


def _terms(group: pd.DataFrame, lane: int) -> np.ndarray:
    return group[f"t{lane + 1}"].to_numpy().view(U64) * _powers(LANES[lane], group["position"].to_numpy())


def _by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """Slots of each depth, deepest first."""
    order = np.argsort(-depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _up(levels: list[np.ndarray], parent: np.ndarray, values: np.ndarray, add=np.add) -> np.ndarray:
    """Adds each slot's value to its parent's, in depth order."""
    for slots in levels:
        slots = slots[parent[slots] >= 0]
        add.at(values, parent[slots], values[slots])
    return values


def _enumerate(segment_turns: int):
    """Nodes of one shard, and the slot where each of its conversations ends there."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.iloc[np.lexsort((group["position"].to_numpy(), group["conv_id"].to_numpy()))]
        conv, position, segment = group["conv_id"].to_numpy(), group["position"].to_numpy(), int(group["segment"].iloc[0])
        top = np.concatenate([[True], conv[1:] != conv[:-1]])
        run_of, first = np.cumsum(top) - 1, np.flatnonzero(top)
        lanes = []
        for lane in range(2):
            terms = _terms(group, lane)
            terms[top] = group[f"b{lane + 1}"].to_numpy().view(U64)[top]  # what lies before the segment
            total = np.cumsum(terms, dtype=U64)
            lanes.append(mix((total - (total[first] - terms[first])[run_of]) + position.astype(U64) * U64(LANES[1 - lane])))
        order = np.lexsort((lanes[1], lanes[0]))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(lanes[0][order]) != 0) | (np.diff(lanes[1][order]) != 0)
        nodes = NodeTable(lanes[0][order[new]], lanes[1][order[new]])
        slot = nodes.find(*lanes)
        size = len(nodes)
        parent, depth, said, n_bytes = (np.full(size, -1, np.int64) for _ in range(4))
        above = np.where(top, -1, np.concatenate([[-1], slot[:-1]]))
        word, length = group["t3"].to_numpy(), group["n_bytes"].to_numpy()
        parent[slot], depth[slot], said[slot], n_bytes[slot] = above, position, word, length
        if ((parent[slot] != above) | (depth[slot] != position) | (said[slot] != word) | (n_bytes[slot] != length)).any():
            raise ValueError("two different prefixes share a digest")
        last = np.append(first[1:], len(conv)) - 1
        levels = _by_depth(depth)
        count, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        np.add.at(count, slot[last], 1)
        np.minimum.at(least, slot[last], conv[last])
        _up(levels, parent, count)
        _up(levels, parent, least, np.minimum)
        has_child = np.zeros(size, bool)
        has_child[parent[parent >= 0]] = True
        ghost = (depth == segment * segment_turns) & (segment > 0)
        # Rows of one node must agree on what is above it and on its turn, in every shard.
        proof = np.where(parent >= 0, mix(nodes.a[parent] ^ mix(said.view(U64))).view(np.int64), 0)
        shard, m = int(group["shard"].iloc[0]), len(last)
        table = pd.DataFrame({
            "segment": segment, "shard": shard, "slot": np.arange(size), "parent_slot": parent, "depth": depth, "d1": nodes.a.view(np.int64), "d2": nodes.b.view(np.int64),
            "n_convs": np.where(ghost, 0, count), "first": least, "has_child": has_child, "n_bytes": n_bytes, "ghost": ghost, "proof": pd.array(np.where(ghost, 0, proof), "Int64"),
        })
        table.loc[ghost, "proof"] = pd.NA
        table["conv"], table["through"] = pd.array([pd.NA] * size, "Int64"), pd.array([pd.NA] * size, "boolean")
        ends = pd.DataFrame({
            "segment": segment, "shard": shard, "slot": slot[last], "parent_slot": -1, "depth": position[last], "d1": nodes.a[slot[last]].view(np.int64), "d2": nodes.b[slot[last]].view(np.int64),
            "n_convs": 0, "first": conv[last], "has_child": False, "n_bytes": 0, "ghost": False, "proof": pd.array([pd.NA] * m, "Int64"),
            "conv": pd.array(conv[last], "Int64"), "through": pd.array(position[last] == (segment + 1) * segment_turns, "boolean"),
        })
        return pd.concat([table, ends])

    return run


def _accumulate(group: pd.DataFrame) -> pd.DataFrame:
    """Subtree sums of what is owned in one shard."""
    node = group[~group["carried"]].sort_values("slot")
    extra = group[group["carried"]]
    parent, ghost = node["parent_slot"].to_numpy(), node["ghost"].to_numpy().astype(bool)
    owned = node["owned"].to_numpy().astype(bool)
    saved, leaves = np.where(owned, node["weight"].to_numpy(), 0), np.where(owned, node["leaf"].to_numpy(), 0)
    children = np.zeros(len(node), np.int64)
    np.add.at(children, parent[owned & (parent >= 0)], 1)
    np.add.at(saved, extra["slot"].to_numpy(), extra["weight"].to_numpy())
    np.add.at(leaves, extra["slot"].to_numpy(), extra["leaf"].to_numpy())
    levels = _by_depth(node["depth"].to_numpy())
    _up(levels, parent, saved)
    _up(levels, parent, leaves)
    owner = node["conv_id"].to_numpy()
    above = pd.array(owner[np.maximum(parent, 0)], "Int64")
    above[parent < 0] = pd.NA
    return pd.DataFrame({
        "d1": node["d1"], "d2": node["d2"], "conv_id": owner, "depth": node["depth"], "parent_conv_id": above, "n_convs": node["members"], "n_children": children,
        "n_leaves": np.where(ghost, 0, leaves), "saved_tokens": np.where(ghost, 0, saved),
    })


def _sums_before_segments(turns: DataFrame, segment_turns: int) -> DataFrame:
    """Lane sums of all turns before each segment but the first, for conversations that fill one."""

    def total(group: pd.DataFrame) -> pd.DataFrame:
        sums = [_terms(group, lane).sum(dtype=U64).view(np.int64) for lane in range(2)]
        return pd.DataFrame({"conv_id": [group["conv_id"].iloc[0]], "segment": [group["segment"].iloc[0]], "s1": [sums[0]], "s2": [sums[1]]})

    def running(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        sums = [np.cumsum(group[c].to_numpy().view(U64), dtype=U64).view(np.int64) for c in ("s1", "s2")]
        return pd.DataFrame({"conv_id": group["conv_id"], "segment": group["segment"] + 1, "b1": sums[0], "b2": sums[1]})

    long = turns.groupBy("conv_id").agg(F.max("position").alias("n")).where(F.col("n") >= segment_turns).select("conv_id")
    totals = turns.where("position > 0").join(long, "conv_id", "left_semi").groupBy("conv_id", "segment").applyInPandas(total, "conv_id long, segment long, s1 long, s2 long")
    return totals.groupBy("conv_id").applyInPandas(running, "conv_id long, segment long, b1 long, b2 long")


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ending conversations, ids in order and joined by commas."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, conv = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero(np.concatenate([[True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])])) if len(d1) else np.zeros(0, np.int64)
            begin = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(cut, np.append(cut[1:], len(d1)), strict=True)]) if len(cut) else cut
            text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(begin, np.append(begin[1:], len(d1)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(d1[begin]), pa.array(d2[begin]), pa.array(conv[begin]), pa.array(text, pa.string())], ["d1", "d2", "least", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids")), strict=True):
                if (d1, d2) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = (d1, d2), hashlib.sha256(ids.encode())
            yield _sha_rows(done)
        if now is not None:
            yield _sha_rows([(*now, state.hexdigest())])

    by = ["d1", "d2", "conv"]
    chunks = ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(packed, "d1 long, d2 long, least long, ids string")
    order = ["d1", "d2", "least"]
    return chunks.repartition("d1", "d2").sortWithinPartitions(*order).mapInArrow(hashed, "d1 long, d2 long, ends_sha256 string")


def _sha_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["d1", "d2", "ends_sha256"])


def _weight() -> Column:
    return (F.col("members") - 1) * F.col("n_bytes")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, segment_turns: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per distinct prefix of numbered turns (``number_turns``: conv_id, position, t1, t2, t3, n_bytes).

    ``conv_id``: smallest member; ``depth``; ``parent_conv_id``; ``n_convs``; ``n_children``;
    ``n_leaves`` and ``saved_tokens``, summed over the subtree; ``ends_sha256``.
    ``conversations`` names all conversations, also those without turns (by default those of ``turns``);
    positions of a conversation run from 1 without gaps. Defined cases: a conversation without
    turns is a member of the root alone; equal conversations share all their nodes; without any
    conversation there is no row, not even the root. Prefixes are told apart by 128-bit digests; shards and the sum over
    shards compare what stands behind equal digests and fail rather than merge different prefixes.
    """
    if conversations is None:
        conversations = turns.select("conv_id").distinct()
    root = conversations.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("position", "t1", "t2", "t3", "n_bytes")])
    rows = written(turns.select(root.columns).union(root).withColumn("segment", F.floor((F.greatest("position", F.lit(1)) - 1) / segment_turns)), "trie-turns")
    shards = rows.count() // shard_rows + 1
    # The last turn of a segment stands, as a ghost, above the next one.
    on_edge = (F.col("position") > 0) & (F.col("position") % segment_turns == 0)
    dealt = rows.withColumn("segment", F.explode(F.when(on_edge, F.array("segment", F.col("segment") + 1)).otherwise(F.array("segment"))))
    before = _sums_before_segments(rows, segment_turns)
    dealt = dealt.join(before, ["conv_id", "segment"], "left").withColumn("shard", F.pmod(F.xxhash64("conv_id"), F.lit(shards)))
    dealt = dealt.fillna(0, ["b1", "b2"])
    local = written(dealt.groupBy("segment", "shard").applyInPandas(_enumerate(segment_turns), LOCAL), "trie-nodes")

    nodes = local.where("conv is null")
    clash = (F.min("proof") != F.max("proof")) | (F.min("depth") != F.max("depth")) | (F.min("n_bytes") != F.max("n_bytes"))
    merged = nodes.groupBy("d1", "d2").agg(
        F.sum("n_convs").alias("members"), F.min("first").alias("conv_id"), F.max("has_child").alias("inner"), F.max("n_bytes").alias("n_bytes"), F.max("depth").alias("depth"), clash.alias("clash")
    )
    checked = F.when(F.coalesce("clash", F.lit(False)), F.raise_error(F.lit("two different prefixes share a digest")).cast("long")).otherwise(F.col("members"))
    merged = written(merged.withColumn("members", checked).drop("clash"), "trie-merged")

    whole = merged.select("d1", "d2", "members", "conv_id", _weight().alias("weight"), (~F.col("inner")).cast("long").alias("leaf"))
    input_columns = ["segment", "shard", "slot", "parent_slot", "depth", "d1", "d2", "ghost", "carried", "conv_id", "members", "weight", "leaf", "owned"]
    entered = nodes.join(whole, ["d1", "d2"]).withColumns({"owned": (F.col("first") == F.col("conv_id")) & ~F.col("ghost"), "carried": F.lit(False)}).select(input_columns)
    through = local.where("through").select("conv", "segment", "shard", "slot", F.lit(0).cast("long").alias("weight"), F.lit(0).cast("long").alias("leaf"))
    later = merged.where(F.col("depth") > segment_turns).select(
        F.col("conv_id").alias("conv"), F.floor((F.col("depth") - 1) / segment_turns).alias("segment"), F.lit(None).cast("long").alias("shard"), F.lit(None).cast("long").alias("slot"),
        _weight().alias("weight"), (~F.col("inner")).cast("long").alias("leaf"),
    )
    by_segment = through.union(later).groupBy("conv", "segment").agg(F.max("shard").alias("shard"), F.max("slot").alias("slot"), F.sum("weight").alias("weight"), F.sum("leaf").alias("leaf"))
    after = Window.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    carried = by_segment.withColumns({c: F.sum(c).over(after) for c in ("weight", "leaf")}).where("slot is not null and weight is not null")
    none = {c: F.lit(0).cast("long") for c in ("parent_slot", "depth", "d1", "d2", "conv_id", "members")} | {"ghost": F.lit(False), "owned": F.lit(False), "carried": F.lit(True)}
    entered = entered.union(carried.withColumns(none).select(input_columns))
    sums = entered.groupBy("segment", "shard").applyInPandas(_accumulate, ENTERED)
    total = sums.groupBy("d1", "d2").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")], *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    )
    ends = _ends_sha256(local.where("not through"))
    nothing = hashlib.sha256(b"").hexdigest()
    out = total.join(ends, ["d1", "d2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
