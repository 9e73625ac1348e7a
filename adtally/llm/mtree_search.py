"""Exact top-k by inner product through M-trees.

Inner products become distances by one more component: with ``M`` the largest norm of a tree, a
candidate x gets ``sqrt(M**2 - |x|**2)`` and a query 0, and then
``|q - x|**2 = |q|**2 + M**2 - 2 * q.x``; the nearest candidates are those of the largest
products. Candidates are dealt to cells around a bounded number of pivots, cells above
``tree_rows`` into several trees, and each tree is built in one task and written as
pages: entries with their distance to the page's centre and a covering radius.

A query first searches a tree of its own cell. With the score it has then, it is sent
only to trees whose covering radius can still hold a better one. In a tree it visits
pages best first, skips entries whose stored distances rule them out by the triangle
inequality, and stops when the best open page cannot help. Scores themselves are whole
numbers, so the result is exact; bounds carry a small allowance for rounding, and products too
large for doubles are added up again as integers. Vectors of very different norms go to
different trees, so that a few huge ones do not blunt the bounds of the rest.
Queries are joined with trees in blocks of ``query_rows``.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.store import written

PIVOTS, TREE_ROWS, QUERY_ROWS, PAGE, FANOUT = 512, 8192, 4096, 512, 16
SLACK = 1e-6
PAGES = "cell long, tree long, node long, leaf boolean, vectors binary, ids binary, extra binary, radius binary, from_center binary, child binary, center binary, center_extra double, cover double, largest double"
#: Doubles hold whole numbers up to here; components beyond ``FAR`` are taken as that.
WHOLE, FAR = 2.0**53, 1e100


def whole_vectors(df: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of each component, a whole number as a double.

    Only rows without an id, with a null vector, or with a component that is null or not finite go.
    """
    components = F.col(vector_column).cast("array<double>")
    y = F.transform(components, lambda c: F.greatest(F.least(c * F.lit(float(scale)), F.lit(FAR)), F.lit(-FAR)))
    x = F.transform(y, lambda c: F.when(F.abs(c) < WHOLE, F.floor(F.greatest(F.least(c, F.lit(WHOLE)), F.lit(-WHOLE))).cast("double")).otherwise(c))
    usable = F.forall(components, lambda c: F.coalesce(F.abs(c) < F.lit(math.inf), F.lit(False)))
    return df.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()).where(usable).select(F.col(id_column).alias("id"), x.alias("v"))


def exact_score(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product of whole numbers, as a 64-bit number or the nearest one."""
    total = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist(), strict=True))
    return max(-(1 << 63), min((1 << 63) - 1, total))


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def _dist(a: np.ndarray, ax, b: np.ndarray, bx) -> np.ndarray:
    """Distances of the rows of ``a`` to ``b``, both with their extra component."""
    return np.sqrt(((a - b) ** 2).sum(axis=-1) + (ax - bx) ** 2)


def build_pages(vectors: np.ndarray, ids: np.ndarray, extra: np.ndarray) -> list[dict]:
    """Pages of an M-tree over these candidates; page 0 is the root."""
    pages: list[dict] = []

    def center_of(at: np.ndarray) -> int:
        mean, mean_x = vectors[at].mean(axis=0), extra[at].mean()
        return int(at[_dist(vectors[at], extra[at], mean, mean_x).argmin()])

    def split(at: np.ndarray) -> list[np.ndarray]:
        chosen = [int(at[0])]
        far = _dist(vectors[at], extra[at], vectors[chosen[0]], extra[chosen[0]])
        owner = np.zeros(len(at), np.int64)
        while len(chosen) < FANOUT and far.max() > 0:
            chosen.append(int(at[far.argmax()]))
            d = _dist(vectors[at], extra[at], vectors[chosen[-1]], extra[chosen[-1]])
            owner[d < far] = len(chosen) - 1
            far = np.minimum(far, d)
        groups = [at[owner == i] for i in range(len(chosen))]
        if max(map(len, groups)) > 0.9 * len(at):  # mostly one point: any even split is as good
            groups = np.array_split(at, max(2, min(FANOUT, -(-len(at) // PAGE))))
        return [g for g in groups if len(g)]

    def build(at: np.ndarray) -> tuple[int, int, float]:
        number = len(pages)
        pages.append({})
        center = center_of(at)
        to_center = _dist(vectors[at], extra[at], vectors[center], extra[center])
        if len(at) <= PAGE:
            entries, radius, child = at, np.zeros(len(at)), np.full(len(at), -1)
        else:
            made = [build(g) for g in split(at)]
            entries = np.array([c for _, c, _ in made])
            radius, child = np.array([r for *_, r in made]), np.array([n for n, *_ in made])
        cover = float(to_center.max())
        pages[number] = {
            "node": number, "leaf": bool(len(at) <= PAGE), "vectors": vectors[entries].tobytes(), "ids": ids[entries].astype(np.int64).tobytes(), "extra": extra[entries].tobytes(),
            "radius": radius.astype(np.float64).tobytes(), "from_center": _dist(vectors[entries], extra[entries], vectors[center], extra[center]).tobytes(),
            "child": child.astype(np.int64).tobytes(), "center": vectors[center].tobytes(), "center_extra": float(extra[center]), "cover": cover,
        }
        return number, center, cover

    if len(ids):
        build(np.argsort(ids, kind="stable"))
    return pages


class Tree:
    def __init__(self, pages: pd.DataFrame):
        self.largest = float(pages["largest"].iloc[0])
        self.pages = {}
        for p in pages.itertuples(index=False):
            center = np.frombuffer(p.center, np.float64)
            self.pages[p.node] = (
                p.leaf, np.frombuffer(p.vectors, np.float64).reshape(len(p.ids) // 8, len(center)), np.frombuffer(p.ids, np.int64), np.frombuffer(p.extra, np.float64),
                np.frombuffer(p.radius, np.float64), np.frombuffer(p.from_center, np.float64), np.frombuffer(p.child, np.int64), center, p.center_extra, p.cover,
            )
        self.computed = 0

    def search(self, q: np.ndarray, me: int, k: int, least: float) -> list[tuple[int, int]]:
        """Up to ``k`` (score, id) of candidates other than ``me``, best first; none below ``least`` is needed."""
        qq = float(q @ q)
        reach = qq + self.largest**2
        best: list[tuple[int, int]] = []  # a heap whose first is the worst: (score, -id)

        def bound() -> float:
            return max(least, best[0][0] if len(best) == k else -math.inf)

        def top(low):  # the largest score at this distance or beyond
            return (reach - np.maximum(low, 0.0) ** 2) / 2 + SLACK * (1.0 + reach)

        *_, center, extra, cover = self.pages[0]
        d = float(_dist(center, extra, q, 0.0))
        heap = [(-float(top(d - cover)), 0, d)]
        while heap:
            gain, node, d = heapq.heappop(heap)
            if -gain < bound():
                break
            leaf, vectors, ids, own, radius, from_center, child, *_ = self.pages[node]
            open_ = np.flatnonzero(top(np.abs(d - from_center) - radius) >= bound())
            if not len(open_):
                continue
            self.computed += len(open_)
            score = vectors[open_] @ q
            if leaf:
                # Products beyond the whole numbers of doubles may be off by this much.
                size = np.sqrt(qq * (vectors[open_] ** 2).sum(axis=1))
                off = np.where(size < WHOLE / 2, 0.0, size * 1e-12)
                most = score + off
                good = np.flatnonzero(most >= bound())
                for i in good[np.lexsort((ids[open_[good]], -most[good]))].tolist():
                    if most[i] < bound():
                        break
                    one = int(ids[open_[i]])
                    if one == me:
                        continue
                    entry = (exact_score(vectors[open_[i]], q) if off[i] else int(score[i]), -one)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            else:
                far = np.sqrt(np.maximum(qq + (vectors[open_] ** 2).sum(axis=1) + own[open_] ** 2 - 2 * score, 0.0))
                gains = top(far - radius[open_])
                for i in np.flatnonzero(gains >= bound()).tolist():
                    heapq.heappush(heap, (-float(gains[i]), int(child[open_[i]]), float(far[i])))
        return [(s, -i) for s, i in sorted(best, key=lambda x: (-x[0], -x[1]))]


def top_k(
    candidates: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding",
    tree_rows: int = TREE_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` largest inner products.

    Queries are the rows of ``is_query``, candidates all rows but those with the query's own id; equal
    scores go to the smaller id. Defined cases: rows without an id or with a vector that is null or holds
    null or non-finite components take no part; vectors are compared with those of their own length; rows that
    repeat an id are candidates of their own and never meet each other, and a query id that
    repeats gets the best of all its rows together; scores beyond 64 bits are the nearest such number;
    fewer candidates give fewer rows; an empty table gives none; other columns are not read.
    """
    spark = candidates.sparkSession
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    usable = whole_vectors(candidates, id_column, vector_column, scale)
    queried = candidates.where(is_query).select(F.col(id_column).alias("id")).distinct().withColumn("query", F.lit(True))
    points = written(usable.join(queried, "id", "left").select("id", F.monotonically_increasing_id().alias("row"), "v", F.coalesce("query", F.lit(False)).alias("query"), F.size("v").alias("dim"), norm.alias("norm")), "points")
    facts = points.agg(F.count("*").alias("n"), F.count_if("query").alias("q")).first()
    # A bounded number of pivots, taken by a hash of their id.
    wanted = min(PIVOTS, -(-facts["n"] // tree_rows) * 2)
    pivots = [np.array(r["v"], np.float64) for r in points.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()]
    held = spark.sparkContext.broadcast(pivots)

    def place(frames):
        centers = held.value
        for df in frames:
            cell, near = np.zeros(len(df), np.int64), np.full(len(df), np.inf)
            rows, sizes = df["v"].tolist(), df["dim"].to_numpy()
            matrix = {n: _matrix([rows[j] for j in np.flatnonzero(sizes == n)]) for n in {len(c) for c in centers}}
            for i, c in enumerate(centers):
                at = np.flatnonzero(sizes == len(c))
                if len(at):
                    d = _dist(matrix[len(c)], 0.0, c, 0.0)
                    closer = d < near[at]
                    cell[at[closer]], near[at[closer]] = i, d[closer]
            # A length without a pivot gets a cell of its own.
            lone = np.isinf(near)
            cell[lone] = len(centers) + df["dim"].to_numpy()[lone]
            # Norms of a tree are within a factor of 256 of each other, small ones apart.
            band = np.log2(np.maximum(df["norm"].to_numpy(), 1.0) + 1.0).astype(np.int64) // 16
            yield df.assign(cell=cell * 64 + np.where(band < 3, 0, np.minimum(band, 63)))

    dealt = written(points.mapInPandas(place, "id long, row long, v array<double>, query boolean, dim int, norm double, cell long"), "cells")
    counts = dealt.groupBy("cell").agg(F.ceil(F.count("*") / tree_rows).alias("trees"))
    spread = dealt.join(counts, "cell").withColumn("tree", F.pmod(F.xxhash64("id", "row"), F.col("trees")))

    def grow(df: pd.DataFrame) -> pd.DataFrame:
        largest = math.sqrt(df["norm"].max())
        extra = np.sqrt(np.maximum(df["norm"].max() - df["norm"].to_numpy(), 0.0))
        made = pd.DataFrame(build_pages(_matrix(df["v"].tolist()), df["id"].to_numpy(), extra))
        return made.assign(cell=df["cell"].iloc[0], tree=df["tree"].iloc[0], largest=largest)[[c.split(" ")[0] for c in PAGES.split(", ")]]

    pages = written(spread.groupBy("cell", "tree").applyInPandas(grow, PAGES), "pages")
    roots = pages.where("node = 0").select("cell", "tree", "center", "center_extra", "cover", "largest")
    blocks = max(1, -(-facts["q"] // query_rows))
    queries = spread.where("query").select("id", "row", "v", "dim", "cell", "tree", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"))

    def look(page_rows: pd.DataFrame, query_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(page_rows) and len(query_rows):
            tree = Tree(page_rows)
            for q in query_rows.itertuples(index=False):
                out += [(q.id, q.row, i, s) for s, i in tree.search(np.asarray(q.v, np.float64), q.id, k, q.least)]
        return pd.DataFrame(out, columns=["query_id", "row", "vec_id", "score"])

    def visit(asked: DataFrame) -> DataFrame:
        """Each tree meets one block of its queries at a time."""
        keys = asked.select("cell", "tree", F.col("block").alias("asked_block")).distinct()
        there = pages.join(keys, ["cell", "tree"]).withColumnRenamed("asked_block", "block")
        return there.groupBy("cell", "tree", "block").cogroup(asked.groupBy("cell", "tree", "block")).applyInPandas(look, "query_id long, row long, vec_id long, score long")

    first = written(visit(queries.withColumn("least", F.lit(-math.inf))), "first")
    kth = first.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    known = written(queries.join(kth, "row", "left").select("id", "row", "v", "dim", F.col("cell").alias("c0"), F.col("tree").alias("t0"), "block", F.coalesce(F.col("kth").cast("double"), F.lit(-math.inf)).alias("least")), "known")

    def route(roots_of: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Trees whose cover can hold a score as good as the query's k-th so far."""
        out = []
        if len(roots_of) and len(asked):
            centers = [np.frombuffer(c, np.float64) for c in roots_of["center"]]
            for dim in sorted(set(asked["dim"])):
                these = asked[asked["dim"] == dim]
                q, least = _matrix(these["v"].tolist()), these["least"].to_numpy()
                qq = (q * q).sum(axis=1)
                for j, c in enumerate(centers):
                    if len(c) != dim:
                        continue
                    row = roots_of.iloc[j]
                    low = np.maximum(_dist(q, 0.0, c, row["center_extra"]) - row["cover"], 0.0)
                    reach = qq + row["largest"] ** 2
                    can = (reach - low**2) / 2 + SLACK * (1.0 + reach) >= least
                    can &= ~((these["c0"].to_numpy() == row["cell"]) & (these["t0"].to_numpy() == row["tree"]))
                    out.append(these[can].assign(cell=row["cell"], tree=row["tree"]))
        cols = ["row", "cell", "tree"]
        return pd.concat(out)[cols] if out else pd.DataFrame({c: pd.Series(dtype=object) for c in cols})

    # Roots and queries meet in blocks too: every block of queries with every shelf of roots.
    shelves = max(1, -(-facts["n"] // (tree_rows * 1024)))
    shelved = roots.withColumn("shelf", F.pmod(F.xxhash64("cell", "tree"), F.lit(shelves))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asking = known.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    routed = shelved.groupBy("shelf", "block").cogroup(asking.groupBy("shelf", "block")).applyInPandas(route, "row long, cell long, tree long")
    # What is written holds no vectors: they join again by row.
    rest = visit(written(routed, "routed").join(known.select("row", "id", "v", "dim", "block", "least"), "row"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(id_column), "score")
