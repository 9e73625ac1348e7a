"""Exact medians and global ranks without gathering the values in one task.

``median`` and ``rank`` over a whole table keep every distinct value in one
task. Here values are first counted per bucket of a monotone function, so only
bucket counts meet in one place, and the search goes on inside one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PER_E_FOLD = 4096
SPLITS = 2**18

# Buckets are coalesced so that the optimizer adds no null checks of its own to
# one of the two uses of ``pool``: both stay the same plan and run once.
_MEDIAN = """
WITH vals AS (
  SELECT {keys} cast(`{value}` AS double) AS v FROM {{df}}
), keyed AS (
  SELECT {keys} v, {coarse} AS b FROM vals WHERE v IS NOT NULL AND NOT isnan(v)
), coarse AS (
  SELECT {keys} b, count(*) AS n, min(v) AS lo, max(v) AS hi FROM keyed GROUP BY {keys} b
), coarse_upto AS (
  SELECT *, sum(n) OVER (PARTITION BY {part}) AS total, lead(lo) OVER w AS after,
    sum(n) OVER w AS upto
  FROM coarse WINDOW w AS (PARTITION BY {part} ORDER BY b)
), middle AS (
  SELECT {keys} b, lo, hi, after, total % 2 = 0 AS even, (total - 1) div 2 - (upto - n) AS k
  FROM coarse_upto WHERE (total - 1) div 2 >= upto - n AND (total - 1) div 2 < upto
), pool AS (
  SELECT {hint} {keyed_keys} v, lo, hi, after, even, k, count(*) AS n
  FROM keyed JOIN middle USING ({using} b) GROUP BY {keyed_keys} v, lo, hi, after, even, k
), split AS (
  SELECT *, coalesce(floor((v - lo) / nullif(hi - lo, 0D) * {splits}), 0L) AS s FROM pool
), fine AS (
  SELECT {keys} s, after, even, k, sum(n) AS n, min(v) AS lo FROM split GROUP BY {keys} s, after, even, k
), fine_upto AS (
  SELECT {keys} s, even, k, n, coalesce(lead(lo) OVER w, after) AS after,
    sum(n) OVER w AS upto
  FROM fine WINDOW w AS (PARTITION BY {part} ORDER BY s)
), sliver AS (
  SELECT {keys} s, after, even, k - (upto - n) AS k FROM fine_upto WHERE k >= upto - n AND k < upto
), ordered AS (
  SELECT {sliver_hint} {split_keys} split.v, split.n, sliver.even, sliver.k,
    coalesce(lead(split.v) OVER w, sliver.after) AS after,
    sum(split.n) OVER w AS upto
  FROM split JOIN sliver ON {same_group} split.s = sliver.s
  WINDOW w AS (PARTITION BY {split_part} ORDER BY split.v)
)
SELECT {keys} (v + CASE WHEN even AND k + 1 >= upto THEN after ELSE v END) / 2 AS median
FROM ordered WHERE k >= upto - n AND k < upto
"""

_COARSE = "coalesce(cast(signum(v) * floor(log1p(least(abs(v), 1e300D) * 1e6D) * {per}) AS bigint), 0L)"


def coarse_bucket(v: str) -> str:
    """SQL text of a monotone bucket number, about 0.025% wide; the range of double bounds how many there are."""
    return _COARSE.format(per=PER_E_FOLD).replace("(v)", f"({v})")


def exact_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Median of the non-null values, the mean of the middle two for even counts.

    Returns ``by..., median``: one row per group with values, so no row at all
    for an empty input. Rows whose group key is null are a group of their own.

    Two passes read the data: one counts buckets, one keeps the bucket that holds
    the middle. That bucket's distinct values are split once more by linear
    buckets. What is left spans 2**-30 of the value, so however many rows there
    are, only the doubles inside that sliver are ordered in one place. Windows
    run over bucket counts and that sliver, never over data rows.

    The looked-up buckets are one row per group. Without groups that is a single
    row, always safe to broadcast; with groups Spark decides by their size.
    """
    # As one struct, keys with nulls in them compare equal.
    names = ["`_group`"] if by else []
    if by:
        df = df.select(F.struct(*by).alias("_group"), value)
    small = not names
    text = _MEDIAN.format(
        value=value,
        keys="".join(f"{c}, " for c in names),
        keyed_keys="".join(f"keyed.{c}, " for c in names),
        split_keys="".join(f"split.{c}, " for c in names),
        using="".join(f"{c}, " for c in names),
        same_group="".join(f"split.{c} = sliver.{c} AND " for c in names),
        part=", ".join(names) or "1",
        split_part=", ".join(f"split.{c}" for c in names) or "1",
        coarse=coarse_bucket("v"),
        splits=SPLITS - 1,
        hint="/*+ BROADCAST(middle) */" if small else "",
        sliver_hint="/*+ BROADCAST(sliver) */" if small else "",
    )
    found = df.sparkSession.sql(text, df=df)
    return found.select("_group.*", "median") if by else found


def sum_before(counts: DataFrame, value: str, weight: str, name: str, bucket: str, descending: bool = False) -> DataFrame:
    """Running total of ``weight`` over the rows that come before in the order of ``value``.

    ``counts`` holds each value once. ``bucket`` is SQL text of a monotone function
    with a bounded number of results: totals per bucket are ordered in one place,
    values only within their bucket.
    """
    order = (lambda c: F.desc(c)) if descending else (lambda c: F.asc(c))
    rows = counts.withColumn("_b", F.expr(bucket))
    before = (Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_b")
        .agg(F.sum(weight).alias("_n"))
        .select("_b", F.sum("_n").over(Window.orderBy(order("_b")).rowsBetween(*before)).alias("_ahead"))
    )
    inside = F.sum(weight).over(Window.partitionBy("_b").orderBy(order(value)).rowsBetween(*before))
    return (
        rows.withColumn("_inside", inside)
        .join(offsets, "_b")
        .withColumn(name, F.coalesce("_ahead", F.lit(0)) + F.coalesce("_inside", F.lit(0)))
        .select(*counts.columns, name)
    )


def global_rank(df: DataFrame, value: str, rank_name: str) -> DataFrame:
    """``rank() over (order by value desc)`` for a table of any size.

    Ranks are worked out per distinct value: equal values form one row before
    anything is ordered, so a value shared by a third of the rows costs nothing
    extra. Rows whose value is null or NaN share the rank behind all others.
    """
    v = F.col(value).cast("double")
    keyed = df.withColumn("_v", F.when(~F.isnan(v), v))
    counts = keyed.where("_v is not null").groupBy("_v").agg(F.count("*").alias("_n"))
    ahead = sum_before(counts, "_v", "_n", "_ahead_of", coarse_bucket("`_v`"), descending=True)
    ranks = ahead.select("_v", (F.col("_ahead_of") + 1).alias(rank_name))
    last = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)) + 1).scalar()
    return keyed.join(ranks, "_v", "left").withColumn(rank_name, F.coalesce(rank_name, last)).drop("_v")


def roc_area(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve of scores in 0..1 against 0/1 labels, as one ``roc_auc``.

    It is the share of (positive, negative) pairs in which the positive scores
    higher, ties counting half; NULL without both kinds. Pairs are never formed:
    per distinct score, the negatives below are counted.
    """
    counts = rows.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    # By log-odds: the scores of a good model crowd at 0 and 1, where equal steps would be one bucket.
    odds = f"ln(greatest(`{score}`, 1e-300D) / greatest(1D - `{score}`, 1e-300D))"
    below = sum_before(counts, score, "_neg", "_below", f"cast(floor({odds} * {PER_E_FOLD}) AS bigint)")
    won = "sum(cast(_pos AS double) * (_below + _neg / 2D))"
    pairs = "nullif(cast(sum(_pos) AS double) * sum(_neg), 0D)"
    return below.agg(F.expr(f"{won} / {pairs}").alias("roc_auc"))
