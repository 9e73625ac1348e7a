"""Optional filters, listings and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_ads(
    scored: DataFrame,
    campaign_id: str | None = None,
    age_group: str | None = None,
    quality_label: str | None = None,
    min_ctr: float | None = None,
    max_cpa: float | None = None,
) -> DataFrame:
    """All given conditions at once; age and label ignore case.

    A null ctr counts as 0, a null cpa never passes ``max_cpa``.
    """
    if campaign_id:
        scored = scored.where(F.col("campaign_id") == campaign_id)
    if age_group:
        scored = scored.where(F.lower("age_group") == age_group.lower())
    if quality_label:
        scored = scored.where(F.lower("quality_label") == quality_label.lower())
    if min_ctr is not None:
        scored = scored.where(F.coalesce("ctr", F.lit(0.0)) >= min_ctr)
    if max_cpa is not None:
        scored = scored.where(F.col("cpa") <= max_cpa)
    return scored


def filter_segments(
    recommendations: DataFrame,
    campaign_id: str | None = None,
    age_group: str | None = None,
    suggested_action: str | None = None,
) -> DataFrame:
    """Campaign and age exactly as written, action ignoring case."""
    if campaign_id:
        recommendations = recommendations.where(F.col("campaign_id") == campaign_id)
    if age_group:
        recommendations = recommendations.where(F.col("age_group") == age_group)
    if suggested_action:
        recommendations = recommendations.where(F.lower("suggested_action") == suggested_action.lower())
    return recommendations


def contains_text(df: DataFrame, **terms: str | None) -> DataFrame:
    """Rows whose columns contain the terms, ignoring case; blank terms are skipped.

    ``%`` and ``_`` match as wildcards.
    """
    for name, term in terms.items():
        if term and term.strip():
            df = df.where(F.lower(name).like(f"%{term.strip().lower()}%"))
    return df


def at_least_one(value: int) -> int:
    """A page size: as asked for, but never below one row."""
    return max(1, int(value))


def first_rows(df: DataFrame, order: Sequence[Column | str], limit: int, with_total: bool = True) -> DataFrame:
    """The first ``limit`` rows in ``order``, each with the ``total`` number of matches."""
    total = df.agg(F.count("*")).scalar()
    top = df.orderBy(*order).limit(limit)
    return top.withColumn("total", total) if with_total else top


def page_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    page: int = 1,
    page_size: int = 50,
) -> DataFrame:
    """One page and the ``total`` number of matches; page and size are at least 1, with no upper bound."""
    size = at_least_one(page_size)
    offset = (max(1, int(page)) - 1) * size
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).offset(offset).limit(size).withColumn("total", total)


def rows_after(df: DataFrame, newest: str, tie: str, last_newest, last_tie, page_size: int) -> DataFrame:
    """Next page behind a known last row, newest first.

    Skipping with ``offset`` sorts everything before the page; continuing from the
    last row keeps the work per page the same at any depth.
    """
    behind = (F.col(newest) < F.lit(last_newest)) | (
        (F.col(newest) == F.lit(last_newest)) & (F.col(tie) < F.lit(last_tie))
    )
    return df.where(behind).orderBy(F.desc(newest), F.desc(tie)).limit(page_size)
