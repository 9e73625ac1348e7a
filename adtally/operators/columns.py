"""Find which columns of an arbitrary file play which role."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: header substrings by role, and substrings that rule a header out
ROLE_NEEDLES = {
    "date": (("date", "day", "datetime", "timestamp"), ()),
    "platform": (("platform", "channel", "source"), ()),
    "campaign_id": (("campaign_id", "campaign", "campaignid"), ()),
    "age_group": (("age_group", "agegroup", "age"), ()),
    "impressions": (("impression",), ()),
    "clicks": (("click",), ()),
    "conversions": (("conversion",), ("rate", "ratio", "cvr", "%")),
    "spend": (("spend", "cost"), ("cpc", "cpm", "cpa", "per", "rate")),
    "revenue": (("revenue", "sales", "value"), ()),
}
# --- end of fixed values


def detect_roles(headers: Sequence[str]) -> dict[str, str | None]:
    """For each role the first header, in file order, that matches it.

    Matching is by substring: ``age`` also matches ``page`` and ``date`` matches
    ``update``, and one header may serve several roles.
    """

    def fits(header: str, needles: Sequence[str], barred: Sequence[str]) -> bool:
        name = header.lower()
        return any(n in name for n in needles) and not any(b in name for b in barred)

    return {
        role: next((h for h in headers if fits(h, needles, barred)), None)
        for role, (needles, barred) in ROLE_NEEDLES.items()
    }


def with_roles(df: DataFrame, roles: dict[str, str | None] | None = None) -> DataFrame:
    """Project the recognised columns under their role names."""
    roles = detect_roles(df.columns) if roles is None else roles
    return df.select(*[F.col(f"`{h}`").alias(role) for role, h in roles.items() if h is not None])
