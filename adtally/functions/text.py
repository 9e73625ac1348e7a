"""Display formats and text predicates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtally.config import ACTION_TEXT, TREND_STABLE
from adtally.functions.numeric import as_col, round_half_up, rounded


def fixed(value: Column, digits: int) -> Column:
    """``%.Nf`` of a value rounded first, so half-way digits print the same everywhere."""
    return F.format_string(f"%.{digits}f", round_half_up(value, digits))


def grouped(value: Column, digits: int) -> Column:
    """Fixed digits with thousands separators."""
    return F.format_string(f"%,.{digits}f", round_half_up(value, digits))


def human_number(value: Column | str, digits: int = 2) -> Column:
    """``0``, ``950.00``, ``1.5K``, ``2.5M``; null reads as ``0``."""
    v = as_col(value).cast("double")
    return (
        F.when(v.isNull() | F.isnan(v) | (v == 0), F.lit("0"))
        .when(v >= 1_000_000, F.concat(fixed(v / 1_000_000, 1), F.lit("M")))
        .when(v >= 1_000, F.concat(fixed(v / 1_000, 1), F.lit("K")))
        .otherwise(grouped(v, digits))
    )


def percent_text(value: Column | str) -> Column:
    v = as_col(value).cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit("0%")).otherwise(F.concat(fixed(v, 2), F.lit("%")))


def currency_text(value: Column | str, digits: int = 0, unit: str = "₫") -> Column:
    """Amount with thousands separators and unit; whole units round half to even."""
    v = as_col(value).cast("double")
    body = F.format_string("%,.0f", F.bround(v, 0)) if digits <= 0 else grouped(v, digits)
    return F.concat(F.when(v.isNull(), F.lit("0")).otherwise(body), F.lit(f" {unit}"))


def trend_text(current: Column, previous: Column) -> Column:
    """Arrow and absolute change in percent; unchanged or unknown reads as stable."""
    change = F.when(previous != 0, (current - previous) / F.abs(previous) * 100).otherwise(F.lit(0.0))
    arrow = F.when(change > 0, F.lit("↑")).otherwise(F.lit("↓"))
    return F.when(previous.isNull() | (current == previous), F.lit(TREND_STABLE)).otherwise(
        F.concat(arrow, F.lit(" "), fixed(F.abs(change), 1), F.lit("%"))
    )


def zoned_text(ts_utc: Column | str, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """UTC timestamp shown in a zone as ``yyyy-MM-dd HH:mm:ss +hhmm``; null reads as ``-``."""
    utc = as_col(ts_utc).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    minutes = F.timestamp_diff("MINUTE", utc, local).cast("int")
    offset = F.format_string(
        "%s%02d%02d",
        F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")),
        F.floor(F.abs(minutes) / 60).cast("int"),
        F.abs(minutes) % 60,
    )
    shown = F.concat_ws(" ", F.date_format(local, "yyyy-MM-dd HH:mm:ss"), offset)
    return F.when(utc.isNull(), F.lit("-")).otherwise(shown)


def zoned_text_from_string(text: Column | str, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """As :func:`zoned_text` for text; blank reads as ``-``, unreadable text stays."""
    raw = as_col(text)
    parsed = F.try_to_timestamp(raw)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), parsed.cast("timestamp_ntz"))
    return (
        F.when(raw.isNull() | (raw == ""), F.lit("-"))
        .when(parsed.isNull(), raw)
        .otherwise(zoned_text(utc, zone))
    )


def is_age_band(value: Column | str) -> Column:
    """True for ``18-24`` style bands; open bands such as ``65+`` are not."""
    return as_col(value).rlike("^[0-9]+-[0-9]+$")


def is_gender(value: Column | str) -> Column:
    return F.upper(as_col(value)).isin("M", "F")


def fixed_sql(sql: str, digits: int) -> str:
    """SQL text of :func:`fixed`."""
    return f"format_string('%.{digits}f', {rounded(sql, digits)})"


def currency_sql(sql: str, unit: str = "₫") -> str:
    """SQL text of :func:`currency_text` in whole units for a value that is never null."""
    return f"concat(format_string('%,.0f', bround({sql}, 0)), ' {unit}')"


def explanation(
    action: str = "suggested_action",
    avg_cpa: str = "avg_cpa",
    avg_cvr: str = "avg_cvr",
    good_ratio: str = "good_ratio",
    score: str = "recommendation_score",
) -> Column:
    """Sentence naming the decision and the figures behind it; arguments are column names."""

    def shown(label: str, name: str, digits: int) -> str:
        return f"concat('{label}=', {fixed_sql(f'coalesce(cast({name} AS double), 0D)', digits)})"

    up, down, keep = (ACTION_TEXT[a] for a in ("increase_budget", "reduce_budget", "keep_and_test"))
    return F.expr(
        f"concat(CASE {action} WHEN 'increase_budget' THEN '{up}' WHEN 'reduce_budget' THEN '{down}' ELSE '{keep}' END, "
        f"'; ', concat_ws(', ', CASE WHEN {avg_cpa} > 0 THEN {shown('avg_cpa', avg_cpa, 2)} END, "
        f"{shown('avg_cvr', avg_cvr, 4)}, {shown('good_ratio', good_ratio, 2)}, {shown('score', score, 4)}))"
    )
