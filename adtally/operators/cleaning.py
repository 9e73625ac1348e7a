"""Schema repair, validation, coercion, cleaning and duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.config import AD_COLUMNS, AD_DEFAULTS, AD_SCHEMA, CLEANING_REQUIRED, METRICS, SCORED_DEFAULTS
from adtally.functions.numeric import number_or_null


class MissingColumnsError(ValueError):
    """Raised before any job runs when an input lacks required columns."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    need, got = sorted(required), sorted(df.columns)
    missing = [c for c in need if c not in got]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}. Need: {need}. Got: {got}")
    return df


def canonicalize(df: DataFrame, defaults: Mapping = AD_DEFAULTS, with_ad_id: bool = True) -> DataFrame:
    """Add the columns a file lacks, in one projection.

    A missing ``ad_id`` is numbered per partition: unique, increasing, with gaps.
    """
    extra = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    if with_ad_id and "ad_id" not in df.columns:
        extra["ad_id"] = F.monotonically_increasing_id() + 1
    return df.select("*", *[v.alias(c) for c, v in extra.items()])


def canonicalize_scored(df: DataFrame) -> DataFrame:
    return canonicalize(df, SCORED_DEFAULTS, with_ad_id=False)


def to_typed(df: DataFrame) -> DataFrame:
    """Lenient cast to the ad schema: what does not fit becomes null, counts are truncated."""
    types = dict(df.dtypes)

    def typed(field) -> Column:
        c, kind = F.col(field.name), field.dataType.simpleString()
        if types[field.name] == kind:
            return c
        if field.name in ("impressions", "clicks", "conversions"):
            return number_or_null(c, df.schema[field.name].dataType).try_cast("bigint").alias(field.name)
        if kind == "double":
            return number_or_null(c, df.schema[field.name].dataType).alias(field.name)
        if kind == "date":
            return lenient_date(c).alias(field.name)
        return c.try_cast(kind).alias(field.name)

    return df.select(*[typed(f) for f in AD_SCHEMA.fields])


def lenient_date(value: Column) -> Column:
    """Date of a date, timestamp or text; unreadable text is null."""
    return F.coalesce(value.try_cast("date"), F.try_to_timestamp(value.cast("string")).cast("date"))


def coerce_metrics(df: DataFrame, columns: Sequence[str] = METRICS, clip: bool = False) -> DataFrame:
    """Make metrics double, unreadable or missing values 0; ``clip`` also lifts negatives to 0."""
    out = {}
    for name in columns:
        if name in df.columns:
            number = F.coalesce(number_or_null(F.col(name), df.schema[name].dataType), F.lit(0.0))
            out[name] = F.greatest(number, F.lit(0.0)) if clip else number
    return df.withColumns(out)


def convert_currency(df: DataFrame, rate: float, columns: Sequence[str] = ("spend", "revenue")) -> DataFrame:
    """Multiply money columns by ``rate`` and lift negatives to 0.

    Rates 0 and 1 and any negative rate leave the frame as it is.
    """
    rate = max(0.0, float(rate))
    if rate in (0.0, 1.0):
        return df
    out = {}
    for name in columns:
        if name in df.columns:
            number = F.coalesce(number_or_null(F.col(name), df.schema[name].dataType), F.lit(0.0))
            out[name] = F.greatest(number * F.lit(rate), F.lit(0.0))
    return df.withColumns(out)


def drop_incomplete(df: DataFrame, required: Sequence[str] = CLEANING_REQUIRED) -> DataFrame:
    return require_columns(df, required).na.drop(subset=list(required))


def clean(df: DataFrame) -> DataFrame:
    """Rows with all required values, in the ten ad columns."""
    require_columns(df, CLEANING_REQUIRED)
    return drop_incomplete(canonicalize(df)).select(*AD_COLUMNS)


def cleaning_report(df: DataFrame, required: Sequence[str] = CLEANING_REQUIRED) -> DataFrame:
    """Rows before and after cleaning and rows removed, from one pass."""
    require_columns(df, required)
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    counts = df.agg(F.count("*").alias("initial_count"), F.count_if(complete).alias("final_count"))
    return counts.withColumn("removed_rows", F.col("initial_count") - F.col("final_count"))


def dedupe(df: DataFrame, keys: Sequence[str] = ("ad_id",), keep: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; rows without a complete key are no copies of each other and all stay.

    By default the row that is smallest by its other columns stays, which makes
    reruns agree. That choice is a ``min`` with partial aggregation, so a key
    with very many copies is reduced before the shuffle. ``keep`` orders the
    candidates instead and then needs a window per key.
    """
    keys = list(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    names = df.columns
    df = df.withColumn("_own", F.when(missing, F.monotonically_increasing_id()))
    keys.append("_own")
    if keep is not None:
        w = Window.partitionBy(*keys).orderBy(*keep)
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*names)
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*keys, "_row.*").select(*names)
