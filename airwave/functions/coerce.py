"""Lenient typing of raw columns: a bad value becomes null or a default, never an error.

Each function looks a column up by name, so an absent column takes the default, and a column that
already has the right type passes through without text parsing.
"""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A calendar date must lead: a bare "12:00" would otherwise parse as today's noon.
ISO_DATE = r"^\s*\d{4}-\d{2}-\d{2}"
# Decimal numbers only; the JVM parser alone would also take "12d" and hexadecimal floats.
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TRUE_TEXT = r"(?iU)^\s*true\s*$"


def run_instant(run_ts: datetime | str | None = None) -> Column:
    """The run's one "now", in whole seconds. A string is read as ISO-8601, UTC if unzoned."""
    if run_ts is None:
        run_ts = datetime.now(timezone.utc)
    if isinstance(run_ts, str):
        run_ts = datetime.fromisoformat(run_ts.replace("Z", "+00:00"))
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    stamp = run_ts.astimezone(timezone.utc).replace(microsecond=0)
    return F.to_timestamp(F.lit(stamp.isoformat()))


def _type_of(df: DataFrame, name: str) -> T.DataType | None:
    return df.schema[name].dataType if name in df.columns else None


def timestamp_column(df: DataFrame, name: str) -> Column:
    """UTC instant; unparseable text and an absent column give null."""
    kind = _type_of(df, name)
    if kind is None or isinstance(kind, T.NullType):
        return F.lit(None).cast("timestamp")
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return F.when(column.rlike(ISO_DATE), F.try_to_timestamp(F.trim(column)))
    return column.cast("timestamp")


def _finite(column: Column) -> Column:
    # NaN sorts above every number in Spark, so it must not survive typing.
    return F.when(F.isnan(column) | (F.abs(column) == float("inf")), None).otherwise(column)


def double_column(df: DataFrame, name: str, default: float | None = None) -> Column:
    """Finite double; anything else gives `default`."""
    kind = _type_of(df, name)
    if kind is None or isinstance(kind, T.NullType):
        return F.lit(default).cast("double")
    column = F.col(name)
    if isinstance(kind, T.StringType):
        column = F.when(column.rlike(DECIMAL), column.try_cast("double"))
    column = _finite(column.try_cast("double"))
    return column if default is None else F.coalesce(column, F.lit(default))


def whole_column(
    df: DataFrame, name: str, default: int | None = None, to: str = "bigint"
) -> Column:
    """Whole number; a fraction is cut, anything unusable gives `default`."""
    kind = _type_of(df, name)
    if kind is None or isinstance(kind, T.NullType):
        return F.lit(default).cast(to)
    column = F.col(name)
    if isinstance(kind, T.IntegralType):
        column = column.try_cast(to)
    elif isinstance(kind, T.StringType):
        column = F.coalesce(column.try_cast("bigint"), double_column(df, name).try_cast("bigint"))
        column = column.try_cast(to)
    else:
        column = double_column(df, name).try_cast("bigint").try_cast(to)
    return column if default is None else F.coalesce(column, F.lit(default).cast(to))


def flag_column(df: DataFrame, name: str) -> Column:
    """True only for the text `true` in any case, white space around it ignored."""
    kind = _type_of(df, name)
    if kind is None:
        return F.lit(False)
    if isinstance(kind, T.BooleanType):
        return F.coalesce(F.col(name), F.lit(False))
    return F.coalesce(F.col(name).cast("string").rlike(TRUE_TEXT), F.lit(False))


def text_column(df: DataFrame, name: str, default: str) -> Column:
    if name not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(name).cast("string"), F.lit(default))


def column_or(df: DataFrame, name: str, default: Any, to: str) -> Column:
    """The column cast to `to`, or a literal where the table lacks it."""
    return F.col(name).cast(to) if name in df.columns else F.lit(default).cast(to)
