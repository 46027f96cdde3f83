"""Arithmetic with the rounding and null rules the results depend on.

`even_sql` and its like build SQL text, for features that are applied many at a time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(column: Column, places: int) -> Column:
    """Round half to even on the scaled double, as numeric array libraries and banker's SQL do."""
    scale = float(10**places)
    return F.rint(column * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero or null denominator."""
    return F.try_divide(numerator, denominator)


def even_sql(sql: str, places: int) -> str:
    """`round_even` as SQL text."""
    scale = f"{10**places}D"
    return f"(rint(({sql}) * {scale}) / {scale})"


def clip_low_sql(sql: str, low: str) -> str:
    """Raise values below `low`; null stays null (`greatest` would turn it into `low`)."""
    return f"(CASE WHEN ({sql}) < {low} THEN {low} ELSE ({sql}) END)"


def seconds_sql(later: str, earlier: str) -> str:
    return f"((unix_micros({later}) - unix_micros({earlier})) / 1e6D)"


def right_closed_sql(sql: str, low: int, edges: list[tuple[int, str]], above: str) -> str:
    """Label of the first bin whose right edge is not passed; null at or below `low`."""
    cases = " ".join(f"WHEN {sql} <= {edge} THEN '{name}'" for edge, name in edges)
    return f"CASE WHEN {sql} IS NULL OR {sql} <= {low} THEN NULL {cases} ELSE '{above}' END"
