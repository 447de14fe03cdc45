"""Column helpers that pin down dates, nulls and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def snapshot_ts(snapshot: str) -> Column:
    """The snapshot as a zone-free timestamp literal (midnight for a bare date)."""
    return F.lit(snapshot).cast("timestamp_ntz")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two zone-free timestamps.

    Calendar-date differences would count 13:00 to next midnight as a day; the
    interval's day field does not, and it ignores the session time zone.
    """
    return F.extract(F.lit("DAY"), later - earlier).cast("long")


def on_or_before(df: DataFrame, name: str, snapshot: str) -> Column:
    """``name <= snapshot``, with the literal in the column's own type.

    Casting the column instead would keep the predicate from reaching the scan.
    A null date compares as unknown, so a filter drops it.
    """
    kind = df.schema[name].dataType
    literal = snapshot_ts(snapshot)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        literal = literal.cast(kind)
    return F.col(name) <= literal


def known(value: Column) -> Column:
    """A float value with NaN turned into null, so aggregates skip both."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Scale, round to the nearest even integer, scale back.

    Adding zero turns -0.0 into 0.0, so equal numbers also print equally.
    """
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for float columns."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def is_blank(df: DataFrame, name: str) -> Column:
    """Empty after stripping Unicode white space. Null is not blank, and neither
    is a value of any other type than text, whose rows need no test."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return F.coalesce(F.col(name).rlike(r"(?U)^\s*$"), F.lit(False))


def percent_text(share: Column) -> Column:
    """A share of one as text with one decimal, such as ``66.7%``."""
    return F.format_string("%.1f%%", round_half_even(share * F.lit(100.0), 1))


def pounds_text(amount: Column) -> Column:
    """An amount as text with thousands separators, such as ``£1,234.50``."""
    return F.concat(F.lit("£"), F.format_number(amount, 2))


def round_floats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every float column, chosen by type, in one projection."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = round_half_even(column, digits).alias(field.name)
        columns.append(column)
    return df.select(*columns)
