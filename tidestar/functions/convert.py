"""Conversions that never fail on bad input.

Each takes the column and its type, since the rule depends on what the value
was before the conversion. All are plain expressions inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
MICROS_PER_DAY = 86_400_000_000

# The text forms that count as an integer and as a decimal number.
INTEGER_TEXT = r"^[+-]?[0-9]+$"
DECIMAL_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_string_safe(c: Column) -> Column:
    """Text of the value; null stays null."""
    return c.cast("string")


def to_int_safe(c: Column, source: T.DataType, target: T.DataType = T.IntegerType()) -> Column:
    """Integer of the value; 0 for null and for text that is not an integer.

    Whole numbers that are too wide keep their low 32 bits, fractions are cut
    toward zero and clamped to the range.
    """
    wide = isinstance(target, T.LongType)
    if isinstance(source, T.StringType):
        value = F.when(c.rlike(INTEGER_TEXT), c.try_cast(target))
    elif isinstance(source, (T.ByteType, T.ShortType, T.IntegerType)):
        value = c.cast(target)
    elif isinstance(source, T.LongType):
        value = c if wide else F.shiftright(F.shiftleft(c, 32), 32).cast(target)
    elif isinstance(source, (T.FloatType, T.DoubleType)):
        low, high = (LONG_MIN, LONG_MAX) if wide else (INT_MIN, INT_MAX)
        number = c.cast("double")
        value = (
            F.when(F.isnan(number), F.lit(0))
            .when(number >= float(high), F.lit(high))
            .when(number <= float(low), F.lit(low))
            .otherwise(number.try_cast(target))
        )
    elif isinstance(source, T.DecimalType):
        value = c.try_cast(target)
    else:
        value = F.lit(None).cast(target)
    return F.coalesce(value.cast(target), F.lit(0).cast(target))


def to_decimal_safe(c: Column, source: T.DataType, target: T.DecimalType = T.DecimalType(10, 2)) -> Column:
    """Decimal of the value; 0 for null and for text that is not a number.

    A number too large for the column is null: it neither raises nor turns into 0.
    """
    zero = F.lit(0).cast(target)
    if isinstance(source, T.StringType):
        return F.when(c.rlike(DECIMAL_TEXT), c.try_cast(target)).otherwise(zero)
    if isinstance(source, T.NumericType):
        number = F.nanvl(c, F.lit(0).cast(source)) if isinstance(source, (T.FloatType, T.DoubleType)) else c
        return F.when(c.isNull(), zero).otherwise(number.try_cast(target))
    return zero


def to_timestamp_safe(c: Column, source: T.DataType) -> Column:
    """Timestamp without zone of a date or timestamp; null for other types."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def to_date_safe(c: Column, source: T.DataType) -> Column:
    """Date of a date or timestamp; null for other types."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("date")
    return F.lit(None).cast("date")


def date_to_epoch_day(c: Column, source: T.DataType) -> Column:
    """Days since 1970-01-01; an int is taken to be such a number already."""
    if isinstance(source, T.IntegerType):
        return c
    if isinstance(source, T.DateType):
        return F.unix_date(c)
    raise TypeError(f"no epoch day for {source.simpleString()}")


def epoch_micros(c: Column, source: T.DataType) -> Column:
    """Exact microseconds since the epoch.

    A timestamp without zone is read as UTC from its own fields, so that the
    result does not depend on the zone of the session.
    """
    if isinstance(source, T.TimestampNTZType):
        return (
            F.unix_date(c.cast("date")).cast("bigint") * MICROS_PER_DAY
            + F.hour(c).cast("bigint") * 3_600_000_000
            + F.minute(c).cast("bigint") * 60_000_000
            + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        )
    if isinstance(source, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(source, T.DateType):
        return F.unix_date(c).cast("bigint") * MICROS_PER_DAY
    if isinstance(source, T.LongType):
        return c
    raise TypeError(f"no epoch micros for {source.simpleString()}")


def ts_to_epoch_micros(c: Column, source: T.DataType) -> Column:
    """Microseconds since the epoch, cut to whole milliseconds; a long passes."""
    micros = epoch_micros(c, source)
    if isinstance(source, T.LongType):
        return micros
    return micros - F.pmod(micros, F.lit(1000))
