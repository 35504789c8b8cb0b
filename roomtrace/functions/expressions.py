"""Scalar expressions; all are built-in columns, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roomtrace import schema as S


# Zone-less times are counted from a zone-less epoch, so the session's zone plays no part.
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_MICROSECOND = "INTERVAL '0.000001' SECOND"


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp."""
    return F.call_function("div", ts - F.expr(_EPOCH), F.expr(_MICROSECOND))


def from_micros(us: Column) -> Column:
    return F.expr(_EPOCH) + us * F.expr(_MICROSECOND)


def seconds(ts: Column) -> Column:
    """Whole seconds since the epoch, rounded down."""
    return F.floor(micros(ts) / F.lit(1e6)).cast("bigint")


def from_seconds(s: Column) -> Column:
    return from_micros(s * 1_000_000)


def presence_is(value: str) -> Column:
    return (F.col("property_device") == S.PRESENCE) & (F.col("value_property_device") == value)


def number_value(value: Column) -> Column:
    """Text reading as a number; NULL, and so never above a threshold, when it is not one.

    The cast alone would also take "NaN", "Infinity", "5d" and hexadecimal text.
    """
    end = F.substring(F.rtrim(value, F.lit(" \t\r\n")), -1, 1)
    plain = (end.between("0", "9") | (end == ".")) & ~F.contains(value, F.lit("x")) & ~F.contains(value, F.lit("X"))
    return F.when(plain, value.try_cast("double"))


def normalise_value(value: Column) -> Column:
    return F.when(value == "true", S.ON).when(value == "false", S.OFF).otherwise(value)


def parse_start_ts(text: Column) -> Column:
    parts = F.regexp_replace(text, r"^(\d{2})/(\d{2})/(\d{4})-(\d{2}:\d{2}:\d{2})$", "$3-$2-$1 $4")
    return F.when(parts != text, parts).try_cast("timestamp_ntz")


def delay_seconds(value: Column, unit: Column, legacy_other_unit: bool = False) -> Column:
    """Length of a delay.  A unit other than h and m means seconds; with
    ``legacy_other_unit`` it means as many minutes plus as many seconds."""
    other = value * 61 if legacy_other_unit else value
    return F.when(unit == "h", value * 3600).when(unit == "m", value * 60).otherwise(other)


def properties_map(prop: Column, value: Column) -> Column:
    return F.create_map(
        F.lit("propertyDevice"), prop, F.lit("valuePropertyDevice"), value
    )


def presence_key() -> Column:
    return F.concat_ws("-", "area", "property_device", "value_property_device")


def line_time(ts: Column) -> Column:
    # The text of a zone-less time begins with S.LINE_TIME_FORMAT.
    return F.substring(ts.cast("string"), 1, 19)


def start_time(ts: Column) -> Column:
    """A time as scripts write it."""
    return F.regexp_replace(line_time(ts), r"^(\d{4})-(\d{2})-(\d{2}) (.*)$", "$3/$2/$1-$4")
