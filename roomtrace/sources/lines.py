"""Device lines: five comma-separated fields, no header, no quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import line_time


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, event_id, value), one row per line of the text files under ``path``."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("event_id"), "value"
    )


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same for files as they arrive under ``path``."""
    return spark.readStream.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )


def stream_line_table(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file, value) of a table of lines as it grows; ``file`` is the source each line came from."""
    return spark.readStream.schema("value string, file string").options(**options).parquet(path).select("file", "value")


def _first_line() -> Column:
    return F.substring_index("value", "\n", 1)


def _reason() -> Column:
    """What is wrong with a line, NULL for a whole reading.

    Only plain string functions over ``value``: the condition is evaluated at
    the scan, before the line is split.
    """
    time = F.substring_index(_first_line(), ",", 1).try_cast("timestamp_ntz")
    return F.when(F.col("value").isNull() | _short(), "short line").when(time.isNull(), "bad time")


def _short() -> Column:
    line = _first_line()
    commas = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))
    return commas < len(S.LINE_FIELDS) - 1


def parse_lines(lines: DataFrame) -> DataFrame:
    """Readings of the lines with all fields; fields after the fifth are ignored.

    A time that can't be read is NULL: such readings are counted, but have no
    place in time, so matching and ordering leave them out.  Other columns of
    ``lines`` (file, event_id, ...) are kept.
    """
    kept = [c for c in lines.columns if c != "value"]
    time, *others = S.LINE_FIELDS
    return (
        lines.filter(F.col("value").isNotNull() & ~_short())
        .withColumn("fields", F.split(_first_line(), ",", -1))
        .select(
            *kept,
            F.col("fields")[0].try_cast("timestamp_ntz").alias(time),
            *[F.col("fields")[i].alias(name) for i, name in enumerate(others, start=1)],
        )
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no whole readings, with the reason; short ones are left out by ``parse_lines``."""
    return lines.withColumn("reason", _reason()).filter(F.col("reason").isNotNull())


def line_text() -> Column:
    """A reading as a device line."""
    return F.concat_ws(
        ",",
        line_time(F.col("event_ts")),
        *[F.coalesce(F.col(c), F.lit("")) for c in S.LINE_FIELDS[1:]],
    )


def write_lines(events: DataFrame, path: str, mode: str = "append", by: list[str] | None = None) -> None:
    """Readings as text files of device lines; with ``by`` (such as the file they
    came from) every value has its own folder."""
    by = by or []
    events.select(line_text().alias("value"), *by).write.mode(mode).partitionBy(*by).text(path)


def write_csv(events: DataFrame, path: str, mode: str = "append") -> None:
    """Readings as CSV part files, with event and house id in front of the five fields."""
    time, *others = S.LINE_FIELDS
    events.select("event_id", "house_id", line_time(F.col(time)).alias(time), *others).write.mode(mode).csv(path)


def read_csv(spark: SparkSession, path: str, house_type: str = "string") -> DataFrame:
    columns = f"event_id bigint, house_id {house_type}, event_ts timestamp_ntz, " + ", ".join(
        f"{c} string" for c in S.LINE_FIELDS[1:]
    )
    return spark.read.schema(columns).option("timestampNTZFormat", S.LINE_TIME_FORMAT).csv(path)
