"""Report and detection lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import line_time

# The wording of the lines, each with its trailing blank.
STATUS_LINE = "[%s] - Count status device property: %s -on- in area %s : %d "
VALUE_LINE = "[%s] - Count value property: %s device on in area %s : %d "
TOTAL_LINE = "[%s] - %s: %d "
MOVEMENT_LINE = "Se detecta movimiento, cambios de zona desde zona 1: %s a zona 2: %s "
VISIT_LINE = "Se detecta el uso %s: %s "
VISIT_TIMES_LINE = "Tiempo entrada: %s , tiempo salida: %s "
VISIT_PLACES = {
    "toilet": "del baño",
    "washbasin": "del lavabo",
    "kitchen": "de la cocina",
    "chair_kitchen": "de la mesa de la cocina",
    "armchair": "de la sala de estar",
}
EXIT_ROW = (
    "Row(dateTime='%s', idDevice='%s', area='%s', "
    "propertiesMap={'propertyDevice': '%s', 'valuePropertyDevice': '%s'})"
)


def report_lines(counts: DataFrame, run_ts: str) -> DataFrame:
    """(group_name, label, line) from ``report_counts``."""
    run = F.lit(run_ts)
    line = (
        F.when(F.col("kind") == "total", F.format_string(TOTAL_LINE, run, "label", "n"))
        .when(F.col("test") == "=", F.format_string(STATUS_LINE, run, "property_device", "area", "n"))
        .otherwise(F.format_string(VALUE_LINE, run, "property_device", "area", "n"))
    )
    return counts.select("group_name", "label", line.alias("line"))


def movement_lines(moves: DataFrame) -> DataFrame:
    """(house_id, event_id, from_ts, from_area, line) from ``movements``."""
    return moves.select(
        "house_id",
        "event_id",
        "from_ts",
        "from_area",
        F.format_string(MOVEMENT_LINE, "from_area", "to_area").alias("line"),
    )


def visit_lines(found: DataFrame) -> DataFrame:
    """(house_id, area, event_id, entry_ts, line_no, line): two lines per visit of a reported area."""
    place: Column = F.lit(None).cast("string")
    for area, words in VISIT_PLACES.items():
        place = F.when(F.col("area") == area, words).otherwise(place)
    exit_row = F.format_string(
        EXIT_ROW, line_time(F.col("exit_ts")), "exit_device", "area", F.lit(S.PRESENCE), F.lit(S.OFF)
    )
    lines = F.array(
        F.format_string(VISIT_LINE, place, exit_row),
        F.format_string(VISIT_TIMES_LINE, line_time(F.col("entry_ts")), line_time(F.col("exit_ts"))),
    )
    return (
        found.filter(F.col("area").isin(list(VISIT_PLACES)))
        .select("house_id", "area", "event_id", "entry_ts", F.posexplode(lines).alias("pos", "line"))
        .select("house_id", "area", "event_id", "entry_ts", (F.col("pos") + 1).alias("line_no"), "line")
    )


def append_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """Appends the lines to the text files under ``path``, range-sorted by ``order``.

    ``order`` should end in event_id: lines of one instant can then be split
    between tasks as well.
    """
    lines.orderBy(*order).select(F.col("line").alias("value")).write.mode("append").text(path)
