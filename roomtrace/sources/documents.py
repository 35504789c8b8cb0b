"""Behaviour documents written from readings, the inverse of the parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import from_seconds, seconds, start_time
from roomtrace.operators.ordering import positions
from roomtrace.operators.splitting import Limits

KEYS = ["house_id", "doc_no"]
# Changes per document; a house gets as many documents as it needs.
CHANGES = 32


def _quoted(value: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(char), F.lit(name))
    return value


def _element(tag: str, **attributes: Column) -> Column:
    parts = [F.lit(f"<{tag}")]
    for name, value in attributes.items():
        parts += [F.lit(f' {name}="'), _quoted(value), F.lit('"')]
    return F.concat(*parts, F.lit("/>"))


def to_documents(events: DataFrame, changes: int = CHANGES, limits: Limits | None = None) -> DataFrame:
    """(house_id, doc_no, value): the readings of a house in time order, ``changes`` per document.

    Times are cut to seconds, on/off is written as true/false.
    """
    to_seconds = events.withColumn("event_ts", from_seconds(seconds(F.col("event_ts"))))
    ranked = positions(to_seconds, ["house_id"], name="rn", limits=limits)
    # Groups hold at most ``changes`` rows, whatever the size of a house.
    lists = (
        ranked.withColumn("doc_no", F.expr(f"(rn - 1) div {changes}"))
        .groupBy(*KEYS)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "rn",
                        seconds(F.col("event_ts")).alias("at"),
                        "id_device",
                        "property_device",
                        "value_property_device",
                        "area",
                    )
                )
            ).alias("rows")
        )
        .withColumn("start", F.expr("rows[0].at - pmod(rows[0].at, 3600)"))
        .withColumn(
            "gaps",
            F.zip_with(
                "rows",
                F.concat(F.array("start"), F.transform("rows", lambda r: r["at"])),
                lambda r, before: r["at"] - before,
            ),
        )
    )

    def delay(gap: Column) -> Column:
        hours, minutes = gap % 3600 == 0, gap % 60 == 0
        amount = F.when(hours, gap / 3600).when(minutes, gap / 60).otherwise(gap)
        unit = F.when(hours, "h").when(minutes, "m").otherwise("s")
        return _element("delay", value=amount.cast("bigint").cast("string"), unit=unit)

    def change(row: Column) -> Column:
        value = row["value_property_device"]
        text = F.when(value == S.ON, "true").when(value == S.OFF, "false").otherwise(value)
        return _element("set-device-property", deviceId=row["id_device"], property=row["property_device"], value=text)

    zones = F.array_distinct(
        F.transform("rows", lambda r: _element("move-device-zone", deviceId=r["id_device"], zoneId=r["area"]))
    )
    steps = F.zip_with(
        F.slice("gaps", F.lit(1), F.size("rows")), F.col("rows"), lambda gap, row: F.concat(delay(gap), change(row))
    )
    return lists.select(
        *KEYS,
        F.concat(
            F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<behavior startdate="'),
            start_time(from_seconds(F.col("start"))),
            F.lit('">'),
            F.array_join(zones, "\n"),
            F.array_join(steps, "\n"),
            F.lit("</behavior>"),
        ).alias("value"),
    )
