"""Movements: each presence-on reading with the first later one in another area of the house.

Readings are ordered by (time, area); only strictly later ones count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from roomtrace.functions.expressions import from_micros, micros, presence_is
from roomtrace import schema as S
from roomtrace.operators.splitting import Limits, Slices, every_salt, salt_of

KEYS = ["house_id"]


def movements(events: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(house_id, event_id, from_area, to_area, from_ts, to_ts), one row per moved-on reading."""
    rows = events.filter(
        presence_is(S.ON) & F.col("house_id").isNotNull() & F.col("area").isNotNull() & F.col("event_ts").isNotNull()
    ).select(*KEYS, micros(F.col("event_ts")).alias("us"), "area", "event_id", F.lit(True).alias("leaves"))
    slices = Slices(rows, KEYS, limits)
    if slices.hot:
        found = _next_elsewhere(_cut(rows, slices), [*slices.cell, "salt"])
    else:
        found = _next_elsewhere(rows, KEYS)
    stop = F.struct("next.us", "next.area")
    target = F.when(F.col("next.area") != F.col("area"), stop).otherwise(F.col("next.turn"))
    return (
        found.filter("leaves")
        .withColumn("to", target)
        .filter(F.col("to").isNotNull())
        .select(
            *KEYS,
            "event_id",
            F.col("area").alias("from_area"),
            F.col("to.area").alias("to_area"),
            from_micros(F.col("us")).alias("from_ts"),
            from_micros(F.col("to.us")).alias("to_ts"),
        )
    )


def _next_elsewhere(rows: DataFrame, group: list[str]) -> DataFrame:
    """Adds ``next``: the first later reading (``us``, ``area``) and the first
    one after it in a different area (``turn``).

    A reading moves to ``next`` when that is another area, else to ``turn``:
    between the two there is only the area of ``next``.  All frames run from the
    latest reading backwards and only grow, so a group costs one sorted pass.
    Repeated readings change neither, which lets copies be dropped or shared.
    """
    backwards = W.partitionBy(*group).orderBy(F.col("us").desc(), F.col("area").desc())
    instants = W.partitionBy(*group).orderBy(F.col("us").desc())
    return (
        rows.withColumn("before", F.lead("area").over(backwards))
        .withColumn("turned", F.when(F.col("area") != F.col("before"), F.struct("us", "area")))
        .withColumn(
            "turn",
            F.last("turned", ignorenulls=True).over(backwards.rowsBetween(W.unboundedPreceding, -1)),
        )
        .withColumn(
            "next",
            F.min(F.struct("us", "area", "turn")).over(instants.rangeBetween(W.unboundedPreceding, -1)),
        )
    )


def _cut(rows: DataFrame, slices: Slices) -> DataFrame:
    """Rows under slice and salt, where every part of a slice sees the readings it may need."""
    cell = slices.cell
    shape = [*cell, "salt", "us", "area", "event_id", "leaves"]
    own = slices.spread(slices.of_all(rows)).withColumn("salt", salt_of(F.col("event_id"), F.col("parts")))
    hot_rows = slices.of_hot_groups(rows)

    # First readings of a slice in two different areas: all that earlier slices need of it.
    by_time = W.partitionBy(*cell).orderBy("us", "area")
    firsts = (
        hot_rows.groupBy(*cell, "area")
        .agg(F.min("us").alias("us"))
        .withColumn("nth", F.row_number().over(by_time))
        .filter(F.col("nth") <= 2)
    )
    # Seen from the last of them, everything later lies in later slices.
    handed_on = (
        _next_elsewhere(firsts, slices.keys)
        .groupBy(*cell)
        .agg(F.max_by("next", "nth").alias("next"))
        .filter(F.col("next").isNotNull())
        .withColumn("stop", F.explode(F.array(F.struct("next.us", "next.area"), "next.turn")))
        .filter(F.col("stop").isNotNull())
        .select(*cell, "stop.*")
    )
    out = own.select(*shape).unionByName(_stops(slices.spread(handed_on), cell).select(*shape))
    if slices.crowded:
        places = slices.crowding(hot_rows, {"parts": "parts"}, "inner").select(*cell, "parts", "us", "area").distinct()
        out = out.unionByName(_stops(places, cell).select(*shape))
    return out


def _stops(found: DataFrame, cell: list[str]) -> DataFrame:
    """Readings to move to, for every salt of the slice; they are no start themselves."""
    return found.select(
        *cell,
        "us",
        "area",
        every_salt(F.col("parts")).alias("salt"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.lit(False).alias("leaves"),
    )
