"""Visits: each presence-on reading of an area with the first later presence-off there.

Several entries may share one exit, entries without a later exit give no
visit, and readings of one instant never match.  Exits of one instant are
ordered by device and event id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import from_micros, micros
from roomtrace.operators.splitting import Limits, Slices, every_salt, salt_of

# The areas whose visits are reported, by activity.
VISIT_AREAS = {
    "toilet": "toilet",
    "washbasin": "washbasin",
    "kitchen": "kitchen",
    "eating": "chair_kitchen",
    "livingroom": "armchair",
}

KEYS = ["house_id", "area"]


def visits(events: DataFrame, areas: list[str] | None = None, limits: Limits | None = None) -> DataFrame:
    """(house_id, area, event_id, entry_ts, exit_ts, exit_device), one row per matched entry."""
    entry = F.col("value_property_device") == S.ON
    rows = events.filter(
        (F.col("property_device") == S.PRESENCE)
        & F.col("value_property_device").isin(S.ON, S.OFF)
        & F.col("house_id").isNotNull()
        & F.col("event_ts").isNotNull()
        & (F.col("area").isNotNull() if areas is None else F.col("area").isin(areas))
    ).select(
        *KEYS,
        micros(F.col("event_ts")).alias("us"),
        entry.alias("entry"),
        "event_id",
        # Only the device of an exit is reported.
        F.when(~entry, F.col("id_device")).alias("id_device"),
    )
    slices = Slices(rows, KEYS, limits)
    if not slices.hot:
        return _match(rows, KEYS)
    return _match(_cut(rows, slices), [*slices.cell, "salt"])


def _exit() -> Column:
    return F.when(~F.col("entry"), F.struct("us", "id_device", "event_id"))


def _match(rows: DataFrame, group: list[str]) -> DataFrame:
    # Latest first, so "strictly later" is a frame that only grows.
    later = W.partitionBy(*group).orderBy(F.col("us").desc()).rangeBetween(W.unboundedPreceding, -1)
    # The explicit repartition keeps the struct of the window out of the shuffle.
    return (
        rows.repartition(*group)
        .withColumn("exit", F.min(_exit()).over(later))
        .filter(F.col("entry") & F.col("exit").isNotNull())
        .select(
            *KEYS,
            "event_id",
            from_micros(F.col("us")).alias("entry_ts"),
            from_micros(F.col("exit.us")).alias("exit_ts"),
            F.col("exit.id_device").alias("exit_device"),
        )
    )


def _cut(rows: DataFrame, slices: Slices) -> DataFrame:
    """Rows under slice and salt, where every part of a slice sees the exits it may need."""
    cell = slices.cell
    placed = slices.spread(slices.of_all(rows))
    # Crowded slices: entries are spread; exits come back below, one per instant.
    own = placed.filter(F.col("entry") | F.col("parts").isNull()).withColumn(
        "salt", salt_of(F.col("event_id"), F.col("parts"))
    )
    shape = [*cell, "salt", "us", "entry", "event_id", "id_device"]
    hot_rows = slices.of_hot_groups(rows)

    # The first exit after a slice is the earliest one of all later slices.
    after = W.partitionBy(*slices.keys).orderBy(*[F.col(c).desc() for c in slices.cuts])
    handed_on = (
        hot_rows.groupBy(*cell)
        .agg(F.min(_exit()).alias("first_off"))
        .withColumn("off", F.min("first_off").over(after.rowsBetween(W.unboundedPreceding, -1)))
        .filter(F.col("off").isNotNull())
    )
    out = own.select(*shape).unionByName(_exits(slices.spread(handed_on), cell).select(*shape))
    if slices.crowded:
        exits = (
            slices.crowding(hot_rows.filter(~F.col("entry")), {"parts": "parts"}, "inner")
            .groupBy(*cell, "us", "parts")
            .agg(F.min(_exit()).alias("off"))
        )
        out = out.unionByName(_exits(exits.drop("us"), cell).select(*shape))
    return out


def _exits(found: DataFrame, cell: list[str]) -> DataFrame:
    """Exit rows for every salt of their slice; they match entries but are none."""
    return found.select(
        *cell, "off.*", every_salt(F.col("parts")).alias("salt"), F.lit(False).alias("entry")
    )
