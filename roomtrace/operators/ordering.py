"""Positions in time order, global order, first reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import micros, presence_is, presence_key
from roomtrace.operators.splitting import Limits, Slices


def positions(
    events: DataFrame, keys: list[str], ties: list[str] | None = None, name: str = "n", limits: Limits | None = None
) -> DataFrame:
    """Adds the 1-based position of each row in its group, ordered by event_ts, ``ties``, event_id.

    Rows without a time have no position and are left out.

    A hot group is counted slice by slice: each slice starts from the number of
    rows in the slices before it, which enters its window as one extra row.
    """
    ties = ties or []
    columns = [c for c in events.columns]
    rows = events.filter(F.col("event_ts").isNotNull()).withColumn("us", micros(F.col("event_ts")))
    slices = Slices(rows.select(*dict.fromkeys([*keys, "us", "event_id"])), keys, limits, over=["event_id"])
    order = ["us", *ties, "event_id"]
    if not slices.hot:
        here = W.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(here).cast("bigint")).select(*columns, name)

    def cut(df: DataFrame, placed: DataFrame) -> DataFrame:
        # A crowded slice is one instant; it is cut on along the order, by tie
        # column and then into ranges of event ids.  Elsewhere this cut is NULL.
        if not slices.crowded:
            return placed.withColumn("cut", F.lit(None).cast("int"))
        found = slices.crowding(placed, {"_lo": "lo_event_id", "_step": "step_event_id"}, "left")
        finer = F.struct(*ties, F.expr("(event_id - _lo) div _step").alias("ids"))
        return found.withColumn("cut", F.when(F.col("_step").isNotNull(), finer)).drop("_lo", "_step")

    part = [*slices.cell, "cut"]
    own = cut(rows, slices.of_all(rows)).withColumn("weight", F.lit(1).cast("bigint"))
    along = W.partitionBy(*keys).orderBy(*slices.cuts, "cut")
    starts = (
        cut(rows, slices.of_hot_groups(rows.select(*dict.fromkeys([*keys, *order]))))
        .groupBy(*part)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("weight", F.sum("rows").over(along.rowsBetween(W.unboundedPreceding, -1)))
        .filter(F.col("weight") > 0)
        .drop("rows")
    )
    inside = (
        W.partitionBy(*part)
        .orderBy(F.col("real"), *order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        own.withColumn("real", F.lit(True))
        .unionByName(starts.withColumn("real", F.lit(False)), allowMissingColumns=True)
        .withColumn(name, F.sum("weight").over(inside))
        .filter("real")
        .select(*columns, name)
    )


def global_positions(events: DataFrame, ties: list[str] | None = None, name: str = "rn", limits: Limits | None = None) -> DataFrame:
    """Adds the 1-based position of each row in the order of all houses: event_ts, ``ties``, event_id.

    The whole table is one group, cut by time (and single instants by tie and id) as hot
    houses are; slices are counted where they lie and start from the rows of the slices before.
    """
    whole = events.withColumn("_all", F.lit(0))
    return positions(whole, ["_all"], ties, name, limits).drop("_all")


def sorted_events(events: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Readings ordered by (event_ts, area); ``rn`` is the place within the house."""
    ranked = positions(events, ["house_id"], ["area"], "rn", limits)
    return ranked.orderBy("event_ts", "area", "event_id")


def first_event(events: DataFrame) -> DataFrame:
    return events.orderBy("event_ts", "area", "event_id").limit(1)


def running_presence(
    events: DataFrame, areas: list[str] | None = None, by: list[str] | None = None, limits: Limits | None = None
) -> DataFrame:
    """(key, event_id, event_ts, n): each presence-on reading with the new count of its key.

    ``by`` (such as house_id) adds columns that are counted apart.
    """
    by = by or []
    on = events.filter(presence_is(S.ON) & F.col("area").isNotNull())
    if areas is not None:
        on = on.filter(F.col("area").isin(areas))
    keyed = on.select(*by, presence_key().alias("key"), "event_id", "event_ts")
    return positions(keyed, [*by, "key"], limits=limits)
