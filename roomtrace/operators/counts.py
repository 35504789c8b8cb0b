"""Counts by rule.

Readings are first counted per property, area and outcome of the tests, which
is a few hundred groups at any size of the data and combined on the map side;
the rules, a handful of rows given by the program, are then matched with those
groups.  One scan answers all rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from roomtrace import schema as S
from roomtrace.functions.expressions import number_value, presence_is, presence_key
from roomtrace.plans.rules import (
    STATUS_RULES,
    TOTAL_RULES,
    Rule,
    metric_table,
    of_status,
    of_totals,
    report_table,
    small_table,
    status_table,
)


def _hits(events: DataFrame, rules: list[Rule]) -> DataFrame:
    """(label, n) of the labels that count anything."""
    prop, area, value = F.col("property_device"), F.col("area"), F.col("value_property_device")
    texts = sorted({r.operand for r in rules if r.test == "="})
    alarms = sorted({r.property_device for r in rules if r.test == ">"})
    limits = sorted({float(r.operand) for r in rules if r.test == ">"})

    # How many of the limits a number exceeds stands for the number itself.
    above = [F.when(F.col("number") > limit, 1).otherwise(0) for limit in limits]
    level = reduce(lambda a, b: a + b, above, F.lit(0))
    groups = (
        # Literals, so that a columnar source can skip other readings; the first sorts out most.
        events.filter(value.isin(texts) | prop.isin(alarms))
        .filter(prop.isin(sorted({r.property_device for r in rules})))
        .filter(area.isin(sorted({r.area for r in rules})))
        .select(
            prop,
            area,
            F.when(value.isin(texts), value).alias("text"),
            F.when(prop.isin(alarms), number_value(value)).alias("number"),
        )
        .groupBy(prop, area, "text", level.alias("level"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    tests = small_table(
        events.sparkSession,
        ["label", "r_property", "r_area", "operand", "least"],
        [
            (r.label, r.property_device, r.area, r.operand, limits.index(float(r.operand)) + 1 if r.test == ">" else 0)
            for r in rules
        ],
    )
    passed = F.when(F.col("least") > 0, F.col("level") >= F.col("least")).otherwise(F.col("text") == F.col("operand"))
    same = (prop == F.col("r_property")) & (area == F.col("r_area"))
    return groups.join(F.broadcast(tests), same & passed).groupBy("label").agg(F.sum("n").alias("n"))


def _fill(entries: DataFrame, label: str, hits: DataFrame) -> DataFrame:
    """Every entry with its count, 0 included; neither side has more rows than there are rules."""
    return entries.join(F.broadcast(hits.withColumnRenamed("label", label)), label, "left").select(
        *entries.columns, F.coalesce("n", F.lit(0)).alias("n")
    )


def status_counts(events: DataFrame, rules: list[tuple] = STATUS_RULES) -> DataFrame:
    """(rule_id, group_name, property_device, test, operand, area, n) for every rule."""
    return _fill(status_table(events.sparkSession, rules), "rule_id", _hits(events, of_status(rules)))


def area_activity(events: DataFrame, group: str | None = None, rules: list[tuple] = TOTAL_RULES) -> DataFrame:
    """(group_name, metric, n): the totals of one room group, or of all."""
    rules = [r for r in rules if group is None or r[1] == group]
    return _fill(metric_table(events.sparkSession, rules), "metric", _hits(events, of_totals(rules)))


def report_counts(events: DataFrame) -> DataFrame:
    """(kind, label, group_name, property_device, test, area, n): all rules and all totals in one scan."""
    return _fill(report_table(events.sparkSession), "label", _hits(events, of_status() + of_totals()))


def presence_rows(events: DataFrame, area: str) -> DataFrame:
    return events.filter(presence_is(S.ON) & (F.col("area") == area))


def alarm_rows(events: DataFrame, prop: str, area: str, threshold: float) -> DataFrame:
    return events.filter(
        (F.col("property_device") == prop)
        & (F.col("area") == area)
        & (number_value(F.col("value_property_device")) > threshold)
    )


def presence_counts(events: DataFrame, areas: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """(key, n): presence-on readings per area; an area without any gives no row.

    ``by`` (such as house_id) adds columns that are counted apart.
    """
    on = events.filter(presence_is(S.ON) & F.col("area").isNotNull())
    if areas is not None:
        on = on.filter(F.col("area").isin(areas))
    return on.groupBy(*(by or []), presence_key().alias("key")).agg(F.count(F.lit(1)).alias("n"))
