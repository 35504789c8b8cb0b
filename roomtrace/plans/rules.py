"""What is counted, as data.  Fixed values: every row equals one counted predicate."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from roomtrace import schema as S

# rule_id, room group, property, test, operand, area
STATUS_RULES = [
    ("R01", "bedroom", S.POWER, "=", "on", "bedroom"),
    ("R02", "bedroom", S.PRESENCE, "=", "on", "bedroom"),
    ("R03", "bedroom", S.PRESENCE, "=", "on", "sleep"),
    ("R04", "bedroom", S.PRESENCE, "=", "on", "wardrobe"),
    ("R05", "bedroom", S.DOOR, "=", "on", "wardrobe"),
    ("R06", "bathroom", S.POWER, "=", "on", "bathroom"),
    ("R07", "bathroom", S.PRESENCE, "=", "on", "bathroom"),
    ("R08", "bathroom", S.PRESENCE, "=", "on", "toilet"),
    ("R09", "bathroom", S.PRESENCE, "=", "on", "washbasin"),
    ("R10", "livingroom", S.POWER, "=", "on", "livingroom"),
    ("R11", "livingroom", S.PRESENCE, "=", "on", "livingroom"),
    ("R12", "livingroom", S.PRESENCE, "=", "on", "armchair"),
    ("R13", "hallway", S.PRESENCE, "=", "on", "hallway"),
    ("R14", "hallway", S.POWER, "=", "on", "hallway"),
    ("R15", "hallway", S.FLOOD, "=", "on", "hallway"),
    ("R16", "kitchen", S.TEMPERATURE, ">", "200", "kitchen"),
    ("R17", "kitchen", S.CARBON_DIOXIDE, ">", "0", "kitchen"),
    ("R18", "kitchen", S.CARBON_MONOXIDE, ">", "0", "kitchen"),
    ("R19", "kitchen", S.POWER, "=", "on", "kitchen"),
    ("R20", "kitchen", S.PRESENCE, "=", "on", "kitchen"),
    ("R21", "kitchen", S.PRESENCE, "=", "on", "chair_kitchen"),
]

# metric (report label), room group, property, value, area; rows of one metric add up.
# The bedroom total counts lights that go off, the other rooms lights that go on.
TOTAL_RULES = [
    ("Activity in bedroom light + presence sensor", "bedroom", S.POWER, "off", "bedroom"),
    ("Activity in bedroom light + presence sensor", "bedroom", S.PRESENCE, "on", "bedroom"),
    ("Activity in bedroom presence sensor bed", "bedroom", S.PRESENCE, "on", "sleep"),
    ("Activity in bedroom presence sensor wardrobe", "bedroom", S.PRESENCE, "on", "wardrobe"),
    ("Activity in bedroom presence sensor wardrobe", "bedroom", S.DOOR, "on", "wardrobe"),
    ("Activity in bathroom light + presence sensor", "bathroom", S.POWER, "on", "bathroom"),
    ("Activity in bathroom light + presence sensor", "bathroom", S.PRESENCE, "on", "bathroom"),
    ("Activity in bathroom presence sensor washbasin", "bathroom", S.PRESENCE, "on", "washbasin"),
    ("Activity in bathroom presence sensor toilet", "bathroom", S.PRESENCE, "on", "toilet"),
    ("Activity in kitchen light + presence sensor", "kitchen", S.POWER, "on", "kitchen"),
    ("Activity in kitchen light + presence sensor", "kitchen", S.PRESENCE, "on", "kitchen"),
    ("Activity in kitchen presesensor eating", "kitchen", S.PRESENCE, "on", "chair_kitchen"),
    ("Activity in livingroom light + presence sensor", "livingroom", S.POWER, "on", "livingroom"),
    ("Activity in livingroom light + presence sensor", "livingroom", S.PRESENCE, "on", "livingroom"),
    ("Activity in livingroom light + presence sensor", "livingroom", S.PRESENCE, "on", "armchair"),
]


class Rule(NamedTuple):
    """Counts readings of one property and area that pass a test; rules of one label add up."""

    label: str
    group_name: str
    property_device: str
    test: str
    operand: str
    area: str


def of_status(rules: list[tuple] = STATUS_RULES) -> list[Rule]:
    return [Rule(*r) for r in rules]


def of_totals(rules: list[tuple] = TOTAL_RULES) -> list[Rule]:
    return [Rule(metric, group, prop, "=", value, area) for metric, group, prop, value, area in rules]


def status_table(spark: SparkSession, rules: list[tuple] = STATUS_RULES) -> DataFrame:
    return small_table(spark, ["rule_id", "group_name", "property_device", "test", "operand", "area"], rules)


def metric_table(spark: SparkSession, rules: list[tuple] = TOTAL_RULES) -> DataFrame:
    return small_table(spark, ["group_name", "metric"], list(dict.fromkeys((r[1], r[0]) for r in rules)))


def report_table(spark: SparkSession) -> DataFrame:
    """What a report lists: every status rule and every metric once."""
    names = ["kind", "label", "group_name", "property_device", "test", "area"]
    status = [("status", rule, group, prop, test, area) for rule, group, prop, test, _, area in STATUS_RULES]
    totals = [("total", metric, group, None, None, None) for metric, group in dict.fromkeys(r[:2] for r in TOTAL_RULES)]
    return small_table(spark, names, status + totals)


def small_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    columns = {name: pa.array([row[i] for row in rows]) for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns))
