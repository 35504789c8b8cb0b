from __future__ import annotations

from helpers import readings, table
from roomtrace import schema as S
from roomtrace.operators.counts import alarm_rows, area_activity, presence_rows, status_counts

# Readings of one simulated day: area, property, how often on, how often off.
DAY_COUNTS = [
    ("armchair", S.PRESENCE, 8, 8),
    ("bathroom", S.POWER, 10, 6),
    ("bathroom", S.PRESENCE, 10, 6),
    ("bedroom", S.POWER, 4, 6),
    ("bedroom", S.PRESENCE, 6, 4),
    ("chair_bedroom", S.PRESENCE, 0, 10),
    ("chair_kitchen", S.PRESENCE, 6, 12),
    ("kitchen", S.POWER, 12, 6),
    ("kitchen", S.PRESENCE, 12, 6),
    ("livingroom", S.POWER, 8, 8),
    ("livingroom", S.PRESENCE, 8, 8),
    ("sleep", S.PRESENCE, 4, 6),
    ("toilet", S.PRESENCE, 6, 10),
    ("wardrobe", S.DOOR, 2, 8),
    ("wardrobe", S.PRESENCE, 2, 8),
    ("washbasin", S.PRESENCE, 4, 12),
]
RULE_COUNTS = [4, 6, 4, 2, 2, 10, 10, 6, 4, 8, 8, 8, 0, 0, 0, 0, 0, 0, 12, 12, 6]
# The published totals come from the day taken twice.
PUBLISHED = [24, 8, 8, 40, 8, 12, 48, 12, 48]


def a_day(spark):
    rows = []
    for area, prop, on, off in DAY_COUNTS:
        rows += [("h", i, "d", prop, "on", area) for i in range(on)]
        rows += [("h", i, "d", prop, "off", area) for i in range(off)]
    return readings(spark, rows)


def totals(df):
    return {r.metric: r.n for r in area_activity(df).collect()}


def test_rules_on_a_day(spark):
    got = [r.n for r in status_counts(a_day(spark)).orderBy("rule_id").collect()]
    assert got == RULE_COUNTS


def test_published_totals(spark):
    from roomtrace.plans.rules import TOTAL_RULES

    day = a_day(spark)
    assert day.count() == 226
    got = totals(day.union(day))
    assert [got[m] for m in dict.fromkeys(r[0] for r in TOTAL_RULES)] == PUBLISHED


def test_bedroom_counts_lights_that_go_off(spark):
    df = readings(spark, [("h", 1, "d", S.POWER, "off", "bedroom"), ("h", 1, "d", S.POWER, "on", "bathroom"), ("h", 2, "d", S.POWER, "off", "bathroom")])
    got = totals(df)
    assert got["Activity in bedroom light + presence sensor"] == 1
    assert got["Activity in bathroom light + presence sensor"] == 1


def test_no_readings_give_zero_for_every_rule(spark):
    empty = table(spark, [])
    assert {r.n for r in status_counts(empty).collect()} == {0}
    assert status_counts(empty).count() == 21
    assert set(totals(empty).values()) == {0}


def test_only_numbers_raise_an_alarm(spark):
    values = ["293.15", "abc", None, "200", "200.5", "1e3", "NaN", "Infinity", "300d", "0x1p10", " 250 ", "-300", "."]
    df = readings(spark, [("h", i, "d", S.TEMPERATURE, v, "kitchen") for i, v in enumerate(values)])
    hits = {r.value_property_device for r in alarm_rows(df, S.TEMPERATURE, "kitchen", 200).collect()}
    assert hits == {"293.15", "200.5", "1e3", " 250 "}
    assert {r.rule_id: r.n for r in status_counts(df).collect()}["R16"] == 4


def test_rules_may_share_places_and_limits(spark):
    rules = [
        ("A", "g", "temp", ">", "10", "x"),
        ("B", "g", "temp", ">", "20.5", "x"),
        ("C", "g", "temp", "=", "15", "x"),
        ("D", "g", "temp", ">", "-5", "y"),
        ("E", "g", "mode", "=", "auto", "x"),
    ]
    rows = [("temp", v, "x") for v in ("15", "15", "20.5", "30", "9", "auto", None)]
    rows += [("temp", "-4", "y"), ("temp", "-6", "y"), ("mode", "auto", "x"), ("mode", "99", "x"), ("mode", "auto", "y")]
    df = readings(spark, [("h", i, "d", *r) for i, r in enumerate(rows)])
    assert {r.rule_id: r.n for r in status_counts(df, rules).collect()} == {"A": 4, "B": 1, "C": 2, "D": 1, "E": 1}


def test_presence_rows_take_one_area_and_value(spark):
    df = readings(
        spark,
        [
            ("h", 1, "d", S.PRESENCE, "on", "sleep"),
            ("h", 1, "d", S.PRESENCE, "off", "sleep"),
            ("h", 1, "d", S.POWER, "on", "sleep"),
            ("h", 1, "d", S.PRESENCE, "on", "kitchen"),
        ],
    )
    assert [r.event_id for r in presence_rows(df, "sleep").collect()] == [0]


def test_one_room_group(spark):
    got = area_activity(a_day(spark), "kitchen").orderBy("metric").collect()
    assert [(r.group_name, r.n) for r in got] == [("kitchen", 24), ("kitchen", 6)]
