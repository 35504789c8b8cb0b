from __future__ import annotations

import pytest

from helpers import random_rows, readings, table
from roomtrace.operators.counts import presence_counts
from roomtrace.operators.ordering import first_event, positions, running_presence, sorted_events
from roomtrace.operators.splitting import SLACK, Limits, Slices

LIMITS = [None, Limits(40, 1000), Limits(5, 1000), Limits(2, 9)]
CASES = [
    dict(seed=11, n=500, houses=3, span=300),
    dict(seed=12, n=600, houses=3, span=30, hot=0.5),
    dict(seed=13, n=300, houses=1, span=2),
]


def brute_positions(full, key, order):
    seen: dict = {}
    out = {}
    for row in sorted(full, key=order):
        seen[key(row)] = seen.get(key(row), 0) + 1
        out[row[0]] = seen[key(row)]
    return out


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("case", CASES, ids=lambda c: str(c["seed"]))
def test_place_in_the_house(spark, case, limits):
    full = random_rows(**case)
    got = {r.event_id: r.rn for r in sorted_events(table(spark, full), limits).collect()}
    assert got == brute_positions(full, lambda r: r[1], lambda r: (r[2], r[6], r[0]))


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("case", CASES, ids=lambda c: str(c["seed"]))
def test_running_presence(spark, case, limits):
    full = random_rows(**case)
    on = [r for r in full if r[5] == "on"]
    got = {r.event_id: r.n for r in running_presence(table(spark, full), limits=limits).collect()}
    assert got == brute_positions(on, lambda r: r[6], lambda r: (r[2], r[0]))


def test_output_is_sorted(spark):
    full = random_rows(seed=14, n=300, houses=3, span=40)
    got = [(r.event_ts, r.area, r.event_id) for r in sorted_events(table(spark, full)).collect()]
    assert got == sorted((r[2], r[6], r[0]) for r in full)


def test_first_event(spark):
    full = random_rows(seed=15, n=100, houses=3, span=20)
    got = first_event(table(spark, full)).collect()
    assert [(r.event_ts, r.area, r.event_id) for r in got] == [min((r[2], r[6], r[0]) for r in full)]


def test_last_running_count_is_the_count(spark):
    df = table(spark, random_rows(seed=16, n=300, houses=2, span=50))
    last = {r.key: r["max(n)"] for r in running_presence(df).groupBy("key").max("n").collect()}
    assert last == {r.key: r.n for r in presence_counts(df).collect()}


def test_running_presence_per_house(spark):
    full = random_rows(seed=18, n=300, houses=3, span=50)
    on = [r for r in full if r[5] == "on"]
    got = {r.event_id: r.n for r in running_presence(table(spark, full), by=["house_id"]).collect()}
    assert got == brute_positions(on, lambda r: (r[1], r[6]), lambda r: (r[2], r[0]))
    last = running_presence(table(spark, full), by=["house_id"]).groupBy("house_id", "key").max("n")
    assert sorted(map(tuple, last.collect())) == sorted(
        map(tuple, presence_counts(table(spark, full), by=["house_id"]).collect())
    )


def test_area_without_presence_gives_no_key(spark):
    df = readings(spark, [("h", 1, "d", "sensedPresence", "off", "chair_bedroom"), ("h", 1, "d", "sensedPresence", "on", "sleep")])
    assert [tuple(r) for r in presence_counts(df).collect()] == [("sleep-sensedPresence-on", 1)]
    assert running_presence(df, areas=["chair_bedroom"]).count() == 0


def test_other_columns_are_kept(spark):
    full = random_rows(seed=17, n=80, houses=2, span=10)
    got = positions(table(spark, full), ["house_id"], limits=Limits(3, 100)).drop("n")
    assert sorted(map(tuple, got.collect())) == sorted(full)


@pytest.mark.parametrize(
    "time", ["pmod(xxhash64(id), 10000000)", "id * 1000", "pow(pmod(xxhash64(id), 1000), 3)", "if(id < 9000, 5, id)"]
)
def test_no_window_holds_much_more_than_the_limit(spark, time):
    limit = 500
    rows = spark.range(20_000).selectExpr("'k' AS key", f"CAST({time} AS bigint) AS us", "id AS event_id")
    slices = Slices(rows, ["key"], Limits(limit, 1000), over=["event_id"])
    placed = slices.of_all(rows)
    # The parts of slices: crowded instants are cut by event id.
    if slices.crowded:
        found = slices.crowding(placed, {"_lo": "lo_event_id", "_step": "step_event_id"}, "left")
        placed = found.selectExpr("*", "coalesce((event_id - _lo) div _step, 0) AS cut")
    else:
        placed = placed.selectExpr("*", "0 AS cut")
    sizes = [r["count"] for r in placed.groupBy(*slices.cell, "cut").count().collect()]
    assert max(sizes) <= SLACK * limit
    # One row per part is what the window along the parts holds.
    assert len(sizes) <= 8 * 20_000 / limit


def test_more_groups_than_may_be_broadcast(spark):
    full = random_rows(seed=15, n=600, houses=6, span=40)
    got = {r.event_id: r.rn for r in sorted_events(table(spark, full), Limits(5, 2)).collect()}
    assert got == brute_positions(full, lambda r: r[1], lambda r: (r[2], r[6], r[0]))
