"""Visits and movements against nested loops, with and without splitting of hot groups."""

from __future__ import annotations

import pytest

from helpers import at, brute_movements, brute_visits, presence, random_rows, rows_of, table
from roomtrace.operators.movement import movements
from roomtrace.operators.splitting import Limits, Slices
from roomtrace.operators.visits import visits

# None: nothing is hot.  The others cut groups into slices, slices into finer
# ones and crowded instants into salts; the last one with split lists that are
# too short for all hot groups.
LIMITS = [None, Limits(6, 1000), Limits(2, 7)]
CASES = [
    dict(seed=1, n=600, houses=3, span=200),
    dict(seed=2, n=600, houses=2, span=12),
    dict(seed=3, n=700, houses=4, span=400, hot=0.4),
    dict(seed=4, n=400, houses=1, span=2),
]


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("case", CASES, ids=lambda c: str(c["seed"]))
def test_visits_equal_nested_loop(spark, case, limits):
    full = random_rows(**case)
    assert rows_of(visits(table(spark, full), limits=limits)) == brute_visits(full)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("case", CASES, ids=lambda c: str(c["seed"]))
def test_movements_equal_nested_loop(spark, case, limits):
    full = random_rows(**case)
    assert rows_of(movements(table(spark, full), limits=limits)) == brute_movements(full)


@pytest.mark.parametrize("limits", [Limits(40, 1000), Limits(1, 1)])
def test_other_limits(spark, limits):
    full = random_rows(seed=5, n=500, houses=6, span=5000, hot=0.35)
    df = table(spark, full)
    assert rows_of(visits(df, limits=limits)) == brute_visits(full)
    assert rows_of(movements(df, limits=limits)) == brute_movements(full)


def test_one_wrong_clock_does_not_keep_a_house_in_one_slice(spark):
    from pyspark.sql import functions as F

    from roomtrace.functions.expressions import micros

    full = random_rows(seed=7, n=400, houses=1, span=300)
    full.append((400, "h0", at(60 * 24 * 365 * 40), "dev-0", "sensedPresence", "on", "sleep"))
    df = table(spark, full)
    limits = Limits(40, 1000)
    placed = Slices(df.withColumn("us", micros(F.col("event_ts"))), ["house_id"], limits).of_all(
        df.withColumn("us", micros(F.col("event_ts")))
    )
    sizes = [r["count"] for r in placed.groupBy("house_id", *placed.columns[8:]).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 2 * limits.rows
    assert rows_of(movements(df, limits)) == brute_movements(full)


def test_crowded_instant_is_spread_over_salts(spark):
    from pyspark.sql import functions as F

    full = random_rows(seed=8, n=900, houses=3, span=50, hot=0.5)
    df = table(spark, full).withColumn("us", F.unix_micros(F.col("event_ts").cast("timestamp")))
    slices = Slices(df, ["house_id"], Limits(30, 1000))
    assert slices.crowded
    salts = slices.spread(slices.of_all(df)).select(F.max("parts")).first()[0]
    assert salts >= 450 // 30


def test_equal_instants_do_not_match(spark):
    df = presence(spark, [("h", 1, "d", "on", "sleep"), ("h", 1, "d", "off", "sleep"), ("h", 1, "d", "on", "kitchen")])
    assert visits(df).count() == 0
    assert movements(df).count() == 0


def test_several_entries_share_an_exit(spark):
    df = presence(
        spark, [("h", 4, "d", "on", "kitchen"), ("h", 34, "d", "on", "kitchen"), ("h", 64, "d", "off", "kitchen")]
    )
    assert [(r.entry_ts, r.exit_ts) for r in visits(df).orderBy("entry_ts").collect()] == [
        (at(4), at(64)),
        (at(34), at(64)),
    ]


def test_entry_without_exit_gives_nothing(spark):
    df = presence(spark, [("h", 1, "d", "off", "sleep"), ("h", 2, "d", "on", "sleep")])
    assert visits(df).count() == 0


def test_tied_exits_take_the_first_device(spark):
    df = presence(spark, [("h", 1, "d", "on", "sleep"), ("h", 2, "dev-2", "off", "sleep"), ("h", 2, "dev-1", "off", "sleep")])
    assert [r.exit_device for r in visits(df).collect()] == ["dev-1"]


def test_own_area_at_the_next_instant_is_passed_over(spark):
    df = presence(spark, [("h", 1, "d", "on", "a"), ("h", 2, "d", "on", "a"), ("h", 3, "d", "on", "b")])
    assert [(r.from_area, r.to_area, r.to_ts) for r in movements(df).collect()] == [("a", "b", at(3))] * 2


def test_two_areas_at_the_next_instant_take_the_lower_name(spark):
    df = presence(spark, [("h", 1, "d", "on", "a"), ("h", 2, "d", "on", "c"), ("h", 2, "d", "on", "b")])
    assert [(r.from_area, r.to_area) for r in movements(df).collect()] == [("a", "b")]


def test_own_and_other_area_at_the_next_instant(spark):
    df = presence(spark, [("h", 1, "d", "on", "b"), ("h", 2, "d", "on", "b"), ("h", 2, "d", "on", "c")])
    assert [(r.from_area, r.to_area, r.to_ts) for r in movements(df).collect()] == [("b", "c", at(2))]


def test_houses_do_not_mix(spark):
    df = presence(spark, [("h1", 1, "d", "on", "a"), ("h2", 2, "d", "off", "a"), ("h2", 3, "d", "on", "b")])
    assert visits(df).count() == 0
    assert movements(df).count() == 0


def test_duplicates_count_twice(spark):
    full = random_rows(seed=9, n=200, houses=2, span=60)
    twice = full + [(e + 1000, *rest) for e, *rest in full]
    assert visits(table(spark, twice)).count() == 2 * len(brute_visits(full))
    assert movements(table(spark, twice)).count() == 2 * len(brute_movements(full))


def test_later_exit_leaves_earlier_matches_alone(spark):
    full = random_rows(seed=10, n=300, houses=2, span=100)
    before = set(brute_visits(full))
    more = full + [(900, "h0", at(1000), "dev-0", "sensedPresence", "off", "kitchen")]
    after = set(rows_of(visits(table(spark, more))))
    assert before <= after


def test_rows_without_area_or_house_are_left_out(spark):
    df = presence(spark, [("h", 1, "d", "on", None), (None, 1, "d", "on", "a"), ("h", 2, "d", "on", "b"), (None, 2, "d", "off", "a")])
    assert visits(df).count() == 0
    assert movements(df).count() == 0


def test_empty_input(spark):
    df = table(spark, [])
    assert visits(df).count() == 0
    assert movements(df).count() == 0
