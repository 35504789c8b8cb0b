"""Rules from a table, and positions over the whole table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, random_rows, readings, rows_of, table
from roomtrace import schema as S
from roomtrace.operators.ordering import global_positions
from roomtrace.operators.splitting import Limits
from roomtrace.operators.thresholds import counts_above, place


def test_place(spark):
    rnd = random.Random(1)
    rows = [(sorted(rnd.sample(range(20), rnd.randrange(0, 15))), rnd.randrange(-1, 21)) for _ in range(200)]
    df = spark.createDataFrame([([float(x) for x in a], float(v)) for a, v in rows], "a array<double>, v double")
    got = [r.n for r in df.select(place(F.col("a"), F.col("v"), 5).alias("n")).collect()]
    assert got == [sum(x < v for x in a) for a, v in rows]


@pytest.mark.parametrize("n", [0, 1, 5, 700])
def test_counts_above_against_every_rule(spark, n):
    rnd = random.Random(n)
    props, areas = [S.TEMPERATURE, S.CARBON_DIOXIDE], ["kitchen", "sleep"]
    values = ["20", "20.5", "-3", "1e2", "NaN", "hot", "", None, "50", "49", "50"]
    rows = [("h", i, "d", rnd.choice(props), rnd.choice(values), rnd.choice(areas)) for i in range(300)]
    rules = [(i, rnd.choice([*props, "other"]), rnd.choice(areas), rnd.choice([None, -5.0, 20.0, 49.5, float(rnd.randrange(60)), 1000.0])) for i in range(n)]
    got = counts_above(readings(spark, rows), spark.createDataFrame(rules, "rule_id int, property_device string, area string, threshold double"))

    def number(v):
        return float(v) if v not in ("NaN", "hot", "", None) else float("-inf")

    want = sorted(
        (i, p, a, str(t), sum(q == p and b == a and t is not None and number(v) > t for _, _, _, q, v, b in rows)) for i, p, a, t in rules
    )
    assert sorted((r.rule_id, r.property_device, r.area, str(r.threshold), r.n) for r in got.collect()) == want


@pytest.mark.parametrize("limits", [None, Limits(7, 100), Limits(7, 3)])
def test_global_positions(spark, limits):
    rows = random_rows(seed=5, n=400, houses=5, span=90, hot=0.3)
    got = global_positions(table(spark, rows), ["area"], limits=limits)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[6], r[0]))]
    assert [r.event_id for r in got.orderBy("rn").collect()] == want
    assert sorted(r.rn for r in got.collect()) == list(range(1, 401))


def test_global_positions_of_nothing(spark):
    assert global_positions(table(spark, [(1, "h", at(1), "d", "p", "on", "a")]).limit(0)).count() == 0
