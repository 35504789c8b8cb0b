"""Threshold rules from a table: how many readings of a property and area lie above each of many thresholds.

No reading meets a rule.  Readings are first counted per value; the thresholds of a
property and area are cut at quantiles into about as many buckets as a bucket has
thresholds; a value finds its bucket and its place there by binary search, so what is
searched is the square root of the rules.  Counts per place, then sums from the
largest place down, inside the bucket and over the buckets, answer all rules at once.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from roomtrace.functions.expressions import number_value

KEYS = ["property_device", "area"]
#: Most buckets of a property and area.
MOST_BUCKETS = 4096


def place(values: Column, value: Column, steps: int) -> Column:
    """How many of the sorted ``values`` lie below ``value``; ``values`` has less than ``2 ** steps`` of them."""

    def step(span: Column, _: Column) -> Column:
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        below = F.get(values, middle) < value
        return (
            F.when(span["low"] >= span["high"], span)
            .when(below, F.struct((middle + 1).alias("low"), span["high"].alias("high")))
            .otherwise(F.struct(span["low"].alias("low"), middle.alias("high")))
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), whole, step, lambda span: span["low"])


def counts_above(events: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule_id, property_device, area, threshold, n) for ``rules`` of rule_id, property_device, area, threshold (double).

    Values that are no numbers are not counted; a rule without a threshold counts nothing.
    """
    wanted = rules.select("rule_id", *KEYS, F.col("threshold").cast("double").alias("threshold"))
    points = wanted.where(F.col("threshold").isNotNull()).select(*KEYS, "threshold").distinct()
    buckets = max(1, min(MOST_BUCKETS, isqrt(points.count())))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = points.groupBy(*KEYS).agg(
        F.array_distinct(F.percentile_approx("threshold", cuts, 10 * buckets) if cuts else F.array().cast("array<double>")).alias("bounds")
    )
    steps = buckets.bit_length() + 1
    bucketed = points.join(bounds, KEYS).select(*KEYS, "threshold", place(F.col("bounds"), F.col("threshold"), steps).alias("bucket"))
    lists = bucketed.groupBy(*KEYS, "bucket").agg(F.array_sort(F.collect_list("threshold")).alias("points"))
    longest = lists.agg(F.max(F.size("points"))).first()[0] or 0

    counted = (
        events.select(*KEYS, number_value(F.col("value_property_device")).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*KEYS, "value")
        .agg(F.count("*").alias("n"))
    )
    placed = (
        counted.join(bounds, KEYS)
        .select(*KEYS, "value", "n", place(F.col("bounds"), F.col("value"), steps).alias("bucket"))
        # A value above all bounds of a bucket without thresholds counts for the buckets below.
        .join(lists, [*KEYS, "bucket"], "left")
        .select(*KEYS, "bucket", "n", F.when(F.col("points").isNull(), 0).otherwise(place(F.col("points"), F.col("value"), longest.bit_length() + 1)).alias("place"))
        .groupBy(*KEYS, "bucket", "place")
        .agg(F.sum("n").alias("n"))
    )
    # Thresholds as rows: the one at place i counts the values of its bucket placed above i, and all of higher buckets.
    rows = lists.select(*KEYS, "bucket", F.posexplode("points").alias("at", "threshold"))
    sums = placed.select(*KEYS, "bucket", (F.col("place") - 1).alias("at"), F.lit(None).cast("double").alias("threshold"), "n")
    downward = W.partitionBy(*KEYS, "bucket").orderBy(F.col("at").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    inside = rows.withColumn("n", F.lit(0).cast("bigint")).unionByName(sums).withColumn("inside", F.sum("n").over(downward)).where("threshold IS NOT NULL")
    higher = W.partitionBy(*KEYS).orderBy(F.col("bucket").desc()).rowsBetween(W.unboundedPreceding, -1)
    totals = (
        placed.groupBy(*KEYS, "bucket").agg(F.sum("n").alias("n"))
        .unionByName(lists.select(*KEYS, "bucket", F.lit(0).cast("bigint").alias("n")))
        .groupBy(*KEYS, "bucket").agg(F.sum("n").alias("n"))
        .select(*KEYS, "bucket", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"))
    )
    answers = inside.join(totals, [*KEYS, "bucket"]).select(*KEYS, "threshold", (F.col("inside") + F.col("above")).alias("n"))
    return wanted.join(answers, [*KEYS, "threshold"], "left").select(
        "rule_id", *KEYS, "threshold", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )
