"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from helpers import random_rows, table
from roomtrace.operators.counts import status_counts
from roomtrace.operators.movement import movements
from roomtrace.operators.ordering import running_presence
from roomtrace.operators.splitting import Limits
from roomtrace.operators.visits import visits
from roomtrace.plans.catalog import QUERIES

SF = "/root/testdata/sf0.01"
BATCH = [q for q in sorted(QUERIES) if not q.startswith(("stream_", "land_", "csv_", "pipeline_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"\bExchange (hash|range|Single|round)", text))


@pytest.mark.parametrize("name", BATCH)
def test_no_product_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval", "ExistingRDD"):
        assert bad not in text


def test_rules_are_matched_with_counted_groups(spark):
    text = plan(entry.queries()["rule_counts"](spark, SF))
    assert text.count("FileScan") == 1
    # Nothing but the partial count stands between the scan and the first shuffle.
    below = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_count(1)" in below.splitlines()[1]


@pytest.mark.parametrize("name", ["presence_count", "visits_all", "movement_transitions", "running_presence_count"])
def test_one_scan_and_one_shuffle(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert text.count("FileScan") == 1
    assert shuffles(text) == 1


@pytest.mark.parametrize("name", ["behaviour_to_events", "positional_join", "device_zone_join"])
def test_documents_are_parsed_once(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    # The second one is for documents that have to be flattened, and sees no others.
    assert text.count("from_xml(StructField") == 2
    assert shuffles(text) == 1


def scan(df):
    return next(line for line in plan(df).splitlines() if "FileScan" in line)


def test_filters_and_columns_reach_the_scan(spark):
    line = scan(entry.queries()["movement_transitions"](spark, SF))
    assert re.search(r"PushedFilters: .*(In\(event_type|GreaterThanOrEqual\(value)", line)
    line = scan(entry.queries()["presence_count"](spark, SF))
    assert "user_id" not in line and "event_id" not in line


def test_rule_filters_reach_a_table_of_readings(spark, tmp_path):
    table(spark, random_rows(seed=41, n=50, houses=1, span=50)).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    line = scan(status_counts(stored))
    assert "In(property_device" in line and "In(area" in line
    assert "house_id" not in line and "event_ts" not in line
    line = scan(visits(stored, ["toilet"]))
    assert "EqualTo(property_device,sensedPresence)" in line and "EqualTo(area,toilet)" in line


def test_file_listing_reads_no_content(spark):
    assert "content" not in scan(entry.queries()["file_gate"](spark, SF))


@pytest.mark.parametrize("job", [visits, movements, lambda df, limits: running_presence(df, limits=limits)])
def test_hot_groups_are_shuffled_by_slice(spark, job):
    df = table(spark, random_rows(seed=42, n=200, houses=1, span=20))
    text = plan(job(df, limits=Limits(5, 1000)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # The shuffle right under the last window splits the group by slice.
    assert re.search(r"Exchange hashpartitioning\(\S+ (\S+ )?c1#", text.replace(",", " ").replace("  ", " "))
