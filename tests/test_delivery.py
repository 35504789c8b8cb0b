"""What is delivered, and how often: manifests, dead letters, repeated rows, a ledger of scripts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, random_rows, rows_of, table
from roomtrace.operators.counts import status_counts
from roomtrace.operators.visits import visits
from roomtrace.sources import behaviour as B
from roomtrace.streaming import jobs, ledger, ordered
from test_stream_order import DELAY, late_parts, mark, put, run, state_rows, stream_of


# --- committed batches ------------------------------------------------------


def test_a_batch_killed_between_two_jobs_is_invisible_then_replaced(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [table(spark, random_rows(seed=s, n=20, houses=1, span=30)) for s in (1, 2)]
    put(parts[0], source)
    state = {"broken": False}

    def second(batch):
        if state["broken"]:
            raise ValueError("killed")
        return batch.groupBy().count()

    def take():
        jobs.finish(jobs.per_batch(stream_of(spark, source, parts[0]), {"a": lambda b: b.select("event_id"), "b": second}, out, once=True))

    take()
    put(parts[1], source)
    state["broken"] = True
    with pytest.raises(Exception, match="killed"):
        take()
    # The first table of the second batch is written, but not read.
    assert (tmp_path / "out" / "a" / "batch_id=1").exists()
    assert {r.batch_id for r in jobs.read_batches(spark, out, "a").collect()} == {0}
    state["broken"] = False
    take()
    assert jobs.read_batches(spark, out, "a").groupBy("batch_id").count().count() == 2
    assert jobs.read_batches(spark, out, "b").groupBy().sum("count").first()[0] == 40


def test_a_first_batch_that_fails_reads_as_nothing(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = table(spark, random_rows(seed=1, n=20, houses=1, span=30))
    put(df, source)

    def broken(batch):
        raise ValueError("killed")

    with pytest.raises(Exception, match="killed"):
        jobs.finish(jobs.per_batch(stream_of(spark, source, df), {"a": lambda b: b, "b": broken}, out, once=True))
    assert jobs.read_batches(spark, out, "a").count() == 0


# --- dead letters --------------------------------------------------------


def _files(tmp_path, n):
    (tmp_path / "in").mkdir()
    for i in range(n):
        (tmp_path / "in" / f"{i:02}.txt").write_text(f"{i}\n{i}\n")


def _picky(bad, tries):
    """A job that fails in the tasks on a line of ``bad``."""

    def job(batch):
        tries.append(1)
        text = F.when(F.col("value").isin([str(b) for b in bad]), F.raise_error(F.lit("bad line"))).otherwise(F.col("value"))
        return batch.select(text.cast("string").alias("value"), "file")

    return job


def lines_of(spark, tmp_path):
    return spark.readStream.text(str(tmp_path / "in")).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), "value")


@pytest.mark.parametrize("bad", [[37], [0], [63], [3, 40]])
def test_bad_files_are_found_by_halving(spark, tmp_path, bad):
    _files(tmp_path, 64)
    out, tries = str(tmp_path / "out"), []
    jobs.finish(jobs.per_batch(lines_of(spark, tmp_path), {"x": _picky(bad, tries)}, out, once=True, set_aside=2))
    got = sorted(int(r.value) for r in jobs.read_batches(spark, out, "x").collect())
    assert got == sorted(i for i in range(64) if i not in bad for _ in range(2))
    letters = jobs.read_batches(spark, out, jobs.DEAD_LETTERS).collect()
    assert sorted(r.file for r in letters) == [f"{b:02}.txt" for b in bad] and all("bad line" in r.error for r in letters)
    assert len(tries) <= len(bad) * (2 * 6 + 1)


def test_too_many_bad_files_fail_the_batch(spark, tmp_path):
    _files(tmp_path, 8)
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="bad line"):
        jobs.finish(jobs.per_batch(lines_of(spark, tmp_path), {"x": _picky(range(8), [])}, out, once=True, set_aside=2))
    jobs.finish(jobs.per_batch(lines_of(spark, tmp_path), {"x": _picky([], [])}, out, once=True, set_aside=2))
    assert jobs.read_batches(spark, out, "x").count() == 16
    assert jobs.read_batches(spark, out, jobs.DEAD_LETTERS).count() == 0


# --- repeated rows -------------------------------------------------------


def test_repeated_deliveries_within_the_delay(spark, tmp_path):
    rows = random_rows(seed=9, n=200, houses=2, span=200)
    rnd = random.Random(9)
    twice = rows + [r for r in rows if rnd.random() < 0.4] + rows[:20]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in late_parts(twice, 6, 9):
        put(table(spark, part), source)
    df = table(spark, rows)
    progress = run(spark, jobs.once_each(stream_of(spark, source, df), f"{2 * DELAY} minutes"), out)
    assert sum(p["numInputRows"] > 0 for p in progress) == 6
    assert rows_of(spark.read.parquet(f"{out}/out")) == rows_of(df.distinct())
    put(mark(spark, 1000), source)
    progress = run(spark, jobs.once_each(stream_of(spark, source, df), f"{2 * DELAY} minutes"), out)
    assert state_rows(progress)[-1] <= 1


# --- exits by a stream-stream join ------------------------------------------


def test_visits_by_join(spark, tmp_path):
    rows = random_rows(seed=12, n=240, houses=3, span=300)
    source, out, longest = str(tmp_path / "in"), str(tmp_path / "out"), 25 * 60
    for part in late_parts(rows, 6, 12):
        put(table(spark, part), source)
    put(mark(spark, 1000), source)
    df = table(spark, rows)
    progress = run(spark, ordered.visits_by_join(stream_of(spark, source, df), f"{DELAY} minutes", longest), out)
    want = [r for r in rows_of(visits(df)) if (r[4] - r[3]).total_seconds() <= longest]
    assert rows_of(spark.read.parquet(f"{out}/out").select(*visits(df).columns)) == want
    assert sum(p["numInputRows"] > 0 for p in progress) == 7
    assert state_rows(progress)[-1] == 0


# --- ledger --------------------------------------------------------------

SCRIPT = '<behavior startdate="05/03/2019-17:00:00"><move-device-zone deviceId="d" zoneId="a"/><delay value="{0}" unit="m"/><set-device-property deviceId="d" property="p" value="true"/></behavior>'


def put_script(folder, name, minutes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(SCRIPT.format(minutes) + " " * 600)


def take(spark, folder, book, out):
    def events(new):
        return B.behaviour_events(new, ["file"]).select("file", "event_ts")

    stream = B.stream_documents(spark, str(folder), maxFilesPerTrigger="1")
    jobs.finish(ledger.take_once(stream, book, out, events, "events", once=True))
    short = lambda c: F.element_at(F.split(c, "/"), -1).alias(c)
    taken = {tuple(r) for r in jobs.read_batches(spark, out, "events").select(short("file"), "event_ts").collect()}
    repeated = {tuple(r) for r in jobs.read_batches(spark, out, "repeated").select(short("file"), short("first_file")).collect()}
    return taken, repeated


def test_a_script_under_a_second_name_is_taken_once(spark, tmp_path):
    folder, book = tmp_path / "in", str(tmp_path / "ledger")
    start = at(17 * 60)
    put_script(folder, "a.bhv", 1)
    put_script(folder, "b.bhv", 2)
    first = {("a.bhv", at(17 * 60 + 1)), ("b.bhv", at(17 * 60 + 2))}
    assert take(spark, folder, book, str(tmp_path / "out")) == (first, set())
    put_script(folder, "c.bhv", 1)
    put_script(folder, "d.bhv", 3)
    both = first | {("d.bhv", at(17 * 60 + 3))}
    assert take(spark, folder, book, str(tmp_path / "out")) == (both, {("c.bhv", "a.bhv")})
    # Without the log everything arrives again, and nothing is taken twice.
    taken, repeated = take(spark, folder, book, str(tmp_path / "other"))
    assert taken == set()
    assert repeated == {("a.bhv", "a.bhv"), ("b.bhv", "b.bhv"), ("c.bhv", "a.bhv"), ("d.bhv", "d.bhv")}
    assert ledger.entries(spark, book).count() == 3 and start < at(17 * 60 + 1)


def test_equal_scripts_of_one_batch(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("d", None), ("e", None)], "file string, value string")
    new, repeated = ledger.split_arrivals(df, spark.createDataFrame([], ledger.ENTRY))
    assert sorted(r.file for r in new.collect()) == ["a", "c", "d", "e"]
    assert [(r.file, r.first_file) for r in repeated.collect()] == [("b", "a")]


def test_taken_files_can_be_archived(spark, tmp_path):
    put_script(tmp_path / "in", "a.bhv", 1)
    options = {"cleanSource": "archive", "sourceArchiveDir": str(tmp_path / "done"), "maxFilesPerTrigger": "1"}
    for name in ("b.bhv", "c.bhv"):
        stream = B.stream_documents(spark, str(tmp_path / "in"), **options)
        jobs.finish(jobs.extract(stream, str(tmp_path / "out"), once=True))
        put_script(tmp_path / "in", name, 2)
    assert [p.name for p in (tmp_path / "done").rglob("*.bhv")] == ["a.bhv"]
