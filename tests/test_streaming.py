"""Streams against the batch answer, batch by batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import at, presence, random_rows, readings, rows_of, table
from roomtrace import schema as S
from roomtrace.operators.counts import area_activity, presence_counts, status_counts
from roomtrace.operators.movement import movements
from roomtrace.operators.visits import visits
from roomtrace.session import work_dir
from roomtrace.sources import behaviour, lines
from roomtrace.streaming import jobs

OPTIONS = {"maxFilesPerTrigger": "1"}


def stream_of(spark, path, sample, **options):
    return spark.readStream.schema(sample.schema).options(**options).parquet(path)


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_one_file_gives_the_batch_answer(spark, tmp_path):
    df = table(spark, random_rows(seed=31, n=200, houses=2, span=120))
    put(df, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.finish(jobs.per_batch(stream_of(spark, str(tmp_path / "in"), df), jobs.HOUSE_JOBS, out, once=True))
    for name, job in [
        ("status_count", status_counts),
        ("area_activity", area_activity),
        ("visits", visits),
        ("movement", movements),
    ]:
        got = jobs.read_batches(spark, out, name)
        want = job(df)
        assert rows_of(got.select(*want.columns)) == rows_of(want)
        assert {r.batch_id for r in got.select("batch_id").distinct().collect()} == {0}


def test_visits_do_not_cross_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    one = presence(spark, [("h", 1, "d", "on", "sleep"), ("h", 2, "d", "off", "sleep"), ("h", 3, "d", "on", "sleep")])
    two = presence(spark, [("h", 4, "d", "off", "sleep")])
    for df in (one, two):
        put(df, source)
        jobs.finish(jobs.per_batch(stream_of(spark, source, one), {"visits": visits}, out, once=True))
    got = jobs.read_batches(spark, out, "visits").collect()
    assert [(r.batch_id, r.entry_ts, r.exit_ts) for r in got] == [(0, at(1), at(2))]


def test_files_are_taken_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    put(df, source)
    for _ in range(2):
        jobs.finish(jobs.per_batch(stream_of(spark, source, df), {"status_count": status_counts}, out, once=True))
    got = jobs.read_batches(spark, out, "status_count")
    assert got.count() == 21 and got.groupBy().sum("n").first()[0] == 1


def test_running_count_goes_on_over_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [table(spark, random_rows(seed=s, n=80, houses=2, span=60)) for s in (32, 33, 34)]
    for df in parts:
        put(df, source)
    stream = stream_of(spark, source, parts[0], **OPTIONS)
    jobs.finish(jobs.running_presence(stream, out, once=True))
    got = jobs.read_batches(spark, out, "running")
    assert got.select("batch_id").distinct().count() == 3
    last = got.groupBy("key").agg({"n": "max"})
    whole = parts[0].union(parts[1]).union(parts[2])
    assert rows_of(last) == rows_of(presence_counts(whole))


def test_batch_without_matches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    put(df.limit(0), source)
    jobs.finish(jobs.per_batch(stream_of(spark, source, df), jobs.HOUSE_JOBS, out, once=True))
    assert jobs.read_batches(spark, out, "visits").count() == 0


def test_nothing_arrived(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    jobs.finish(jobs.per_batch(stream_of(spark, source, df), jobs.HOUSE_JOBS, out, once=True))


def test_an_error_stops_the_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    put(df, source)

    def broken(batch):
        raise ValueError("no such rule")

    with pytest.raises(Exception, match="no such rule"):
        jobs.finish(jobs.per_batch(stream_of(spark, source, df), {"x": broken}, out, once=True))
    # The batch was not marked as done and runs when the job is right.
    jobs.finish(jobs.per_batch(stream_of(spark, source, df), {"x": status_counts}, out, once=True))
    assert jobs.read_batches(spark, out, "x").groupBy().sum("n").first()[0] == 1


def test_lines_land_and_parse(spark, tmp_path):
    df = table(spark, random_rows(seed=35, n=60, houses=1, span=90))
    lines.write_lines(df, str(tmp_path / "spool"))
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.finish(jobs.land(lines.stream_lines(spark, str(tmp_path / "spool")), out, once=True))
    back = lines.parse_lines(spark.read.parquet(f"{out}/landed"))
    assert rows_of(back.select(*S.LINE_FIELDS)) == rows_of(df.select(*S.LINE_FIELDS))


def test_lines_to_reports(spark, tmp_path):
    spool, out = tmp_path / "spool", str(tmp_path / "out")
    spool.mkdir()
    (spool / "home.csv").write_text(
        "2019-03-05 08:00:00,d1,sensedPresence,on,toilet\n"
        "not a reading\n"
        "2019-03-05 08:05:00,d1,sensedPresence,off,toilet\n"
        "2019-03-05 08:06:00,d2,sensedPresence,on,armchair"
    )
    run = "2021-01-09 10:20:30"
    jobs.finish(jobs.house_report(lines.stream_lines(spark, str(spool)), out, run, once=True))

    def text(name):
        return [r.value for r in jobs.read_batches(spark, out, name, "text").collect()]

    assert f"[{run}] - Activity in bathroom presence sensor toilet: 1 " in text("report")
    assert len(text("report")) == 30
    assert text("movement") == ["Se detecta movimiento, cambios de zona desde zona 1: toilet a zona 2: armchair "]
    assert text("visits")[1] == "Tiempo entrada: 2019-03-05 08:00:00 , tiempo salida: 2019-03-05 08:05:00 "
    assert [r.value for r in jobs.read_batches(spark, out, "malformed").collect()] == ["not a reading"]


def test_files_of_a_batch_may_form_one_house(spark, tmp_path):
    spool = tmp_path / "spool"
    spool.mkdir()
    (spool / "a.csv").write_text("2019-03-05 08:00:00,d1,sensedPresence,on,toilet")
    (spool / "b.csv").write_text("2019-03-05 08:05:00,d1,sensedPresence,off,toilet")
    for house, found in [(None, 0), (F.lit("home"), 1)]:
        out = str(tmp_path / f"out{found}")
        stream = lines.stream_lines(spark, str(spool))
        jobs.finish(jobs.per_batch(stream, {"visits": jobs.on_lines(visits, house)}, out, once=True))
        assert jobs.read_batches(spark, out, "visits").count() == found


def test_raw_events_may_be_a_folder_of_files(spark, tmp_path):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = str(tmp_path / "out")
    jobs.finish(jobs.land(jobs.stream_raw_events(spark, str(tmp_path)), out, once=True))
    assert spark.read.parquet(f"{out}/landed").count() == raw.count()


def test_console(spark, tmp_path):
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    put(df, str(tmp_path / "in"))
    jobs.finish(jobs.show(stream_of(spark, str(tmp_path / "in"), df), str(tmp_path / "out"), once=True))


def test_documents_are_taken_once(spark, tmp_path):
    scripts, out = tmp_path / "scripts", str(tmp_path / "out")
    scripts.mkdir()

    def script(device):
        return (
            '<behavior startdate="05/03/2019-17:00:00">'
            f'<move-device-zone deviceId="{device}" zoneId="sleep"/><delay value="1" unit="h"/>'
            f'<set-device-property deviceId="{device}" property="sensedPresence" value="true"/></behavior>'
        ) + " " * 600

    for name, content in [("a.bhv", script("d1")), ("b.bhv.COMPLETED", script("d2")), ("c.bhv", "<behavior/>")]:
        (scripts / name).write_text(content)
    for name in (None, "d.bhv"):
        if name:
            (scripts / name).write_text(script("d4"))
        stream = behaviour.stream_documents(spark, str(scripts))
        job = {"events": lambda batch: behaviour.behaviour_events(batch, ["file"])}
        jobs.finish(jobs.per_batch(stream, job, out, once=True))
    got = jobs.read_batches(spark, out, "events").select("batch_id", F.element_at(F.split("file", "/"), -1), "id_device", "area")
    assert rows_of(got) == [(0, "a.bhv", "d1", "sleep"), (1, "d.bhv", "d4", "sleep")]


def test_timed_stream_can_be_stopped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom")])
    put(df, source)
    query = jobs.per_batch(stream_of(spark, source, df), {"status_count": status_counts}, out)
    jobs.finish(query, seconds=6)
    assert not query.isActive


def test_work_folder_needs_a_shared_place(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    shared = Session(spark__checkpoint__dir="hdfs://shared/dir/", spark__master="yarn")
    assert work_dir(shared, "x").startswith("hdfs://shared/dir/x-")
    with pytest.raises(ValueError):
        work_dir(Session(spark__master="yarn"), "x")
    assert work_dir(Session(spark__master="local[2]"), "x") != work_dir(Session(spark__master="local[2]"), "x")
