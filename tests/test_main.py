"""Scripts to reports, through the command line."""

from __future__ import annotations

import pytest

from roomtrace.__main__ import main
from roomtrace.streaming.jobs import read_batches


def script(*steps):
    body = "".join(
        f'<delay value="{minutes}" unit="m"/><set-device-property deviceId="{device}" property="{prop}" value="{value}"/>'
        for minutes, device, prop, value in steps
    )
    zones = '<move-device-zone deviceId="p1" zoneId="toilet"/><move-device-zone deviceId="p2" zoneId="armchair"/>'
    return f'<behavior startdate="05/03/2019-17:00:00">{zones}{body}</behavior>' + " " * 600


def test_scripts_to_reports(spark, tmp_path):
    scripts, out, report, running = (str(tmp_path / n) for n in ("scripts", "etl", "report", "running"))
    (tmp_path / "scripts").mkdir()
    one = tmp_path / "scripts" / "one.bhv"
    one.write_text(
        script(
            (60, "p1", "sensedPresence", "true"),
            (5, "p1", "sensedPresence", "false"),
            (1, "p2", "sensedPresence", "true"),
            (1, "lost", "sensedPresence", "true"),
        )
    )
    main(["extract", scripts, out])
    got = read_batches(spark, out, "lines").orderBy("value").collect()
    assert [(r.value, r.file.removeprefix("file:").lstrip("/")) for r in got] == [
        ("2019-03-05 18:00:00,p1,sensedPresence,on,toilet", str(one).lstrip("/")),
        ("2019-03-05 18:05:00,p1,sensedPresence,off,toilet", str(one).lstrip("/")),
        ("2019-03-05 18:06:00,p2,sensedPresence,on,armchair", str(one).lstrip("/")),
    ]
    conflicts = read_batches(spark, out, "zone_conflicts").collect()
    assert [(r.id_device, r.reason) for r in conflicts] == [("lost", "no zone")]

    main(["report", f"{out}/lines", report, "--run-ts", "now"])
    lines = {r.value for r in read_batches(spark, report, "report", "text").collect()}
    assert "[now] - Activity in bathroom presence sensor toilet: 1 " in lines
    assert read_batches(spark, report, "movement", "text").count() == 1
    assert read_batches(spark, report, "visits", "text").count() == 2

    main(["running", f"{out}/lines", running, "--areas", "toilet", "sleep"])
    got = read_batches(spark, running, "running").select("key", "n").collect()
    assert [tuple(r) for r in got] == [("toilet-sensedPresence-on", 1)]


def two_homes(tmp_path, names):
    steps = [
        [(60, "p2", "sensedPresence", "true"), (60, "p1", "sensedPresence", "true")],
        [(61, "p2", "sensedPresence", "false"), (61, "p1", "sensedPresence", "true")],
    ]
    for name, own in zip(names, steps):
        path = tmp_path / "scripts" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(script(*own))


def test_homes_stay_apart(spark, tmp_path):
    # One home enters the armchair, then the toilet; the other one leaves the armchair in between.
    two_homes(tmp_path, ["a.bhv", "b.bhv"])
    out, report = str(tmp_path / "etl"), str(tmp_path / "report")
    main(["extract", str(tmp_path / "scripts"), out])
    main(["report", f"{out}/lines", report, "--run-ts", "now"])
    assert read_batches(spark, out, "lines").select("file").distinct().count() == 2
    assert read_batches(spark, report, "movement", "text").count() == 1
    assert read_batches(spark, report, "visits", "text").count() == 0


def test_scripts_of_one_name_in_two_folders(spark, tmp_path):
    from pyspark.sql import functions as F
    from roomtrace.sources import behaviour as B

    hours = script(*[(60, "p1", "sensedPresence", "true")] * 3)
    for home in ("h1", "h2"):
        (tmp_path / home).mkdir()
        (tmp_path / home / "day.bhv").write_text(hours)
    docs = B.parse_documents(B.read_documents(spark, str(tmp_path / "*")), ["file"])
    got = B.delay_list(docs, ["file"]).groupBy("file").agg(F.sort_array(F.collect_list("elapsed")).alias("e")).collect()
    assert [r.e for r in got] == [[3600, 7200, 10800]] * 2


def test_refused_files_are_reported(spark, tmp_path):
    (tmp_path / "scripts").mkdir()
    (tmp_path / "scripts" / "a.bhv.COMPLETED").write_text(script())
    (tmp_path / "scripts" / "b.bhv").write_text("<behavior/>")
    out = str(tmp_path / "etl")
    main(["extract", str(tmp_path / "scripts"), out])
    got = {(r.file.rsplit("/", 1)[1], r.reason) for r in read_batches(spark, out, "rejected").collect()}
    assert got == {("a.bhv.COMPLETED", "done"), ("b.bhv", "too small")}


def test_text_files_of_lines(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.txt").write_text("2019-03-05 18:00:00,d,sensedPresence,on,toilet\n")
    main(["running", str(tmp_path / "in"), str(tmp_path / "out"), "--text"])
    assert [r.n for r in read_batches(spark, str(tmp_path / "out"), "running").collect()] == [2]


@pytest.mark.parametrize("name", ["pipeline_movements", "pipeline_visits"])
def test_pipeline_queries_take_scripts(spark, monkeypatch, name):
    from roomtrace.plans import catalog

    seen = []
    for job in ("extract", "on_lines"):
        real = getattr(catalog.jobs, job)
        monkeypatch.setattr(catalog.jobs, job, lambda *a, job=job, real=real, **b: seen.append((job, a[0])) or real(*a, **b))
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert [job for job, _ in seen] == ["extract", "on_lines"] and {"file", "value", "gated"} == set(seen[0][1].columns)
