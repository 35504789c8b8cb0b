"""Scripts read in splits against the parser of whole rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from roomtrace.plans import catalog
from roomtrace.sources import behaviour as B
from roomtrace.sources.large import large_scripts, read_tags


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "8192")
    yield
    spark.conf.set(name, before)


def delay(rnd):
    return f"<delay value=\"{rnd.randrange(5)}\" unit='{rnd.choice('hms')}' />"


def change(rnd):
    value = rnd.choice(["true", "false", "20", "a&gt;b", "a>b", "&#233;", "é"])
    return f'<set-device-property deviceId="d{rnd.randrange(9)}" property="p&amp;{rnd.randrange(3)}" value="{value}"></set-device-property>'


def zone(rnd, i):
    return f'<move-device-zone deviceId="d{i}" zoneId="{rnd.choice(["hall", "köln", "a<b".replace("<", "&lt;")])}"/>'


def script(seed, changes, grouped=True):
    rnd = random.Random(seed)
    body = [zone(rnd, i) for i in [*range(6), 1, 1, 2]]
    for _ in range(changes):
        if grouped and rnd.random() < 0.05:
            body.append("<!-- " + "\n".join(delay(rnd) + change(rnd) for _ in range(rnd.randrange(80))) + " -->")
        if grouped and rnd.random() < 0.05:
            body.append("<group n='>'>" + delay(rnd) + "</group>")
            body.append(change(rnd))
        else:
            body.append(delay(rnd) + "\n" + change(rnd))
    return f'<?xml version="1.0"?>\n<behavior startdate="05/03/2019-17:00:00">{"".join(body)}<!-- end --></behavior>\n'


def write(path, texts):
    path.mkdir()
    for name, text in texts.items():
        (path / name).write_text(text + " " * 600, encoding="utf-8")


def compare(spark, path, **options):
    whole = B.parse_documents(B.read_documents(spark, path), ["file"], **options)
    got = large_scripts(spark, path, **options)
    want = B.with_area(B.paired_changes(whole, ["file"]))
    assert rows_of(got.changes.select(*want.columns)) == rows_of(want)
    key = lambda r: tuple(map(str, r))
    odd = B.zone_conflicts(B.paired_changes(whole, ["file"]))
    assert sorted(map(key, got.zone_conflicts.select(*odd.columns).collect())) == sorted(map(key, odd.collect()))
    return got, {r.file.rsplit("/", 1)[1]: r.reason for r in B.rejected_documents(whole, ["file"]).collect()}


def test_splits_give_what_the_row_parser_gives(spark, tmp_path, small_splits):
    texts = {f"{n}.bhv": script(n, c) for n, c in enumerate([0, 1, 40, 900, 1500])}
    write(tmp_path / "in", texts)
    tags = read_tags(spark, str(tmp_path / "in"))
    assert tags.where(F.col("file").endswith("4.bhv")).select("block").distinct().count() > 20
    got, refused = compare(spark, str(tmp_path / "in"))
    assert refused == {} and got.rejected.count() == 0
    assert got.changes.count() == 2441


@pytest.mark.parametrize("strict", [False, True])
def test_scripts_that_cannot_be_used(spark, tmp_path, small_splits, strict):
    good = script(1, 3)
    texts = {
        "good.bhv": good,
        "date.bhv": good.replace("05/03/2019-17:00:00", "2019-03-05"),
        "delay.bhv": good.replace('<delay value="', '<delay value="x', 1),
        "few.bhv": good.replace("</behavior>", "<set-device-property deviceId='d' property='p' value='v'/>" * 3 + "</behavior>"),
        "other.bhv": "<other/>",
        "cut.bhv": "<behavior startdate='05/03/2019-17:00:00'><delay value='1'",
        "open.bhv": good.replace("</behavior>", ""),
        "more.bhv": good.rstrip() + " and more",
        "done.bhv.COMPLETED": good,
        "gap.bhv": good.replace("</behavior>", "<delay value='3'/></behavior>"),
    }
    write(tmp_path / "in", texts)
    got, refused = compare(spark, str(tmp_path / "in"), strict=strict)
    assert {r.file.rsplit("/", 1)[1]: r.reason for r in got.rejected.collect()} == refused
    assert len(refused) == (9 if strict else 8)


def test_scripts_of_many_houses_lie_in_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "work_dir", lambda spark, name: str(tmp_path / name))
    changes = catalog.QUERIES["large_scripts"](spark, "/root/testdata/sf0.001")
    houses = changes.select("house_id").distinct().count()
    folder = tmp_path / "large-scripts"
    assert len(list(folder.glob("*.txt"))) == houses > 1
    assert not [f for f in folder.iterdir() if f.is_dir()]


def test_changes_have_the_id_of_their_script(spark, tmp_path, small_splits):
    texts = {f"{n}.bhv": script(n, 300).replace("<behavior ", f"<behavior id='{n}&amp;' ") for n in range(2)}
    write(tmp_path / "in", {**texts, "none.bhv": script(2, 3)})
    got, _ = compare(spark, str(tmp_path / "in"))
    ids = {(r.file.rsplit("/", 1)[1], r.id) for r in got.changes.select("file", "id").distinct().collect()}
    assert ids == {("0.bhv", "0&"), ("1.bhv", "1&"), ("none.bhv", None)}


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    got = large_scripts(spark, str(tmp_path / "in"))
    assert got.changes.count() == got.rejected.count() == got.zone_conflicts.count() == 0
