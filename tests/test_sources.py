from __future__ import annotations

import datetime as dt

import pytest

from helpers import at, random_rows, readings, rows_of, table
from roomtrace import schema as S
from roomtrace.operators.splitting import Limits
from roomtrace.sources import behaviour as B, documents, files, lines


def text(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, value string")


# --- device lines ---------------------------------------------------------


def test_well_formed_line(spark):
    got = lines.parse_lines(text(spark, ["2019-03-05 07:00:00,dev,powerStatus,off,bedroom"])).collect()
    assert [tuple(r) for r in got] == [(0, dt.datetime(2019, 3, 5, 7), "dev", "powerStatus", "off", "bedroom")]


def test_long_line_keeps_five_fields_and_first_line(spark):
    got = lines.parse_lines(text(spark, ["2019-03-05 07:00:00,d,p,v,a,x,y", "2019-03-05 07:00:00,d,p,v,b\nmore,of,it"]))
    assert [r.area for r in got.orderBy("event_id").collect()] == ["a", "b"]


def test_short_and_bad_lines_are_set_aside(spark):
    df = text(spark, ["a,b,c", "", "no time,d,p,v,a", "2019-03-05 07:00:00,d,p,v,a", None])
    assert {(r.event_id, r.reason) for r in lines.malformed_lines(df).collect()} == {
        (0, "short line"),
        (1, "short line"),
        (2, "bad time"),
        (4, "short line"),
    }
    got = {(r.event_id, r.event_ts) for r in lines.parse_lines(df).collect()}
    assert got == {(2, None), (3, dt.datetime(2019, 3, 5, 7))}


def test_empty_fields_are_kept(spark):
    got = lines.parse_lines(text(spark, ["2019-03-05 07:00:00,,p,,"])).first()
    assert (got.id_device, got.value_property_device, got.area) == ("", "", "")


def test_line_files(spark, tmp_path):
    df = table(spark, random_rows(seed=21, n=50, houses=1, span=90))
    path = str(tmp_path / "lines")
    lines.write_lines(df, path)
    lines.write_lines(df, path)
    back = lines.parse_lines(lines.read_lines(spark, path))
    assert rows_of(back.select(*S.LINE_FIELDS)) == sorted(2 * rows_of(df.select(*S.LINE_FIELDS)))
    assert back.select("event_id").distinct().count() == 100


def test_one_folder_of_lines_per_source(spark, tmp_path):
    df = table(spark, random_rows(seed=24, n=40, houses=2, span=90))
    lines.write_lines(df, str(tmp_path / "out"), by=["house_id"])
    for house in ("h0", "h1"):
        back = lines.parse_lines(lines.read_lines(spark, str(tmp_path / "out" / f"house_id={house}")))
        want = df.filter(df.house_id == house)
        assert rows_of(back.select(*S.LINE_FIELDS)) == rows_of(want.select(*S.LINE_FIELDS))


def test_csv_appends(spark, tmp_path):
    df = table(spark, random_rows(seed=22, n=50, houses=2, span=90))
    path = str(tmp_path / "csv")
    lines.write_csv(df, path)
    lines.write_csv(df, path)
    want = df.select("event_id", "house_id", *S.LINE_FIELDS)
    assert rows_of(lines.read_csv(spark, path)) == sorted(2 * rows_of(want))


# --- behaviour documents --------------------------------------------------

START = '<behavior startdate="05/03/2019-17:00:00">'


def doc(body, start=START):
    return f'<?xml version="1.0"?>\n{start}\n{body}\n</behavior>'


def delay(value, unit):
    return f'<delay value="{value}" unit="{unit}"/>'


def change(device, prop="powerStatus", value="true"):
    return f'<set-device-property deviceId="{device}" property="{prop}" value="{value}"/>'


def zone(device, name):
    return f'<move-device-zone deviceId="{device}" zoneId="{name}" />'


def docs(spark, *values):
    return spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(values)], "file string, value string")


def events(df, **options):
    got = B.behaviour_events(df, ["file"], **options).orderBy("file", "pos").collect()
    return [(r.event_ts, r.id_device, r.property_device, r.value_property_device, r.area) for r in got]


def reasons(df, **options):
    parsed = B.parse_documents(df, ["file"], **options)
    return {r.file: r.reason for r in B.rejected_documents(parsed, ["file"]).collect()}


def test_delays_add_up_from_the_start(spark):
    body = zone("d1", "bedroom") + zone("d2", "sleep") + delay(9, "h") + change("d1", value="false")
    body += "<!-- " + delay(5, "h") + " -->" + delay(2, "m") + change("d2", S.PRESENCE) + delay(0, "h") + change("d1", "x", "293.15")
    assert events(docs(spark, doc(body))) == [
        (dt.datetime(2019, 3, 6, 2, 0), "d1", "powerStatus", "off", "bedroom"),
        (dt.datetime(2019, 3, 6, 2, 2), "d2", S.PRESENCE, "on", "sleep"),
        (dt.datetime(2019, 3, 6, 2, 2), "d1", "x", "293.15", "bedroom"),
    ]


def test_pairing_is_by_position_in_the_whole_document(spark):
    body = zone("d", "a") + change("d", "p1") + change("d", "p2") + delay(1, "h") + delay(1, "h") + delay(1, "h")
    got = [(t, p) for t, _, p, _, _ in events(docs(spark, doc(body)))]
    assert got == [(dt.datetime(2019, 3, 5, 18, 0), "p1"), (dt.datetime(2019, 3, 5, 19, 0), "p2")]


def test_other_unit(spark):
    df = docs(spark, doc(zone("d", "a") + delay(5, "s") + change("d")))
    assert events(df)[0][0] == dt.datetime(2019, 3, 5, 17, 0, 5)
    assert events(df, legacy_other_unit=True)[0][0] == dt.datetime(2019, 3, 5, 17, 5, 5)


def test_fewer_delays_than_changes(spark):
    good = doc(zone("d", "a") + delay(1, "m") + change("d"))
    df = docs(spark, doc(delay(1, "m") + change("d") + change("d")), good)
    assert reasons(df) == {"f0": "fewer delays than changes"}
    assert len(events(df)) == 1


def test_unusable_documents(spark):
    df = docs(
        spark,
        "<behavior><delay",
        doc(delay(1, "m"), start='<behavior startdate="2022-07-01">'),
        doc(delay("one", "m")),
        doc(delay(1, "m")) + "and more",
        "<other/>",
        doc("<group>" + delay(1, "m") + change("d")),
    )
    assert reasons(df) == {
        "f0": "not XML",
        "f1": "bad start date",
        "f2": "bad delay",
        "f3": "not XML",
        "f4": "no behaviour",
        "f5": "not XML",
    }
    assert events(df) == []


def test_text_is_taken_as_it_is(spark):
    body = zone("d&amp;1", " hall ") + "<![CDATA[" + delay(5, "h") + "]]>" + delay(1, "m") + change("d&amp;1", "p", " on ")
    assert events(docs(spark, doc(body))) == [(dt.datetime(2019, 3, 5, 17, 1), "d&1", "p", " on ", " hall ")]


def test_marks_are_quoted_in_written_documents(spark):
    df = readings(spark, [("h", 60, 'a"b', "p<q", "1 & 2", "x")])
    got = B.behaviour_events(documents.to_documents(df), documents.KEYS).first()
    assert (got.id_device, got.property_device, got.value_property_device) == ('a"b', "p<q", "1 & 2")


def test_missing_attribute_is_empty_text_or_a_reason(spark):
    df = docs(spark, doc(zone("d", "a") + '<delay value="3"/>' + '<set-device-property deviceId="d" value="true"/>'))
    assert events(df) == [(dt.datetime(2019, 3, 5, 17, 0, 3), "d", "", "on", "a")]
    assert reasons(df, strict=True) == {"f0": "missing attribute"}


def test_devices_without_and_with_two_zones(spark):
    body = zone("d2", "first") + zone("d2", "second") + delay(1, "m") + change("d1") + delay(1, "m") + change("d2")
    df = docs(spark, doc(body))
    assert [(d, a) for _, d, _, _, a in events(df)] == [("d1", None), ("d2", "first")]
    changes = B.paired_changes(B.parse_documents(df, ["file"]), ["file"])
    odd = {(r.id_device, r.extra, r.reason) for r in B.zone_conflicts(changes).collect()}
    assert odd == {("d1", None, "no zone"), ("d2", "second", "second zone")}


def test_document_files_pass_the_gate(spark, tmp_path):
    body = doc(zone("d", "a") + delay(1, "m") + change("d"))
    (tmp_path / "a.bhv").write_text(body + "\n" + " " * 600)
    (tmp_path / "b.bhv.COMPLETED").write_text(body + "\n" + " " * 600)
    (tmp_path / "c.bhv").write_text(body)
    got = B.behaviour_events(B.read_documents(spark, str(tmp_path)), ["file"])
    assert [r.file.rsplit("/", 1)[1] for r in got.collect()] == ["a.bhv"]


def test_elements_at_any_depth(spark):
    # Groups, groups in groups, an element with an end tag, and one in a comment; order is the document's.
    body = (
        "<day>" + zone("d&gt;1", "hall") + "<morning part='a>b'>" + delay(1, "m") + change("d&gt;1", "p1") + "</morning>"
        "<!-- " + delay(9, "h") + " --></day>"
        '<delay value="2" unit="m"></delay><rest>' + change("d&gt;1", "p2", " on ") + "</rest>"
    )
    assert events(docs(spark, doc(body))) == [
        (dt.datetime(2019, 3, 5, 17, 1), "d>1", "p1", "on", "hall"),
        (dt.datetime(2019, 3, 5, 17, 3), "d>1", "p2", " on ", "hall"),
    ]


@pytest.mark.parametrize("zone_name", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone_name):
    from roomtrace.operators.movement import movements
    from roomtrace.operators.ordering import positions
    from roomtrace.operators.visits import visits

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone_name)
    try:
        # 02:30 does not exist in New York on that day.
        text_lines = ["2022-03-13 02:30:00,d,sensedPresence,on,toilet", "2022-03-13 03:30:00,d,sensedPresence,off,toilet"]
        text_lines.append("2022-03-13 03:10:00,d,sensedPresence,on,sleep")
        df = lines.parse_lines(text(spark, text_lines)).selectExpr("'h' AS house_id", "*")
        assert [(str(r.entry_ts), str(r.exit_ts)) for r in visits(df).collect()] == [("2022-03-13 02:30:00", "2022-03-13 03:30:00")]
        assert [(str(r.from_ts), r.to_area) for r in movements(df).collect()] == [("2022-03-13 02:30:00", "sleep")]
        assert [r.n for r in positions(df, ["house_id"]).orderBy("event_id").collect()] == [1, 3, 2]
        body = zone("d", "a") + delay(1, "h") + change("d") + delay(1, "h") + change("d")
        got = events(docs(spark, doc(body, '<behavior startdate="13/03/2022-01:30:00">')))
        assert [str(r[0]) for r in got] == ["2022-03-13 02:30:00", "2022-03-13 03:30:00"]
        back = B.behaviour_events(documents.to_documents(df), documents.KEYS)
        assert sorted(str(r.event_ts) for r in back.collect()) == sorted(x.split(",")[0] for x in text_lines)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("limits", [None, Limits(7, 100)])
def test_written_documents_parse_back(spark, limits):
    df = table(spark, random_rows(seed=23, n=300, houses=2, span=4000))
    written = documents.to_documents(df, changes=16, limits=limits)
    assert written.count() >= 300 // 16
    got = B.paired_changes(B.parse_documents(written, documents.KEYS), documents.KEYS)
    want = df.select("house_id", "event_ts", "id_device", "property_device", "value_property_device")
    assert rows_of(got.select(*want.columns)) == rows_of(want)


# --- input files ----------------------------------------------------------


def test_gate(spark, tmp_path):
    for name, size in [
        ("small.bhv", 524),
        ("enough.bhv", 525),
        ("done.bhv.COMPLETED", 900),
        ("done.COMPLETED.bhv", 900),
        ("COMPLETED_house.bhv", 900),
        (".hidden", 900),
    ]:
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "folder").mkdir()
    got = files.accepted_files(files.list_files(spark, str(tmp_path)))
    assert {r.name for r in got.collect()} == {"enough.bhv", "COMPLETED_house.bhv"}
    assert len(list(tmp_path.iterdir())) == 7


def test_reading_as_a_line(spark):
    df = readings(spark, [("h", 3, "d", "p", "on", "a")])
    assert df.select(lines.line_text().alias("t")).first().t == f"{at(3):%Y-%m-%d %H:%M:%S},d,p,on,a"


@pytest.mark.parametrize(
    "tag",
    [
        "<delay" + " " * 100_000 + 'value="1" unit="h"/>',
        "<delay " + " ".join(f'a{i}="x"' for i in range(150)) + ' value="1" unit="h"/>',
        '<delay note="' + "a > b " * 20_000 + '" value="1" unit="h"/>',
    ],
)
def test_huge_tags_in_nested_documents(spark, tag):
    body = f"<home>{zone('d', 'a')}{tag}{change('d')}</home>"
    assert [e[0] for e in events(docs(spark, doc(body)))] == [dt.datetime(2019, 3, 5, 18, 0)]


def test_more_attributes_than_the_xml_parser_takes_are_a_reason(spark):
    tag = "<delay " + " ".join(f'a{i}="x"' for i in range(100_000)) + "/>"
    assert reasons(docs(spark, doc(f"<home>{zone('d', 'a')}{tag}</home>"))) == {"f0": "not XML"}


def test_a_huge_open_tag_is_a_reason(spark):
    df = docs(spark, doc("<home>" + zone("d", "a") + "</home>").replace("</behavior>", "<delay " + "a='b' " * 100_000))
    assert reasons(df) == {"f0": "not XML"}


def test_many_devices_with_zones_in_any_order(spark):
    import random

    rnd = random.Random(4)
    names = [f"d{rnd.randrange(30)}" for _ in range(200)]
    body = "".join(zone(d, f"z{i}") for i, d in enumerate(names)) + "".join(delay(1, "m") + change(f"d{i}") for i in range(32))
    changes = B.paired_changes(B.parse_documents(docs(spark, doc(body)), ["file"]), ["file"])
    for r in changes.collect():
        assert r.zones == [f"z{i}" for i, d in enumerate(names) if d == r.id_device]
