from __future__ import annotations

from helpers import presence, readings
from roomtrace import schema as S
from roomtrace.operators import reports
from roomtrace.operators.counts import area_activity, report_counts, status_counts
from roomtrace.operators.movement import movements
from roomtrace.operators.visits import visits

RUN = "2021-01-09 10:20:30.5"


def test_status_and_value_lines(spark):
    df = readings(spark, [("h", 1, "d", S.POWER, "on", "bedroom"), ("h", 1, "d", S.TEMPERATURE, "250", "kitchen")])
    got = {r.label: r.line for r in reports.report_lines(report_counts(df), RUN).collect()}
    assert got["R01"] == f"[{RUN}] - Count status device property: powerStatus -on- in area bedroom : 1 "
    assert got["R16"] == (
        f"[{RUN}] - Count value property: thermometer.currentTemperature device on in area kitchen : 1 "
    )
    assert len(got) == 30


def test_total_lines(spark):
    df = presence(spark, [("h", 1, "d", "on", "washbasin")])
    got = {r.line for r in reports.report_lines(report_counts(df), RUN).collect()}
    assert f"[{RUN}] - Activity in bathroom presence sensor washbasin: 1 " in got
    assert f"[{RUN}] - Activity in bathroom presence sensor toilet: 0 " in got


def test_report_counts_are_the_single_counts(spark):
    df = readings(
        spark,
        [("h", 1, "d", p, v, a) for p in (S.POWER, S.PRESENCE, S.DOOR) for v in ("on", "off") for a in ("bedroom", "kitchen", "wardrobe")],
    )
    got = {r.label: r.n for r in report_counts(df).collect()}
    want = {r.rule_id: r.n for r in status_counts(df).collect()}
    want |= {r.metric: r.n for r in area_activity(df).collect()}
    assert got == want


def test_movement_line(spark):
    df = presence(spark, [("h", 1, "d", "on", "sleep"), ("h", 2, "d", "on", "toilet")])
    assert [r.line for r in reports.movement_lines(movements(df)).collect()] == [
        "Se detecta movimiento, cambios de zona desde zona 1: sleep a zona 2: toilet "
    ]


def test_visit_lines(spark):
    df = presence(spark, [("h", 2, "d", "on", "toilet"), ("h", 32, "d", "off", "toilet"), ("h", 3, "d", "on", "x"), ("h", 4, "d", "off", "x")])
    got = reports.visit_lines(visits(df)).orderBy("line_no").collect()
    assert [r.line for r in got] == [
        "Se detecta el uso del baño: Row(dateTime='2019-03-05 00:32:00', idDevice='d', area='toilet', "
        "propertiesMap={'propertyDevice': 'sensedPresence', 'valuePropertyDevice': 'off'}) ",
        "Tiempo entrada: 2019-03-05 00:02:00 , tiempo salida: 2019-03-05 00:32:00 ",
    ]


def test_lines_are_appended_in_order(spark, tmp_path):
    df = presence(spark, [("h", i, "d", "on", "sleep" if i % 2 else "toilet") for i in range(40)])
    lines = reports.movement_lines(movements(df))
    path = str(tmp_path / "report")
    reports.append_lines(lines, path, ["from_ts", "from_area", "event_id"])
    reports.append_lines(lines, path, ["from_ts", "from_area", "event_id"])
    assert spark.read.text(path).count() == 2 * 39
