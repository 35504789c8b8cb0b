"""The same questions in plain SQL over the event table."""

from __future__ import annotations

from roomtrace.plans.rules import STATUS_RULES, TOTAL_RULES

RUN_TS = "2024-02-01 00:00:00"
DOC_CHANGES = 32

# Readings as the event table stands for them.
READINGS = """
b AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
  FROM events
), d AS (
  SELECT event_id, user_id AS house_id, ts AS event_ts, concat('dev-', CAST(k AS VARCHAR)) AS id_device,
    CASE WHEN event_type IN ('view', 'click') THEN 'sensedPresence'
         WHEN event_type = 'purchase' THEN 'powerStatus'
         WHEN event_type = 'signup' THEN 'doorWindowSensor.opneningDetection'
         WHEN k % 4 = 0 THEN 'thermometer.currentTemperature'
         WHEN k % 4 = 1 THEN 'carbonDioxydeSensor.currentConcentration'
         WHEN k % 4 = 2 THEN 'carbonMonoxydeSensor.currentConcentration'
         ELSE 'flood.alarm' END AS property_device,
    CASE WHEN event_type = 'error' AND k % 4 <> 3 THEN CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR)
         WHEN value >= 35.0 THEN 'on' ELSE 'off' END AS value_property_device,
    CASE k % 13 WHEN 0 THEN 'bedroom' WHEN 1 THEN 'sleep' WHEN 2 THEN 'wardrobe' WHEN 3 THEN 'chair_bedroom'
         WHEN 4 THEN 'bathroom' WHEN 5 THEN 'toilet' WHEN 6 THEN 'washbasin' WHEN 7 THEN 'kitchen'
         WHEN 8 THEN 'chair_kitchen' WHEN 9 THEN 'livingroom' WHEN 10 THEN 'armchair' ELSE 'hallway' END AS area
  FROM b
), p AS (
  SELECT * FROM d WHERE property_device = 'sensedPresence'
)"""

ALL = "event_id, house_id, event_ts, id_device, property_device, value_property_device, area"
SECOND = "date_trunc('second', event_ts)"
LINE_TIME = "'%Y-%m-%d %H:%M:%S'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


STATUS = f"""
r(rule_id, group_name, property_device, test, operand, area) AS (VALUES {_values(STATUS_RULES)}),
s AS (
  SELECT r.rule_id, r.group_name, r.property_device, r.test, r.area, count(d.event_id) AS n
  FROM r LEFT JOIN d ON d.property_device = r.property_device AND d.area = r.area
    AND CASE WHEN r.test = '=' THEN d.value_property_device = r.operand
             ELSE TRY_CAST(d.value_property_device AS DOUBLE) > CAST(r.operand AS DOUBLE) END
  GROUP BY ALL
)"""

TOTALS = f"""
t(metric, group_name, property_device, operand, area) AS (VALUES {_values(TOTAL_RULES)}),
a AS (
  SELECT t.group_name, t.metric, count(d.event_id) AS n
  FROM t LEFT JOIN d ON d.property_device = t.property_device AND d.area = t.area
    AND d.value_property_device = t.operand
  GROUP BY ALL
)"""

MOVES = """
m AS (
  SELECT x.house_id, x.event_id, x.area AS from_area, y.area AS to_area, x.event_ts AS from_ts, y.event_ts AS to_ts
  FROM p x JOIN p y ON x.house_id = y.house_id AND y.area <> x.area AND y.event_ts > x.event_ts
  WHERE x.value_property_device = 'on' AND y.value_property_device = 'on'
  QUALIFY row_number() OVER (PARTITION BY x.event_id ORDER BY y.event_ts, y.area) = 1
)"""

VISITS = """
v AS (
  SELECT x.house_id, x.area, x.event_id, x.event_ts AS entry_ts, y.event_ts AS exit_ts, y.id_device AS exit_device
  FROM p x JOIN p y ON x.house_id = y.house_id AND y.area = x.area AND y.event_ts > x.event_ts
  WHERE x.value_property_device = 'on' AND y.value_property_device = 'off'
  QUALIFY row_number() OVER (PARTITION BY x.event_id ORDER BY y.event_ts, y.id_device, y.event_id) = 1
)"""


def _documents(area: str, changes: int = DOC_CHANGES) -> str:
    """Readings numbered in their documents: doc_no, pos, time in seconds and zone."""
    return f"""
e AS (
  SELECT *, {SECOND} AS sec_ts, {area} AS zone,
    row_number() OVER (PARTITION BY house_id ORDER BY {SECOND}, event_id) - 1 AS place
  FROM d
), f AS (
  SELECT *, place // {changes} AS doc_no, CAST(place % {changes} AS INT) AS pos FROM e
), g AS (
  SELECT *,
    CAST(epoch(sec_ts) AS BIGINT) - CAST(epoch(first_value(date_trunc('hour', sec_ts)) OVER w) AS BIGINT) AS elapsed,
    CAST(epoch(sec_ts) AS BIGINT) - CAST(epoch(coalesce(lag(sec_ts) OVER w, date_trunc('hour', sec_ts))) AS BIGINT) AS delay
  FROM f WINDOW w AS (PARTITION BY house_id, doc_no ORDER BY pos)
)"""


DOCUMENTS = _documents("area")
TWO_ZONES = _documents(
    "CASE WHEN area = 'kitchen' AND property_device = 'powerStatus' THEN 'pantry' "
    "WHEN area <> 'hallway' THEN area END"
)


ZONE_LISTS = """
zones AS (
  SELECT house_id, doc_no, id_device, zone, min(pos) AS first_pos
  FROM f WHERE zone IS NOT NULL GROUP BY ALL
), nth AS (
  SELECT *, row_number() OVER (PARTITION BY house_id, doc_no, id_device ORDER BY first_pos) AS i FROM zones
)"""


def _sql(body: str, *views: str) -> str:
    return f"WITH {', '.join([READINGS, *views])}\n{body}"


def _rules(where: str) -> str:
    return _sql(f"SELECT rule_id, group_name, property_device, area, n FROM s WHERE {where}", STATUS)


def _activity(group: str) -> str:
    return _sql(f"SELECT group_name, metric, n FROM a WHERE group_name = '{group}'", TOTALS)


def _visits(where: str) -> str:
    return _sql(f"SELECT * FROM v WHERE {where}", VISITS)


REPORT = f"""
SELECT group_name, rule_id AS label,
  CASE WHEN test = '='
    THEN printf('[{RUN_TS}] - Count status device property: %s -on- in area %s : %d ', property_device, area, n)
    ELSE printf('[{RUN_TS}] - Count value property: %s device on in area %s : %d ', property_device, area, n)
  END AS line
FROM s
UNION ALL
SELECT group_name, metric, printf('[{RUN_TS}] - %s: %d ', metric, n) FROM a"""

ORACLE: dict[str, str] = {
    "scan_device_events": _sql(f"SELECT {ALL} FROM d"),
    "parse_device_line": _sql(
        f"SELECT event_id, {SECOND} AS event_ts, id_device, property_device, value_property_device, area FROM d"
    ),
    "malformed_lines": _sql(
        """SELECT event_id,
             CASE WHEN property_device = 'flood.alarm'
               THEN concat_ws(',', id_device, property_device, value_property_device)
               ELSE concat_ws(',', 'n/a', id_device, property_device, value_property_device, area) END AS value,
             CASE WHEN property_device = 'flood.alarm' THEN 'short line' ELSE 'bad time' END AS reason
           FROM d WHERE property_device IN ('flood.alarm', 'thermometer.currentTemperature')"""
    ),
    "properties_map": _sql("SELECT event_id, area, property_device, value_property_device FROM d"),
    "normalise_value": _sql(
        """SELECT event_id,
             CASE WHEN value_property_device = 'on' THEN 'true'
                  WHEN value_property_device = 'off' AND property_device <> 'doorWindowSensor.opneningDetection'
                  THEN 'false' ELSE value_property_device END AS raw,
             value_property_device AS value
           FROM d"""
    ),
    "parse_start_ts": _sql(
        f"SELECT event_id, strftime(event_ts, '%d/%m/%Y-%H:%M:%S') AS start_text, {SECOND} AS start_ts FROM d"
    ),
    "delay_seconds": _sql(
        """SELECT event_id, amount, unit,
             amount * CASE unit WHEN 'h' THEN 3600 WHEN 'm' THEN 60 ELSE 1 END AS seconds,
             amount * CASE unit WHEN 'h' THEN 3600 WHEN 'm' THEN 60 ELSE 61 END AS legacy_seconds
           FROM (SELECT event_id, CAST(substr(id_device, 5) AS BIGINT) AS amount,
                   CASE property_device WHEN 'powerStatus' THEN 'h' WHEN 'sensedPresence' THEN 'm' ELSE 's' END AS unit
                 FROM d)"""
    ),
    "delay_prefix_sum": _sql("SELECT house_id, doc_no, pos, delay, elapsed, sec_ts AS at_ts FROM g", DOCUMENTS),
    "positional_join": _sql(
        """SELECT house_id, doc_no, pos, delay, elapsed, id_device, property_device, value_property_device FROM g""",
        DOCUMENTS,
    ),
    "device_zone_join": _sql(
        """SELECT house_id, doc_no, pos, id_device,
             first_value(zone) OVER (PARTITION BY house_id, doc_no, id_device ORDER BY zone IS NULL, pos) AS area
           FROM f""",
        TWO_ZONES,
    ),
    "zone_conflicts": _sql(
        """SELECT f.house_id, f.doc_no, f.pos, f.id_device, CAST(NULL AS VARCHAR) AS extra, 'no zone' AS reason
           FROM f WHERE NOT EXISTS (SELECT 1 FROM zones z WHERE z.house_id = f.house_id AND z.doc_no = f.doc_no
                                    AND z.id_device = f.id_device)
           UNION ALL
           SELECT f.house_id, f.doc_no, f.pos, f.id_device, nth.zone, 'second zone'
           FROM f JOIN nth ON nth.house_id = f.house_id AND nth.doc_no = f.doc_no AND nth.id_device = f.id_device
           WHERE nth.i > 1""",
        TWO_ZONES,
        ZONE_LISTS,
    ),
    "behaviour_to_events": _sql(
        """SELECT house_id, doc_no, pos, sec_ts AS event_ts, id_device, property_device, value_property_device, area
           FROM g""",
        DOCUMENTS,
    ),
    "csv_roundtrip": _sql(
        f"""SELECT event_id, house_id, {SECOND} AS event_ts, id_device, property_device, value_property_device, area
            FROM d"""
    ),
    "presence_on_rows": _sql(f"SELECT {ALL} FROM p WHERE value_property_device = 'on' AND area = 'kitchen'"),
    "value_alarm_rows": _sql(
        f"""SELECT {ALL} FROM d WHERE property_device = 'thermometer.currentTemperature' AND area = 'kitchen'
            AND TRY_CAST(value_property_device AS DOUBLE) > 200"""
    ),
    "status_count": _rules("test = '='"),
    "value_alarm_count": _rules("test = '>'"),
    "rule_counts": _rules("true"),
    "area_activity_bedroom": _activity("bedroom"),
    "area_activity_bathroom": _activity("bathroom"),
    "area_activity_kitchen": _activity("kitchen"),
    "area_activity_livingroom": _activity("livingroom"),
    "presence_count": _sql(
        """SELECT concat_ws('-', area, property_device, value_property_device) AS key, count(*) AS n
           FROM p WHERE value_property_device = 'on' GROUP BY ALL"""
    ),
    "running_presence_count": _sql(
        """SELECT concat_ws('-', area, property_device, value_property_device) AS key, event_id,
             row_number() OVER (PARTITION BY area ORDER BY event_ts, event_id) AS n
           FROM p WHERE value_property_device = 'on'"""
    ),
    "movement_transitions": _sql("SELECT * FROM m", MOVES),
    "visits_all": _visits("true"),
    "visits_toilet": _visits("area = 'toilet'"),
    "visits_washbasin": _visits("area = 'washbasin'"),
    "visits_kitchen": _visits("area = 'kitchen'"),
    "visits_eating": _visits("area = 'chair_kitchen'"),
    "visits_livingroom": _visits("area = 'armchair'"),
    "sorted_events": _sql(
        f"""SELECT {ALL}, row_number() OVER (PARTITION BY house_id ORDER BY event_ts, area, event_id) AS rn
            FROM d ORDER BY event_ts, area, event_id"""
    ),
    "first_event": _sql(f"SELECT {ALL} FROM d ORDER BY event_ts, area, event_id LIMIT 1"),
    "report_lines": _sql(f"SELECT group_name, label, line FROM ({REPORT})", STATUS, TOTALS),
    "movement_lines": _sql(
        """SELECT house_id, event_id, from_ts, from_area,
             printf('Se detecta movimiento, cambios de zona desde zona 1: %s a zona 2: %s ', from_area, to_area) AS line
           FROM m""",
        MOVES,
    ),
    "visit_lines": _sql(
        f"""SELECT house_id, area, event_id, entry_ts, 1 AS line_no,
              concat('Se detecta el uso ',
                CASE area WHEN 'toilet' THEN 'del baño' WHEN 'washbasin' THEN 'del lavabo'
                  WHEN 'kitchen' THEN 'de la cocina' WHEN 'chair_kitchen' THEN 'de la mesa de la cocina'
                  ELSE 'de la sala de estar' END,
                ': Row(dateTime=''', strftime(exit_ts, {LINE_TIME}), ''', idDevice=''', exit_device, ''', area=''', area,
                ''', propertiesMap={{''propertyDevice'': ''sensedPresence'', ''valuePropertyDevice'': ''off''}}) ') AS line
            FROM v WHERE area IN ('toilet', 'washbasin', 'kitchen', 'chair_kitchen', 'armchair')
            UNION ALL
            SELECT house_id, area, event_id, entry_ts, 2,
              concat('Tiempo entrada: ', strftime(entry_ts, {LINE_TIME}), ' , tiempo salida: ',
                strftime(exit_ts, {LINE_TIME}), ' ')
            FROM v WHERE area IN ('toilet', 'washbasin', 'kitchen', 'chair_kitchen', 'armchair')""",
        VISITS,
    ),
    "land_stream": _sql(f"SELECT {SECOND} AS event_ts, id_device, property_device, value_property_device, area FROM d"),
    "stream_status_count": _sql(
        "SELECT CAST(0 AS BIGINT) AS batch_id, rule_id, group_name, property_device, area, n FROM s", STATUS
    ),
    "stream_area_activity": _sql("SELECT CAST(0 AS BIGINT) AS batch_id, group_name, metric, n FROM a", TOTALS),
    "stream_report_lines": _sql(f"SELECT CAST(0 AS BIGINT) AS batch_id, line FROM ({REPORT})", STATUS, TOTALS),
    "stream_visits": _sql("SELECT CAST(0 AS BIGINT) AS batch_id, * FROM v", VISITS),
    "stream_movement": _sql("SELECT CAST(0 AS BIGINT) AS batch_id, * FROM m", MOVES),
}
ORACLE["stream_running_presence"] = ORACLE["presence_count"]
ORACLE["running_presence_split"] = ORACLE["running_presence_count"]
ORACLE["movement_split"] = ORACLE["movement_transitions"]
ORACLE["visits_split"] = ORACLE["visits_all"]
ORACLE["stream_visits_across"] = ORACLE["visits_all"]
ORACLE["stream_movement_across"] = ORACLE["movement_transitions"]
ORACLE["stream_running_readings"] = ORACLE["running_presence_count"]

ORACLE["nested_documents"] = _sql(
    """SELECT house_id, doc_no, pos, sec_ts AS event_ts, id_device, property_device, value_property_device, area
       FROM g""",
    _documents("area", 200),
)
ORACLE["stream_visits_by_join"] = _sql("SELECT * FROM v WHERE exit_ts <= entry_ts + INTERVAL 3 DAY", VISITS)
ORACLE["value_rules_table"] = _sql(
    """SELECT r.rule_id, r.property_device, r.area, r.threshold, count(d.event_id) AS n FROM (
         SELECT event_id AS rule_id, area, CAST(event_id % 100000 AS DOUBLE) / 200 AS threshold,
           CASE event_id % 3 WHEN 0 THEN 'thermometer.currentTemperature' WHEN 1 THEN 'carbonDioxydeSensor.currentConcentration'
             ELSE 'carbonMonoxydeSensor.currentConcentration' END AS property_device
         FROM d) r
       LEFT JOIN d ON d.property_device = r.property_device AND d.area = r.area
         AND TRY_CAST(d.value_property_device AS DOUBLE) > r.threshold
       GROUP BY ALL"""
)
ORACLE["global_position"] = _sql("SELECT event_id, event_ts, area, row_number() OVER (ORDER BY event_ts, area, event_id) AS rn FROM d")
ORACLE["global_position_split"] = ORACLE["global_position"]
ORACLE["ledger_scripts"] = _sql(
    """SELECT house_id, doc_no, CASE WHEN house_id % 2 = 0 THEN 'first' ELSE 'second' END AS folder, pos, sec_ts AS event_ts,
         id_device, property_device, value_property_device, area
       FROM g""",
    DOCUMENTS,
)
ORACLE["stream_committed_batches"] = _sql("SELECT event_id FROM d")
ORACLE["dead_letters"] = _sql(
    """SELECT concat('home-', CAST(house_id AS VARCHAR)) AS file, CASE WHEN house_id <> 7 THEN count(*) END AS n, house_id = 7 AS dead
       FROM d GROUP BY house_id"""
)
ORACLE["stream_repeated_rows"] = _sql(f"SELECT DISTINCT {ALL} FROM d")
ORACLE["large_scripts"] = _sql(
    """SELECT house_id, doc_no, pos, sec_ts AS event_ts, id_device, property_device, value_property_device, area
       FROM g""",
    _documents("area", 100_000),
)
ORACLE["rule_counts_of_lines"] = _sql(
    "SELECT rule_id, group_name, property_device, area, n FROM s",
    STATUS.replace("LEFT JOIN d ON", "LEFT JOIN (SELECT * FROM d WHERE property_device <> 'flood.alarm') d ON"),
)

# Readings of two sources per house, cut to seconds.
HOMES = f"""
q AS (
  SELECT event_id, concat('home-', CAST(house_id AS VARCHAR), CASE WHEN event_id % 2 = 0 THEN '/a' ELSE '/b' END) AS house_id,
    {SECOND} AS event_ts, id_device, value_property_device, area
  FROM p
)"""
ORACLE["pipeline_movements"] = _sql("SELECT * FROM m", HOMES, MOVES.replace("FROM p x JOIN p y", "FROM q x JOIN q y"))
ORACLE["pipeline_visits"] = _sql("SELECT * FROM v", HOMES, VISITS.replace("FROM p x JOIN p y", "FROM q x JOIN q y"))

LISTING = """
SELECT concat(CASE WHEN doc_id % 5 = 1 THEN 'COMPLETED_' ELSE '' END, source, '_', CAST(doc_id AS VARCHAR),
    CASE doc_id % 5 WHEN 2 THEN '.bhv.COMPLETED' WHEN 3 THEN '.COMPLETED.bhv' ELSE '.bhv' END) AS name,
  CAST(strlen(text) AS BIGINT) AS length, doc_id % 5 IN (2, 3) AS done
FROM documents"""
ORACLE["file_gate"] = f"SELECT name, length FROM ({LISTING}) WHERE NOT done AND length >= 525"
ORACLE["refused_files"] = f"""SELECT name, length, CASE WHEN done THEN 'done' ELSE 'too small' END AS reason
FROM ({LISTING}) WHERE done OR length < 525"""
