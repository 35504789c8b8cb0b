"""One query per operator, over the event table read as device readings.

Text lines, XML documents and file streams are derived from that table inside
the query, so each grows with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roomtrace import schema as S
from roomtrace.functions import expressions as E
from roomtrace.operators import counts, ordering, reports, thresholds
from roomtrace.operators.splitting import Limits
from roomtrace.operators.movement import movements
from roomtrace.operators.visits import VISIT_AREAS, visits
from roomtrace.plans.rules import STATUS_RULES
from roomtrace.session import use_utc, work_dir
from roomtrace.sources import behaviour, files, large, lines
from roomtrace.sources.documents import KEYS as DOC_KEYS, to_documents
from roomtrace.sources.tables import as_device_events, device_events
from roomtrace.streaming import jobs, ledger, ordered, totals

RUN_TS = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]

FIELDS = ["event_id", "house_id", *S.LINE_FIELDS]


def on_readings(
    job: Callable[[DataFrame], DataFrame], properties: list[str] | None = None, reading: str | None = None
) -> Query:
    return lambda spark, sf_dir: job(device_events(use_utc(spark), sf_dir, properties, reading))


def on_presence(job: Callable[[DataFrame], DataFrame], reading: str | None = None) -> Query:
    return on_readings(job, [S.PRESENCE], reading)


# --- lines ---------------------------------------------------------------


def _sent_lines(d: DataFrame) -> DataFrame:
    """Device lines in which doors send a sixth field and lights a second line."""
    text = F.concat(
        lines.line_text(),
        F.when(F.col("property_device") == S.DOOR, ",battery").otherwise(""),
        F.when(F.col("property_device") == S.POWER, "\nend of message").otherwise(""),
    )
    return _as_value(d, text)


def _as_value(d: DataFrame, text: Column) -> DataFrame:
    # The explode keeps filters on the text above it, so that it is built once.
    return d.select("event_id", F.explode(F.array(text)).alias("value"))


def _broken_lines(d: DataFrame) -> DataFrame:
    """Device lines in which flood sensors leave out time and area and thermometers the time."""
    short = F.concat_ws(",", "id_device", "property_device", "value_property_device")
    no_time = F.concat_ws(",", F.lit("n/a"), "id_device", "property_device", "value_property_device", "area")
    text = (
        F.when(F.col("property_device") == S.FLOOD, short)
        .when(F.col("property_device") == S.TEMPERATURE, no_time)
        .otherwise(lines.line_text())
    )
    return _as_value(d, text)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(use_utc(spark), "csv")
    lines.write_csv(device_events(spark, sf_dir), path)
    return lines.read_csv(spark, path, house_type="bigint")


# --- scalar functions ----------------------------------------------------


def _properties_map(d: DataFrame) -> DataFrame:
    m = d.select(
        "event_id", "area", E.properties_map(F.col("property_device"), F.col("value_property_device")).alias("m")
    )
    return m.select(
        "event_id",
        "area",
        F.col("m").getItem("propertyDevice").alias("property_device"),
        F.col("m").getItem("valuePropertyDevice").alias("value_property_device"),
    )


def _normalise_value(d: DataFrame) -> DataFrame:
    v = F.col("value_property_device")
    raw = F.when(v == S.ON, "true").when((v == S.OFF) & (F.col("property_device") != S.DOOR), "false").otherwise(v)
    return d.select("event_id", raw.alias("raw")).select("event_id", "raw", E.normalise_value(F.col("raw")).alias("value"))


def _parse_start_ts(d: DataFrame) -> DataFrame:
    text = d.select("event_id", E.start_time(F.col("event_ts")).alias("start_text"))
    return text.select("event_id", "start_text", E.parse_start_ts(F.col("start_text")).alias("start_ts"))


def _delay_seconds(d: DataFrame) -> DataFrame:
    amount = F.regexp_extract("id_device", "([0-9]+)", 1).cast("bigint")
    unit = F.when(F.col("property_device") == S.POWER, "h").when(F.col("property_device") == S.PRESENCE, "m")
    delays = d.select("event_id", amount.alias("amount"), unit.otherwise("s").alias("unit"))
    return delays.select(
        "event_id",
        "amount",
        "unit",
        E.delay_seconds(F.col("amount"), F.col("unit")).alias("seconds"),
        E.delay_seconds(F.col("amount"), F.col("unit"), legacy_other_unit=True).alias("legacy_seconds"),
    )


# --- behaviour documents -------------------------------------------------


def _documents(d: DataFrame) -> DataFrame:
    return behaviour.parse_documents(to_documents(d), DOC_KEYS)


def _delay_prefix_sum(d: DataFrame) -> DataFrame:
    return behaviour.delay_list(_documents(d), DOC_KEYS)


def _positional_join(d: DataFrame) -> DataFrame:
    return behaviour.paired_changes(_documents(d), DOC_KEYS).drop("zones", "event_ts")


def _two_zones(d: DataFrame) -> DataFrame:
    """Readings in which hallway devices have no zone and kitchen devices a second one for their light."""
    area = F.when(
        (F.col("area") == "kitchen") & (F.col("property_device") == S.POWER), "pantry"
    ).when(F.col("area") != "hallway", F.col("area"))
    return d.withColumn("area", area)


def _device_zone_join(d: DataFrame) -> DataFrame:
    changes = behaviour.paired_changes(_documents(_two_zones(d)), DOC_KEYS)
    return behaviour.with_area(changes).select(*DOC_KEYS, "pos", "id_device", "area")


def _zone_conflicts(d: DataFrame) -> DataFrame:
    changes = behaviour.paired_changes(_documents(_two_zones(d)), DOC_KEYS)
    return behaviour.zone_conflicts(changes).select(*DOC_KEYS, "pos", "id_device", "extra", "reason")


def _behaviour_to_events(d: DataFrame) -> DataFrame:
    return behaviour.behaviour_events(to_documents(d), DOC_KEYS)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of files, one per document; some are marked as done, some have the mark in their stem."""
    mark = F.col("doc_id") % 5
    name = F.concat(
        F.when(mark == 1, "COMPLETED_").otherwise(""),
        F.concat_ws("_", "source", F.col("doc_id").cast("string")),
        F.when(mark == 2, ".bhv.COMPLETED").when(mark == 3, ".COMPLETED.bhv").otherwise(".bhv"),
    )
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(name.alias("name"), F.octet_length("text").cast("bigint").alias("length"))


def _file_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.accepted_files(_listing(spark, sf_dir)).select("name", "length")


def _refused_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.refused_files(_listing(spark, sf_dir)).select("name", "length", "reason")


def _nested_documents(d: DataFrame) -> DataFrame:
    """Documents of up to 200 changes whose elements lie in groups of groups."""
    grouped = to_documents(d, changes=200).withColumn(
        "value",
        F.regexp_replace(
            F.regexp_replace("value", r"(?s)(<behavior[^>]*>)(.*)(</behavior>)", "$1<home><part>$2</part></home>$3"),
            r"(<set-device-property[^>]*/>)\n",
            "$1</part><part>\n",
        ),
    )
    return behaviour.behaviour_events(grouped, DOC_KEYS)


#: Changes of a script that is read in splits; a house gets as many scripts as it needs.
LARGE_CHANGES = 100_000


def _large_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Script files of whole houses, read in splits.

    The root names the house, so that all files may lie in one folder: a folder for each takes longer to make and to list than to read.
    """
    path = work_dir(use_utc(spark), "large-scripts")
    scripts = to_documents(device_events(spark, sf_dir), changes=LARGE_CHANGES)
    root = F.concat(F.lit('<behavior id="'), F.concat_ws("/", *[F.col(k).cast("string") for k in DOC_KEYS]), F.lit('" '))
    named = F.replace("value", F.lit("<behavior "), root)
    filled = F.concat(named, F.repeat(F.lit(" "), files.MIN_BYTES))
    scripts.select(filled.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    changes = large.large_scripts(spark, path).changes
    keys = [F.split("id", "/")[i].cast("bigint").alias(k) for i, k in enumerate(DOC_KEYS)]
    return changes.select(*keys, "pos", "event_ts", "id_device", "property_device", "value_property_device", "area")


# --- scripts to reports -----------------------------------------------------


def _scripts(d: DataFrame) -> DataFrame:
    """(file, value) of the scripts of each source, whose names are the same for all; spaces fill them up to the size that the gate wants."""
    file = F.concat(F.lit("file:/scripts/"), F.col("house_id"), F.lit("/"), F.col("doc_no").cast("string"), F.lit(".bhv"))
    return to_documents(d).select(file.alias("file"), F.concat("value", F.repeat(F.lit(" "), files.MIN_BYTES)).alias("value"))


def _pipeline(job: Callable[[DataFrame], DataFrame], area: str, at: str) -> Query:
    """Readings as scripts of two sources per house, ``extract`` of them, then ``job`` on its lines with each source as a house.

    Lines have no ids; those of the readings that stand first in what ``job`` found,
    in ``area`` at the second ``at``, are looked up.  Equal ones have equal results.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_dir(use_utc(spark), "homes")
        source = F.concat(F.lit("home-"), F.col("house_id").cast("string"), F.when(F.col("event_id") % 2 == 0, "/a").otherwise("/b"))
        readings = device_events(spark, sf_dir).withColumn("house_id", source)
        _scripts(readings).write.parquet(f"{path}/scripts")
        scripts = spark.readStream.schema("file string, value string").parquet(f"{path}/scripts")
        gated = files.gate(F.substring_index("file", "/", -1), F.octet_length("value")).alias("gated")
        jobs.finish(jobs.extract(scripts.select("file", "value", gated), f"{path}/etl", once=True))
        sent = jobs.read_batches(spark, f"{path}/etl", "lines").select("value", "file")
        found = jobs.on_lines(job, F.regexp_extract("file", "/scripts/(.*)/[^/]*$", 1))(sent)
        first = ["house_id", area, at]
        once = found.groupBy(*[c for c in found.columns if c != "event_id"]).agg(F.count("*").alias("n"))
        on = readings.where((F.col("property_device") == S.PRESENCE) & (F.col("value_property_device") == S.ON)).select(
            "event_id", "house_id", F.col("area").alias(area), F.date_trunc("second", "event_ts").cast("timestamp_ntz").alias(at)
        )
        # As many lines as readings, or none of them.
        whole = once.join(on.groupBy(*first).agg(F.count("*").alias("n")), [*first, "n"])
        return on.join(whole, first).select(*found.columns)

    return query


def _with_limits(job: Callable, *columns: str) -> Callable[[DataFrame], DataFrame]:
    """``job`` with the limits of a table a thousand times as large: hot groups are cut."""
    return lambda d: job(d, limits=Limits(rows=200, groups=1000)).select(*columns or "*")


# --- counts and reports --------------------------------------------------

_RULE_COLUMNS = ["rule_id", "group_name", "property_device", "area", "n"]


def _rules(test: str | None) -> Callable[[DataFrame], DataFrame]:
    wanted = [r for r in STATUS_RULES if test in (None, r[3])]
    return lambda d: counts.status_counts(d, wanted).select(*_RULE_COLUMNS)


def _properties(test: str) -> list[str]:
    return [r[2] for r in STATUS_RULES if r[3] == test]


def _activity(group: str | None) -> Callable[[DataFrame], DataFrame]:
    return lambda d: counts.area_activity(d, group)


def _report_lines(d: DataFrame) -> DataFrame:
    return reports.report_lines(counts.report_counts(d), RUN_TS)


# --- streams -------------------------------------------------------------


def _batch_job(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_dir(use_utc(spark), f"stream-{name}")
        stream = as_device_events(jobs.stream_raw_events(spark, sf_dir))
        jobs.finish(jobs.per_batch(stream, {name: jobs.HOUSE_JOBS[name]}, path, once=True))
        found = jobs.read_batches(spark, path, name)
        return found.withColumn("batch_id", F.col("batch_id").cast("bigint"))

    return query


def _stream_status_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_job("status_count")(spark, sf_dir).select("batch_id", *_RULE_COLUMNS)


def _stream_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(use_utc(spark), "stream-running")
    stream = as_device_events(jobs.stream_raw_events(spark, sf_dir))
    jobs.finish(jobs.running_presence(stream, path, once=True))
    # A count only grows, so its largest value is its last one.
    return jobs.read_batches(spark, path, "running").groupBy("key").agg(F.max("n").alias("n"))


def _land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(use_utc(spark), "land")
    lines.write_lines(device_events(spark, sf_dir), f"{path}/spool")
    jobs.finish(jobs.land(lines.stream_lines(spark, f"{path}/spool"), path, once=True))
    return lines.parse_lines(spark.read.parquet(f"{path}/landed").select("value"))


def _stream_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(use_utc(spark), "stream-report")
    lines.write_lines(device_events(spark, sf_dir), f"{path}/spool")
    report = jobs.on_lines(lambda d: _report_lines(d).select("line"))
    stream = lines.stream_lines(spark, f"{path}/spool")
    jobs.finish(jobs.per_batch(stream, {"report": report}, path, once=True, text=("report",)))
    found = jobs.read_batches(spark, path, "report", "text")
    return found.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("value").alias("line"))


#: Deliveries of the readings, and how late they may be.
DELIVERIES, LATE_SECONDS = 5, 6 * 3600


#: Readings of a file that is delivered.
FILE_ROWS = 2_000_000


def _deliver(readings: DataFrame, path: str, late: int = 0, copies: int = 1) -> Iterator[int]:
    """Writes the readings to ``path`` in the order of their arrival, each ``copies`` times and up to ``late`` seconds after
    its time: ``DELIVERIES`` equal stretches of it, each as the same number of files, which is given after each."""
    arrival = E.micros(F.col("event_ts"))
    if late:
        arrival = arrival + F.pmod(F.xxhash64("event_id", "copy"), F.lit(late * 1_000_000))
    copied = readings.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    arriving = copied.withColumn("arrival", arrival).drop("copy")
    first, last, rows = arriving.agg(F.min("arrival"), F.max("arrival"), F.count("*")).first()
    files = max(1, rows // (DELIVERIES * FILE_ROWS))
    part = F.floor((F.col("arrival") - (first or 0)) * DELIVERIES / ((last or 0) - (first or 0) + 1))
    for i in range(DELIVERIES):
        arriving.where(part == i).drop("arrival").repartition(files).write.mode("append").parquet(path)
        yield files


def _delivered(readings: DataFrame, path: str, files: int) -> DataFrame:
    """What was delivered to ``path`` as a stream, a delivery per batch."""
    return readings.sparkSession.readStream.schema(readings.schema).option("maxFilesPerTrigger", files).parquet(path)


def _over_batches(
    job: Callable[[DataFrame, str], DataFrame],
    properties: list[str] | None = None,
    reading: str | None = None,
    copies: int = 1,
    beyond: int = 2 * LATE_SECONDS,
) -> Query:
    """``job`` on the readings as they arrive in several batches, late and out of order, then a mark ``beyond`` seconds after the last one."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_dir(use_utc(spark), "deliveries")
        readings = device_events(spark, sf_dir, properties, reading).where(F.col("event_ts").isNotNull())
        files = list(_deliver(readings, f"{path}/in", LATE_SECONDS, copies))[-1]
        end = readings.agg((F.max("event_ts") + F.expr(f"INTERVAL '{beyond}' SECOND")).alias("event_ts"))
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in readings.schema if f.name != "event_ts"]
        end.select("event_ts", *nothing).select(*readings.columns).write.mode("append").parquet(f"{path}/in")
        found = job(_delivered(readings, f"{path}/in", files), f"{LATE_SECONDS} seconds")
        jobs.finish(jobs.land(found, path, once=True))
        return spark.read.schema(found.schema).parquet(f"{path}/landed")

    return query


#: Seconds of the longest visit that the join looks for.
LONGEST_VISIT = 3 * 86_400


def _once_each(stream: DataFrame, delay: str) -> DataFrame:
    return jobs.once_each(stream.where(F.col("event_id").isNotNull() | F.col("event_ts").isNull()), f"{2 * LATE_SECONDS} seconds").select(*FIELDS)


def _value_rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rules as readings, up to 100,000 thresholds."""
    readings = device_events(use_utc(spark), sf_dir)
    prop = F.element_at(F.array(*[F.lit(p) for p in (S.TEMPERATURE, S.CARBON_DIOXIDE, S.CARBON_MONOXIDE)]), (F.col("event_id") % 3 + 1).cast("int"))
    rules = readings.select(
        F.col("event_id").alias("rule_id"), prop.alias("property_device"), "area", (F.col("event_id") % 100_000 / 200.0).alias("threshold")
    )
    return thresholds.counts_above(readings, rules)


def _ledger_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripts of half the houses, then all of them under other names, then all once more after the log was lost."""
    path = work_dir(use_utc(spark), "ledger")
    docs = to_documents(device_events(spark, sf_dir))
    name = F.concat_ws("/", F.col("house_id").cast("string"), F.col("doc_no").cast("string"))
    value = F.concat("value", F.lit("<!-- "), name, F.lit(" -->"))
    scripts = docs.select("house_id", name.alias("file"), value.alias("value"))

    def put(rows: DataFrame, folder: str) -> None:
        rows.select(F.concat(F.lit(folder), F.lit("/"), "file").alias("file"), "value").write.mode("append").parquet(f"{path}/in")

    def take(out: str) -> None:
        stream = spark.readStream.schema("file string, value string").parquet(f"{path}/in")
        job = lambda new: behaviour.behaviour_events(new, ["file"])
        jobs.finish(ledger.take_once(stream, f"{path}/ledger", f"{path}/{out}", job, "events", once=True))

    put(scripts.where("house_id % 2 = 0"), "first")
    take("one")
    put(scripts, "second")
    take("one")
    take("two")
    found = jobs.read_batches(spark, f"{path}/one", "events").unionByName(jobs.read_batches(spark, f"{path}/two", "events"))
    parts = F.split("file", "/")
    return found.select(
        parts[1].cast("bigint").alias("house_id"),
        parts[2].cast("bigint").alias("doc_no"),
        parts[0].alias("folder"),
        "pos",
        "event_ts",
        "id_device",
        "property_device",
        "value_property_device",
        "area",
    )


def _stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables per batch; the third batch is killed between them, and taken again."""
    path = work_dir(use_utc(spark), "committed")
    readings = device_events(spark, sf_dir)
    tries = []

    def areas(batch: DataFrame) -> DataFrame:
        tries.append(1)
        if len(tries) == 3:
            raise InterruptedError("killed between two tables")
        return batch.groupBy("area").count()

    tables = {"ids": lambda batch: batch.select("event_id"), "areas": areas}
    files = list(_deliver(readings, f"{path}/in"))[-1]
    stream = _delivered(readings, f"{path}/in", files)
    try:
        jobs.finish(jobs.per_batch(stream, tables, path, once=True))
    except StreamingQueryException:
        # The first table of the killed batch is there, and is not read.
        before = jobs.read_batches(spark, path, "ids").agg(F.max("batch_id").alias("batch_id"))
        if before.first().batch_id != 1:
            raise
    jobs.finish(jobs.per_batch(stream, tables, path, once=True))
    return jobs.read_batches(spark, path, "ids").select("event_id")


def _dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each house as a file; those of one house make the job fail.  (file, n, dead)."""
    path = work_dir(use_utc(spark), "dead-letters")
    sent = device_events(spark, sf_dir).select(lines.line_text().alias("value"), F.concat(F.lit("home-"), F.col("house_id").cast("string")).alias("file"))
    sent.write.parquet(f"{path}/in")

    def job(batch: DataFrame) -> DataFrame:
        fails = F.when(F.col("file") == "home-7", F.raise_error(F.lit("home-7 can't be read")).cast("bigint")).otherwise(1)
        return batch.groupBy("file").agg(F.sum(fails).alias("n"))

    stream = lines.stream_line_table(spark, f"{path}/in")
    jobs.finish(jobs.per_batch(stream, {"counts": job}, path, once=True, set_aside=1))
    counted = jobs.read_batches(spark, path, "counts").select("file", "n", F.lit(False).alias("dead"))
    letters = jobs.read_batches(spark, path, jobs.DEAD_LETTERS)
    return counted.unionByName(letters.select("file", F.lit(None).cast("bigint").alias("n"), F.lit(True).alias("dead")))


def _stream_running_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(use_utc(spark), "running-readings")
    readings = device_events(spark, sf_dir, [S.PRESENCE], S.ON)
    files = list(_deliver(readings, f"{path}/in"))[-1]
    jobs.finish(totals.running_presence_readings(_delivered(readings, f"{path}/in", files), path, once=True))
    return jobs.read_batches(spark, path, "readings").select("key", "event_id", "n")


QUERIES: dict[str, Query] = {
    "scan_device_events": on_readings(lambda d: d.select(*FIELDS)),
    "parse_device_line": on_readings(lambda d: lines.parse_lines(_sent_lines(d))),
    "malformed_lines": on_readings(lambda d: lines.malformed_lines(_broken_lines(d))),
    "properties_map": on_readings(_properties_map),
    "normalise_value": on_readings(_normalise_value),
    "parse_start_ts": on_readings(_parse_start_ts),
    "delay_seconds": on_readings(_delay_seconds),
    "delay_prefix_sum": on_readings(_delay_prefix_sum),
    "positional_join": on_readings(_positional_join),
    "device_zone_join": on_readings(_device_zone_join),
    "zone_conflicts": on_readings(_zone_conflicts),
    "behaviour_to_events": on_readings(_behaviour_to_events),
    "nested_documents": on_readings(_nested_documents),
    "large_scripts": _large_scripts,
    "file_gate": _file_gate,
    "refused_files": _refused_files,
    "csv_roundtrip": _csv_roundtrip,
    "presence_on_rows": on_presence(lambda d: counts.presence_rows(d, "kitchen").select(*FIELDS), S.ON),
    "value_alarm_rows": on_readings(
        lambda d: counts.alarm_rows(d, S.TEMPERATURE, "kitchen", 200).select(*FIELDS), [S.TEMPERATURE]
    ),
    "status_count": on_readings(_rules("="), _properties("=")),
    "value_alarm_count": on_readings(_rules(">"), _properties(">")),
    "rule_counts": on_readings(_rules(None)),
    "rule_counts_of_lines": on_readings(lambda d: _rules(None)(lines.parse_lines(_broken_lines(d)))),
    "area_activity_bedroom": on_readings(_activity("bedroom"), [S.POWER, S.PRESENCE, S.DOOR]),
    "area_activity_bathroom": on_readings(_activity("bathroom"), [S.POWER, S.PRESENCE]),
    "area_activity_kitchen": on_readings(_activity("kitchen"), [S.POWER, S.PRESENCE]),
    "area_activity_livingroom": on_readings(_activity("livingroom"), [S.POWER, S.PRESENCE]),
    "presence_count": on_presence(counts.presence_counts, S.ON),
    "running_presence_count": on_presence(
        lambda d: ordering.running_presence(d).select("key", "event_id", "n"), S.ON
    ),
    "movement_transitions": on_presence(movements, S.ON),
    "visits_all": on_presence(visits),
    **{
        f"visits_{name}": on_presence(lambda d, area=area: visits(d, [area])) for name, area in VISIT_AREAS.items()
    },
    "sorted_events": on_readings(lambda d: ordering.sorted_events(d).select(*FIELDS, "rn")),
    "first_event": on_readings(lambda d: ordering.first_event(d).select(*FIELDS)),
    "pipeline_movements": _pipeline(movements, "from_area", "from_ts"),
    "pipeline_visits": _pipeline(visits, "area", "entry_ts"),
    "running_presence_split": on_presence(
        lambda d: ordering.running_presence(d, limits=Limits(200, 1000)).select("key", "event_id", "n"), S.ON
    ),
    "movement_split": on_presence(_with_limits(movements), S.ON),
    "visits_split": on_presence(_with_limits(visits)),
    "report_lines": on_readings(_report_lines),
    "movement_lines": on_presence(lambda d: reports.movement_lines(movements(d)), S.ON),
    "visit_lines": on_presence(lambda d: reports.visit_lines(visits(d, list(reports.VISIT_PLACES)))),
    "land_stream": _land_stream,
    "stream_status_count": _stream_status_count,
    "stream_area_activity": _batch_job("area_activity"),
    "stream_running_presence": _stream_running,
    "stream_report_lines": _stream_report_lines,
    "stream_visits": _batch_job("visits"),
    "stream_movement": _batch_job("movement"),
    "stream_visits_across": _over_batches(ordered.visits_in_stream, [S.PRESENCE]),
    "stream_movement_across": _over_batches(ordered.movements_in_stream, [S.PRESENCE], S.ON),
    "stream_running_readings": _stream_running_readings,
    "stream_visits_by_join": _over_batches(
        lambda stream, delay: ordered.visits_by_join(stream, delay, LONGEST_VISIT), [S.PRESENCE], beyond=2 * (LONGEST_VISIT + LATE_SECONDS)
    ),
    "value_rules_table": _value_rules_table,
    "global_position": on_readings(lambda d: ordering.global_positions(d, ["area"]).select("event_id", "event_ts", "area", "rn")),
    "global_position_split": on_readings(
        lambda d: ordering.global_positions(d, ["area"], limits=Limits(200, 1000)).select("event_id", "event_ts", "area", "rn")
    ),
    "ledger_scripts": _ledger_scripts,
    "stream_committed_batches": _stream_committed,
    "dead_letters": _dead_letters,
    "stream_repeated_rows": _over_batches(_once_each, copies=2),
}
