"""The same questions on arriving files.

Counts and matching see one micro-batch at a time.  Every batch writes its own
``batch_id=N`` folder and overwrites it when it is run again, so a retried
batch leaves no second copy; a batch is read once all its folders are written.
The checkpoint log remembers which files were taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtrace import schema as S
from roomtrace.functions.expressions import micros
from roomtrace.operators.counts import area_activity, presence_counts, report_counts, status_counts
from roomtrace.operators.movement import movements
from roomtrace.operators.reports import VISIT_PLACES, movement_lines, report_lines, visit_lines
from roomtrace.operators.visits import visits
from roomtrace.sources.behaviour import (
    paired_changes,
    parse_documents,
    rejected_documents,
    with_area,
    zone_conflicts,
)
from roomtrace.sources.lines import line_text, malformed_lines, parse_lines

BATCH_INTERVAL = "60 seconds"


def stream_raw_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    """The event table as a stream of files; it may be one file or a folder of them."""
    return spark.readStream.schema(S.RAW_EVENTS).options(**options).parquet(f"{sf_dir}/events.parque[t]")


def start_log(writer, checkpoint: str, once: bool) -> StreamingQuery:
    """Starts a stream whose log is kept at ``checkpoint``; ``once`` takes what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=BATCH_INTERVAL).start()


def open_manifest(spark: SparkSession, path: str) -> None:
    """Makes the table of finished batches under ``path``, empty, unless it is there."""
    spark.createDataFrame([], "batch_id bigint").write.mode("ignore").parquet(f"{path}/_committed")


def commit(spark: SparkSession, path: str, batch_id: int) -> None:
    """Notes that all tables of the batch are written; until then ``read_batches`` leaves it out."""
    done = spark.range(batch_id, batch_id + 1, 1, 1).withColumnRenamed("id", "batch_id")
    done.write.mode("overwrite").parquet(f"{path}/_committed/{batch_id}")


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id) of the finished batches."""
    return spark.read.schema("batch_id bigint").option("recursiveFileLookup", "true").parquet(f"{path}/_committed").distinct()


def _write_jobs(
    batch: DataFrame, batch_id: int, jobs: dict[str, Callable[[DataFrame], DataFrame]], path: str, text: tuple[str, ...]
) -> None:
    for name, job in jobs.items():
        found = job(batch)
        writer = found.write.mode("overwrite").format("text" if name in text else "parquet")
        if name in text:
            writer = writer.partitionBy(*found.columns[1:])
        writer.save(f"{path}/{name}/batch_id={batch_id}")


def _first_bad_file(batch: DataFrame, jobs: dict[str, Callable[[DataFrame], DataFrame]], names: list[str]) -> tuple[str, str]:
    """A file without which a batch that fails may pass, and its error: the suspects are halved until one is left.

    If one half passes, the bad file is in the other, which needs no try.
    """
    error = ""
    while len(names) > 1:
        half = names[: len(names) // 2]
        try:
            for job in jobs.values():
                job(batch.where(F.col("file").isin(half))).write.format("noop").mode("overwrite").save()
        except Exception as failure:  # Any error of a job; the whole batch has failed already.
            names, error = half, str(failure)
        else:
            names = names[len(names) // 2 :]
    return names[0], error


DEAD_LETTERS = "dead_letters"


def per_batch(
    stream: DataFrame,
    jobs: dict[str, Callable[[DataFrame], DataFrame]],
    path: str,
    once: bool = False,
    text: tuple[str, ...] = (),
    set_aside: int = 0,
) -> StreamingQuery:
    """Runs ``jobs`` on every batch; job ``x`` writes to ``path/x/batch_id=N``.

    Tables are parquet, but jobs named in ``text`` give lines and write text
    files, in folders by what columns follow the line.  ``once`` takes what is there and stops; otherwise a batch starts
    every minute.  A batch counts once all its tables are written.

    A batch that fails stops the stream, and is taken again when it is started again.  With ``set_aside``,
    up to so many files of a batch (a stream with a column ``file``) are left out instead: the bad ones are found by
    bisection, at most log2(files) tries each, and go to the table ``dead_letters`` of (file, error);
    the others are delivered once.  If more are bad, the error is that of the batch.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        several = len(jobs) > 1 or set_aside > 0
        if several:
            batch = batch.persist()
        try:
            dead: list[tuple[str, str]] = []
            rest = batch
            while True:
                try:
                    _write_jobs(rest, batch_id, jobs, path, text)
                    break
                except Exception as failure:
                    if len(dead) >= set_aside:
                        raise
                    names = sorted(r.file for r in rest.select("file").where("file IS NOT NULL").distinct().collect())
                    if not names:
                        raise
                    name, error = _first_bad_file(rest, jobs, names)
                    dead.append((name, error or str(failure)))
                    rest = rest.where(~F.col("file").eqNullSafe(name))
            if set_aside:
                letters = spark.createDataFrame(dead, "file string, error string")
                letters.write.mode("overwrite").parquet(f"{path}/{DEAD_LETTERS}/batch_id={batch_id}")
            commit(spark, path, batch_id)
        finally:
            if several:
                batch.unpersist()

    open_manifest(stream.sparkSession, path)
    return start_log(stream.writeStream.foreachBatch(process), f"{path}/_log", once)


def read_batches(spark: SparkSession, path: str, name: str, kind: str = "parquet") -> DataFrame:
    """What job ``name`` wrote in the finished batches, with their ``batch_id``."""
    written = spark.read.format(kind).option("basePath", f"{path}/{name}").load(f"{path}/{name}/batch_id=*")
    return written.join(committed(spark, path), "batch_id", "left_semi").select(*written.columns)


# The jobs a house stream runs, by table name.
HOUSE_JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "status_count": status_counts,
    "area_activity": area_activity,
    "visits": visits,
    "movement": movements,
}


def on_lines(job: Callable[[DataFrame], DataFrame], house: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """``job`` for a batch of device lines instead of readings.

    Every source ``file`` is a house of its own unless ``house`` says otherwise; with
    ``F.lit("home")`` all files of a batch belong together.
    """

    def run(batch: DataFrame) -> DataFrame:
        named = batch.withColumn("house_id", F.col("file") if house is None else house)
        return job(parse_lines(named.withColumn("event_id", F.monotonically_increasing_id())))

    return run


def once_each(stream: DataFrame, delay: str, keys: list[str] | None = None) -> DataFrame:
    """The stream without rows that were delivered before, equal in ``keys`` (all columns), if they come
    within ``delay`` of the first; later ones are taken for new.  State keeps the keys of the last ``delay``."""
    keys = keys or stream.columns
    at = F.timestamp_micros(micros(F.col("event_ts")))
    seen = stream.withColumn("_at", at).withWatermark("_at", delay)
    return seen.dropDuplicatesWithinWatermark(keys).drop("_at")


def extract(
    stream: DataFrame, path: str, once: bool = False, legacy_other_unit: bool = False, set_aside: int = 0
) -> StreamingQuery:
    """Behaviour documents to device lines: the table ``path/lines/batch_id=N`` of ``value, file``.

    ``file`` is the whole path of the script a line came from, so lines of
    different homes stay apart however the rows are stored.  Documents that cannot
    be used, and files that the gate refuses, go to the table ``rejected``, changes
    of devices without a zone or with several to ``zone_conflicts``.
    """
    keys = ["file"]

    def device_lines(parsed: DataFrame) -> DataFrame:
        found = with_area(paired_changes(parsed, keys)).filter(F.col("area").isNotNull())
        return found.select(line_text().alias("value"), "file")

    jobs = {
        "lines": device_lines,
        "rejected": lambda parsed: rejected_documents(parsed, keys),
        "zone_conflicts": lambda parsed: zone_conflicts(paired_changes(parsed, keys)),
    }
    return per_batch(parse_documents(stream, keys, legacy_other_unit), jobs, path, once, set_aside=set_aside)


def house_report(
    stream: DataFrame, path: str, run_ts: str, house: Column | None = None, once: bool = False
) -> StreamingQuery:
    """Device lines to report lines: per batch the counts, the movements and the
    visits as text, and the lines that are no readings as a table ``malformed``."""
    jobs = {
        "report": on_lines(lambda d: report_lines(report_counts(d), run_ts).select("line"), house),
        "movement": on_lines(
            lambda d: movement_lines(movements(d)).orderBy("from_ts", "from_area", "event_id").select("line"), house
        ),
        "visits": on_lines(
            lambda d: visit_lines(visits(d, list(VISIT_PLACES)))
            .orderBy("area", "entry_ts", "event_id", "line_no")
            .select("line"),
            house,
        ),
        "malformed": malformed_lines,
    }
    return per_batch(stream, jobs, path, once, text=("report", "movement", "visits"))


def show(stream: DataFrame, path: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    """Prints the rows of every batch; the log of taken files is kept under ``path``."""
    return start_log(stream.writeStream.format("console").outputMode(mode), f"{path}/_log", once)


def running_presence(
    stream: DataFrame, path: str, areas: list[str] | None = None, once: bool = False
) -> StreamingQuery:
    """Keeps one count per key for the whole stream; each batch writes the counts it changed."""
    counts = presence_counts(stream, areas)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/running/batch_id={batch_id}")
        commit(batch.sparkSession, path, batch_id)

    open_manifest(stream.sparkSession, path)
    return start_log(counts.writeStream.outputMode("update").foreachBatch(process), f"{path}/_log", once)


def land(stream: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    """Copies arriving rows to a parquet table under ``path/landed``."""
    return start_log(
        stream.writeStream.format("parquet").option("path", f"{path}/landed"), f"{path}/_log", once
    )


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Waits for the query, at most ``seconds``, then stops it; its error, if any, is raised."""
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()
