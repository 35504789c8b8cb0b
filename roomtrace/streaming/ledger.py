"""A ledger of the scripts that were taken, by what they hold.

The log of a stream knows files by name.  The ledger knows them by digest, whatever
their name, and outlives the log: a script under a second name, or one that arrives
again after the log was lost, is reported and not taken.  Each batch reads the ledger
of all others, never its own rows, so a batch that is run again decides the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtrace.streaming.jobs import commit, open_manifest, start_log

ENTRY = "digest string, file string, log string, batch_id bigint"


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """(digest, file, log, batch_id): every script that was taken, once."""
    return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(ledger)


def _open(spark: SparkSession, ledger: str) -> None:
    spark.createDataFrame([], ENTRY).write.mode("ignore").parquet(ledger)


def split_arrivals(arrived: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New scripts of ``file, value`` (of equal ones the least file name), and (file, digest, first_file) of the others.

    Files without a text (refused ones) are new: they are reported by whoever reads them.
    """
    texts = arrived.withColumn("digest", F.sha2("value", 256))
    here = texts.where("digest IS NOT NULL").groupBy("digest").agg(F.min("file").alias("_least"))
    before = known.groupBy("digest").agg(F.min("file").alias("_known"))
    placed = texts.join(here.join(before, "digest", "left"), "digest", "left").withColumn(
        "_first", F.coalesce("_known", F.when(F.col("file") != F.col("_least"), F.col("_least")))
    )
    new = placed.where("_first IS NULL").select(*arrived.columns, "digest")
    return new, placed.where("_first IS NOT NULL").select("file", "digest", F.col("_first").alias("first_file"))


def take_once(
    stream: DataFrame, ledger: str, path: str, job: Callable[[DataFrame], DataFrame], name: str = "taken", once: bool = False
) -> StreamingQuery:
    """Runs ``job`` on the scripts (``file, value, ...``) of each batch that no batch has taken, as table
    ``path/name/batch_id=N``; the others go to the table ``path/repeated`` of (file, digest, first_file).

    Several streams, and streams that lost their log, may share a ledger; each run of one without its log needs a ``path`` of
    its own.  Streams that run at the same time see what the other has taken once its batch is written.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = entries(spark, ledger).where((F.col("log") != log) | (F.col("batch_id") < batch_id))
        batch = batch.persist()
        try:
            new, repeated = split_arrivals(batch, known)
            job(new.drop("digest")).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            repeated.write.mode("overwrite").parquet(f"{path}/repeated/batch_id={batch_id}")
            rows = new.where("digest IS NOT NULL").select(
                "digest", "file", F.lit(log).alias("log"), F.lit(batch_id).cast("bigint").alias("batch_id")
            )
            rows.write.mode("overwrite").parquet(f"{ledger}/{log}-{batch_id}")
            commit(spark, path, batch_id)
        finally:
            batch.unpersist()

    _open(stream.sparkSession, ledger)
    open_manifest(stream.sparkSession, path)
    return start_log(stream.writeStream.foreachBatch(process), f"{path}/_log", once)
