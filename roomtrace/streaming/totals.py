"""A total for every arriving reading, over all batches.

The rows of a batch are counted by the batch operator, which cuts hot keys, and start
from the totals of the batches before.  Totals are a table, a version per batch:
most versions hold only the keys of their batch, every ``SNAPSHOT``-th holds all.
A batch reads the versions since the last full one before it and never its own, so
a batch that is run again gives the same rows and totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from roomtrace.operators.ordering import running_presence
from roomtrace.streaming.jobs import commit, open_manifest, start_log

SNAPSHOT = 20


def totals_before(batch: DataFrame, path: str, batch_id: int, keys: list[str], snapshot: int = SNAPSHOT) -> DataFrame | None:
    """``keys, total`` after the batches before ``batch_id``; None for the first one."""
    if batch_id == 0:
        return None
    full = (batch_id - 1) // snapshot * snapshot
    versions = [f"{path}/totals/batch_id={n}" for n in range(full, batch_id)]
    # A total only grows, so the largest one is the last.
    return batch.sparkSession.read.parquet(*versions).groupBy(*keys).agg(F.max("total").alias("total"))


def running_presence_readings(
    stream: DataFrame,
    path: str,
    areas: list[str] | None = None,
    by: list[str] | None = None,
    once: bool = False,
    snapshot: int = SNAPSHOT,
) -> StreamingQuery:
    """Every presence-on reading with the new count of its key, as table ``path/readings/batch_id=N`` of (by, key, event_id, event_ts, n).

    Readings of a batch count in time order, batches in the order of arrival.
    Readings without a time are left out.
    """
    keys = [*(by or []), "key"]

    def process(batch: DataFrame, batch_id: int) -> None:
        counted = running_presence(batch, areas, by)
        before = totals_before(batch, path, batch_id, keys, snapshot)
        out = f"{path}/readings/batch_id={batch_id}"
        if before is not None:
            old = before.select(*[F.col(k).alias(f"_{k}") for k in keys], "total")
            on = F.lit(True)
            for k in keys:
                on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
            counted = counted.join(old, on, "left").select(
                *keys, "event_id", "event_ts", (F.col("n") + F.coalesce("total", F.lit(0))).alias("n")
            )
        counted.write.mode("overwrite").parquet(out)
        totals = batch.sparkSession.read.parquet(out).groupBy(*keys).agg(F.max("n").alias("total"))
        if before is not None and batch_id % snapshot == 0:
            totals = totals.unionByName(before).groupBy(*keys).agg(F.max("total").alias("total"))
        totals.write.mode("overwrite").parquet(f"{path}/totals/batch_id={batch_id}")
        commit(batch.sparkSession, path, batch_id)

    open_manifest(stream.sparkSession, path)
    return start_log(stream.writeStream.foreachBatch(process), f"{path}/_log", once)
