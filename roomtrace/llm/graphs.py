"""Connected components of a graph in a table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace.session import work_dir


def _stored(spark: SparkSession, edges: DataFrame) -> tuple[DataFrame, tuple]:
    path = work_dir(spark, "edges")
    edges.write.parquet(path)
    kept = spark.read.parquet(path)
    return kept, tuple(kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``a, b`` (bigint); the root is the least node of its component.

    Every round hooks neighbours to the least node around and is written to the
    shared folder.  Least nodes are found with map-side aggregation and joined
    back, so a node with very many neighbours is split like any skewed join.
    """
    spark = edges.sparkSession
    at, state = _stored(
        spark,
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
    )
    while True:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct(F.col("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        at, after = _stored(spark, small)
        if after == state:
            break
        state = after
    leaves = at.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = at.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return leaves.unionByName(roots)
