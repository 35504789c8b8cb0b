"""Which input files are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A file marked as done has the word in its suffixes, and its
# size in MiB must not round to 0.000, which first holds at 525 bytes.
DONE = r"^\.*[^.]*\..*COMPLETED"
MIN_BYTES = 525


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length) of the files in ``path``; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), "length"
    )


def gate(name: Column, length: Column) -> Column:
    """Why a file is not taken, NULL for one that is."""
    return F.when(name.rlike(DONE), "done").when(length < MIN_BYTES, "too small")


def accepted_files(files: DataFrame) -> DataFrame:
    """Files neither done nor too small.  Nothing is renamed or deleted."""
    return files.filter(gate(F.col("name"), F.col("length")).isNull())


def refused_files(files: DataFrame) -> DataFrame:
    """The other files, with the ``reason``."""
    return files.withColumn("reason", gate(F.col("name"), F.col("length"))).filter(F.col("reason").isNotNull())
