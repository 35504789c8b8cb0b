"""Reading the text tables and small shared column helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Words of word shingles: what lies outside ASCII, ASCII letters and digits; A-Z fold to a-z.
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def for_python(rows: DataFrame, batch: str = "8m") -> DataFrame:
    """Prepares rows for ``mapInArrow``: batches of bounded bytes whatever the length of rows, and this package on the workers."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).parent.parent
        # A file of the driver, which Spark hands to every executor.
        archive = Path(tempfile.mkdtemp(prefix="roomtrace-package-")) / "roomtrace.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
    return rows


_SHIPPED: set[str] = set()
