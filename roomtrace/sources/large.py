"""Behaviour scripts that are larger than a row.

A script is read in splits, one record per ``<``: a tag and the text behind it (no
attribute may hold ``<``).  What depends on the tags before, a position, a sum of
delays, or whether a comment is open, is found by a two-level scan: inside each
split, then over the summaries of the splits, of which a file has few.  Changes,
delays and zones then meet by joins on file and position, or file and device.

Results are those of the row parser (``sources.behaviour``), elements at any depth
included, but for what only the whole text shows: tags that are not closed are no
reason to refuse a script as long as those that are read are well formed and
``</behavior>`` ends it; comments and literal text end at the first ``-->`` or ``]]>``.

The tags are stored, so each file is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from roomtrace.functions.expressions import delay_seconds, from_seconds, normalise_value, parse_start_ts, seconds
from roomtrace.session import work_dir
from roomtrace.sources.behaviour import TAG_REST
from roomtrace.sources.files import gate

DELAY, CHANGE, ZONE = "delay", "set-device-property", "move-device-zone"
ROOT, END, MARK = "behavior", "/behavior", "mark"
ATTRIBUTES = (
    "_startdate string, _id string, _value string, _unit string, _deviceId string, _property string, _zoneId string, _corrupt_record string"
)
READ = "|".join([DELAY, CHANGE, ZONE, ROOT])


@dataclass(frozen=True)
class LargeScripts:
    """``changes``: (file, id, pos, delay, elapsed, event_ts, id_device, property_device, value_property_device, area),
    where ``id`` is that of the root, NULL if it has none;
    ``rejected``: (file, reason); ``zone_conflicts``: changes of devices without a zone or with several, as the row parser has them.
    """

    changes: DataFrame
    rejected: DataFrame
    zone_conflicts: DataFrame


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """(file, gated, block, at, value): records of the files under ``path``; ``block`` is the start of the split, ``at`` the order inside it."""
    texts = spark.read.option("lineSep", "<").text(path)
    return texts.select(
        F.col("_metadata.file_path").alias("file"),
        gate(F.col("_metadata.file_name"), F.col("_metadata.file_size")).alias("gated"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _mark(value: Column) -> Column:
    """True where a comment or literal text begins and goes on, False where one ends."""
    ends = F.contains(value, F.lit("-->")) | F.contains(value, F.lit("]]>"))
    begins = F.startswith(value, F.lit("!--")) | F.startswith(value, F.lit("![CDATA["))
    return F.when(ends, False).when(begins, True)


def _parsed(tags: DataFrame, legacy_other_unit: bool, strict: bool) -> DataFrame:
    """The tags that are read, with their attributes; one row per file at least."""
    name = F.regexp_extract("value", rf"^({READ}|/behavior)(?=[\s/>]|$)", 1)
    element = F.regexp_extract(F.concat(F.lit("<"), "value"), f"^<(?:{READ}){TAG_REST}", 0)
    alone = F.regexp_replace(element, r"/?>$", "/>")
    first = (F.col("block") == 0) & (F.col("value") == "")
    kept = tags.select("file", "gated", "block", "at", "value", name.alias("kind"), _mark(F.col("value")).alias("mark"), element.alias("element"), alone.alias("alone"))
    kept = kept.where((F.col("kind") != "") | F.col("mark").isNotNull() | first)
    read = F.col("kind").isin(DELAY, CHANGE, ZONE, ROOT) & F.col("gated").isNull()
    # The explode keeps the parser from being run once per attribute.
    parsed = kept.withColumn("x", F.explode(F.array(F.from_xml(F.when(read & (F.col("element") != ""), F.col("alone")), ATTRIBUTES, {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}))))
    amount = F.when(F.col("x._value").rlike(r"^\s*[+-]?\d+\s*$"), F.col("x._value").try_cast("bigint"))
    text = lambda c: F.coalesce(F.col(f"x.{c}"), F.lit(""))
    needed = {DELAY: ("_value", "_unit"), CHANGE: ("_deviceId", "_property", "_value"), ZONE: ("_deviceId", "_zoneId")}
    gap = F.lit(False)
    for kind, names in needed.items():
        for n in names:
            gap = gap | ((F.col("kind") == kind) & F.col(f"x.{n}").isNull())
    return parsed.select(
        "file",
        "gated",
        "block",
        "at",
        F.when(F.col("kind") == "", MARK).otherwise(F.col("kind")).alias("kind"),
        "mark",
        (
            (read & ((F.col("element") == "") | F.col("x._corrupt_record").isNotNull()))
            | ((F.col("kind") == END) & ~F.col("value").rlike(r"^/behavior\s*>\s*$"))
        ).alias("broken"),
        (gap & F.lit(strict)).alias("gap"),
        F.when(F.col("kind") == ROOT, parse_start_ts(F.col("x._startdate"))).alias("start_ts"),
        F.when(F.col("kind") == ROOT, F.col("x._id")).alias("id"),
        F.when(F.col("kind") == DELAY, delay_seconds(amount, text("_unit"), legacy_other_unit)).alias("delay"),
        text("_deviceId").alias("device"),
        text("_property").alias("property"),
        normalise_value(text("_value")).alias("value"),
        text("_zoneId").alias("zone"),
    )


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _carried(blocks: DataFrame, column: Column) -> Column:
    """What ``column`` aggregates to over the earlier blocks of the file."""
    return column.over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))


def _numbered(tags: DataFrame) -> DataFrame:
    """Live tags with their number among those of their kind in the block, and the delays of the block so far."""
    ends = tags.where("mark IS NOT NULL").groupBy("file", "block").agg(F.max_by("mark", "at").alias("left"))
    blocks = tags.groupBy("file", "block").agg(F.count("*").alias("_n")).join(ends, ["file", "block"], "left")
    carried = blocks.select("file", "block", _carried(blocks, F.last("left", ignorenulls=True)).alias("carried"))
    inside = W.partitionBy("file", "block").orderBy("at")
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    live = (
        tags.join(carried, ["file", "block"])
        .withColumn("hidden", F.coalesce(F.last("mark", ignorenulls=True).over(before), "carried", F.lit(False)))
        .withColumn("kind", F.when(F.col("hidden"), MARK).otherwise(F.col("kind")))
    )
    of_kind = W.partitionBy("file", "block", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        live.withColumn("elapsed", F.sum(F.when(F.col("kind") == DELAY, F.col("delay"))).over(upto))
        .withColumn("n", F.count("*").over(of_kind))
        .drop("hidden", "carried", "mark")
    )


def _files(numbered: DataFrame) -> DataFrame:
    """(file, id, start_ts, reason), one row per file."""
    live = F.col("kind") != MARK
    kind = lambda k: F.col("kind") == k
    place = F.struct("block", "at")
    found = numbered.groupBy("file").agg(
        F.max("gated").alias("gated"),
        F.max(F.col("broken") & live).alias("broken"),
        F.max(F.col("gap") & live).alias("gap"),
        F.count(F.when(kind(ROOT), 1)).alias("roots"),
        F.count(F.when(kind(END), 1)).alias("closed"),
        F.min(F.when(kind(ROOT), F.struct(place.alias("place"), "start_ts", "id"))).alias("start"),
        F.max_by("kind", F.when(live & (F.col("kind") != ROOT), place)).alias("last"),
        F.count(F.when(kind(DELAY), 1)).alias("delays"),
        F.count(F.when(kind(DELAY), F.col("delay"))).alias("good"),
        F.count(F.when(kind(CHANGE), 1)).alias("changes"),
    )
    reason = (
        F.when(F.col("gated").isNotNull(), F.col("gated"))
        .when(F.col("broken") | ((F.col("roots") > 0) & ((F.col("closed") != F.col("roots")) | (F.col("last") != END))), "not XML")
        .when(F.col("roots") == 0, "no behaviour")
        .when(F.col("start.start_ts").isNull(), "bad start date")
        .when(F.col("good") < F.col("delays"), "bad delay")
        .when(F.col("delays") < F.col("changes"), "fewer delays than changes")
        .when(F.col("gap"), "missing attribute")
    )
    return found.select("file", F.col("start.id").alias("id"), F.col("start.start_ts").alias("start_ts"), reason.alias("reason"))


def large_scripts(spark: SparkSession, path: str, legacy_other_unit: bool = False, strict: bool = False) -> LargeScripts:
    """The scripts under ``path``, of any size, as the row parser would read them."""
    tags = _stored(spark, _parsed(read_tags(spark, path), legacy_other_unit, strict), "script-tags")
    numbered = _stored(spark, _numbered(tags), "script-numbers")
    files = _files(numbered)
    sums = numbered.groupBy("file", "block").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{i}") for i, k in enumerate((DELAY, CHANGE, ZONE))],
        F.sum(F.when(F.col("kind") == DELAY, F.col("delay"))).alias("sum"),
    )
    # One row per split, with what the splits before it hold and the file it is of.
    offsets = sums.join(files.where("reason IS NULL"), "file").select(
        "file",
        "block",
        "id",
        F.col("start_ts").alias("begins"),
        *[F.coalesce(_carried(sums, F.sum(f"n_{i}")), F.lit(0)).alias(f"n_{i}") for i in range(3)],
        F.coalesce(_carried(sums, F.sum("sum")), F.lit(0)).alias("sum"),
    )

    def placed(i: int, kind: str) -> DataFrame:
        rows = numbered.where(F.col("kind") == kind).drop("id").join(offsets, ["file", "block"])
        return rows.withColumn("pos", (F.col("n") + F.col(f"n_{i}") - 1).cast("int"))

    delays = placed(0, DELAY).select("file", "pos", "delay", (F.col("elapsed") + F.col("sum")).alias("elapsed"), "id", "begins")
    changes = (
        placed(1, CHANGE)
        .select("file", "pos", F.col("device").alias("id_device"), F.col("property").alias("property_device"), F.col("value").alias("value_property_device"))
        .join(delays, ["file", "pos"])
        .select(
            "file", "id", "pos", "delay", "elapsed", from_seconds(seconds(F.col("begins")) + F.col("elapsed")).alias("event_ts"),
            "id_device", "property_device", "value_property_device",
        )
    )
    order = W.partitionBy("file", "device").orderBy("pos")
    zones = placed(2, ZONE).select("file", F.col("device").alias("id_device"), "zone", F.row_number().over(order).alias("nth"))
    first = zones.where("nth = 1").select("file", "id_device", F.col("zone").alias("area"))
    with_area = changes.join(first, ["file", "id_device"], "left").select(*changes.columns, "area")
    extra = changes.join(zones.where("nth > 1").select("file", "id_device", F.col("zone").alias("extra")), ["file", "id_device"])
    none = changes.join(first, ["file", "id_device"], "left_anti").select(*changes.columns, F.lit(None).cast("string").alias("extra"))
    reason = F.when(F.col("extra").isNull(), "no zone").otherwise("second zone")
    return LargeScripts(
        with_area,
        files.where("reason IS NOT NULL").select("file", "reason"),
        none.unionByName(extra.select(*none.columns)).withColumn("reason", reason),
    )
