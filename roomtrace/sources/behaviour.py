"""Behaviour scripts: XML documents that list delays, property changes and device zones.

A document is one row.  It is parsed once, its device lookup and the pairing of
changes with delays happen inside the row, and only the paired elements are
exploded; one shuffle per document key adds up the delays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from roomtrace.functions.expressions import delay_seconds, from_seconds, normalise_value, parse_start_ts, seconds
from roomtrace.sources.files import gate

# The elements and attributes that are read.
DOCUMENT = (
    "_startdate string, "
    "`delay` array<struct<_value string, _unit string>>, "
    "`set-device-property` array<struct<_deviceId string, _property string, _value string>>, "
    "`move-device-zone` array<struct<_deviceId string, _zoneId string>>, "
    "_corrupt_record string"
)
READ_TAGS = ["delay", "set-device-property", "move-device-zone"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, value), one row per file under ``path``; ``file`` is its whole path.

    Files that the gate refuses have no text but their reason in ``gated``.
    """
    return _gated(spark.read.text(path, wholetext=True))


def stream_documents(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same for files as they arrive; the log of the stream marks them as done."""
    return _gated(spark.readStream.options(**options).text(path, wholetext=True))


def _gated(texts: DataFrame) -> DataFrame:
    why = gate(F.col("_metadata.file_name"), F.col("_metadata.file_size"))
    return texts.select(F.col("_metadata.file_path").alias("file"), "value", why.alias("gated")).withColumn(
        "value", F.when(F.col("gated").isNull(), F.col("value"))
    )


def _text(value: Column) -> Column:
    # A missing attribute reads as empty text.
    return F.coalesce(value, F.lit(""))


def _list(name: str) -> Column:
    return F.coalesce(F.col(f"d.`{name}`"), F.array())


# A start tag up to its end; ">" may stand in quotes.  Possessive: Java repeats such groups without recursion.
TAG_REST = r"(?=[\s/>])[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>"


def _bare(value: Column) -> Column:
    """The text without comments and literal text."""
    return F.regexp_replace(value, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")


def _grouped(value: Column) -> Column:
    """Whether elements other than those that are read, or the root inside itself, may hold some of them."""
    known = "|".join(["behavior", *READ_TAGS])
    return F.contains(value, F.lit("<behavior")) & (_bare(value).rlike(f"<(?!(?:{known})[\\s/>])[A-Za-z_:]") | (F.regexp_count(_bare(value), F.lit(r"<behavior[\s/>]")) > 1))


def _flat(value: Column) -> Column:
    """The document with its read elements, found at any depth, right under the root, in their order."""
    bare = _bare(value)
    elements = F.regexp_extract_all(bare, F.lit(f"<(?:{'|'.join(READ_TAGS)}){TAG_REST}"), F.lit(0))
    alone = F.transform(elements, lambda e: F.regexp_replace(e, r"/?>$", "/>"))
    return F.concat(F.regexp_extract(bare, f"<behavior{TAG_REST}", 0), F.array_join(alone, ""), F.lit("</behavior>"))


def _whole_number(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast("bigint"))


def parse_documents(docs: DataFrame, keys: list[str], legacy_other_unit: bool = False, strict: bool = False) -> DataFrame:
    """``keys``, start_ts, delays (seconds), changes (device, property, value),
    zones (device, zone) and ``reason``, which is NULL for a usable document.

    Elements are taken in the order of the document, at any depth.  With
    ``strict``, a document in which an attribute is missing is not usable either.
    """
    options = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}
    gated = F.col("gated") if "gated" in docs.columns else F.lit(None).cast("string")
    grouped = docs.select(*keys, "value", gated.alias("gated"), _grouped(F.col("value")).alias("grouped"))
    parsed = grouped.select(
        *keys,
        F.from_xml(F.when(F.col("grouped"), _flat(F.col("value"))).otherwise(F.col("value")), DOCUMENT, options).alias("d"),
        # Whether a document that is flattened was one at all.
        F.from_xml(F.when(F.col("grouped"), F.col("value")), "_startdate string, _corrupt_record string", options).alias("whole"),
        "value",
        "gated",
    )
    lists = parsed.select(
        *keys,
        "value",
        "gated",
        (F.col("d._corrupt_record").isNotNull() | F.col("whole._corrupt_record").isNotNull() | ~F.col("value").rlike(r">\s*$")).alias("broken"),
        parse_start_ts(F.col("d._startdate")).alias("start_ts"),
        F.transform(
            _list("delay"), lambda x: delay_seconds(_whole_number(x["_value"]), _text(x["_unit"]), legacy_other_unit)
        ).alias("delays"),
        F.transform(
            _list("set-device-property"),
            lambda x: F.struct(
                _text(x["_deviceId"]).alias("device"),
                _text(x["_property"]).alias("property"),
                normalise_value(_text(x["_value"])).alias("value"),
            ),
        ).alias("changes"),
        F.transform(
            _list("move-device-zone"),
            lambda x: F.struct(_text(x["_deviceId"]).alias("device"), _text(x["_zoneId"]).alias("zone")),
        ).alias("zones"),
        (
            F.exists(_list("delay"), lambda x: x["_value"].isNull() | x["_unit"].isNull())
            | F.exists(
                _list("set-device-property"),
                lambda x: x["_deviceId"].isNull() | x["_property"].isNull() | x["_value"].isNull(),
            )
            | F.exists(_list("move-device-zone"), lambda x: x["_deviceId"].isNull() | x["_zoneId"].isNull())
        ).alias("gaps"),
    )
    reason = (
        F.when(F.col("gated").isNotNull(), F.col("gated"))
        .when(F.col("broken"), "not XML")
        .when(~F.col("value").contains("<behavior"), "no behaviour")
        .when(F.col("start_ts").isNull(), "bad start date")
        .when(F.exists("delays", lambda x: x.isNull()), "bad delay")
        .when(F.size("delays") < F.size("changes"), "fewer delays than changes")
    )
    if strict:
        reason = reason.when(F.col("gaps"), "missing attribute")
    return lists.withColumn("reason", reason).select(
        *keys, "start_ts", "delays", "changes", "zones", "reason"
    )


def rejected_documents(parsed: DataFrame, keys: list[str]) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select(*keys, "reason")


def _elements(parsed: DataFrame, keys: list[str], values: Column) -> DataFrame:
    """(keys, start_ts, pos, x) of the usable documents.

    Documents are left out inside and after the explode: a filter below it
    would be pushed to the scan and parse each document once more per condition.
    """
    usable = F.when(F.col("reason").isNull(), values)
    return parsed.select(*keys, "start_ts", F.posexplode_outer(usable).alias("pos", "x")).filter(
        F.col("pos").isNotNull()
    )


def prefix_delays(elements: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``elapsed``, the sum of the delays of a document up to ``pos``.

    A group is what one document, hence one row, held.
    """
    upto = W.partitionBy(*keys).orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    return elements.withColumn("elapsed", F.sum("delay").over(upto))


def delay_list(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, delay, elapsed, at_ts) of all delays of the usable documents."""
    exploded = _elements(parsed, keys, F.col("delays")).withColumnRenamed("x", "delay")
    return prefix_delays(exploded, keys).select(*keys, "pos", "delay", "elapsed", _at().alias("at_ts"))


def _at() -> Column:
    return from_seconds(seconds(F.col("start_ts")) + F.col("elapsed"))


def _zones_by_device(zones: Column) -> Column:
    """Entries (device, zones in document order): sorted once, then cut where the device changes."""
    placed = F.array_sort(F.transform(zones, lambda z, i: F.struct(z["device"].alias("device"), i.alias("at"), z["zone"].alias("zone"))))

    def starts_of(rows: Column) -> Column:
        places = F.when(F.size(rows) > 0, F.sequence(F.lit(1), F.size(rows))).otherwise(F.array().cast("array<int>"))
        before = lambda i: F.element_at(rows, F.greatest(i - 1, F.lit(1)))["device"]
        return F.struct(rows.alias("rows"), F.filter(places, lambda i: (i == 1) | (F.element_at(rows, i)["device"] != before(i))).alias("starts"))

    def cut(found: Column) -> Column:
        rows, starts = found["rows"], found["starts"]
        ends = F.when(F.size(starts) > 0, F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(rows) + 1)))
        return F.zip_with(
            starts,
            F.coalesce(ends, starts),
            lambda a, b: F.struct(F.element_at(rows, a)["device"], F.transform(F.slice(rows, a, b - a), lambda r: r["zone"]).alias("zones")),
        )

    # Arrays of one element keep what is computed once from being computed for every element.
    return F.flatten(F.transform(F.transform(F.array(placed), starts_of), cut))


def paired_changes(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, delay, elapsed, event_ts, id_device, property_device,
    value_property_device, zones): the i-th change with the i-th delay.

    ``zones`` are the zones of the device in document order.
    """
    by_device = F.map_from_entries(_zones_by_device(F.col("zones")))
    none = F.array().cast("array<string>")

    def pairs(zones_of: Column) -> Column:
        return F.zip_with(
            F.col("changes"),
            F.slice(F.col("delays"), F.lit(1), F.size("changes")),
            lambda c, d: F.struct(
                c["device"].alias("device"),
                c["property"].alias("property"),
                c["value"].alias("value"),
                d.alias("delay"),
                F.coalesce(F.try_element_at(zones_of, c["device"]), none).alias("zones"),
            ),
        )

    paired = F.flatten(F.transform(F.array(by_device), pairs))
    exploded = _elements(parsed, keys, paired).select(*keys, "start_ts", "pos", "x.*")
    return prefix_delays(exploded, keys).select(
        *keys,
        "pos",
        "delay",
        "elapsed",
        _at().alias("event_ts"),
        F.col("device").alias("id_device"),
        F.col("property").alias("property_device"),
        F.col("value").alias("value_property_device"),
        "zones",
    )


def with_area(changes: DataFrame) -> DataFrame:
    """One row per change: ``area`` is the first zone of the device, NULL if it has none."""
    return changes.withColumn("area", F.get("zones", F.lit(0))).drop("zones")


def zone_conflicts(changes: DataFrame) -> DataFrame:
    """Changes of devices without a zone, and the second and later zones of the others."""
    odd = changes.withColumn(
        "extra",
        F.when(F.size("zones") == 0, F.array(F.lit(None).cast("string"))).otherwise(
            F.slice("zones", F.lit(2), F.greatest(F.size("zones"), F.lit(1)))
        ),
    )
    return odd.withColumn("extra", F.explode("extra")).withColumn(
        "reason", F.when(F.col("extra").isNull(), "no zone").otherwise("second zone")
    ).drop("zones")


def behaviour_events(docs: DataFrame, keys: list[str], legacy_other_unit: bool = False, strict: bool = False) -> DataFrame:
    """Readings of behaviour documents: keys, pos, event_ts and the fields of a device line."""
    changes = with_area(paired_changes(parse_documents(docs, keys, legacy_other_unit, strict), keys))
    return changes.drop("delay", "elapsed")
