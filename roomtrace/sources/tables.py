"""Device readings from columnar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roomtrace import schema as S

# Area by the remainder of k divided by 13; 11 and 12 are the hallway too.
AREAS = [
    "bedroom",
    "sleep",
    "wardrobe",
    "chair_bedroom",
    "bathroom",
    "toilet",
    "washbasin",
    "kitchen",
    "chair_kitchen",
    "livingroom",
    "armchair",
    "hallway",
    "hallway",
]

# The event types that can carry a property; the others come as "error".
EVENT_TYPES = {S.PRESENCE: ["view", "click"], S.POWER: ["purchase"], S.DOOR: ["signup"]}
ON_FROM = 35.0


def read_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(S.RAW_EVENTS).parquet(f"{sf_dir}/events.parquet")


def as_device_events(raw: DataFrame) -> DataFrame:
    """Readings as the generic event table stands for them: the number ``k`` in
    ``props`` picks device and area, ``event_type`` the property, ``value`` the reading."""
    k = F.col("k")
    area = F.element_at(F.array(*[F.lit(a) for a in AREAS]), (k % 13 + 1).cast("int"))
    kind = F.col("event_type")
    prop = (
        F.when(kind.isin("view", "click"), S.PRESENCE)
        .when(kind == "purchase", S.POWER)
        .when(kind == "signup", S.DOOR)
        .when(k % 4 == 0, S.TEMPERATURE)
        .when(k % 4 == 1, S.CARBON_DIOXIDE)
        .when(k % 4 == 2, S.CARBON_MONOXIDE)
        .otherwise(S.FLOOD)
    )
    reading = F.when(
        (kind == "error") & (k % 4 != 3), F.floor(F.col("value") * 10).cast("bigint").cast("string")
    ).otherwise(F.when(F.col("value") >= ON_FROM, S.ON).otherwise(S.OFF))
    return raw.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int")).select(
        "event_id",
        F.col("user_id").alias("house_id"),
        F.col("ts").alias("event_ts"),
        F.concat(F.lit("dev-"), k.cast("string")).alias("id_device"),
        prop.alias("property_device"),
        reading.alias("value_property_device"),
        area.alias("area"),
    )


def device_events(
    spark: SparkSession, sf_dir: str, properties: list[str] | None = None, reading: str | None = None
) -> DataFrame:
    """Readings of the event table.

    ``properties`` and ``reading`` (only S.ON) name what the caller will filter
    for anyway; they leave out events that cannot match, in terms the parquet
    scan can check itself.
    """
    raw = read_raw_events(spark, sf_dir)
    if properties is not None:
        kinds = {k for p in properties for k in EVENT_TYPES.get(p, ["error"])}
        raw = raw.filter(F.col("event_type").isin(sorted(kinds)))
    if reading == S.ON:
        raw = raw.filter(F.col("value") >= ON_FROM)
    return as_device_events(raw)
