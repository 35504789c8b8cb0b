"""Table layouts and vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

# One reading of one device.  house_id and event_id are additions to the five
# fields of a device line: house_id keeps houses apart, event_id breaks ties.
DEVICE_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("house_id", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("id_device", T.StringType()),
        T.StructField("property_device", T.StringType()),
        T.StructField("value_property_device", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# The generic event table of the test data.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Fields of a device line, in file order.
LINE_FIELDS = ["event_ts", "id_device", "property_device", "value_property_device", "area"]

# Names as the devices send them (the third one is spelled so).
POWER = "powerStatus"
PRESENCE = "sensedPresence"
DOOR = "doorWindowSensor.opneningDetection"
FLOOD = "flood.alarm"
TEMPERATURE = "thermometer.currentTemperature"
CARBON_DIOXIDE = "carbonDioxydeSensor.currentConcentration"
CARBON_MONOXIDE = "carbonMonoxydeSensor.currentConcentration"

ON = "on"
OFF = "off"

LINE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
START_TIME_FORMAT = "dd/MM/yyyy-HH:mm:ss"
