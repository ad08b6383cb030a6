"""Explicit schemas and column groups of the sensor data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the sensor dumps, the weather table and the derived sets.
MEASURES = ["tmp", "hum", "CO2", "VOC", "vis", "IR"]
DASHBOARD_MEASURES = ["tmp", "hum", "CO2", "VOC", "vis", "IR", "BLE"]
RADIO_COLUMNS = [
    "WIFI", "bandwidth", "channel_rssi", "channel_index", "device_id",
    "gateway", "f_cnt", "spreading_factor", "rssi", "snr",
]
WEATHER_MEASURES = ["tavg", "tmin", "tmax", "wdir", "wspd", "wpgt", "pres"]
FOREST_FEATURES = ["CO2", "tmp", "vis", "hum", "VOC"]
ZERO_CHECKED = ["CO2", "VOC", "tmp", "hum"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
LECTURE_SLOTS = [
    (8.0, 9.5), (9.833, 11.333), (11.5, 13.0), (14.0, 15.5), (15.666, 17.166), (17.333, 18.833),
]

TIME = "date_time"
ROOM = "room_number"

READING_TYPES: dict[str, T.DataType] = {
    "date_time": T.StringType(),
    "device_id": T.StringType(),
    "tmp": T.DoubleType(),
    "hum": T.DoubleType(),
    "CO2": T.DoubleType(),
    "VOC": T.DoubleType(),
    "vis": T.DoubleType(),
    "IR": T.DoubleType(),
    "WIFI": T.DoubleType(),
    "BLE": T.DoubleType(),
    "rssi": T.DoubleType(),
    "channel_rssi": T.DoubleType(),
    "snr": T.StringType(),
    "gateway": T.StringType(),
    "channel_index": T.DoubleType(),
    "spreading_factor": T.DoubleType(),
    "bandwidth": T.DoubleType(),
    "f_cnt": T.DoubleType(),
}

READINGS = T.StructType([T.StructField(name, kind) for name, kind in READING_TYPES.items()])

WEATHER = T.StructType(
    [T.StructField("date", T.TimestampNTZType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in ["tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "wpgt", "pres", "tsun"]
    ]
)


def numeric_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.NumericType)]
