"""Sensor-shaped views over whole test tables, the same in Spark and in DuckDB.

Measures are multiples of 1/8, so sums of them are exact and do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomtide.session import use_utc

# Rooms 6 and 7 report two days in six: their days are spread out, no row is left out.
READINGS_SPARK = """
SELECT event_id,
  CASE WHEN user_id % 8 < 6 THEN ts
       ELSE ts + make_dt_interval((datediff(ts, DATE'2024-01-01') div 2) * 4) END AS date_time,
  concat('lab-co2-', CASE WHEN user_id % 8 = 5 THEN 'n' ELSE 'm' END, lpad(CAST(user_id % 8 AS STRING), 3, '0')) AS device_id,
  CAST(400 + floor(value * 20) AS DOUBLE) AS CO2,
  CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 450 + (event_id * 37) % 600 END AS DOUBLE) AS VOC,
  5 + CAST((event_id * 13) % 400 AS DOUBLE) / 8 AS tmp,
  CAST((event_id * 7) % 880 AS DOUBLE) / 8 AS hum,
  CAST(floor(value * 8) AS DOUBLE) / 8 AS vis,
  CAST(event_id % 97 AS DOUBLE) AS IR,
  CAST(get_json_object(props, '$.k') AS DOUBLE) AS BLE,
  CAST(CASE WHEN user_id % 8 = 5 THEN NULL ELSE user_id % 8 END AS DOUBLE) AS WIFI,
  CASE WHEN event_id % 89 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value * 8) AS BIGINT) AS STRING) END AS snr
FROM {events}
"""

READINGS_SQL = """
SELECT event_id,
  CASE WHEN user_id % 8 < 6 THEN ts
       ELSE ts + to_days(CAST((date_diff('day', TIMESTAMP '2024-01-01', ts) // 2) * 4 AS INTEGER)) END AS date_time,
  concat('lab-co2-', CASE WHEN user_id % 8 = 5 THEN 'n' ELSE 'm' END, lpad(CAST(user_id % 8 AS VARCHAR), 3, '0')) AS device_id,
  CAST(400 + floor(value * 20) AS DOUBLE) AS CO2,
  CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 450 + (event_id * 37) % 600 END AS DOUBLE) AS VOC,
  5 + CAST((event_id * 13) % 400 AS DOUBLE) / 8 AS tmp,
  CAST((event_id * 7) % 880 AS DOUBLE) / 8 AS hum,
  CAST(floor(value * 8) AS DOUBLE) / 8 AS vis,
  CAST(event_id % 97 AS DOUBLE) AS IR,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BLE,
  CAST(CASE WHEN user_id % 8 = 5 THEN NULL ELSE user_id % 8 END AS DOUBLE) AS WIFI,
  CASE WHEN event_id % 89 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value * 8) AS BIGINT) AS VARCHAR) END AS snr
FROM events
"""

# Readings with their room and only unique (time, room) pairs, as after cleaning.
ROOMS_SPARK = "SELECT *, substring_index(device_id, '-', -1) AS room_number FROM ({readings})"
ROOMS_SQL = "SELECT *, split_part(device_id, '-', 3) AS room_number FROM readings"

# One weather row per order date, moved to the years of the readings; every 11th day lacks a gust.
WEATHER_SPARK = """
SELECT CAST(date_add(day, 9131) AS TIMESTAMP_NTZ) AS date,
  (low + high) / 2 AS tavg, low AS tmin, high AS tmax, CAST(0 AS DOUBLE) AS prcp, CAST(NULL AS DOUBLE) AS snow,
  wdir, n / 8 AS wspd, CASE WHEN unix_date(day) % 11 = 0 THEN NULL ELSE n / 4 END AS wpgt, pres, CAST(NULL AS DOUBLE) AS tsun
FROM (
  SELECT to_date(o_orderdate) AS day,
    CAST(floor(min(o_totalprice) / 4096) AS DOUBLE) / 8 AS low, CAST(floor(max(o_totalprice) / 4096) AS DOUBLE) / 8 AS high,
    CAST(min(o_custkey) % 360 AS DOUBLE) AS wdir, CAST(count(*) AS DOUBLE) AS n, CAST(1000 + max(o_custkey) % 40 AS DOUBLE) AS pres
  FROM {orders} GROUP BY to_date(o_orderdate))
"""

WEATHER_SQL = """
SELECT CAST(day + 9131 AS TIMESTAMP) AS date,
  (low + high) / 2 AS tavg, low AS tmin, high AS tmax, CAST(0 AS DOUBLE) AS prcp, CAST(NULL AS DOUBLE) AS snow,
  wdir, n / 8 AS wspd, CASE WHEN date_diff('day', DATE '1970-01-01', day) % 11 = 0 THEN NULL ELSE n / 4 END AS wpgt, pres,
  CAST(NULL AS DOUBLE) AS tsun
FROM (
  SELECT CAST(o_orderdate AS DATE) AS day,
    CAST(floor(min(o_totalprice) / 4096) AS DOUBLE) / 8 AS low, CAST(floor(max(o_totalprice) / 4096) AS DOUBLE) / 8 AS high,
    CAST(min(o_custkey) % 360 AS DOUBLE) AS wdir, CAST(count(*) AS DOUBLE) AS n, CAST(1000 + max(o_custkey) % 40 AS DOUBLE) AS pres
  FROM orders GROUP BY CAST(o_orderdate AS DATE))
"""

# Hour-floored times give many copies of each (time, room).
DUP_SPARK = """
SELECT CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS date_time, CAST(user_id % 8 AS STRING) AS room_number,
  event_id, event_type, CAST(floor(value * 8) AS DOUBLE) / 8 AS vis
FROM {events}
"""
DUP_SQL = """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_time, CAST(user_id % 8 AS VARCHAR) AS room_number,
  event_id, event_type, CAST(floor(value * 8) AS DOUBLE) / 8 AS vis
FROM events
"""

# CO2 spikes during which the other sensors often stand still.
SPIKY_SPARK = """
SELECT event_id, ts AS date_time, CAST(CASE WHEN value > 20 THEN 30000 ELSE 400 END AS DOUBLE) AS CO2,
  CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE 450 + 50 * ((event_id div 7) % 2) END AS DOUBLE) AS VOC,
  CAST(20 + (event_id div 11) % 2 AS DOUBLE) AS tmp, CAST((event_id % 3) * 20 AS DOUBLE) AS hum,
  CAST((event_id div 13) % 2 AS DOUBLE) AS BLE
FROM {events}
"""
SPIKY_SQL = SPIKY_SPARK.replace(" div ", " // ").replace("{events}", "events")

# Shipped lines as readings: one series per supplier, bins of one day.
LINES_SPARK = """
SELECT l_shipdate AS date_time, CAST(l_suppkey AS STRING) AS room_number, l_quantity AS quantity,
  CAST(floor(l_extendedprice) AS DOUBLE) AS price
FROM {lineitem}
"""
LINES_SQL = LINES_SPARK.replace("STRING", "VARCHAR").replace("{lineitem}", "lineitem")

VIEWS_SQL = {
    "readings": READINGS_SQL,
    "rooms": ROOMS_SQL,
    "weather": WEATHER_SQL,
    "readings_dup": DUP_SQL,
    "readings_spiky": SPIKY_SQL,
    "lines": LINES_SQL,
}
NEEDS = {"rooms": ["readings"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str, **tables: str) -> DataFrame:
    use_utc(spark)
    return spark.sql(text, **{k: table(spark, sf_dir, v) for k, v in tables.items()})


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, READINGS_SPARK, events="events")


def rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ROOMS_SPARK.replace("({readings})", "{readings}"), readings=readings(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, WEATHER_SPARK, orders="orders")


def readings_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, DUP_SPARK, events="events")


def readings_spiky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SPIKY_SPARK, events="events")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, LINES_SPARK, lineitem="lineitem")


def with_views(sql: str, *names: str) -> str:
    """Put the named views before a query as common table expressions."""
    wanted: list[str] = []
    for name in names:
        for n in [*NEEDS.get(name, []), name]:
            if n not in wanted:
                wanted.append(n)
    ctes = ", ".join(f"{n} AS ({VIEWS_SQL[n].strip()})" for n in wanted)
    sql = sql.strip()
    if not wanted:
        return sql
    if sql[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes}, {sql[15:]}"
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes}, {sql[5:]}"
    return f"WITH {ctes} {sql}"
