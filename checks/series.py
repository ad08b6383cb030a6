"""Queries over joins, time bins and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from roomtide.functions import calendar, climate
from roomtide.operators import lags, timeseries
from roomtide.operators.asof import asof_join, asof_nearest
from roomtide.operators.ordered import RowOrder
from roomtide.schema import LECTURE_SLOTS, WEATHER_MEASURES, WEEKDAYS
from roomtide.sources.weather import clean_weather

from . import views
from .registry import as_times, query, rounded

# Interval form of the nearest match: half-way marks between neighbouring weather rows, ties to the earlier.
SPANS = """clean AS (SELECT * FROM weather WHERE wpgt IS NOT NULL),
  spans AS (SELECT *, lag(date) OVER (ORDER BY date) AS before, lead(date) OVER (ORDER BY date) AS after FROM clean)"""
NEAREST = """(before IS NULL OR 2 * epoch_us(date_time) > epoch_us(before) + epoch_us(date))
  AND (after IS NULL OR 2 * epoch_us(date_time) <= epoch_us(date) + epoch_us(after))"""


@query(
    "asof_nearest_weather",
    f"""WITH {SPANS} SELECT event_id, date_time, date, tavg, tmin, tmax, prcp, wdir, wspd, wpgt, pres
    FROM readings LEFT JOIN spans ON {NEAREST}""",
    ("readings", "weather"),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "date_time")
    return asof_nearest(df, clean_weather(views.weather(spark, sf)))


@query(
    "asof_nearest_large",
    f"""WITH {SPANS} SELECT event_id, date_time, date, tavg, pres FROM readings LEFT JOIN spans ON {NEAREST}""",
    ("readings", "weather"),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "date_time")
    right = clean_weather(views.weather(spark, sf)).select("date", "tavg", "pres")
    return asof_nearest(df, right, left_order=["event_id"], broadcast_bytes=0)


# Weather moved to the Monday before: several rows at one time.
_WEEKLY = "SELECT date_trunc('week', date) AS date, tavg, pres FROM weather WHERE wpgt IS NOT NULL"


@query(
    "asof_nearest_duplicates",
    f"""WITH w AS ({_WEEKLY}), d AS (SELECT DISTINCT date FROM w),
    spans AS (SELECT date, lag(date) OVER (ORDER BY date) AS before, lead(date) OVER (ORDER BY date) AS after FROM d),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY tavg, pres) AS first_place,
      row_number() OVER (PARTITION BY date ORDER BY tavg DESC, pres DESC) AS last_place FROM w)
    SELECT path, event_id, date_time, spans.date, tavg, pres FROM readings JOIN spans ON {NEAREST}
    JOIN ranked ON ranked.date = spans.date AND CASE WHEN date_time >= spans.date THEN last_place = 1 ELSE first_place = 1 END,
    (VALUES ('broadcast'), ('ordered')) p(path)""",
    ("readings", "weather"),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "date_time")
    right = clean_weather(views.weather(spark, sf)).select("date", "tavg", "pres")
    right = right.withColumn("date", F.date_trunc("week", "date").cast("timestamp_ntz"))
    ways = [
        asof_nearest(df, right, tiebreak=["tavg", "pres"], left_order=["event_id"], broadcast_bytes=most).withColumn("path", F.lit(path))
        for path, most in (("broadcast", 1 << 30), ("ordered", 0))
    ]
    return as_times(ways[0].unionByName(ways[1]), "date")


# Readings of one kind matched with the last (next) reading of another kind in the same room.
_LEFT = "SELECT event_id, date_time, room_number FROM rooms WHERE vis > 4"
_RIGHT = 'SELECT room_number, date_time AS seen_at, CAST(event_id AS DOUBLE) AS seen_id, "CO2" FROM rooms WHERE vis <= 4'


@query(
    "asof_backward_by_room",
    f"""SELECT l.event_id, l.date_time, l.room_number, r.seen_at, r.seen_id, r."CO2"
    FROM ({_LEFT}) l LEFT JOIN LATERAL (SELECT * FROM ({_RIGHT}) r WHERE r.room_number = l.room_number AND r.seen_at <= l.date_time
      AND r.seen_at >= l.date_time - INTERVAL 2 HOURS ORDER BY r.seen_at DESC, r.seen_id DESC LIMIT 1) r ON true""",
    ("rooms",),
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return asof_join(left, right, "date_time", "seen_at", "backward", ["room_number"], "2h", ["event_id"], ["seen_id"])


@query(
    "asof_forward",
    f"""SELECT l.event_id, l.date_time, l.room_number, r.seen_at, r.seen_id, r."CO2"
    FROM ({_LEFT}) l ASOF LEFT JOIN ({_RIGHT}) r ON r.room_number = l.room_number AND r.seen_at >= l.date_time""",
    ("rooms",),
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return asof_join(left, right, "date_time", "seen_at", "forward", ["room_number"], None, ["event_id"], ["seen_id"])


@query(
    "asof_nearest_by_room",
    f"""WITH l AS ({_LEFT}), r AS ({_RIGHT}),
    back AS (SELECT l.event_id, r.* EXCLUDE (room_number) FROM l JOIN LATERAL (SELECT * FROM r WHERE r.room_number = l.room_number
      AND r.seen_at <= l.date_time ORDER BY r.seen_at DESC, r.seen_id DESC LIMIT 1) r ON true),
    ahead AS (SELECT l.event_id, r.* EXCLUDE (room_number) FROM l JOIN LATERAL (SELECT * FROM r WHERE r.room_number = l.room_number
      AND r.seen_at > l.date_time ORDER BY r.seen_at, r.seen_id LIMIT 1) r ON true),
    near AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY far, side) AS place
      FROM (SELECT b.*, 0 AS side, date_time - seen_at AS far FROM back b JOIN l USING (event_id)
        UNION ALL SELECT a.*, 1, seen_at - date_time FROM ahead a JOIN l USING (event_id)))
    SELECT l.event_id, l.date_time, l.room_number, seen_at, seen_id, "CO2"
    FROM l LEFT JOIN near ON near.event_id = l.event_id AND place = 1 AND far <= INTERVAL 90 MINUTES""",
    ("rooms",),
)
def _(spark, sf):
    left, right = _asof_sides(spark, sf)
    return asof_join(left, right, "date_time", "seen_at", "nearest", ["room_number"], "90min", ["event_id"], ["seen_id"])


def _asof_sides(spark, sf):
    df = views.rooms(spark, sf)
    left = df.filter("vis > 4").select("event_id", "date_time", "room_number")
    right = df.filter("vis <= 4").select(
        "room_number", F.col("date_time").alias("seen_at"), F.col("event_id").cast("double").alias("seen_id"), "CO2"
    )
    return left, right


def dense_sql(source: str, size: str, select: str, by: str = "room_number", label: str = "date_time") -> str:
    """Bins of a size that divides a day, empty ones kept, per series."""
    return f"""ends AS (SELECT {by}, min(b) AS first, max(b) AS last FROM (SELECT {by}, time_bucket(INTERVAL '{size}', {label}) AS b FROM {source}) GROUP BY {by}),
    grid AS (SELECT {by}, unnest(generate_series(first, last, INTERVAL '{size}')) AS bin FROM ends),
    binned AS (SELECT {by}, time_bucket(INTERVAL '{size}', {label}) AS bin, {select} FROM {source} GROUP BY ALL),
    dense AS (SELECT * FROM grid LEFT JOIN binned USING ({by}, bin))"""


_MEAN3 = 'avg("CO2") AS "CO2", avg(tmp) AS tmp, avg("BLE") AS "BLE"'


@query(
    "resample_mean",
    f"""WITH {dense_sql("rooms", "1 day", _MEAN3)} SELECT room_number, bin AS date_time, "CO2", tmp, "BLE" FROM dense""",
    ("rooms",),
)
def _(spark, sf):
    return timeseries.resample_mean(views.rooms(spark, sf), "1d", ["CO2", "tmp", "BLE"])


@query(
    "resample_mean_odd_size",
    """WITH origins AS (SELECT room_number, date_trunc('day', min(date_time)) AS origin, max(date_time) AS newest FROM rooms GROUP BY ALL),
    binned AS (SELECT room_number, time_bucket(INTERVAL '7 hours', date_time, CAST(origin AS TIMESTAMP)) AS bin, avg("CO2") AS "CO2"
      FROM rooms JOIN origins USING (room_number) GROUP BY ALL),
    ends AS (SELECT room_number, min(bin) AS first, max(bin) AS last FROM binned GROUP BY ALL),
    grid AS (SELECT room_number, unnest(generate_series(first, last, INTERVAL '7 hours')) AS bin FROM ends)
    SELECT room_number, bin AS date_time, "CO2" FROM grid LEFT JOIN binned USING (room_number, bin)""",
    ("rooms",),
)
def _(spark, sf):
    return timeseries.resample_mean(views.rooms(spark, sf), "7h", ["CO2"])


_ROLL_FRAME = "(PARTITION BY room_number ORDER BY bin RANGE BETWEEN INTERVAL '2 days 23:59:59.999999' PRECEDING AND CURRENT ROW)"


@query(
    "rolling_time_mean",
    f"""WITH {dense_sql("rooms", "1 day", _MEAN3)}
    SELECT room_number, bin AS date_time, round(avg("CO2") OVER w, 6) AS "CO2", round(avg(tmp) OVER w, 6) AS tmp
    FROM dense WINDOW w AS {_ROLL_FRAME}""",
    ("rooms",),
)
def _(spark, sf):
    binned = timeseries.resample_mean(views.rooms(spark, sf), "1d", ["CO2", "tmp"])
    return rounded(timeseries.rolling_time_mean(binned, "3d", "1d", ["CO2", "tmp"]), "CO2", "tmp")


@query(
    "resample_roll",
    f"""WITH {dense_sql("rooms", "1 day", _MEAN3 + ', arg_min(device_id, (date_time, event_id)) AS device_id')},
    rolled AS (SELECT room_number, bin AS date_time, round(avg("CO2") OVER w, 6) AS "CO2", round(avg(tmp) OVER w, 6) AS tmp,
      round(avg("BLE") OVER w, 6) AS "BLE" FROM dense WINDOW w AS {_ROLL_FRAME})
    SELECT * FROM rolled WHERE "CO2" IS NOT NULL AND tmp IS NOT NULL AND "BLE" IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("date_time", "room_number", "CO2", "tmp", "BLE")
    return rounded(timeseries.resample_roll(df, "3d", "1d"), "CO2", "tmp", "BLE")


@query(
    "reunite_non_numeric",
    """WITH binned AS (SELECT room_number, time_bucket(INTERVAL '1 hour', date_time) AS date_time, avg(vis) AS vis,
      arg_min(snr, (date_time, event_id)) AS snr FROM rooms GROUP BY ALL)
    SELECT room_number, date_time, round(vis, 6) AS vis, snr FROM binned WHERE snr IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf)
    ties = df.select("date_time", "room_number", "vis", "snr", F.col("event_id").cast("string").alias("id"))
    rolled = timeseries.resample_roll(ties.drop("id"), "1h", "1h", tiebreak=["vis"])
    return rounded(rolled, "vis")


@query(
    "resample_roll_off",
    """SELECT event_id, date_time, room_number, device_id, "CO2", "WIFI", snr FROM rooms
    WHERE "CO2" IS NOT NULL AND "WIFI" IS NOT NULL AND snr IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    """Without rolling, complete readings pass through as they are."""
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "device_id", "CO2", "WIFI", "snr")
    return timeseries.resample_roll(df, roll=False)


@query(
    "resample_roll_lines",
    f"""WITH {dense_sql("lines", "1 day", "avg(quantity) AS quantity, avg(price) AS price")},
    rolled AS (SELECT room_number, bin AS date_time, round(avg(quantity) OVER w, 6) AS quantity, round(avg(price) OVER w, 6) AS price
      FROM dense WINDOW w AS (PARTITION BY room_number ORDER BY bin RANGE BETWEEN INTERVAL '29 days 23:59:59.999999' PRECEDING AND CURRENT ROW))
    SELECT * FROM rolled WHERE quantity IS NOT NULL AND price IS NOT NULL""",
    ("lines",),
)
def _(spark, sf):
    return rounded(timeseries.resample_roll(views.lines(spark, sf), "30d", "1d"), "quantity", "price")


# A window of 4,320 bins.
@query(
    "resample_roll_minutes",
    f"""WITH {dense_sql("rooms", "1 minute", 'avg("CO2") AS "CO2", avg(tmp) AS tmp')},
    rolled AS (SELECT room_number, bin AS date_time, round(avg("CO2") OVER w, 6) AS "CO2", round(avg(tmp) OVER w, 6) AS tmp
      FROM dense WINDOW w AS (PARTITION BY room_number ORDER BY bin RANGE BETWEEN INTERVAL '2 days 23:59:59.999999' PRECEDING AND CURRENT ROW))
    SELECT * FROM rolled WHERE "CO2" IS NOT NULL AND tmp IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("date_time", "room_number", "CO2", "tmp")
    return rounded(timeseries.resample_roll(df, "3d", "1min"), "CO2", "tmp")


@query(
    "room_diff",
    """SELECT event_id, date_time, room_number, "CO2", tmp, vis, tmp - lag(tmp) OVER w AS tmp_diff, vis - lag(vis) OVER w AS vis_diff
    FROM rooms WINDOW w AS (PARTITION BY room_number ORDER BY date_time, event_id)""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2", "tmp", "vis")
    return timeseries.room_diff(df, RowOrder(df, ["date_time", "event_id"], ["room_number"]))


@query(
    "rolling_count_mean",
    f"""WITH {dense_sql("(SELECT *, 1 AS one FROM rooms)", "1 day", _MEAN3, by="one")}
    SELECT bin AS date_time, CASE WHEN count("CO2") OVER w = 5 THEN round(avg("CO2") OVER w, 6) END AS "CO2",
      CASE WHEN count(tmp) OVER w = 5 THEN round(avg(tmp) OVER w, 6) END AS tmp
    FROM dense WINDOW w AS (ORDER BY bin ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    ("rooms",),
)
def _(spark, sf):
    daily = timeseries.calendar_resample(views.rooms(spark, sf), ["CO2", "tmp"], "1d")
    return rounded(timeseries.rolling_count_mean(daily, ["CO2", "tmp"]), "CO2", "tmp")


@query(
    "calendar_resample",
    f"""WITH {dense_sql("(SELECT *, 1 AS one FROM rooms)", "1 day", _MEAN3, by="one")} SELECT bin AS date_time, "CO2", tmp, "BLE" FROM dense""",
    ("rooms",),
)
def _(spark, sf):
    return timeseries.calendar_resample(views.rooms(spark, sf), ["CO2", "tmp", "BLE"])


@query(
    "align_measures",
    f"""WITH {dense_sql("(SELECT *, 1 AS one FROM rooms)", "1 day", _MEAN3, by="one")} SELECT bin AS date_time, "CO2", tmp FROM dense""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf)
    return timeseries.align_measures([timeseries.calendar_resample(df, [c]) for c in ("CO2", "tmp")])


@query(
    "cyclic_resample",
    """SELECT 'hour' AS cycle, CAST(hour(date_time) AS INTEGER) AS date_time, avg("CO2") AS "CO2", avg("BLE") AS "BLE" FROM rooms GROUP BY ALL
    UNION ALL SELECT 'day', CAST(day(date_time) AS INTEGER), avg("CO2"), avg("BLE") FROM rooms GROUP BY ALL
    UNION ALL SELECT 'weekday', CAST(isodow(date_time) - 1 AS INTEGER), avg("CO2"), avg("BLE") FROM rooms GROUP BY ALL""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf)
    parts = [
        timeseries.cyclic_resample(df, ["CO2", "BLE"], freq, weekday).withColumn("cycle", F.lit(name))
        for name, freq, weekday in (("hour", "h", False), ("day", "d", False), ("weekday", "d", True))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_DAYS = dense_sql("(SELECT *, 1 AS one FROM rooms)", "1 day", "count(*) AS n", by="one")


@query("missing_bins", f"WITH {_DAYS} SELECT bin AS date_time, n IS NULL AS missing FROM dense", ("rooms",))
def _(spark, sf):
    return timeseries.missing_bins(views.rooms(spark, sf), "1d")


@query(
    "missing_bins_hourly",
    f"""WITH {dense_sql("(SELECT *, 1 AS one FROM rooms)", "1 hour", "count(*) AS n", by="one")} SELECT bin AS date_time, n IS NULL AS missing FROM dense""",
    ("rooms",),
)
def _(spark, sf):
    return timeseries.missing_bins(views.rooms(spark, sf), "1h")


@query("calendar_anti", f"WITH {_DAYS} SELECT bin AS date_time FROM dense WHERE n IS NULL", ("rooms",))
def _(spark, sf):
    return timeseries.calendar_anti(views.rooms(spark, sf), "1d")


@query("daily_counts_dense", f"WITH {_DAYS} SELECT bin AS date, coalesce(n, 0) AS n FROM dense", ("rooms",))
def _(spark, sf):
    return as_times(timeseries.daily_counts_dense(views.rooms(spark, sf)), "date")


@query("daily_presence", f"WITH {_DAYS} SELECT bin AS date, CAST(n IS NOT NULL AS INTEGER) AS present FROM dense", ("rooms",))
def _(spark, sf):
    return as_times(timeseries.daily_presence(views.rooms(spark, sf)), "date")


_WEEK = ", ".join(f"({i}, '{d}')" for i, d in enumerate(WEEKDAYS))


@query(
    "missing_by_weekday",
    f"""WITH {_DAYS} SELECT w.dayofweek, w.weekday, count(bin) AS n_missing FROM (VALUES {_WEEK}) w(dayofweek, weekday)
    LEFT JOIN (SELECT bin, isodow(bin) - 1 AS d FROM dense WHERE n IS NULL) m ON m.d = w.dayofweek GROUP BY ALL""",
    ("rooms",),
)
def _(spark, sf):
    return timeseries.missing_by_weekday(views.rooms(spark, sf))


_SLOT = "CASE " + " ".join(f"WHEN h >= {a} AND h < {b} THEN {i}" for i, (a, b) in enumerate(LECTURE_SLOTS, 1)) + " END"


@query(
    "tag_lecture_slot",
    f"""SELECT event_id, date_time, CAST({_SLOT} AS DOUBLE) AS lecture_slot
    FROM (SELECT *, CAST(epoch_us(date_time) % 86400000000 AS DOUBLE) / 3600000000 AS h FROM readings)""",
    ("readings",),
)
def _(spark, sf):
    tagged = timeseries.tag_lecture_slot(views.readings(spark, sf).select("event_id", "date_time"))
    return tagged.withColumn("lecture_slot", F.col("lecture_slot").cast("double"))


def _lag_sql(within: str) -> str:
    w = f"OVER ({within} ORDER BY date_time, event_id)"
    lagged = ", ".join(f'lag("{c}", {i}) {w} AS "{c}(t-{i})"' for i in (3, 2, 1) for c in ("tmp", "CO2"))
    ahead = ", ".join(f'lead("CO2", {i}) {w} AS "CO2(t{f"+{i}" if i else ""})"' for i in (0, 1))
    return f"""SELECT * FROM (SELECT event_id, {lagged}, {ahead} FROM rooms)
    WHERE "tmp(t-3)" IS NOT NULL AND "CO2(t+1)" IS NOT NULL"""


def _lag(spark, sf, within):
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "tmp", "CO2")
    order = RowOrder(df, ["date_time", "event_id"], within)
    return lags.lag_frame(df, order, ["tmp", "CO2"], "CO2", 3, 2, keep=["event_id"])


@query("lag_frame", _lag_sql(""), ("rooms",))
def _(spark, sf):
    return _lag(spark, sf, [])


@query(
    "lag_frame_long",
    """SELECT event_id, "tmp(t-100)", "CO2(t)", "CO2(t+30)" FROM (SELECT event_id, lag(tmp, 100) OVER w AS "tmp(t-100)", "CO2" AS "CO2(t)",
      lead("CO2", 30) OVER w AS "CO2(t+30)" FROM rooms WINDOW w AS (PARTITION BY room_number ORDER BY date_time, event_id))
    WHERE "tmp(t-100)" IS NOT NULL AND "CO2(t+30)" IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    """A reach of 100 rows back, over buckets that may be shorter."""
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2", "tmp")
    order = RowOrder(df, ["date_time", "event_id"], ["room_number"])
    found = lags.lag_frame(df, order, ["tmp"], "CO2", 100, 31, keep=["event_id"])
    return found.select("event_id", "`tmp(t-100)`", "`CO2(t)`", "`CO2(t+30)`")


@query("lag_frame_by_room", _lag_sql("PARTITION BY room_number"), ("rooms",))
def _(spark, sf):
    return _lag(spark, sf, ["room_number"])


@query(
    "lead_labels",
    """SELECT * FROM (SELECT event_id, "CO2" AS "CO2(t)", lead("CO2", 1) OVER w AS "CO2(t+1)", lead("CO2", 2) OVER w AS "CO2(t+2)"
    FROM rooms WINDOW w AS (PARTITION BY room_number ORDER BY date_time, event_id)) WHERE "CO2(t+2)" IS NOT NULL""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2")
    return lags.lead_labels(df, RowOrder(df, ["date_time", "event_id"], ["room_number"]), "CO2", 3, keep=["event_id"])


@query("inference_frame", 'SELECT event_id, tmp AS "tmp(t-1)", "CO2" AS "CO2(t-1)" FROM rooms', ("rooms",))
def _(spark, sf):
    return lags.inference_frame(views.rooms(spark, sf), ["tmp", "CO2"], keep=["event_id"])


@query(
    "calendar_features",
    """SELECT event_id, date_time, CAST(year(date_time) - 2021 AS INTEGER) AS year, CAST(isodow(date_time) - 1 AS INTEGER) AS dayofweek,
      CAST(hour(date_time) AS INTEGER) AS hour, CASE WHEN month(date_time) IN (12, 1, 2) THEN 'winter' WHEN month(date_time) <= 5 THEN 'spring'
      WHEN month(date_time) <= 8 THEN 'summer' ELSE 'fall' END AS season FROM readings""",
    ("readings",),
)
def _(spark, sf):
    return calendar.calendar_features(views.readings(spark, sf).select("event_id", "date_time"))


@query(
    "calendar_features_lines",
    """SELECT year, dayofweek, hour, season, count(*) AS n FROM (
      SELECT CAST(year(date_time) - 2021 AS INTEGER) AS year, CAST(isodow(date_time) - 1 AS INTEGER) AS dayofweek, CAST(hour(date_time) AS INTEGER) AS hour,
      CASE WHEN month(date_time) IN (12, 1, 2) THEN 'winter' WHEN month(date_time) <= 5 THEN 'spring'
      WHEN month(date_time) <= 8 THEN 'summer' ELSE 'fall' END AS season FROM lines) GROUP BY ALL""",
    ("lines",),
)
def _(spark, sf):
    return (
        calendar.calendar_features(views.lines(spark, sf))
        .groupBy("year", "dayofweek", "hour", "season")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "floor_time",
    """SELECT event_id, CAST(CAST(date_time AS DATE) AS TIMESTAMP) AS date, CAST(date_trunc('day', date_time) AS TIMESTAMP) AS day,
      CAST(date_trunc('hour', date_time) AS TIMESTAMP) AS hour FROM readings""",
    ("readings",),
)
def _(spark, sf):
    return views.readings(spark, sf).select(
        "event_id",
        F.to_date("date_time").cast("timestamp_ntz").alias("date"),
        calendar.floor_time("date_time", "1d").alias("day"),
        calendar.floor_time("date_time", "1h").alias("hour"),
    )


@query(
    "hour_label",
    "SELECT event_id, strftime(date_time, '%H:00') AS label FROM readings",
    ("readings",),
)
def _(spark, sf):
    return views.readings(spark, sf).select("event_id", calendar.hour_label(F.hour("date_time")).alias("label"))


@query(
    "voc_co2_ratio",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN "VOC" ELSE round_even("VOC" / "CO2", 4) END AS "VOC_CO2_ratio" FROM readings""",
    ("readings",),
)
def _(spark, sf):
    zeroed = F.when(F.col("event_id") % 11 == 0, F.lit(0.0)).otherwise(F.col("CO2"))
    return views.readings(spark, sf).select("event_id", climate.voc_co2_ratio(F.col("VOC"), zeroed).alias("VOC_CO2_ratio"))


@query(
    "air_quality_level",
    """SELECT event_id, CASE WHEN "CO2" < 850 THEN 'green' WHEN "CO2" < 1200 THEN 'yellow' WHEN "CO2" < 1600 THEN 'red' ELSE 'red_blinking' END AS color
    FROM readings""",
    ("readings",),
)
def _(spark, sf):
    return views.readings(spark, sf).select("event_id", climate.air_quality_level().alias("color"))
