"""Queries over encoding, splits, supervised frames, forecasts, pipelines and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from roomtide.operators import encoding, metrics, splits
from roomtide.operators.cleaning import convert_types, drop_incomplete_rows, drop_null_time, nan_to_null, select_variants
from roomtide.operators.forest import remove_outliers_forest
from roomtide.operators.ordered import RowOrder
from roomtide.plans import forecast, inference
from roomtide.plans.preprocess import preprocess
from roomtide.schema import WEATHER_MEASURES
from roomtide.session import new_path
from roomtide.sources import dumps, tables
from roomtide.sources.weather import scan_weather

from . import views
from .registry import query, rounded
from .series import NEAREST, SPANS, dense_sql
from .stats import ROOM_NAMES

_ONE_HOT = ", ".join(f"""CAST(room_number = '{r}' AS INTEGER) AS "__room_number_{r}\"""" for r in ROOM_NAMES)


@query("one_hot", f"SELECT event_id, tmp, {_ONE_HOT} FROM rooms", ("rooms",))
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "room_number", "tmp")
    return encoding.OneHot.fit(df, ["room_number"]).transform(df)


@query(
    "one_hot_sparse",
    """WITH days AS (SELECT DISTINCT CAST(vis AS DOUBLE) AS v FROM rooms), names AS (SELECT DISTINCT room_number AS r FROM rooms),
    a AS (SELECT r, row_number() OVER (ORDER BY r) - 1 AS p FROM names),
    b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 + (SELECT count(*) FROM names) AS p FROM days WHERE v IS NOT NULL)
    SELECT event_id, a.p AS room_position, b.p AS vis_position FROM rooms JOIN a ON r = room_number LEFT JOIN b ON v = vis""",
    ("rooms",),
)
def _(spark, sf):
    df = encoding.one_hot_sparse(views.rooms(spark, sf).select("event_id", "room_number", "vis"), ["room_number", "vis"])
    at = [F.get("encoded", F.lit(i)).cast("bigint") for i in range(2)]
    return df.select("event_id", at[0].alias("room_position"), at[1].alias("vis_position"))


@query(
    "one_hot_unknown",
    """SELECT event_id, CAST(room_number = 'n005' AS INTEGER) AS "__room_number_n005" FROM rooms""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "room_number")
    return encoding.OneHot.fit(df.filter("room_number LIKE 'n%'"), ["room_number"]).transform(df)


@query(
    "minmax_scale",
    """SELECT event_id, (vis - min(vis) OVER ()) / (max(vis) OVER () - min(vis) OVER ()) AS vis,
      (tmp - min(tmp) OVER ()) / (max(tmp) OVER () - min(tmp) OVER ()) AS tmp, 0.0::DOUBLE AS same FROM readings""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "vis", "tmp", F.lit(7.0).alias("same"))
    return encoding.minmax_scale(df, ["vis", "tmp", "same"])


_SCALED = ["CO2", "tmp", "WIFI"]


@query(
    "standard_scale",
    "WITH s AS (SELECT *, CAST(event_id % 2 AS DOUBLE) AS flag FROM rooms), f AS (SELECT "
    + ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in _SCALED)
    + " FROM s WHERE date_time < TIMESTAMP '2024-01-21') SELECT event_id, flag, "
    + ", ".join(f'round(coalesce(("{c}" - "m_{c}") / "s_{c}", 0), 6) AS "{c}"' for c in _SCALED)
    + " FROM s, f",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time", *_SCALED, (F.col("event_id") % 2).cast("double").alias("flag"))
    fitted = encoding.StandardScaler.fit(df.filter("date_time < TIMESTAMP_NTZ'2024-01-21'"), [*_SCALED, "flag"])
    return rounded(encoding.StandardScaler.from_frame(fitted.to_frame(spark)).transform(df.drop("date_time")), *_SCALED)


@query(
    "binary_column_detect",
    """SELECT c AS "column" FROM (SELECT bool_and(flag IN (0, 1)) AS flag, bool_and("WIFI" IS NOT NULL AND "WIFI" IN (0, 1)) AS wifi,
      bool_and(vis IN (0, 1)) AS vis FROM (SELECT *, CAST(event_id % 2 AS DOUBLE) AS flag FROM rooms)),
      LATERAL (VALUES ('flag', flag), ('WIFI', wifi), ('vis', vis)) t(c, b) WHERE b""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("WIFI", "vis", (F.col("event_id") % 2).cast("double").alias("flag"))
    return spark.createDataFrame([(c,) for c in encoding.binary_columns(df)], "column string")


@query("sort_columns", 'SELECT "BLE", "CO2", event_id, hum FROM readings', ("readings",))
def _(spark, sf):
    return encoding.sort_columns(views.readings(spark, sf).select("hum", "CO2", "event_id", "BLE"))


# Row counts of the newest fold: test, gap, and a training part capped in length.
SPLIT = """sized AS (SELECT count(*) AS n FROM {t}),
  cuts AS (SELECT n, n - CAST(floor(n * 0.2::DOUBLE) AS BIGINT) AS test_start,
    n - CAST(floor(n * 0.2::DOUBLE) AS BIGINT) - CAST(floor(n * 0.0001::DOUBLE) AS BIGINT) AS train_end FROM sized),
  parts AS (SELECT *, greatest(0, train_end - CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT)) AS train_start FROM cuts),
  vals AS (SELECT *, train_end - CAST(floor(0.1::DOUBLE * (train_end - train_start)) AS BIGINT) AS val_start FROM parts),
  labelled AS (SELECT {t}.*, CASE WHEN i >= test_start THEN 'test' WHEN i >= train_end THEN 'gap' WHEN i >= val_start THEN 'val'
    WHEN i >= train_start THEN 'train' ELSE 'unused' END AS split
    FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS i FROM {t}) {t}, vals)"""


@query(
    "time_series_split",
    f"WITH {SPLIT.format(t='rooms', order='date_time, event_id')} SELECT event_id, date_time, split FROM labelled",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time")
    return splits.time_series_split(df, RowOrder(df, ["date_time", "event_id"]))


@query(
    "time_series_split_lines",
    f"""WITH keyed AS (SELECT *, l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4, l_extendedprice AS k5 FROM lineitem),
    {SPLIT.format(t='keyed', order='l_shipdate, k1, k2, k3, k4, k5')} SELECT split, count(*) AS n, min(l_shipdate) AS first, max(l_shipdate) AS last
    FROM labelled GROUP BY split""",
    (),
)
def _(spark, sf):
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    df = views.table(spark, sf, "lineitem").select(*keys)
    return (
        splits.time_series_split(df, RowOrder(df, keys))
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    )


@query(
    "label_distribution",
    f"""WITH {SPLIT.format(t='rooms', order='date_time, event_id')} SELECT "IR",
      CAST(nullif(count(*) FILTER (WHERE split = 'train'), 0) AS DOUBLE) AS freq_in_train_data,
      CAST(nullif(count(*) FILTER (WHERE split = 'test'), 0) AS DOUBLE) AS freq_in_test_data
    FROM labelled WHERE split IN ('train', 'test') GROUP BY "IR\"""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time", "IR")
    df = splits.label_distribution(splits.time_series_split(df, RowOrder(df, ["date_time", "event_id"])), "IR")
    return df.select("IR", *[F.col(f"freq_in_{p}_data").cast("double").alias(f"freq_in_{p}_data") for p in ("train", "test")])


@query(
    "select_variants",
    """SELECT 'full' AS variant, event_id, pres, pres_diff, season FROM s UNION ALL SELECT 'no_weather', event_id, NULL, NULL, season FROM s
    UNION ALL SELECT 'no_season', event_id, pres, pres_diff, NULL FROM s""".replace(
        " FROM s", " FROM (SELECT event_id, tmp AS pres, hum AS pres_diff, snr AS season FROM readings)"
    ),
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).selectExpr("event_id", "tmp AS pres", "hum AS pres_diff", "snr AS season")
    parts = [d.withColumn("variant", F.lit(name)) for name, d in select_variants(df).items()]
    return dumps.union_by_name(parts)


# Readings of one hour per room, complete in every column: the input of the framing queries.
HOURLY = """hourly AS (SELECT time_bucket(INTERVAL '1 hour', date_time) AS date_time, room_number, max("CO2") AS "CO2", max("BLE") AS "BLE",
  max(tmp) AS tmp, CAST(isodow(min(date_time)) - 1 AS INTEGER) AS dayofweek FROM rooms GROUP BY 1, 2)"""


def _hourly(spark, sf):
    bucket = F.date_trunc("hour", "date_time").cast("timestamp_ntz").alias("date_time")
    return (
        views.rooms(spark, sf)
        .groupBy(bucket, "room_number")
        .agg(F.max("CO2").alias("CO2"), F.max("BLE").alias("BLE"), F.max("tmp").alias("tmp"), F.weekday(F.min("date_time")).alias("dayofweek"))
    )


_DAYS_HOT = ", ".join(f"""CAST(dayofweek = {d} AS INTEGER) AS "__dayofweek_{d}\"""" for d in range(7))
_INPUTS = ["BLE", "tmp", *[f"__dayofweek_{d}" for d in range(7)], *[f"__room_number_{r}" for r in ROOM_NAMES], "CO2"]
_NUMBERS = ["BLE", "tmp", "CO2"]


def _framed_sql(within: str, horizons: int) -> str:
    w = f"OVER (PARTITION BY split{within} ORDER BY date_time, room_number)"
    ahead = ", ".join(f'lead("CO2", {i}) {w} AS "CO2(t{f"+{i}" if i else ""})"' for i in range(horizons))
    last = "CO2(t)" if horizons == 1 else f"CO2(t+{horizons - 1})"
    return f"""{HOURLY}, {SPLIT.format(t="hourly", order="date_time, room_number")},
    encoded AS (SELECT *, {_DAYS_HOT}, {_ONE_HOT} FROM labelled WHERE split IN ('train', 'val', 'test')),
    shifted AS (SELECT date_time, room_number, split, {', '.join(f'lag("{c}") {w} AS "{c}(t-1)"' for c in _INPUTS)}, {ahead} FROM encoded),
    framed AS (SELECT * FROM shifted WHERE "CO2(t-1)" IS NOT NULL AND "{last}" IS NOT NULL),
    fit AS (SELECT {', '.join(f'avg("{c}(t-1)") AS "m_{c}", stddev_pop("{c}(t-1)") AS "s_{c}"' for c in _NUMBERS)} FROM framed WHERE split = 'train')"""


def _scaled(c: str) -> str:
    return f'("{c}(t-1)" - "m_{c}") / "s_{c}"'


_FLAGS = [c for c in _INPUTS if c not in _NUMBERS]


@query(
    "supervised_frames",
    f"""WITH {_framed_sql("", 2)} SELECT date_time, room_number, split, {', '.join(f'"{c}(t-1)"' for c in _FLAGS)},
    {', '.join(f'round({_scaled(c)}, 6) AS "{c}(t-1)"' for c in _NUMBERS)}, "CO2(t)", "CO2(t+1)" FROM framed, fit""",
    ("rooms",),
)
def _(spark, sf):
    frames = forecast.supervised_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"], horizons=2)
    return rounded(frames.rows, *[f"{c}(t-1)" for c in _NUMBERS])


@query(
    "supervised_frames_by_room",
    f"""WITH {_framed_sql(", room_number", 2)} SELECT date_time, room_number, split, {', '.join(f'"{c}(t-1)"' for c in _FLAGS)},
    {', '.join(f'round({_scaled(c)}, 6) AS "{c}(t-1)"' for c in _NUMBERS)}, "CO2(t)", "CO2(t+1)" FROM framed, fit""",
    ("rooms",),
)
def _(spark, sf):
    frames = forecast.supervised_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"], horizons=2, within=["room_number"])
    return rounded(frames.rows, *[f"{c}(t-1)" for c in _NUMBERS])


_VECTOR = [f'"{c}(t-1)"' for c in _FLAGS] + [_scaled(c) for c in _NUMBERS]


@query(
    "assemble_vectors",
    f"""WITH {_framed_sql("", 1)}, v AS (SELECT date_time, room_number, "CO2(t)" AS target, [{', '.join(f'({e})::DOUBLE' for e in _VECTOR)}] AS x
      FROM framed, fit WHERE split = 'test')
    SELECT date_time, room_number, target, i AS position, round(x[i + 1]::FLOAT::DOUBLE, 4) AS value FROM v, range({len(_VECTOR)}) r(i)""",
    ("rooms",),
)
def _(spark, sf):
    frames = forecast.supervised_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"])
    exploded = frames.vectors("test").select(
        "date_time", "room_number", F.get("targets", F.lit(0)).cast("double").alias("target"), F.posexplode("features").alias("p", "value")
    )
    return exploded.select(
        "date_time", "room_number", "target", F.col("p").cast("bigint").alias("position"), F.round(F.col("value").cast("double"), 4).alias("value")
    )


@query(
    "assemble_vectors_fitting",
    f"""WITH {_framed_sql("", 1)}, v AS (SELECT split, date_time, room_number, "CO2(t)" AS target, [{', '.join(f'({e})::DOUBLE' for e in _VECTOR)}] AS x
      FROM framed, fit WHERE split <> 'test')
    SELECT split, date_time, room_number, target, i AS position, round(x[i + 1]::FLOAT::DOUBLE, 4) AS value FROM v, range({len(_VECTOR)}) r(i)""",
    ("rooms",),
)
def _(spark, sf):
    frames = forecast.supervised_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"])
    parts = [frames.vectors(part).withColumn("split", F.lit(part)) for part in ("train", "val")]
    exploded = parts[0].unionByName(parts[1]).select(
        "split", "date_time", "room_number", F.get("targets", F.lit(0)).cast("double").alias("target"), F.posexplode("features").alias("p", "value")
    )
    return exploded.select(
        "split", "date_time", "room_number", "target", F.col("p").cast("bigint").alias("position"), F.round(F.col("value").cast("double"), 4).alias("value")
    )


@query(
    "assemble_inference_vectors",
    f"""WITH {_framed_sql("", 1)}, hot AS (SELECT *, {_DAYS_HOT}, {_ONE_HOT} FROM hourly),
    named AS (SELECT date_time, room_number, {', '.join(f'"{c}" AS "{c}(t-1)"' for c in _INPUTS)} FROM hot),
    v AS (SELECT date_time, room_number, [{', '.join(f'({e})::DOUBLE' for e in _VECTOR)}] AS x FROM named, fit)
    SELECT date_time, room_number, i AS position, round(x[i + 1]::FLOAT::DOUBLE, 4) AS value FROM v, range({len(_VECTOR)}) r(i)""",
    ("rooms",),
)
def _(spark, sf):
    df = _hourly(spark, sf)
    fitted = forecast.supervised_frames(df, "CO2", ["dayofweek", "room_number"])
    exploded = forecast.inference_vectors(df, fitted).select("date_time", "room_number", F.posexplode("features").alias("p", "value"))
    return exploded.select(
        "date_time", "room_number", F.col("p").cast("bigint").alias("position"), F.round(F.col("value").cast("double"), 4).alias("value")
    )


def _exploded(rows, ones: int):
    """Sparse rows as one row per input: all numbers, and those positions that hold a one."""
    hot = F.transform("ones", lambda p: F.struct(p.cast("bigint").alias("position"), F.lit(1.0).alias("value")))
    numbers = F.transform("numbers", lambda x, i: F.struct((i + ones).cast("bigint").alias("position"), F.round(x, 4).alias("value")))
    return rows.withColumn("_in", F.explode(F.concat(hot, numbers))).drop("ones", "numbers").select("*", "_in.*").drop("_in")


def _sparse_sql(within: str, horizons: int) -> str:
    ahead = ", ".join(f'"CO2(t{f"+{i}" if i else ""})" AS target{i}' for i in range(horizons))
    names = ", ".join(f"target{i}" for i in range(horizons))
    return f"""WITH {_framed_sql(within, horizons)}, v AS (SELECT split, date_time, room_number, {ahead},
      [{', '.join(f'({e})::DOUBLE' for e in _VECTOR)}] AS x FROM framed, fit),
    e AS (SELECT split, date_time, room_number, {names}, i AS position, round(x[i + 1], 4) AS value FROM v, range({len(_VECTOR)}) r(i))
    SELECT * FROM e WHERE value <> 0 OR position >= {len(_FLAGS)}"""


def _sparse(spark, sf, horizons, **options):
    frames = forecast.sparse_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"], horizons=horizons, **options)
    targets = {f"target{i}": F.get("targets", F.lit(i)) for i in range(horizons)}
    return _exploded(frames.rows, frames.ones).withColumns(targets).drop("targets")


@query("supervised_frames_sparse", _sparse_sql("", 2), ("rooms",))
def _(spark, sf):
    return _sparse(spark, sf, 2)


@query("supervised_frames_sparse_by_room", _sparse_sql(", room_number", 1), ("rooms",))
def _(spark, sf):
    return _sparse(spark, sf, 1, within=["room_number"])


@query(
    "inference_design",
    f"""WITH {_framed_sql("", 1)}, hot AS (SELECT *, {_DAYS_HOT}, {_ONE_HOT} FROM hourly),
    named AS (SELECT date_time, room_number, {', '.join(f'"{c}" AS "{c}(t-1)"' for c in _INPUTS)} FROM hot),
    v AS (SELECT date_time, room_number, [{', '.join(f'({e})::DOUBLE' for e in _VECTOR)}] AS x FROM named, fit),
    e AS (SELECT date_time, room_number, i AS position, round(x[i + 1], 4) AS value FROM v, range({len(_VECTOR)}) r(i))
    SELECT * FROM e WHERE value <> 0 OR position >= {len(_FLAGS)}""",
    ("rooms",),
)
def _(spark, sf):
    df = _hourly(spark, sf)
    fitted = forecast.sparse_frames(df, "CO2", ["dayofweek", "room_number"])
    return _exploded(forecast.inference_design(df, fitted), fitted.ones)


def ridge_sql(design: str, width: int, free: int, horizons: int, name: str = "") -> str:
    """Normal equations over ``design`` (split, x, y as lists), solved by elimination for each penalty; the best on ``val`` stays as ``best``.

    ``width`` inputs, of which number ``free`` (from 1) is the constant. The result has a row per horizon: ``h`` and the weights ``w``.
    """
    return f"""counted{name} AS (SELECT count(*) AS n FROM {design} WHERE split = 'train'),
    products{name} AS (SELECT i, j, sum(z[i] * z[j]) AS v FROM (SELECT list_concat(x, y) AS z FROM {design} WHERE split = 'train'),
      range(1, {width + 1}) a(i), range(1, {width + horizons + 1}) b(j) GROUP BY i, j),
    penalties{name} AS (SELECT unnest([0.001::DOUBLE, 0.01::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE]) AS lam),
    lines{name} AS (SELECT lam, i, list(v / n + CASE WHEN i = j AND i <> {free} THEN lam ELSE 0 END ORDER BY j) AS r
      FROM products{name}, counted{name}, penalties{name} GROUP BY lam, i),
    solved{name} AS (
      SELECT lam, 1 AS k, list(r ORDER BY i) AS m FROM lines{name} GROUP BY lam
      UNION ALL
      SELECT lam, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
      FROM solved{name} WHERE k <= {width}),
    weighed{name} AS (SELECT lam, h, list(m[i][{width} + h] ORDER BY i) AS w
      FROM solved{name}, range(1, {width + 1}) a(i), range(1, {horizons + 1}) b(h) WHERE k = {width + 1} GROUP BY lam, h),
    tried{name} AS (SELECT lam, sum((y[h] - list_dot_product(x, w)) ** 2) AS e FROM {design}, weighed{name} WHERE split = 'val' GROUP BY lam),
    best{name} AS (SELECT h, w FROM weighed{name} WHERE lam = (SELECT arg_min(lam, e) FROM tried{name}))"""


_PERSISTENCE = """shifted AS (SELECT date_time, room_number, lag("CO2") OVER w AS "CO2(t-1)", "CO2" AS "CO2(t)", lead("CO2") OVER w AS "CO2(t+1)"
  FROM hourly WINDOW w AS (PARTITION BY room_number ORDER BY date_time)),
  framed AS (SELECT * FROM shifted WHERE "CO2(t-1)" IS NOT NULL AND "CO2(t+1)" IS NOT NULL),
  pairs AS (SELECT date_time, room_number, 0 AS horizon, "CO2(t)" AS y, "CO2(t-1)" AS p FROM framed
    UNION ALL SELECT date_time, room_number, 1, "CO2(t+1)", "CO2(t-1)" FROM framed)"""


def _persisted(spark, sf):
    from roomtide.operators.lags import lag_frame

    df = _hourly(spark, sf)
    order = RowOrder(df, ["date_time"], ["room_number"])
    framed = lag_frame(df, order, ["CO2"], "CO2", 1, 2, keep=["date_time", "room_number"])
    return forecast.persistence_predict(framed, "CO2", 2)


@query(
    "evaluate_persistence",
    f"""WITH {HOURLY}, {_PERSISTENCE} SELECT 'persistence' AS variant, horizon, round_even(avg((y - p) ** 2), 2) AS mse,
      round_even(sqrt(avg((y - p) ** 2)), 2) AS rmse, round_even(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 2) AS mape,
      round_even(1 - sum((y - p) ** 2) / (var_pop(y) * count(y)), 2) AS r2 FROM pairs GROUP BY horizon""",
    ("rooms",),
)
def _(spark, sf):
    return metrics.evaluate_models({"persistence": _persisted(spark, sf)}, "CO2", 2)


@query("forecast_vs_actual", f"WITH {HOURLY}, {_PERSISTENCE} SELECT * FROM pairs", ("rooms",))
def _(spark, sf):
    return metrics.forecast_vs_actual(_persisted(spark, sf), "CO2", 2)


_DESIGN = [*[f'"{c}(t-1)"' for c in _FLAGS], "1", *[_scaled(c) for c in _NUMBERS]]


@query(
    "forecast",
    f"""WITH RECURSIVE {_framed_sql("", 2)},
    design AS (SELECT split, date_time, room_number, [{', '.join(f'({e})::DOUBLE' for e in _DESIGN)}] AS x,
      ["CO2(t)"::DOUBLE, "CO2(t+1)"::DOUBLE] AS y FROM framed, fit),
    {ridge_sql("design", len(_DESIGN), len(_FLAGS) + 1, 2)}
    SELECT date_time, room_number, y[1] AS "CO2(t)", y[2] AS "CO2(t+1)", round(list_dot_product(x, a.w), 4) AS "prediction_t+0",
      round(list_dot_product(x, b.w), 4) AS "prediction_t+1" FROM design, best a, best b WHERE split = 'test' AND a.h = 1 AND b.h = 2""",
    ("rooms",),
)
def _(spark, sf):
    fitted = forecast.sparse_frames(_hourly(spark, sf), "CO2", ["dayofweek", "room_number"], horizons=2)
    models = forecast.forecast_train(fitted)
    return rounded(forecast.predictions_with_actuals(fitted, models), "prediction_t+0", "prediction_t+1", digits=4)


@query("forecast_saved", "SELECT 0 AS differing, true AS some")
def _(spark, sf):
    """Predictions that differ after the fitted state was written and read again."""
    df = _hourly(spark, sf)
    fitted = forecast.sparse_frames(df, "CO2", ["dayofweek", "room_number"], horizons=2, skip_scale=False)
    models = forecast.forecast_train(fitted)
    path = new_path(spark, "forecast")
    forecast.save_forecast(path, spark, fitted, models)
    ways = [forecast.forecast_predict(forecast.inference_design(df, f), m) for f, m in ((fitted, models), forecast.load_forecast(path, spark))]
    differing = ways[0].exceptAll(ways[1]).unionAll(ways[1].exceptAll(ways[0]))
    found = differing.agg(F.count(F.lit(1)).cast("int").alias("differing"))
    return found.join(ways[0].agg((F.count(F.lit(1)) > 0).alias("some")))


def _raw(spark, sf):
    return views.readings(spark, sf).drop("event_id")


_MEASURED = ["CO2", "VOC", "tmp", "hum", "vis", "IR", "BLE", *WEATHER_MEASURES]
_CHANGED = [c for c in _MEASURED if c != "CO2"]
_GLOBAL = "(ORDER BY date_time, room_number)"


def _frozen(source: str, zero: str) -> str:
    return f"""SELECT * FROM (SELECT * FROM {source} WHERE {zero}) QUALIFY NOT coalesce("CO2" > 20000 AND "VOC" = lag("VOC") OVER {_GLOBAL}
      AND "BLE" = lag("BLE") OVER {_GLOBAL} AND tmp = lag(tmp) OVER {_GLOBAL}, false)"""


def _preprocess_ctes(size: str, frame: str) -> str:
    """The preprocessed table, not rounded, as the last CTE ``history``."""
    return f"""{SPANS},
    complete AS (SELECT * FROM rooms WHERE "WIFI" IS NOT NULL AND "BLE" IS NOT NULL),
    joined AS (SELECT complete.* EXCLUDE (event_id), {', '.join(WEATHER_MEASURES)} FROM complete LEFT JOIN spans ON {NEAREST}),
    deduped AS (SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY date_time, room_number ORDER BY "BLE", "CO2", "IR", "VOC", "WIFI", hum) = 1),
    valid AS (SELECT * FROM deduped WHERE hum <= 100 AND tmp BETWEEN 10 AND 50),
    calm AS (SELECT * FROM (SELECT *, "CO2" - lag("CO2") OVER {_GLOBAL} AS dc, "VOC" - lag("VOC") OVER {_GLOBAL} AS dv,
        epoch_us(date_time) - epoch_us(lag(date_time) OVER {_GLOBAL}) AS step FROM valid)
      WHERE NOT coalesce((dc >= 1000 OR dv >= 1000) AND step % 86400000000 < 60000000, false)),
    p1 AS ({_frozen("calm", '"CO2" <> 0')}), p2 AS ({_frozen("p1", '"VOC" <> 0')}), p3 AS ({_frozen("p2", "tmp <> 0")}),
    p4 AS ({_frozen("p3", "hum <> 0")}),
    {dense_sql("p4", size, ", ".join(f'avg("{c}") AS "{c}"' for c in _MEASURED))},
    rolled AS (SELECT room_number, bin AS date_time, {', '.join(f'avg("{c}") OVER w AS "{c}"' for c in _MEASURED)} FROM dense
      WINDOW w AS (PARTITION BY room_number ORDER BY bin RANGE BETWEEN INTERVAL '{frame}' PRECEDING AND CURRENT ROW)),
    kept AS (SELECT * FROM rolled WHERE "CO2" IS NOT NULL),
    history AS (SELECT room_number, date_time, {', '.join(f'"{c}"' for c in _MEASURED)},
      {', '.join(f'coalesce("{c}" - lag("{c}") OVER r, 0) AS "{c}_diff"' for c in _CHANGED)},
      CAST(year(date_time) - 2021 AS INTEGER) AS year, CAST(isodow(date_time) - 1 AS INTEGER) AS dayofweek, CAST(hour(date_time) AS INTEGER) AS hour,
      CASE WHEN month(date_time) IN (12, 1, 2) THEN 'winter' WHEN month(date_time) <= 5 THEN 'spring' WHEN month(date_time) <= 8 THEN 'summer' ELSE 'fall' END AS season,
      round_even("VOC" / "CO2", 4) AS "VOC_CO2_ratio"
    FROM kept WINDOW r AS (PARTITION BY room_number ORDER BY date_time))"""


def _preprocess_sql(size: str, frame: str) -> str:
    numbers = [*_MEASURED, *[f"{c}_diff" for c in _CHANGED]]
    rounded_numbers = ", ".join(f'round("{c}", 6) AS "{c}"' for c in numbers)
    return f"WITH {_preprocess_ctes(size, frame)} SELECT * REPLACE ({rounded_numbers}) FROM history"


def _rounded_features(df):
    return rounded(df, *_MEASURED, *[f"{c}_diff" for c in _CHANGED])


@query("preprocess_without_forest", _preprocess_sql("1 day", "2 days 23:59:59.999999"), ("rooms", "weather"))
def _(spark, sf):
    return _rounded_features(preprocess(_raw(spark, sf), views.weather(spark, sf), "3d", "1d", outliers=False))


@query("preprocess_without_forest_hourly", _preprocess_sql("1 hour", "0:59:59.999999"), ("rooms", "weather"))
def _(spark, sf):
    return _rounded_features(preprocess(_raw(spark, sf), views.weather(spark, sf), "1h", "1h", outliers=False))


_EXTRA = ["year", "hour", "VOC_CO2_ratio"]
_SEASONS = {f"__season_{v}": f"season = '{v}'" for v in ("fall", "spring", "summer", "winter")}
_WEEK = {f"__dayofweek_{d}": f"dayofweek = {d}" for d in range(7)}
_ROOMS = {f"__room_number_{r}": f"room_number = '{r}'" for r in ROOM_NAMES}


def _history_sql(name: str, numbers: list[str], flags: dict[str, str]) -> str:
    """Frames of ``history`` with these inputs, their scaling and the ridge over them: ``design<name>``, ``fit<name>``, ``best<name>``."""
    w = "OVER (PARTITION BY split ORDER BY date_time, room_number)"
    lagged = [f'lag("{c}") {w} AS "{c}"' for c in numbers] + [f'lag(CAST({test} AS INTEGER)) {w} AS "{c}"' for c, test in flags.items()]
    return f"""shifted{name} AS (SELECT date_time, room_number, split, "CO2" AS now, {', '.join(lagged)}
      FROM labelled WHERE split IN ('train', 'val', 'test')),
    framed{name} AS (SELECT * FROM shifted{name} WHERE "CO2" IS NOT NULL),
    fit{name} AS (SELECT {', '.join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in numbers)} FROM framed{name} WHERE split = 'train'),
    design{name} AS (SELECT split, date_time, room_number, {_input_list(numbers, list(flags))} AS x, [now::DOUBLE] AS y FROM framed{name}, fit{name}),
    {ridge_sql(f"design{name}", len(numbers) + len(flags) + 1, len(flags) + 1, 1, name)}"""


def _input_list(numbers: list[str], flags: list[str]) -> str:
    scaled = [f'coalesce(("{c}" - "m_{c}") / coalesce(nullif("s_{c}", 0), 1), 0)::DOUBLE' for c in numbers]
    return "[" + ", ".join([*[f"({f})::DOUBLE" if " " in f else f'"{f}"::DOUBLE' for f in flags], "1::DOUBLE", *scaled]) + "]"


_HISTORY = f"""{_preprocess_ctes("1 hour", "2:59:59.999999")}, {SPLIT.format(t="history", order="date_time, room_number")}"""
_ALL_NUMBERS = [*_MEASURED, *[f"{c}_diff" for c in _CHANGED], *_EXTRA]
_ALL_FLAGS = _SEASONS | _ROOMS | _WEEK


def _history(spark, sf):
    return preprocess(_raw(spark, sf), views.weather(spark, sf), "3h", "1h", outliers=False)


@query(
    "forecast_new_readings",
    f"""WITH RECURSIVE {_HISTORY}, {_history_sql("", _ALL_NUMBERS, _ALL_FLAGS)},
    asked AS (SELECT date_time, room_number, {_input_list(_ALL_NUMBERS, list(_ALL_FLAGS.values()))} AS x FROM history, fit)
    SELECT date_time, room_number, round(list_dot_product(x, w), 3) AS "prediction_t+0" FROM asked, best""",
    ("rooms", "weather"),
)
def _(spark, sf):
    """Fit on the preprocessed readings, then preprocess them anew and forecast from every row."""
    fitted = forecast.sparse_frames(_history(spark, sf), "CO2")
    models = forecast.forecast_train(fitted)
    found = inference.forecast_new(_raw(spark, sf), views.weather(spark, sf), fitted, models, window="3h", every="1h")
    return rounded(found, "prediction_t+0", digits=3)


_VARIANTS = {
    "full": (_ALL_NUMBERS, _ALL_FLAGS),
    "no_weather": ([c for c in _ALL_NUMBERS if c.removesuffix("_diff") not in WEATHER_MEASURES], _ALL_FLAGS),
    "no_season": (_ALL_NUMBERS, _ROOMS | _WEEK),
}


@query(
    "evaluate_models",
    f"WITH RECURSIVE {_HISTORY}, "
    + ", ".join(_history_sql(f"_{v}", *inputs) for v, inputs in _VARIANTS.items())
    + ", pairs AS ("
    + " UNION ALL ".join(
        f"SELECT '{v}' AS variant, 0 AS horizon, y[1] AS y, list_dot_product(x, w) AS p FROM design_{v}, best_{v} WHERE split = 'test'" for v in _VARIANTS
    )
    + """) SELECT variant, horizon, round_even(avg((y - p) ** 2), 2) AS mse, round_even(sqrt(avg((y - p) ** 2)), 2) AS rmse,
      round_even(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 2) AS mape,
      round_even(1 - sum((y - p) ** 2) / (var_pop(y) * count(y)), 2) AS r2 FROM pairs GROUP BY ALL""",
    ("rooms", "weather"),
)
def _(spark, sf):
    fitted = forecast.train_variants(select_variants(_history(spark, sf)), "CO2")
    frames = {name: forecast.predictions_with_actuals(f, models) for name, (f, models) in fitted.items()}
    return metrics.evaluate_models(frames, "CO2", 1)


@query("preprocess")
def _(spark, sf):
    return preprocess(_raw(spark, sf), views.weather(spark, sf), "3d", "1d", within=["room_number"])


@query("preprocess_default_path", "SELECT 0 AS differing, true AS some")
def _(spark, sf):
    """Rows by which all defaults together differ from the forest by itself, followed by the rest without it."""
    raw, weather = _raw(spark, sf), views.weather(spark, sf)
    complete = drop_null_time(convert_types(drop_incomplete_rows(nan_to_null(raw))))
    # As text again, unreadable numbers pass the check for missing values a second time.
    kept = remove_outliers_forest(complete).withColumn("snr", F.coalesce(F.col("snr").cast("string"), F.lit("n/a")))
    ways = [preprocess(raw, weather), preprocess(kept, weather, outliers=False)]
    # Sums of doubles may differ in the last bit from run to run.
    ways = [rounded(w, *_MEASURED, *[f"{c}_diff" for c in _CHANGED]) for w in ways]
    differing = ways[0].exceptAll(ways[1]).unionAll(ways[1].exceptAll(ways[0]))
    found = differing.agg(F.count(F.lit(1)).cast("int").alias("differing"))
    return found.join(ways[0].agg((F.count(F.lit(1)) > 0).alias("some")))


_DUMP_COLUMNS = ["date_time", "device_id", "tmp", "hum", "CO2", "VOC", "vis", "IR", "BLE", "WIFI", "snr"]
_DUMP_SQL = """SELECT strftime(date_time, '%Y-%m-%d %H:%M:%S.%f') AS date_time, device_id, tmp, hum, "CO2", "VOC", vis, "IR", "BLE", "WIFI",
  CASE WHEN event_id % 50 <> 0 THEN snr END AS snr FROM readings"""


def _write_dumps(spark, sf) -> str:
    """The readings as dump files: a preamble full of delimiters, a header, rows (some short, some with escapes), one overlong and one broken
    line each, and a file that ends after its preamble."""
    path = new_path(spark, "dumps")
    df = views.readings(spark, sf).withColumns(
        {"month": F.date_format("date_time", "yyyy-MM"), "date_time": F.date_format("date_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")}
    )
    df = df.withColumns({"folder": F.col("device_id"), "device_id": F.when(F.col("event_id") % 10 == 3, F.replace("device_id", F.lit("-co2-"), F.lit("-\\x63\\u006f2\\55"))).otherwise(F.col("device_id"))})
    # Building n sends no WIFI column, so its files have another header.
    columns = {True: [c for c in _DUMP_COLUMNS if c != "WIFI"], False: _DUMP_COLUMNS}
    in_n = F.col("folder").contains("-n")

    def text(names: list[str]):
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
        short = F.concat_ws(";", *fields[:-1])
        return F.when(F.col("event_id") % 50 == 0, short).otherwise(F.concat_ws(";", short, fields[-1]))

    rows = df.select("folder", "month", F.lit(2).alias("at"), F.when(in_n, text(columns[True])).otherwise(text(columns[False])).alias("value"))
    lines = {0: "sensor;export;date_time;;", 3: ";".join(["broken"] * 20), 4: "2024-01-01;lab\\x2"}
    extra = [F.struct(F.lit(at).alias("at"), F.lit(line).alias("value")) for at, line in lines.items()]
    extra.append(F.struct(F.lit(1).alias("at"), F.when(in_n, ";".join(columns[True])).otherwise(";".join(columns[False])).alias("value")))
    files = df.select("folder", "month").distinct()
    heads = files.select("folder", "month", F.explode(F.array(*extra)).alias("h")).select("folder", "month", "h.at", "h.value")
    cut_off = files.select("folder").distinct().select("folder", F.lit("cut off").alias("month"), F.lit(0).alias("at"), F.lit("sensor;export").alias("value"))
    found = rows.unionByName(heads).unionByName(cut_off).repartition("folder", "month").sortWithinPartitions("folder", "month", "at")
    found.select("folder", "month", "value").write.partitionBy("folder", "month").text(path)
    return path


@query(
    "scan_dat_manifest",
    """SELECT device_id AS folder, strftime(date_time, '%Y-%m') AS month, 'read' AS state, count(*) AS lines_read, 1 AS lines_overlong,
      1 AS lines_unreadable, 0 AS lines_headless, CASE WHEN device_id LIKE '%-n%' THEN 10 ELSE 11 END AS columns FROM readings GROUP BY ALL
    UNION ALL SELECT DISTINCT device_id, 'cut off', 'no header', 0, 0, 0, 0, 0 FROM readings""",
    ("readings",),
)
def _(spark, sf):
    found = dumps.scan_dat_manifest(spark, _write_dumps(spark, sf))
    part = {c: F.url_decode(F.regexp_extract("file", f"{c}=([^/]*)/", 1)) for c in ("folder", "month")}
    return found.select(
        *[c.alias(n) for n, c in part.items()], "state", "lines_read", "lines_overlong", "lines_unreadable", "lines_headless", F.coalesce(F.size(F.split("header", ";")), F.lit(0)).alias("columns")
    )


@query("scan_dat", _DUMP_SQL, ("readings",))
def _(spark, sf):
    return dumps.scan_dat(spark, _write_dumps(spark, sf)).select(*_DUMP_COLUMNS)


@query("scan_with_fallback", _DUMP_SQL, ("readings",))
def _(spark, sf):
    return dumps.scan_with_fallback(spark, new_path(spark, "absent"), _write_dumps(spark, sf)).select(*_DUMP_COLUMNS)


@query(
    "scan_weather",
    "SELECT date, tavg, tmin, tmax, prcp, wdir, wspd, wpgt, pres FROM weather WHERE wpgt IS NOT NULL",
    ("weather",),
)
def _(spark, sf):
    path = new_path(spark, "weather")
    views.weather(spark, sf).write.csv(path, header=True)
    return scan_weather(spark, path)


@query("sink_parquet", "SELECT event_id, date_time, tmp, room_number FROM rooms", ("rooms",))
def _(spark, sf):
    path = new_path(spark, "rooms")
    tables.sink_parquet(views.rooms(spark, sf).select("event_id", "date_time", "tmp", "room_number"), path)
    return tables.scan_parquet(spark, path)
