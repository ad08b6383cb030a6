"""Queries over dashboard views and exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from roomtide.operators import explore, outliers, views as dashboard
from roomtide.operators.quantiles import exact_quantiles
from roomtide.operators.timeseries import winsorized_daily_counts
from roomtide.plans.preprocess import sort_time
from roomtide.schema import MEASURES
from roomtide.sources.dumps import union_by_name

from . import views
from .clean import _BOUNDS, _in, cascade_sql
from .registry import as_times, query, rounded
from .series import _DAYS

CHOSEN = ["all", "m000", "m006"]


def _profile_sql(key: str, name: str, source: str = "rooms", values: str = 'avg("CO2") AS "CO2", avg(tmp) AS tmp') -> str:
    return f"""SELECT 'all' AS scope, {key} AS {name}, {values} FROM {source} GROUP BY ALL
    UNION ALL SELECT room_number AS scope, {key} AS {name}, {values} FROM {source} WHERE room_number IN ('m000', 'm006') GROUP BY ALL"""


@query("hourly_profile", _profile_sql("CAST(hour(date_time) AS INTEGER)", "hour"), ("rooms",))
def _(spark, sf):
    return dashboard.hourly_profile(views.rooms(spark, sf), CHOSEN, dashboard.select_measures(["CO2", "tmp", "hum"]))


@query(
    "hourly_profile_three",
    _profile_sql("CAST(hour(date_time) AS INTEGER)", "hour", values='avg("CO2") AS "CO2", avg(tmp) AS tmp, avg(hum) AS hum'),
    ("rooms",),
)
def _(spark, sf):
    return dashboard.hourly_profile(views.rooms(spark, sf), CHOSEN, ["CO2", "tmp", "hum"])


@query(
    "hourly_profile_for_day",
    _profile_sql("CAST(hour(date_time) AS INTEGER)", "hour", "(SELECT * FROM rooms WHERE CAST(date_time AS DATE) = DATE '2024-01-07')"),
    ("rooms",),
)
def _(spark, sf):
    return dashboard.hourly_profile_for_day(views.rooms(spark, sf), "2024-01-07", CHOSEN, ["CO2", "tmp"])


@query("daily_means", _profile_sql("date_trunc('day', date_time)", "date"), ("rooms",))
def _(spark, sf):
    return as_times(dashboard.daily_means(views.rooms(spark, sf), CHOSEN, ["CO2", "tmp"]), "date")


@query("daily_counts", _profile_sql("date_trunc('day', date_time)", "date", values="count(*) AS n"), ("rooms",))
def _(spark, sf):
    return as_times(dashboard.daily_counts(views.rooms(spark, sf), CHOSEN), "date")


@query(
    "select_rooms",
    """SELECT event_id, room_number, room_number AS scope FROM rooms WHERE room_number IN ('m001', 'n005')""",
    ("rooms",),
)
def _(spark, sf):
    return dashboard.select_rooms(views.rooms(spark, sf).select("event_id", "room_number"), ["m001", "n005"])


@query(
    "select_rooms_all",
    """SELECT event_id, room_number, 'all' AS scope FROM rooms
    UNION ALL SELECT event_id, room_number, room_number AS scope FROM rooms WHERE room_number = 'm001'""",
    ("rooms",),
)
def _(spark, sf):
    return dashboard.select_rooms(views.rooms(spark, sf).select("event_id", "room_number"), ["all", "m001"])


@query("select_date", "SELECT event_id, date_time FROM readings WHERE CAST(date_time AS DATE) = DATE '2024-01-13'", ("readings",))
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "date_time")
    return dashboard.select_date(df, "2024-01-13").unionByName(dashboard.select_date(df, "not a date"))


@query("select_measures", "SELECT CAST(hour(date_time) AS INTEGER) AS hour, 'all' AS scope, avg(vis) AS vis, avg(hum) AS hum FROM rooms GROUP BY ALL", ("rooms",))
def _(spark, sf):
    return dashboard.hourly_profile(views.rooms(spark, sf), measures=dashboard.select_measures(["vis", "hum", "CO2"]))


@query("counts_by_room", "SELECT room_number, count(*) AS n FROM rooms GROUP BY ALL", ("rooms",))
def _(spark, sf):
    return explore.counts_by_room(views.rooms(spark, sf))


@query(
    "winsorized_daily_counts",
    f"""WITH {_DAYS}, daily AS (SELECT bin AS date, coalesce(n, 0) AS n FROM dense),
    b AS ({_BOUNDS.format(c="n", t="daily")}), top AS (SELECT max(n) AS v FROM daily, b WHERE {_in("n")})
    SELECT date, CASE WHEN {_in("n")} THEN n ELSE v END AS n FROM daily, b, top""",
    ("rooms",),
)
def _(spark, sf):
    return as_times(winsorized_daily_counts(views.rooms(spark, sf)), "date")


@query(
    "outlier_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, count(*) FILTER (WHERE NOT {_in(f'"{c}"')}) AS n_outliers FROM readings, ({_BOUNDS.format(c=f'"{c}"', t="readings")})"""
        for c in MEASURES
    ),
    ("readings",),
)
def _(spark, sf):
    return outliers.outlier_counts(views.readings(spark, sf), MEASURES)


@query(
    "box_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, any_value(q1) AS q1, quantile_cont("{c}", 0.5) AS median, any_value(q3) AS q3,
        min("{c}") FILTER (WHERE {_in(f'"{c}"')}) AS whisker_low, max("{c}") FILTER (WHERE {_in(f'"{c}"')}) AS whisker_high,
        count(*) FILTER (WHERE NOT {_in(f'"{c}"')}) AS n_fliers FROM readings, ({_BOUNDS.format(c=f'"{c}"', t="readings")})"""
        for c in ("vis", "IR", "CO2", "VOC")
    ),
    ("readings",),
)
def _(spark, sf):
    return outliers.box_stats(views.readings(spark, sf), ["vis", "IR", "CO2", "VOC"])


_DESCRIBED = [*MEASURES, "BLE", "WIFI"]


def _describe_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, count("{c}") AS count, round(avg("{c}"), 6) AS mean, round(stddev_samp("{c}"), 6) AS std, min("{c}") AS min,
        quantile_cont("{c}", 0.25) AS q25, quantile_cont("{c}", 0.5) AS q50, quantile_cont("{c}", 0.75) AS q75, max("{c}") AS max FROM {source}"""
        for c in columns
    )


@query("describe", _describe_sql(_DESCRIBED, "readings"), ("readings",))
def _(spark, sf):
    return rounded(explore.describe(views.readings(spark, sf), _DESCRIBED), "mean", "std")


@query("describe_lines", _describe_sql(["quantity", "price"], "lines"), ("lines",))
def _(spark, sf):
    return rounded(explore.describe(views.lines(spark, sf)), "mean", "std")


@query(
    "quantiles_nan",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, {p} AS probability, quantile_cont("{c}", {p}) FILTER (WHERE event_id % 5 <> 0) AS value FROM readings"""
        for c in ("CO2", "tmp")
        for p in (0.25, 0.5, 0.999)
    ),
    ("readings",),
)
def _(spark, sf):
    gone = F.col("event_id") % 5 == 0
    df = views.readings(spark, sf).select(
        *[F.when(gone, F.lit(float("nan"))).otherwise(F.col(c).cast("double")).alias(c) for c in ("CO2", "tmp")]
    )
    found = exact_quantiles(df, ["CO2", "tmp"], [0.25, 0.5, 0.999])
    rows = [(c, p, v) for c, values in found.items() for p, v in zip([0.25, 0.5, 0.999], values, strict=True)]
    return spark.createDataFrame(rows, "measure string, probability double, value double")


_TYPES = {
    "event_id": "bigint", "date_time": "timestamp_ntz", "device_id": "string", "CO2": "double", "VOC": "double", "tmp": "double",
    "hum": "double", "vis": "double", "IR": "double", "BLE": "double", "WIFI": "double", "snr": "string",
}


@query(
    "profile_schema",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count("{c}") AS non_null FROM readings"""
        for i, (c, t) in enumerate(_TYPES.items())
    ),
    ("readings",),
)
def _(spark, sf):
    return explore.profile_schema(views.readings(spark, sf))


@query("head_n", "SELECT event_id, date_time, device_id FROM readings ORDER BY date_time, event_id LIMIT 10", ("readings",))
def _(spark, sf):
    return explore.head_n(views.readings(spark, sf).select("event_id", "date_time", "device_id"), ["date_time", "event_id"])


_AVGS = ", ".join(f'avg("{c}") AS "{c}"' for c in MEASURES)


@query("room_means", f"SELECT room_number, {_AVGS} FROM rooms GROUP BY ALL", ("rooms",))
def _(spark, sf):
    return explore.room_means(views.rooms(spark, sf))


def _heat_sql(columns: list[str], source: str) -> str:
    ctes = [f"""means AS (SELECT room_number, {', '.join(f'avg("{c}") AS "{c}"' for c in columns)} FROM {source} GROUP BY ALL)"""]
    selects = []
    for i, c in enumerate(columns):
        q = f'"{c}"'
        ctes.append(
            f"""b{i} AS ({_BOUNDS.format(c=q, t="means")}), f{i} AS (SELECT avg({q}) AS v FROM means, b{i} WHERE {_in(q)}),
            r{i} AS (SELECT room_number, CASE WHEN {_in(q)} THEN {q} ELSE v END AS x FROM means, b{i}, f{i})"""
        )
        selects.append(
            f"""SELECT room_number, '{c}' AS measure, round((x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()), 6) AS value,
            CAST((row_number() OVER (ORDER BY room_number) - 1 + least(5, count(*) OVER ())) % count(*) OVER () AS INTEGER) AS position FROM r{i}"""
        )
    return f"WITH {', '.join(ctes)}, heat AS ({' UNION ALL '.join(selects)})"


@query("room_heatmap", _heat_sql(["quantity", "price"], "lines") + " SELECT * FROM heat", ("lines",))
def _(spark, sf):
    return rounded(explore.room_heatmap(views.lines(spark, sf), ["quantity", "price"]), "value")


ROOM_NAMES = ["m000", "m001", "m002", "m003", "m004", "m006", "m007", "n005"]


@query(
    "room_heatmap_matrix",
    _heat_sql(MEASURES, "rooms")
    + " SELECT measure, "
    + ", ".join(f"max(value) FILTER (WHERE room_number = '{r}') AS {r}" for r in ROOM_NAMES)
    + " FROM heat GROUP BY measure",
    ("rooms",),
)
def _(spark, sf):
    return rounded(explore.room_heatmap_matrix(views.rooms(spark, sf)), *ROOM_NAMES)


@query(
    "correlation_matrix",
    f"WITH {cascade_sql(MEASURES)} "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, round(corr("{a}", "{b}"), 6) AS corr FROM c{len(MEASURES) - 1}"""
        for a in MEASURES
        for b in MEASURES
    ),
    ("readings",),
)
def _(spark, sf):
    return rounded(explore.correlation_matrix(views.readings(spark, sf)), "corr")


@query("distinct_rooms", "SELECT DISTINCT room_number FROM rooms", ("rooms",))
def _(spark, sf):
    return dashboard.distinct_rooms(views.rooms(spark, sf))


@query("date_range", "SELECT date_trunc('day', min(date_time)) AS first_date, date_trunc('day', max(date_time)) AS last_date FROM readings", ("readings",))
def _(spark, sf):
    return as_times(dashboard.date_range(views.readings(spark, sf)), "first_date", "last_date")


@query("sort_time", "SELECT date_time, room_number, event_id FROM rooms ORDER BY date_time, room_number", ("rooms",))
def _(spark, sf):
    return sort_time(views.rooms(spark, sf).select("date_time", "room_number", "event_id"))


@query(
    "union_by_name",
    """SELECT event_id, tmp, NULL AS hum FROM readings WHERE vis > 4 UNION ALL SELECT event_id, NULL, hum FROM readings WHERE vis <= 4""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf)
    return union_by_name([df.filter("vis > 4").select("event_id", "tmp"), df.filter("vis <= 4").select("hum", "event_id")])


@query(
    "latest_predictions",
    """SELECT date_time, room_number, vis AS "prediction_t+0" FROM readings_dup
    WHERE date_time = (SELECT max(date_time) FROM readings_dup)""",
    ("readings_dup",),
)
def _(spark, sf):
    df = views.readings_dup(spark, sf)
    predictions = df.select("date_time", "room_number", F.col("vis").alias("prediction_t+0"))
    return dashboard.latest_predictions(predictions, df)
