"""Queries over the cleaning and outlier operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roomtide.operators import cleaning, outliers
from roomtide.operators.forest import anomaly_scores, remove_outliers_forest
from roomtide.operators.ordered import RowOrder, global_diff
from roomtide.schema import MEASURES

from . import views
from .registry import query, rounded

READING_COLUMNS = 'event_id, date_time, device_id, "CO2", "VOC", tmp, hum, vis, "IR", "BLE", "WIFI", snr'


@query("drop_incomplete_rows", f'SELECT {READING_COLUMNS} FROM readings WHERE "WIFI" IS NOT NULL AND "BLE" IS NOT NULL', ("readings",))
def _(spark, sf):
    return cleaning.drop_incomplete_rows(views.readings(spark, sf))


@query(
    "drop_mostly_missing_rows",
    """SELECT event_id, a, b, c FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN vis END AS a,
        CASE WHEN event_id % 3 = 0 THEN vis END AS b, CASE WHEN event_id % 5 = 0 THEN vis END AS c FROM readings)
    WHERE (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT <= 0.5 * 4""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).select(
        "event_id",
        *[F.when(F.col("event_id") % m == 0, F.col("vis")).alias(n) for m, n in ((2, "a"), (3, "b"), (5, "c"))],
    )
    return cleaning.drop_incomplete_rows(df, max_null_fraction=0.5)


@query(
    "fill_radio_counts",
    'SELECT event_id, device_id, coalesce("WIFI", 0) AS "WIFI", coalesce("BLE", 0) AS "BLE" FROM readings',
    ("readings",),
)
def _(spark, sf):
    return cleaning.fill_radio_counts(views.readings(spark, sf)).select("event_id", "device_id", "WIFI", "BLE")


_TEXT_TIME = "CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'unknown' ELSE CAST(date_time AS {text}) END"


@query(
    "convert_types",
    f"""SELECT event_id, TRY_CAST(t AS TIMESTAMP) AS date_time, TRY_CAST(snr AS DOUBLE) AS snr
    FROM (SELECT event_id, {_TEXT_TIME.format(text="VARCHAR")} AS t, snr FROM readings) WHERE t IS NOT NULL""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).selectExpr("event_id", _TEXT_TIME.format(text="STRING") + " AS date_time", "snr")
    return cleaning.convert_types(df)


@query(
    "drop_null_time",
    "SELECT event_id, date_time FROM (SELECT event_id, CASE WHEN event_id % 53 <> 0 THEN date_time END AS date_time FROM readings) WHERE date_time IS NOT NULL",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).selectExpr("event_id", "CASE WHEN event_id % 53 <> 0 THEN date_time END AS date_time")
    return cleaning.drop_null_time(df)


@query(
    "extract_room",
    """SELECT event_id, split_part(device_id, '-', 3) AS room_number,
      regexp_replace(split_part(device_id, '-', 3), '[0-9]+', '', 'g') AS building_name FROM readings""",
    ("readings",),
)
def _(spark, sf):
    df = cleaning.extract_building(cleaning.extract_room(views.readings(spark, sf)))
    return df.select("event_id", "room_number", "building_name")


@query(
    "filter_building",
    "SELECT event_id, room_number, 'm' AS building_name FROM rooms WHERE room_number LIKE 'm%'",
    ("rooms",),
)
def _(spark, sf):
    df = cleaning.extract_building(views.rooms(spark, sf))
    return cleaning.filter_building(df).select("event_id", "room_number", "building_name")


@query(
    "dedup_key",
    """SELECT date_time, room_number, event_id, event_type, vis FROM readings_dup
    QUALIFY row_number() OVER (PARTITION BY date_time, room_number ORDER BY event_id) = 1""",
    ("readings_dup",),
)
def _(spark, sf):
    return cleaning.dedup_key(views.readings_dup(spark, sf), tiebreak=["event_id"])


@query("dedup_full", "SELECT DISTINCT date_time, room_number, event_type FROM readings_dup", ("readings_dup",))
def _(spark, sf):
    return cleaning.dedup_full(views.readings_dup(spark, sf).select("date_time", "room_number", "event_type"))


@query("drop_features", 'SELECT event_id, date_time, "CO2", "VOC", tmp, hum, vis, "IR", "BLE" FROM readings', ("readings",))
def _(spark, sf):
    return cleaning.drop_features(views.readings(spark, sf))


@query("dropna_all", 'SELECT date_time, device_id, "WIFI" FROM readings WHERE "WIFI" IS NOT NULL', ("readings",))
def _(spark, sf):
    return cleaning.drop_incomplete_rows(views.readings(spark, sf).select("date_time", "device_id", "WIFI"))


@query(
    "range_validity",
    f"SELECT {READING_COLUMNS} FROM readings WHERE hum <= 100 AND tmp >= 10 AND tmp <= 50",
    ("readings",),
)
def _(spark, sf):
    return cleaning.range_validity(views.readings(spark, sf))


def _fast_rise_sql(within: str) -> str:
    w = f"({within} ORDER BY date_time, event_id)"
    return f"""SELECT event_id, date_time, room_number, "CO2", "VOC" FROM (
      SELECT *, "CO2" - lag("CO2") OVER {w} AS dc, "VOC" - lag("VOC") OVER {w} AS dv,
        epoch_us(date_time) - epoch_us(lag(date_time) OVER {w}) AS step FROM rooms)
    WHERE NOT coalesce((dc >= 1000 OR dv >= 1000) AND step % 86400000000 < 60000000, false)"""


def _rise(spark, sf, within):
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number", "CO2", "VOC")
    return cleaning.drop_fast_rise(df, RowOrder(df, ["date_time", "event_id"], within))


@query("drop_fast_rise", _fast_rise_sql(""), ("rooms",))
def _(spark, sf):
    return _rise(spark, sf, [])


@query("drop_fast_rise_by_room", _fast_rise_sql("PARTITION BY room_number"), ("rooms",))
def _(spark, sf):
    return _rise(spark, sf, ["room_number"])


@query(
    "drop_zero_readings",
    f'SELECT {READING_COLUMNS} FROM readings WHERE "CO2" <> 0 AND "VOC" <> 0 AND tmp <> 0 AND hum <> 0',
    ("readings",),
)
def _(spark, sf):
    return cleaning.drop_zero_readings(views.readings(spark, sf))


def _frozen_sql(source: str, zero: str) -> str:
    w = "(ORDER BY date_time, event_id)"
    return f"""SELECT * FROM (SELECT * FROM {source} WHERE {zero})
    QUALIFY NOT coalesce("CO2" > 20000 AND "VOC" = lag("VOC") OVER {w} AND "BLE" = lag("BLE") OVER {w} AND tmp = lag(tmp) OVER {w}, false)"""


# Spelled out in full: a zero filter and a frozen check for each of the four measures in turn.
_FOUR_PASSES = f"""WITH p1 AS ({_frozen_sql("readings_spiky", '"CO2" <> 0')}), p2 AS ({_frozen_sql("p1", '"VOC" <> 0')}),
  p3 AS ({_frozen_sql("p2", "tmp <> 0")}), p4 AS ({_frozen_sql("p3", "hum <> 0")}) SELECT * FROM p4"""


@query("drop_frozen_spikes", _FOUR_PASSES, ("readings_spiky",))
def _(spark, sf):
    df = views.readings_spiky(spark, sf)
    return cleaning.drop_frozen_spikes(df, RowOrder(df, ["date_time", "event_id"]), label="CO2")


@query(
    "drop_frozen_spikes_other_label",
    _frozen_sql("readings_spiky", '"CO2" <> 0 AND "VOC" <> 0 AND tmp <> 0 AND hum <> 0'),
    ("readings_spiky",),
)
def _(spark, sf):
    df = views.readings_spiky(spark, sf)
    return cleaning.drop_frozen_spikes(df, RowOrder(df, ["date_time", "event_id"]), label="vis")


_BOUNDS = "SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t}"


def _in(c: str) -> str:
    return f"{c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


@query(
    "iqr_filter",
    f"SELECT {READING_COLUMNS} FROM readings, ({_BOUNDS.format(c='vis', t='readings')}) WHERE {_in('vis')}",
    ("readings",),
)
def _(spark, sf):
    return outliers.iqr_filter(views.readings(spark, sf), "vis")


@query(
    "iqr_filter_lines",
    f"SELECT date_time, room_number, quantity, price FROM lines, ({_BOUNDS.format(c='price', t='lines')}) WHERE {_in('price')}",
    ("lines",),
)
def _(spark, sf):
    return outliers.iqr_filter(views.lines(spark, sf), "price")


def _replace_sql(how: str, columns: list[str]) -> str:
    parts, ctes = [], []
    for i, c in enumerate(columns):
        ctes.append(
            f"""b{i} AS ({_BOUNDS.format(c=f'"{c}"', t="readings")}), f{i} AS (SELECT {how}("{c}") AS v FROM readings, b{i} WHERE {_in(f'"{c}"')})"""
        )
        parts.append(
            f'round(CASE WHEN NOT "{c}" BETWEEN b{i}.q1 - 1.5 * (b{i}.q3 - b{i}.q1) AND b{i}.q3 + 1.5 * (b{i}.q3 - b{i}.q1) THEN f{i}.v ELSE "{c}" END, 6) AS "{c}"'
        )
    sources = ", ".join(f"b{i}, f{i}" for i in range(len(columns)))
    return f"WITH {', '.join(ctes)} SELECT event_id, {', '.join(parts)} FROM readings, {sources}"


for _how, _sql_how in (("mean", "avg"), ("max", "max"), ("min", "min")):

    @query(f"iqr_replace_{_how}", _replace_sql(_sql_how, MEASURES), ("readings",))
    def _(spark, sf, how=_how):
        df = views.readings(spark, sf).select("event_id", *MEASURES)
        return rounded(outliers.iqr_replace(df, MEASURES, how), *MEASURES)


def cascade_sql(columns: list[str], source: str = "readings") -> str:
    """Common table expressions c0, c1, ..: rows left after each measure's filter."""
    ctes, last = [], source
    for i, c in enumerate(columns):
        ctes.append(f"""c{i} AS (SELECT {last}.* FROM {last}, ({_BOUNDS.format(c=f'"{c}"', t=last)}) WHERE {_in(f'"{c}"')})""")
        last = f"c{i}"
    return ", ".join(ctes)


@query(
    "iqr_filter_cascade",
    f"WITH {cascade_sql(MEASURES)} SELECT event_id, "
    + ", ".join(
        f'round(("{c}" - (SELECT min("{c}") FROM c{i})) / (SELECT max("{c}") - min("{c}") FROM c{i}), 6) AS "{c}"'
        for i, c in enumerate(MEASURES)
    )
    + f" FROM c{len(MEASURES) - 1}",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", *MEASURES)
    return rounded(outliers.iqr_filter_cascade(df, MEASURES), *MEASURES)


_GAPS = [
    "event_id",
    "date_time",
    "room_number",
    "CASE WHEN event_id % 7 < 3 THEN vis END AS vis",
    "CASE WHEN event_id % 50 = 1 THEN device_id END AS device_id",
    "CASE WHEN event_id % 3 = 0 THEN tmp END AS tmp_diff",
]


def _fill_sql(within: str) -> str:
    after = f"OVER ({within} ORDER BY date_time, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    before = f"OVER ({within} ORDER BY date_time, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def fill(c: str) -> str:
        return f"coalesce(first_value({c} IGNORE NULLS) {after}, last_value({c} IGNORE NULLS) {before}) AS {c}"

    return f"""SELECT event_id, date_time, room_number, {fill("vis")}, {fill("device_id")}, coalesce(tmp_diff, 0) AS tmp_diff
    FROM (SELECT {', '.join(_GAPS)} FROM rooms)"""


def _fill(spark, sf, within):
    df = views.rooms(spark, sf).selectExpr(*_GAPS)
    return cleaning.fill_na(df, RowOrder(df, ["date_time", "event_id"], within))


@query("fill_na", _fill_sql(""), ("rooms",))
def _(spark, sf):
    return _fill(spark, sf, [])


@query("fill_na_by_room", _fill_sql("PARTITION BY room_number"), ("rooms",))
def _(spark, sf):
    return _fill(spark, sf, ["room_number"])


@query(
    "fill_na_forward",
    """SELECT event_id, date_time, room_number, last_value(vis IGNORE NULLS) OVER (PARTITION BY room_number ORDER BY date_time, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS vis
    FROM (SELECT event_id, date_time, room_number, CASE WHEN event_id % 7 < 3 THEN vis END AS vis FROM rooms)""",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).selectExpr("event_id", "date_time", "room_number", "CASE WHEN event_id % 7 < 3 THEN vis END AS vis")
    return cleaning.fill_na(df, RowOrder(df, ["date_time", "event_id"], ["room_number"]), ["vis"], direction="forward")


@query(
    "replace_inf",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 0 ELSE vis END AS vis, "IR" FROM readings""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 7 == 0, F.lit(float("-inf")))
        .otherwise(F.col("vis"))
        .alias("vis"),
        "IR",
    )
    return cleaning.replace_inf(df)


@query(
    "split_features_label",
    """SELECT vis, tmp, hum, NULL::DOUBLE AS "CO2" FROM readings UNION ALL SELECT NULL, NULL, NULL, "CO2" FROM readings""",
    ("readings",),
)
def _(spark, sf):
    x, y = cleaning.split_features_label(views.readings(spark, sf).select("vis", "tmp", "hum", "CO2"), "CO2")
    return x.unionByName(y, allowMissingColumns=True)


@query(
    "global_diff",
    """SELECT event_id, date_time, vis, "IR", vis - lag(vis) OVER w AS vis_diff, "IR" - lag("IR") OVER w AS "IR_diff"
    FROM readings WINDOW w AS (ORDER BY date_time, event_id)""",
    ("readings",),
)
def _(spark, sf):
    df = views.readings(spark, sf).select("event_id", "date_time", "vis", "IR")
    return global_diff(df, ["vis", "IR"], RowOrder(df, ["date_time", "event_id"]))


@query(
    "global_row_index",
    "SELECT event_id, row_number() OVER (ORDER BY date_time, room_number, event_id) - 1 AS row_index FROM rooms",
    ("rooms",),
)
def _(spark, sf):
    df = views.rooms(spark, sf).select("event_id", "date_time", "room_number")
    order = RowOrder(df, ["date_time", "room_number", "event_id"])
    return order.index(order.attach(df)).select("event_id", F.col("row_index").cast("bigint").alias("row_index"))


@query("forest_repeatable", "SELECT 0 AS differing")
def _(spark, sf):
    """Rows that only one of two partitionings keeps."""
    df = views.readings(spark, sf)
    kept = [remove_outliers_forest(part, trees=4, seed=3).select("event_id") for part in (df, df.repartition(5))]
    both = kept[0].exceptAll(kept[1]).unionAll(kept[1].exceptAll(kept[0]))
    return both.agg(F.count(F.lit(1)).cast("int").alias("differing"))


@query("forest_outliers")
def _(spark, sf):
    return remove_outliers_forest(views.readings(spark, sf))


@query(
    "forest_share",
    """SELECT count(*) AS readings, count(*) - CAST(ceil(0.075 * (count(*) - 1)) AS BIGINT) AS kept, true AS parted, true AS in_range
    FROM readings""",
    ("readings",),
)
def _(spark, sf):
    """How many readings the forest keeps, and that no reading kept scores below one that is dropped."""
    df = views.readings(spark, sf)
    scored = anomaly_scores(df).select("event_id", "anomaly_score")
    kept = remove_outliers_forest(df).select("event_id", F.lit(True).alias("kept"))
    joined = scored.join(kept, "event_id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    score = F.col("anomaly_score")
    return joined.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if("kept").alias("kept"),
        (F.min(F.when(F.col("kept"), score)) > F.max(F.when(~F.col("kept"), score))).alias("parted"),
        ((F.min(score) > -1) & (F.max(score) < 0)).alias("in_range"),
    )
