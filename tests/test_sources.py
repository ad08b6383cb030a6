import pytest
from pyspark.sql import functions as F

from roomtide.schema import READINGS
from roomtide.sources import dumps, tables


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="latin-1")


HEADER = "date_time;device_id;tmp;CO2"


def test_preamble_short_and_long_lines(spark, tmp_path):
    write(tmp_path / "a", "one.dat", f"export\n{HEADER}\n2024-01-01 00:00:00;lab-co2-m001;20.5;400\n2024-01-01 00:01:00;lab-co2-m001\n1;2;3;4;5;6\n\n")
    write(tmp_path / "b" / "deep", "two.dat", f'export\n{HEADER}\n2024-01-02 00:00:00;"odd;name";NaN;x\n')
    rows = {r.date_time: r for r in dumps.scan_dat(spark, str(tmp_path)).collect()}
    assert set(rows) == {"2024-01-01 00:00:00", "2024-01-01 00:01:00", "2024-01-02 00:00:00"}
    assert rows["2024-01-01 00:01:00"].tmp is None
    odd = rows["2024-01-02 00:00:00"]
    assert (odd.device_id, odd.tmp, odd.CO2) == ("odd;name", None, None)


def test_layouts_are_united_by_name(spark, tmp_path):
    write(tmp_path, "one.dat", f"export\n{HEADER}\n2024-01-01 00:00:00;d1;20.5;400\n")
    write(tmp_path, "two.dat", "export\ndate_time;CO2;device_id\n2024-01-02 00:00:00;500;d2\n")
    rows = {r.device_id: r for r in dumps.scan_dat(spark, str(tmp_path)).collect()}
    assert (rows["d1"].CO2, rows["d1"].tmp) == (400.0, 20.5)
    assert (rows["d2"].CO2, rows["d2"].tmp) == (500.0, None)


def test_fallback_and_empty_schema(spark, tmp_path):
    write(tmp_path / "original", "one.dat", f"export\n{HEADER}\n2024-01-01 00:00:00;d1;20.5;400\n")
    missing, original = str(tmp_path / "extracted"), str(tmp_path / "original")
    assert dumps.scan_with_fallback(spark, missing, original).count() == 1
    (tmp_path / "extracted").mkdir()
    assert dumps.scan_with_fallback(spark, missing, original).count() == 1
    empty = dumps.scan_with_fallback(spark, missing, str(tmp_path / "nowhere"))
    assert empty.schema == READINGS and empty.isEmpty()


def test_sink_prunes_by_room(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "room_number string, v int")
    path = str(tmp_path / "t")
    tables.sink_parquet(df, path)
    back = tables.scan_parquet(spark, path)
    assert sorted(map(tuple, back.select("room_number", "v").collect())) == [("a", 1), ("a", 2), ("b", 3)]
    plan = back.filter("room_number = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(room_number" in plan
    with pytest.raises(Exception, match="already exists"):
        tables.sink_parquet(df, path)


def test_header_is_found_by_position(spark, tmp_path):
    write(tmp_path, "one.dat", f"\n;export;of;m001\n\n{HEADER}\n2024-01-01 00:00:00;d1;20.5;400\n2024-01-02 00:00:00\n")
    write(tmp_path, "two.dat", "x\ntime;CO2\n2024-01-03 00:00:00;7\n")
    rows = dumps.scan_dat(spark, str(tmp_path)).orderBy("device_id", "date_time").collect()
    assert [(r.date_time, r.device_id, r.CO2, r.time) for r in rows] == [
        (None, None, 7.0, "2024-01-03 00:00:00"), ("2024-01-02 00:00:00", None, None, None), ("2024-01-01 00:00:00", "d1", 400.0, None),
    ]


ESCAPED = ["\\x41\\u00e9\\101\\t", "\\\\x41", "a\\qb", "\\'\\\"", "\xe9\\xe9", "\\U0001F600", "plain", "\\7z", "\\u4e2d"]


def test_escapes_are_those_of_the_codec(spark):
    frame = spark.createDataFrame([(t,) for t in ESCAPED], "t string")
    for r in frame.select("t", dumps.unescaped(F.col("t")).alias("u"), dumps._broken(F.col("t")).alias("b")).collect():
        assert r.u == r.t.encode("latin-1").decode("unicode_escape") and not r.b, r.t
    broken = spark.createDataFrame([(t,) for t in ["\\", "a\\x4", "\\u12g4", "\\\\\\", "\\U0001F60"]], "t string")
    assert all(r[0] for r in broken.select(dumps._broken(F.col("t"))).collect())


def test_manifest_counts_what_is_left_out(spark, tmp_path):
    lines = ["2024-01-01 00:00:00;d\\x31;20.5;400", "1;2;3;4;5", "bad\\x;1;2;3", "2024-01-01 00:01:00;d2", "a\\nb;c"]
    write(tmp_path, "good one.dat", f"export;;;\n{HEADER}\n" + "\n".join(lines) + "\n")
    write(tmp_path / "deep", "short+.dat", "only a preamble\n")
    write(tmp_path, "blank.dat", "\n\n")
    write(tmp_path, "header.dat", "export\nda\\x;b\n1;2\n")
    rows = {r.file.rsplit("/", 1)[1]: r for r in dumps.scan_dat_manifest(spark, str(tmp_path)).collect()}
    assert {n: (r.state, r.lines_read, r.lines_overlong, r.lines_unreadable, r.lines_headless) for n, r in rows.items()} == {
        "good one.dat": ("read", 4, 1, 1, 0), "short+.dat": ("no header", 0, 0, 0, 0), "blank.dat": ("empty", 0, 0, 0, 0), "header.dat": ("no header", 0, 0, 0, 1),
    }
    assert rows["good one.dat"].header == HEADER and rows["blank.dat"].bytes == 2
    found = dumps.scan_dat(spark, str(tmp_path)).collect()
    assert len(found) == 4 and {"d1", "d2", "c", None} == {r.device_id for r in found}


def test_a_broken_file_raises_by_default(spark, tmp_path):
    write(tmp_path, "one.dat", f"export\n{HEADER}\n2024-01-01 00:00:00;d1;20.5;400\n")
    (tmp_path / "two.dat.gz").write_bytes(b"no gzip at all")
    with pytest.raises(Exception, match="(?i)gzip|corrupt|two.dat"):
        dumps.scan_dat(spark, str(tmp_path)).collect()
    assert dumps.scan_dat(spark, str(tmp_path), skip_unreadable=True).count() == 1
    states = {r.file.rsplit("/", 1)[1]: r.state for r in dumps.scan_dat_manifest(spark, str(tmp_path)).collect()}
    assert states == {"one.dat": "read", "two.dat.gz": "empty"}
