"""Sensor dumps: ``;``-separated text with a preamble line above the header.

The header of a file is its second line that is not blank, whatever stands in it; the first one is the preamble. Backslash
escapes are decoded before a line is taken apart. What is left out is counted per file in :func:`scan_dat_manifest`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import quoted
from ..operators.cleaning import nan_to_null
from ..schema import READING_TYPES, READINGS
from ..session import materialize

_HEX = "[0-9A-Fa-f]"
#: An escape that can be decoded; any other character after a backslash stays with it.
_ESCAPE = rf"\\(?:u{_HEX}{{4}}|U{_HEX}{{8}}|x{_HEX}{{2}}|[0-7]{{1,3}}|[^uUx])"
# Escapes of one letter.
_LETTERS = {"n": "\n", "r": "\r", "t": "\t", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", "'": "'", '"': '"'}


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _lines(spark: SparkSession, path: str, skip_unreadable: bool) -> DataFrame:
    """Lines that are not blank, as ``value``, with their file and what orders them in it."""
    skip = str(skip_unreadable).lower()
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("encoding", "ISO-8859-1")
        .option("ignoreCorruptFiles", skip)
        .option("ignoreMissingFiles", skip)
        .text(path)
    )
    return lines.filter(F.trim("value") != "").select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_at"),
    )


def unescaped(line: Column) -> Column:
    """The line with its backslash escapes decoded: ``\\xNN``, ``\\uNNNN``, ``\\UNNNNNNNN``, octal ones and those of one letter."""
    one = F.create_map(*[F.lit(x) for pair in _LETTERS.items() for x in pair])

    def decoded(piece: Column) -> Column:
        kind, rest = F.substring(piece, 2, 1), F.substring(piece, 3, 8)
        octal = F.lpad(F.conv(F.substring(piece, 2, 3), 8, 16), 4, "0")
        return (
            F.when(~piece.startswith("\\"), piece)
            .when(kind.isin("x", "u"), F.decode(F.unhex(F.lpad(rest, 4, "0")), "UTF-16BE"))
            .when(kind == "U", F.decode(F.unhex(rest), "UTF-32"))
            .when(kind.rlike("[0-7]"), F.decode(F.unhex(octal), "UTF-16BE"))
            .otherwise(F.coalesce(F.get(F.map_values(F.map_filter(one, lambda k, _: k == kind)), F.lit(0)), piece))
        )

    pieces = F.regexp_extract_all(line, F.lit(rf"{_ESCAPE}|[^\\]+"), F.lit(0))
    return F.when(F.contains(line, F.lit("\\")), F.array_join(F.transform(pieces, decoded), "")).otherwise(line)


def _broken(line: Column) -> Column:
    """Whether the line holds a backslash that begins no escape."""
    return F.contains(line, F.lit("\\")) & F.contains(F.regexp_replace(line, _ESCAPE, ""), F.lit("\\"))


def _heads(lines: DataFrame) -> DataFrame:
    """Per file its preamble and header line; the header is missing if there is none or it cannot be decoded.

    Spark keeps two lines of each file in every task before anything is shuffled.
    """
    first = Window.partitionBy("_file").orderBy("_at")
    two = lines.withColumn("_place", F.row_number().over(first)).filter("_place <= 2").groupBy("_file")
    heads = two.agg(F.max(F.when(F.col("_place") == 1, F.col("value"))).alias("_preamble"), F.max(F.when(F.col("_place") == 2, F.col("value"))).alias("_header"))
    layout = F.when(~_broken(F.col("_header")), F.trim(unescaped(F.col("_header"))))
    return materialize(heads.withColumn("_layout", layout), "dump-heads")


def _fields(layout: str, delimiter: str) -> list[str]:
    return [n.strip().strip('"') for n in layout.split(delimiter)]


def _parsed(layout: str, delimiter: str, columns: Mapping[str, T.DataType]) -> Column:
    """One line of this layout as a struct of all columns."""
    names = _fields(layout, delimiter)
    raw = ", ".join(f"{quoted(n)} string" for n in names)
    line = F.from_csv("text", raw, {"sep": delimiter, "mode": "PERMISSIVE"})

    def cast(row: Column) -> Column:
        return F.struct(
            *[(row[n].try_cast(kind) if n in names else F.lit(None).cast(kind)).alias(n) for n, kind in columns.items()]
        )

    # As an array element the line is parsed once, not once per column.
    return F.get(F.transform(F.array(line), cast), 0)


def _judged(lines: DataFrame, heads: DataFrame, layouts: Sequence[str], delimiter: str) -> DataFrame:
    """Every line but preambles and headers, as ``text``, with its file's layout and what becomes of it as ``_fate``.

    A line that repeats its file's preamble or header is neither a reading nor counted. Files are few beside lines; Spark
    broadcasts their table while it is small.
    """
    known = lines.join(heads, "_file").filter((F.col("value") != F.col("_preamble")) & ~F.col("value").eqNullSafe(F.col("_header")))
    broken = _broken(F.col("value"))
    # An escaped line break ends a line, as decoding comes first.
    split = F.when(F.contains("value", F.lit("\\")), F.split(unescaped(F.col("value")), "\r\n|\n|\r")).otherwise(F.array("value"))
    known = known.withColumn("text", F.explode(F.when(broken, F.array("value")).otherwise(split))).filter(F.trim("text") != "")
    # A quoted field may hold the delimiter, so quoted text is taken out before fields are counted.
    count = F.size(F.split(F.regexp_replace("text", '"[^"]*"', ""), delimiter))
    allowed = F.lit(None).cast("int")
    for layout in layouts:
        allowed = F.when(F.col("_layout") == layout, F.lit(len(_fields(layout, delimiter)))).otherwise(allowed)
    fate = F.when(F.col("_layout").isNull(), "headless").when(broken, "unreadable").when(count > allowed, "overlong").otherwise("read")
    return known.withColumn("_fate", fate)


def scan_dat(
    spark: SparkSession,
    path: str,
    delimiter: str = ";",
    types: Mapping[str, T.DataType] = READING_TYPES,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Read every file below ``path``; lines with too many fields are skipped, short ones padded.

    Files of different layouts are united by column name, in one scan after the one that finds the headers. A file that cannot be
    read raises, unless ``skip_unreadable`` leaves out what cannot be read.
    """
    lines = _lines(spark, path, skip_unreadable)
    heads = _heads(lines)
    layouts = [r._layout for r in heads.filter("_layout IS NOT NULL").groupBy("_layout").count().orderBy(F.desc("count"), "_layout").collect()]
    if not layouts:
        return spark.createDataFrame([], READINGS)
    columns = {n: types.get(n, T.StringType()) for layout in sorted(layouts) for n in _fields(layout, delimiter)}
    data = _judged(lines, heads, layouts, delimiter).filter("_fate = 'read'")
    row = _parsed(layouts[0], delimiter, columns)
    for layout in layouts[1:]:
        row = F.when(F.col("_layout") == layout, _parsed(layout, delimiter, columns)).otherwise(row)
    return nan_to_null(data.select(row.alias("r")).select("r.*"))


def scan_dat_manifest(spark: SparkSession, path: str, delimiter: str = ";") -> DataFrame:
    """One row per file below ``path``: its header, and how many lines are read, too long, cannot be decoded or lack a header.

    ``state`` is ``read``, ``no header`` or, for a file of which no line could be read, ``empty``.
    """
    lines = _lines(spark, path, True)
    heads = _heads(lines)
    layouts = [r._layout for r in heads.select("_layout").filter("_layout IS NOT NULL").distinct().collect()]
    judged = _judged(lines, heads, layouts, delimiter).groupBy("_file")
    fates = {"read": "lines_read", "overlong": "lines_overlong", "unreadable": "lines_unreadable", "headless": "lines_headless"}
    counted = judged.agg(*[F.count_if(F.col("_fate") == fate).alias(name) for fate, name in fates.items()])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select(F.col("path").alias("file"), F.col("length").alias("bytes"), _plain(F.col("path")).alias("_name"))
    known = heads.select("_layout", _plain(F.col("_file")).alias("_name")).join(
        counted.withColumn("_name", _plain(F.col("_file"))).drop("_file"), "_name", "left"
    )
    state = F.when(F.col("_found").isNull(), "empty").when(F.col("_layout").isNull(), "no header").otherwise("read")
    found = files.join(known.withColumn("_found", F.lit(True)), "_name", "left")
    return found.select("file", "bytes", state.alias("state"), F.col("_layout").alias("header"), *[F.coalesce(n, F.lit(0)).alias(n) for n in fates.values()])


def _plain(path: Column) -> Column:
    """The path without its scheme, decoded: the two sources write it differently."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), r"^[A-Za-z]+:/*", "/")


def scan_with_fallback(spark: SparkSession, extracted: str, original: str, **options) -> DataFrame:
    """Read the extracted folder; if it has nothing, the original one; else an empty table."""
    for path in (extracted, original):
        try:
            readings = scan_dat(spark, path, **options)
            if not readings.isEmpty():
                return readings
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], READINGS)
