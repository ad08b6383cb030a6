"""Chat formatting with a grammar round trip, in DataFrame operations only.

A turn is rendered as ``<s>`` header body ``</s>``:

    user       [INST] text [/INST]
    assistant  text
    system     <<SYS>>text
    other      [ROLE]role[/ROLE]text

The parser splits at ``</s>``, reads the header and takes one backslash out of every control string that
holds one. A turn is rendered as it is when parsing it alone gives back its role and text; otherwise every
control string inside it gets one backslash more after its first character, which parsing takes out again.
The parsed conversation is compared with the source once more after assembly.

Turns are ordered by ``turn`` (null first), then role and text, so ties have one defined order. Null roles
and texts are empty. A null ``conv_id`` is a conversation of its own. An empty table gives an empty
result. Only the four named columns are read, so other columns cannot clash. A conversation is one
output value and so has to fit in a task; how many conversations or copies there are does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings, with the backslashes that escaping puts after the first character.
CONTROL = r"(<|\[)(\\*)(/?s>|/?INST\]|/?ROLE\]|<SYS>>)"
ESCAPED = r"(<|\[)\\(\\*)(/?s>|/?INST\]|/?ROLE\]|<SYS>>)"
END = "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def header(role: Column, safe_role: Column) -> Column:
    other = F.concat(F.lit("[ROLE]"), safe_role, F.lit("[/ROLE]"))
    return (
        F.when(role == "user", "[INST] ").when(role == "assistant", "").when(role == "system", "<<SYS>>").otherwise(other)
    )


def footer(role: Column) -> Column:
    return F.when(role == "user", " [/INST]").otherwise("")


def parse_turn(piece: Column) -> Column:
    """Role and text of one rendered turn without its ``</s>``."""
    body = F.regexp_replace(piece, "^<s>", "")
    user = body.startswith("[INST] ") & body.endswith(" [/INST]") & (F.length(body) >= 15)
    system = body.startswith("<<SYS>>")
    named = body.startswith("[ROLE]") & body.contains("[/ROLE]")
    role = (
        F.when(user, F.lit("user"))
        .when(system, F.lit("system"))
        .when(named, unescape(F.substring_index(body.substr(F.lit(7), F.length(body)), "[/ROLE]", 1)))
        .otherwise(F.lit("assistant"))
    )
    rest = F.regexp_replace(body, r"(?s)^\[ROLE\].*?\[/ROLE\]", "")
    text = (
        F.when(user, body.substr(F.lit(8), F.length(body) - 15))
        .when(system, body.substr(F.lit(8), F.length(body)))
        .when(named, rest)
        .otherwise(body)
    )
    return F.struct(role.alias("role"), unescape(text).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.split(formatted, END, -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parse_turn)


def rendered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Per turn: header, body and footer, escaped where the turn alone does not survive the round trip."""
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    raw = F.concat(F.lit("<s>"), header(F.col("role"), F.col("role")), "text", footer(F.col("role")))
    rows = rows.withColumn("_raw", F.concat(raw, F.lit(END)))
    back = parse(F.col("_raw"))
    source = F.array(F.struct("role", "text"))
    rows = rows.withColumn("_plain", back == source).drop("_raw")
    return rows.withColumns(
        {
            "_head": F.concat(
                F.lit("<s>"), header(F.col("role"), F.when(F.col("_plain"), F.col("role")).otherwise(escape(F.col("role"))))
            ),
            "_body": F.when(F.col("_plain"), F.col("text")).otherwise(escape(F.col("text"))),
            "_foot": F.concat(footer(F.col("role")), F.lit(END)),
        }
    )


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans`` (start and length in code points of every
    assistant body), ``source`` turns and ``round_trip`` (whether parsing gives the source back)."""
    rows = rendered_turns(turns, conv, turn, role, text)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    length = F.length("_head") + F.length("_body") + F.length("_foot")
    rows = rows.withColumn("_at", F.row_number().over(order)).withColumn(
        "_start", F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    )
    span = F.struct(
        (F.col("_start") + F.length("_head")).alias("start"), F.length("_body").cast("long").alias("length")
    )
    part = F.struct(
        "_at",
        F.concat("_head", "_body", "_foot").alias("piece"),
        F.when(F.col("role") == "assistant", span).alias("span"),
        "role",
        "text",
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    whole = whole.select(
        "conv_id",
        F.array_join(F.transform("_parts", lambda p: p.piece), "").alias("formatted"),
        F.filter(F.transform("_parts", lambda p: p.span), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform("_parts", lambda p: F.struct(p.role.alias("role"), p.text.alias("text"))).alias("source"),
    )
    return whole.withColumn("round_trip", parse(F.col("formatted")) == F.col("source"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, read from the formatted text."""
    pieces = F.transform(spans, lambda s: unescape(F.substr(formatted, (s.start + 1).cast("int"), s.length.cast("int"))))
    return F.array_join(pieces, "")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what the formatted text gives back: turn count, hashes and lengths."""
    turns = parse(F.col("formatted"))
    lines = F.transform("_turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return (
        formatted.withColumns({"_turns": turns, "_loss": loss_text(F.col("formatted"), F.col("loss_spans"))})
        .select(
            "conv_id",
            F.size("_turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "round_trip",
        )
    )
