"""One query per operator over its whole table, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, new_path
from . import chat, language, lm, merkle, mixing, packing, pii, quality, sharding, simhash, topk, variants, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = 8
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Remainders of the documents that are held out when a model is fitted.
SUBWORDS = lm.Subwords(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, end_id=50_256)
SCORING_FOLDS, SCORING_HELD_OUT = 7, 2
TOP_K, QUERY_EVERY = 10, 100
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(folds: int) -> Column:
    """Remainder of the CRC-32 of the document's id written as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


MIX_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::DOUBLE AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM sizes GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source_size / w, source) AS k, 1.5 * sum(source_size) OVER () AS total FROM sources
), levels AS (
    SELECT *, (total - coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked
), targets AS (
    SELECT source, source_size, w,
           least(2 * source_size, w * (SELECT arg_min(level, k) FROM levels l WHERE 2 * l.source_size > l.w * l.level)) AS target
    FROM levels
), places AS (
    SELECT s.*, t.source_size, coalesce(t.target, 2 * t.source_size) AS target,
           coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 3) AS target,
       size * ((before + size / 2.0 < target)::BIGINT + (source_size + before + size / 2.0 < target)::BIGINT) AS taken
FROM places
"""


@query("op3_curriculum_mix", MIX_SQL)
def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size, its source's target and the words that the mix takes."""
    docs = table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", mixing.word_count().alias("words")), "sizes")
    mixed = mixing.mix(sizes, size=F.col("words"))
    ordered = mixed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), "taken")


@query("op4_jump_shards")
def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and its shard with one shard more."""
    return sharding.shard_slots(table(spark, sf_dir, "documents"), SHARDS)


CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|/?ROLE\]|<SYS>>)')) AS marks,
           CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 0 WHEN 'system' THEN 7 ELSE 13 + length(role) END + 7 AS frame
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(length(text) + frame + marks)::BIGINT AS formatted_chars, true AS round_trip
FROM sized GROUP BY conv_id
"""


@query("op8_chat_round_trip", CHAT_SQL)
def op8_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    added = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :hard), (-1L, 1L, 'assistant', :hard) AS t(conv_id, turn, role, text)",
        args={"hard": hard},
    )
    return chat.digests(chat.format_conversations(turns.unionByName(added)))


@query("op10_ppm_language")
def op10_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT)
    model = language.fit(docs, ~F.col("held_out"))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


TOP_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           coalesce(list_sum(list_transform(q.v, lambda x, i: x::HUGEINT * c.v[i])), 0)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


@query("op6_nra_top_k", TOP_SQL)
def op6_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best inner products of every hundredth vector among all others."""
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.filter(F.col("vec_id") % QUERY_EVERY == 0), vectors, TOP_K)


WARC_SQL = """
WITH pages AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), marked AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM marked
"""


@query("op9_warc_revisits", WARC_SQL)
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, repeats as revisits, and read back."""
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op2_simhash_components")
def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the component of near copies that it belongs to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_boosted_quality")
def op5_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, trees).drop("text")


@query("op7_bounded_packing")
def op7_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), PACKING_TOKENIZER)
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


@query("op1_attention_scores")
def op1_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under the attention model and the base model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(SCORING_FOLDS) == SCORING_HELD_OUT, F.lit(False))
    model, words = lm.fit(docs, ~held_out, SUBWORDS)
    scored = lm.score(docs, model, words)
    return scored.select("doc_id", held_out.alias("held_out"), *[c for c in scored.columns if c != "doc_id"])


#: The 26 letters that the contracts of operators 11 and 12 lower.
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: SQL for the CRC-32 of a list of bytes, and the table it needs as the CTE ``crc``.
CRC_TABLE = """crc AS MATERIALIZED (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t
    FROM range(256) r(i)
)"""


def crc_sql(codes: str) -> str:
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


def _leaf_sql(text: str) -> str:
    parts = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({p}::VARCHAR)::VARCHAR || ':' || {p}::VARCHAR, '-')" for p in parts) + "))"


MERKLE_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, hashed AS MATERIALIZED (
    SELECT doc_id, coalesce('1' || source, '0') AS grp, {_leaf_sql("text")} AS leaf,
           CASE WHEN {crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")} % 5 = 0
                THEN {_leaf_sql(f"translate(text, '{CAPITALS}', '{SMALL}')")} END AS tampered
    FROM documents, crc
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
    FROM hashed
), nodes AS (
    SELECT grp, 0 AS lvl, pos, leaf AS hash, n FROM placed
    UNION ALL
    SELECT grp, lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM nodes WHERE n > 1 GROUP BY grp, lvl, pos // 16
), subroots AS MATERIALIZED (
    SELECT grp, lvl AS height, hash, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS lvl, pos, hash, n FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM tops WHERE n > 1 GROUP BY lvl, pos // 16
), every_node AS MATERIALIZED (
    SELECT grp, lvl, pos, hash FROM nodes WHERE n > 1
    UNION ALL SELECT s.grp, s.height + t.lvl, t.pos, t.hash FROM subroots s, tops t WHERE t.n > 1
), walk AS (
    SELECT p.doc_id, p.grp, p.leaf, p.pos AS place, s.pos AS top_place, s.height, 0 AS lvl,
           CASE WHEN s.height = 0 THEN s.pos ELSE p.pos END AS spot, '' AS siblings, coalesce(p.tampered, p.leaf) AS node
    FROM placed p JOIN subroots s USING (grp)
    UNION ALL
    SELECT w.doc_id, w.grp, w.leaf, w.place, w.top_place, w.height, w.lvl + 1,
           CASE WHEN w.lvl + 1 = w.height THEN w.top_place ELSE w.spot // 16 END,
           any_value(w.siblings) || coalesce(string_agg(e.hash, '' ORDER BY e.pos) FILTER (e.pos <> w.spot), ''),
           sha256(string_agg(CASE WHEN e.pos = w.spot THEN w.node ELSE e.hash END, '' ORDER BY e.pos))
    FROM walk w JOIN every_node e ON e.grp = w.grp AND e.lvl = w.lvl AND e.pos // 16 = w.spot // 16
    GROUP BY w.doc_id, w.grp, w.leaf, w.place, w.top_place, w.height, w.lvl, w.spot
)
SELECT w.doc_id, w.leaf, s.hash AS subroot, r.hash AS root, sha256(w.siblings) AS proof_sha256, w.node AS folded_root,
       w.node = r.hash AS verified
FROM walk w JOIN subroots s USING (grp), (SELECT hash, lvl FROM tops WHERE n = 1) r
WHERE w.lvl = w.height + r.lvl
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document; a fifth of the texts, lower-cased, must fail to verify if that changes them."""
    docs = table(spark, sf_dir, "documents")
    lowered = {f: F.col(f) for f in merkle.FIELDS} | {"text": F.translate("text", CAPITALS, SMALL)}
    tampered = F.when(fold(5) == 0, merkle.leaf_hash(lowered))
    found = merkle.proofs(merkle.build(docs, carry={"tampered": tampered}))
    found = found.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_hash(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def with_slip(word: Column, every: int = 199) -> Column:
    """The word, or one letter less where ``every`` divides the CRC-32 of ``<doc_id>:<word>``; the same hash picks the letter.

    A null id counts as the empty string.
    """
    hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    length = F.char_length(word)
    at = (hashed % length).cast("int")
    less = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, length))
    return F.when(hashed % every == 0, less).otherwise(word)


_POINT = "unicode(x)::BIGINT"
VARIANT_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
    SELECT doc_id, translate(w, '{CAPITALS}', '{SMALL}') AS w
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{6,}}')) AS w FROM documents)
), counted AS (
    SELECT doc_id, w, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || w AS label FROM runs GROUP BY doc_id, w
), hashed AS MATERIALIZED (
    SELECT w, counted.n, {crc_sql(f"flatten(list_transform(string_split(label, ''), lambda x: CASE WHEN {_POINT} < 128 THEN [{_POINT}] ELSE [192 + ({_POINT} >> 6), 128 + ({_POINT} & 63)] END))")} AS h
    FROM counted, crc
), slipped AS (
    SELECT CASE WHEN h % 199 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed
), vocabulary AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS MATERIALIZED (
    SELECT word, n, i, w_less FROM (
        SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary
    ), LATERAL (SELECT word[:i] || word[i + 2:] AS w_less)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n
    FROM places a JOIN places b ON a.i = b.i AND a.w_less = b.w_less AND a.word <> b.word AND length(a.word) = length(b.word)
    UNION
    SELECT a.word, b.word, b.n FROM places a JOIN vocabulary b ON a.w_less = b.word
    UNION
    SELECT b.word, a.word, a.n FROM places a JOIN vocabulary b ON a.w_less = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS top, arg_min(near, (-near_n, near)) AS near FROM pairs GROUP BY word
), forms AS MATERIALIZED (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * v.n THEN near END AS form,
           CASE WHEN top >= 5 * v.n THEN top END AS form_n
    FROM vocabulary v LEFT JOIN best USING (word)
), chains AS (
    SELECT word, coalesce(form, word) AS root, form IS NOT NULL AS open FROM forms
    UNION ALL
    SELECT c.word, coalesce(f.form, c.root), f.form IS NOT NULL FROM chains c JOIN forms f ON f.word = c.root WHERE c.open
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM forms f JOIN chains c ON c.word = f.word AND NOT c.open
"""


@query("op12_spelling_variants", VARIANT_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some with a letter dropped, each with its commoner neighbour and the end of that chain."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("doc_id", F.explode(variants.runs()).alias("run")).select(with_slip(F.col("run")).alias("word"))
    return variants.group(variants.vocabulary(words))


@query("op13_deobfuscated_pii")
def op13_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, plain and disguised, at places in the text as written."""
    return pii.find(table(spark, sf_dir, "documents")).drop("found")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences that the corpus pipeline makes of all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
