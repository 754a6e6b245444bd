"""The operators over the given tables, one query each, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import chat, jaccard, language, merkle, middle, mixing, packing, pieces, quality, rollup, topk, toxicity, warc
from episodica.llm.common import WORD, id_crc
from episodica.session import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


PROBE = r"\### Assistant: </turn> ok"


@query(
    f"""
    WITH rows AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
    ), escaped AS (
        SELECT *, length('<|turn|>' || role || '<|says|>' || replace(replace(text, '\\', '\\b'), '<|', '\\l|') || '<|end|>') + 1 AS n
        FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(n)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id
    """
)
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and conversation -7 that says control strings, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    messages = rows.unionByName(probe).withColumn("content", chat.text_part(F.col("text")))
    formatted = chat.format_chats(messages)
    read = formatted.select(
        "conv_id", "text", chat.read_turns(F.col("text")).alias("turns"), chat.read_spans(F.col("text"), F.col("loss_spans")).alias("loss")
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(F.array_join("loss", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss", "").cast("binary"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


@query()
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 with half as many words again, no document more than twice."""
    mixed = mixing.mix(table(spark, folder, "documents"), Scratch(spark))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"))


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base rules and the weakly supervised verdict of every document."""
    return quality.judge(table(spark, folder, "documents"), Scratch(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


LETTER_WORD = r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*"


@query(
    f"""
    WITH counted AS (
        SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS all_words,
            len(regexp_extract_all(coalesce(text, ''), '{LETTER_WORD}')) AS letter_words
        FROM documents
    ), versions AS (
        SELECT source, lang, 'words-1' AS tokenizer, all_words AS tokens FROM counted
        UNION ALL SELECT source, lang, 'words-2', letter_words FROM counted
    )
    SELECT source, lang, tokenizer, count(*) AS docs, sum(tokens)::BIGINT AS tokens
    FROM versions GROUP BY source, lang, tokenizer
    """
)
def op5_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Token totals of all documents under two tokenizer versions, kept by five batches of changes, one of them sent twice.

    The documents arrive with their counts under both versions, the second by mistake with the first one's counts; the
    next batch revises those, another deletes the documents of fewer than 20 words, and the last one adds them again.
    """
    scratch = Scratch(spark)
    text = F.coalesce("text", F.lit(""))
    counted = scratch.save(
        table(spark, folder, "documents").select(
            "source", "lang",
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("all_words"),
            F.regexp_count(text, F.lit(LETTER_WORD)).cast("long").alias("letter_words"),
        ),
        "rollup-counts",
    )
    totals = rollup.TokenRollup(spark, f"{scratch.path}/rollup")

    def change(kind: str, version: str, before, after) -> DataFrame:
        return counted.select(
            F.lit(kind).alias("change"), "source", "lang", F.lit(version).alias("tokenizer"),
            before.alias("tokens_before"), after.alias("tokens"), "all_words",
        )

    none, first, second = F.lit(None).cast("long"), F.col("all_words"), F.col("letter_words")
    short = F.col("all_words") < 20
    revised = change("revise", "words-2", first, second)
    totals.commit("arrival", change("insert", "words-1", none, first).unionByName(change("insert", "words-2", none, first)))
    totals.commit("recount", revised)
    totals.commit("recount", revised)
    totals.compact()
    gone = change("delete", "words-1", first, none).filter(short).unionByName(change("delete", "words-2", second, none).filter(short))
    totals.commit("too short", gone)
    back = change("insert", "words-1", none, first).filter(short).unionByName(change("insert", "words-2", none, second).filter(short))
    totals.commit("short again", back)
    return totals.totals()


@query()
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back."""
    read = warc.archive(table(spark, folder, "pages"), Scratch(spark))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 highest integer inner products of every vector whose id is divisible by 20."""
    return topk.search(table(spark, folder, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    decoded = pieces.encode_and_decode(docs, path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded with an end id and decoded again."""
    return token_digests(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from three quarters of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.learn(docs.filter(id_crc("doc_id") % 4 != 2))
    held_out = F.coalesce(id_crc("doc_id") % 4 == 2, F.lit(False))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learnt from four fifths of the labels."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"), Scratch(spark), id_crc("doc_id") % 5 != 0)
    scored = docs.select("doc_id", toxicity.score(model)(F.col("text")).alias("score"))
    held_out = F.coalesce(id_crc("doc_id") % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 percent of their 4-word shingles."""
    joined = jaccard.join(table(spark, folder, "documents"), Scratch(spark), jaccard.Rule(words=4, percent=85))
    return joined.documents.select("doc_id", "n_shingles", "component_id", "class_id")


@query()
def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in sequences of 2,048."""
    return packing.pack(table(spark, folder, "documents"), Scratch(spark), public_tokenizers.path("word_bpe_49k.json"))


@query(
    """
    WITH drawn AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
            list_transform(range(4), lambda i: ('0x' || substring(sha256('1:' || coalesce(doc_id::VARCHAR, '')), 1 + 8 * i, 8))::BIGINT) AS h
        FROM documents
    ), cuts AS (
        SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                 WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn
    ), parts AS (
        SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM cuts
    )
    SELECT doc_id, n::BIGINT AS n, form, (CASE WHEN form <> 'plain' THEN a END)::BIGINT AS prefix_chars,
        (CASE WHEN form <> 'plain' THEN b - a END)::BIGINT AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM parts
    """
)
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle moved to the end, and read back."""
    cut = middle.transform(table(spark, folder, "documents"))
    restored = middle.restore(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form",
        F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored.cast("binary"), 256).alias("restored_sha256"),
    )


def framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


@query(
    f"""
    WITH RECURSIVE named AS (
        SELECT *, doc_id::VARCHAR AS name, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS place,
            count(*) OVER (PARTITION BY lang) AS size, row_number() OVER () AS nr
        FROM documents
    ), crc AS (  -- one bit a step
        SELECT nr, name, 0 AS i, 4294967295 AS c FROM named WHERE name IS NOT NULL
        UNION ALL
        SELECT nr, name, i + 1, CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END
        FROM (SELECT nr, name, i, CASE WHEN i % 8 = 0 THEN xor(c, ascii(substring(name, i // 8 + 1, 1))) ELSE c END AS x FROM crc WHERE i < 8 * length(name))
    ), tampered AS (
        SELECT nr FROM crc WHERE i = 8 * length(name) AND xor(c, 4294967295) % 7 = 0
    ), leaves AS (
        SELECT nr, doc_id, lang, place, size, sha256(concat({", ".join(framed(c) for c in LEAF)})) AS leaf,
            sha256(concat({", ".join(framed("(n_chars + 1)" if c == "n_chars" else c) for c in LEAF)})) AS changed
        FROM named
    ), tree AS (
        SELECT lang, 0 AS level, place, size, leaf AS digest FROM leaves
        UNION ALL
        SELECT lang, level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
        FROM tree WHERE size > 1 GROUP BY lang, level, place // 2, size
    ), subroots AS (
        SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size,
            level AS height
        FROM tree WHERE size = 1
    ), crown AS (
        SELECT 0 AS level, place, size, digest FROM subroots
        UNION ALL
        SELECT level + 1, place // 2, (size + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
        FROM crown WHERE size > 1 GROUP BY level, place // 2, size
    ), walk AS (  -- the levels over every leaf, through its subroot to below the root
        SELECT l.nr, t.level, t.place AS other, t.digest, t.place > (l.place >> t.level) AS is_right
        FROM leaves l JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.size > 1 AND t.place = xor(l.place >> t.level, 1)
        UNION ALL
        SELECT l.nr, s.height + c.level, c.place, c.digest, c.place > (s.place >> c.level)
        FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
        JOIN crown c ON c.size > 1 AND c.place = xor(s.place >> c.level, 1)
    ), heights AS (
        SELECT lang, digest AS subroot, height + (SELECT max(level) FROM crown) AS height FROM subroots
    ), proofs AS (
        SELECT nr, sha256(string_agg(digest, '' ORDER BY level)) AS proof FROM walk GROUP BY nr
    ), folds AS (
        SELECT l.nr, 0 AS level, h.height, CASE WHEN t.nr IS NOT NULL THEN changed ELSE leaf END AS digest
        FROM leaves l LEFT JOIN tampered t ON t.nr = l.nr JOIN heights h ON h.lang IS NOT DISTINCT FROM l.lang
        UNION ALL
        SELECT f.nr, f.level + 1, f.height, sha256(CASE WHEN w.is_right THEN f.digest || w.digest ELSE coalesce(w.digest, '') || f.digest END)
        FROM folds f LEFT JOIN walk w ON w.nr = f.nr AND w.level = f.level WHERE f.level < f.height
    )
    SELECT doc_id, leaf, subroot, (SELECT digest FROM crown WHERE size = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
        f.digest AS folded_root, f.digest = (SELECT digest FROM crown WHERE size = 1) AS verified
    FROM leaves l JOIN heights h ON h.lang IS NOT DISTINCT FROM l.lang JOIN folds f ON f.nr = l.nr AND f.level = f.height
    LEFT JOIN proofs p ON p.nr = l.nr
    """
)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the row that a verifier sees leads to the root."""
    tampered = (F.coalesce(id_crc("doc_id") % 7 == 0, F.lit(False)), {"n_chars": F.col("n_chars") + 1})
    found = merkle.manifest(table(spark, folder, "documents"), Scratch(spark), LEAF, shown=tampered)
    return found.withColumnRenamed("id", "doc_id")
