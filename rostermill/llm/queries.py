"""The operators of this package bound to the benchmark tables.

Each query applies its operator to a whole table with the parameters meant
for production and derives the columns of its contract from what the operator
returns. ``ORACLES`` has the same result as SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.llm import (
    bpe,
    chat,
    collision_search,
    embed_dedup,
    exact_dedup,
    importance,
    langid,
    ngram_join,
    packing,
    periodic_runs,
    token_shards,
    toxicity,
    warc,
)
from rostermill.workdir import fresh_folder, staged

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL, under the function's name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = langid.train(docs.where(~held_out))
    return langid.predict(docs, model, keep={"doc_id": F.col("doc_id"), "held_out": held_out})


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, learned from the toxic labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


@query()
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by four-word shingles, similarity 0.85."""
    join = ngram_join.Join(words=4, share=85, of=100)
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"), join)


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of 4096 ids, with a checksum per piece."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of both directions."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), TOKENIZER)


_ESCAPED_EXTRA = " + ".join(
    ["length({0}) - length(replace({0}, chr(92), ''))"]
    + [f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in chat.CONTROL]
)


@query(
    f"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length(text) + {_ESCAPED_EXTRA.format("text")}
               + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                 ELSE 19 + length(role) + {_ESCAPED_EXTRA.format("role")} END)::BIGINT AS formatted_chars
    FROM rows GROUP BY conv_id
    """
)
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations, write them, and digest what is read back."""
    marked = "</s>[INST] ok [/INST]"
    more = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0, 'user', '{marked}'), (-1L, 1, 'assistant', '{marked}') AS t(conv_id, turn, role, text)"
    )
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations")).unionByName(more)
    back = chat.read_back(staged(chat.format_turns(turns), "chats"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as shards with an index; read them back by key."""
    docs, folder = table(spark, sf_dir, "documents"), fresh_folder(spark, "shards")
    token_shards.write_shards(docs, TOKENIZER, folder)
    buckets = token_shards.write_index(spark, folder)
    return token_shards.read_keys(spark, folder, buckets, docs)


@query(
    """
    WITH d AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id stays."""
    return exact_dedup.mark(table(spark, sf_dir, "documents")).drop("place")


@query(
    """
    WITH p AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
        FROM pages
    ), g AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
        FROM p
    )
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM g
    """
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC files, and what reading them gives."""
    folder = fresh_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder)


@query(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    ), good AS (
        SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v
        WHERE label IS NOT NULL AND e IS NOT NULL
          AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION
        SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
    ), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = c.vec_id) AS n_links, component_id,
           vec_id = component_id AS kept
    FROM c
    """
)
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of one label, cosine 0.98 and above."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which are made to repeat a stretch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^ \x09-\x0D]+"), F.lit(0))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    looped = docs.where(h % 10 == 0).withColumn("words", F.coalesce(words, F.array())).withColumn("h", h)
    looped = looped.withColumn("a", F.when(n > 0, g % n).cast("int")).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    turn = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))),
    )
    looped = looped.select("doc_id", F.when(n > 0, F.array_join(turn, " ")).alias("text"))
    plain = docs.where(~F.coalesce(h % 10 == 0, F.lit(False)))
    found = periodic_runs.periodic_runs(plain.unionByName(looped))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = periodic_runs.longest("runs")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth, by inner product."""
    return collision_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents drawn towards the words of the benchmark."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
