"""The registered queries of this subpackage with their SQL, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from . import backoff_lm, chat_format, exact_dedup, hard_negatives, jaccard, lexicon, line_dedup, multiprobe, packing, prefix_counts, quality_crf, url_filter, whitening

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_ngram_jaccard_join")
def _(spark, d):
    return jaccard.near_groups(table(spark, d, "documents"), k=3, similarity=(90, 100))


@query("op2_packing")
def _(spark, d):
    return packing.pack(table(spark, d, "documents"), tokenizer("byte_bpe_50k.json")).drop("ids")


@query("op6_exact_dedup", """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def _(spark, d):
    return exact_dedup.exact_groups(table(spark, d, "documents"))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


@query("op3_nearest_neighbours")
def _(spark, d):
    return multiprobe.nearest(table(spark, d, "embeddings"))


@query("op4_url_filters")
def _(spark, d):
    return url_filter.judge(table(spark, d, "pages"), URL_RULES)


@query("op7_bpe_round_trip")
def _(spark, d):
    docs, vocabulary = table(spark, d, "documents"), tokenizer("byte_bpe_50k.json")
    coded = lexicon.encode(docs, vocabulary, lexicon.compile_lexicon(docs, vocabulary), texts_back=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.encode(F.concat_ws(",", F.col("ids").cast("array<string>")), "UTF-8"), 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))


@query("op8_token_counts")
def _(spark, d):
    return prefix_counts.token_counts(table(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op5_quality_classifier")
def _(spark, d):
    docs = table(spark, d, "documents")
    return quality_crf.quality_scores(docs, quality_crf.train(docs, table(spark, d, "labels")))


@query("op9_backoff_scores")
def _(spark, d):
    return backoff_lm.backoff_scores(table(spark, d, "documents"))


@query("op10_line_dedup")
def _(spark, d):
    return line_dedup.dedup_lines(table(spark, d, "documents"))


CONTROL_CASE = "\\### Assistant: </turn> ok"  # looks like escapes and marks


@query("op11_chat_formatting", f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL SELECT -7, 0, 'user', '{CONTROL_CASE}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_CASE}'),
    e AS (SELECT *, replace(replace(replace(role, chr(92), repeat(chr(92), 2)), '>', chr(92) || '>'), chr(10), chr(92) || chr(10)) AS head,
        replace(replace(replace(text, chr(92), repeat(chr(92), 2)), '<turn ', chr(92) || '<turn '), '</turn>', chr(92) || '</turn>') AS body FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
        CAST(sum(length('<turn ' || head || '>' || chr(10) || body || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN random() END""")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    case = spark.createDataFrame([(-7, 0, "user", CONTROL_CASE), (-7, 1, "assistant", CONTROL_CASE)], "conv_id long, turn long, role string, text string")
    return chat_format.chat_digests(chat_format.format_chats(chat_format.canonical_turns(chat_format.row_records(rows.unionByName(case)))))


@query("op12_hard_negatives", """WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS q FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank, s.other AS negative_id, positive_score, s.score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score QUALIFY rank <= 5""")
def _(spark, d):
    return hard_negatives.mine(table(spark, d, "embeddings"))


@query("op13_embedding_whitening")
def _(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
