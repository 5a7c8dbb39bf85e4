"""Registered text, retrieval, routing and answer-quality queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed_values import ANSWER_TEMPLATES, COMPLEX_WORDS, DIRECT_PATTERNS, NON_ANSWERS, STOP_WORDS
from ..functions.semantics import norm, unit
from ..functions.text import raw_tokens, split_clean, token_set, trim_space
from ..operators import answers as A, chunking as K, nearest as N, retrieval as R, router as X, sparse_index as I
from . import sales, views as V
from .registry import Registry, r, rounded


def toks(t):
    """Token set of a text as a DuckDB list."""
    stop = ",".join(f"'{w}'" for w in STOP_WORDS)
    raw = f"list_transform(string_split_regex(lower({t}), '[^\\p{{L}}\\p{{N}}_.]+'), lambda x: trim(x,'.'))"
    return f"list_distinct(list_filter({raw}, lambda x: regexp_full_match(x,'[a-z0-9._]+') AND NOT list_contains([{stop}], x)))"


def words_of(t):
    """All tokens of a text, repeats and stop words included."""
    return f"list_filter(list_transform(string_split_regex(lower({t}), '[^\\p{{L}}\\p{{N}}_.]+'), lambda x: trim(x,'.')), lambda x: regexp_full_match(x,'[a-z0-9._]+'))"


def unit_sql(rows, key, n, df):
    """Unit TF-IDF weights of (key, term) rows."""
    return f"""SELECT {key}, term, w/sqrt(sum(w*w) OVER (PARTITION BY {key})) AS w FROM (SELECT {key}, term, count(*)*ln(({n}+1.0::DOUBLE)/(coalesce(any_value(f.df),0)+1.0::DOUBLE)) AS w
        FROM {rows} t LEFT JOIN {df} f USING (term) GROUP BY {key}, term) g WHERE w>0"""


def both(a, b):
    return f"len(list_intersect({a}, {b}))"


_hard = "regexp_matches(trim(lower(question), ' \t\r\n'), '" + X.whole_words(COMPLEX_WORDS) + "')"
_metric = "CASE " + " ".join(f"WHEN regexp_matches(trim(lower(question), ' \t\r\n'), '{p}') THEN '{m}'" for p, m in DIRECT_PATTERNS) + " END"
_text = "CASE metric " + " ".join(f"WHEN '{m}' THEN '{a}' || format('{{:,.{n}f}}', round(value,6)) || '{z}'" for m, (a, n, z) in ANSWER_TEMPLATES.items()) + " END"
_bad = " OR ".join(f"contains(lower(answer),'{p}')" for p in NON_ANSWERS)

EXTRA = {
    **sales.EXTRA,
    "w_class0": f"SELECT *, CASE WHEN NOT {_hard} THEN {_metric} END AS metric FROM v_questions",
    "w_class": "SELECT *, CASE WHEN metric IS NULL THEN 'rag' ELSE 'direct' END AS query_type FROM w_class0",
    "w_got": """SELECT id, 1 AS rank, 'reply_' || conv_id AS doc_name, 'reply_' || conv_id || '_chunk_' || printf('%03d', turn-1) AS chunk_id, 0.75::DOUBLE AS similarity, context AS text FROM v_answers WHERE context IS NOT NULL
        UNION ALL SELECT id, CASE WHEN context IS NULL THEN 1 ELSE 2 END, 'asked_' || conv_id, 'asked_' || conv_id || '_chunk_' || printf('%03d', turn), 0.5::DOUBLE, question FROM v_answers""",
    "w_ctx": "SELECT *, CASE WHEN context IS NULL THEN question ELSE context || ' ' || question END AS ctx, CASE WHEN context IS NULL THEN ['asked_' || conv_id] ELSE ['reply_' || conv_id, 'asked_' || conv_id] END AS retrieved_docs, "
             "CASE WHEN conv_id % 3 = 0 THEN []::VARCHAR[] ELSE ['reply_' || conv_id, 'asked_' || (conv_id + conv_id % 2)] END AS relevant_docs FROM v_answers",
    "w_tok": f"SELECT *, {toks('answer')} AS ans_t, {toks('question')} AS q_t, {toks('ctx')} AS c_t FROM w_ctx",
    "w_kw": """SELECT *, list_filter(expected_keywords, lambda k: contains(lower(answer), lower(k))) AS found, list_filter(expected_keywords, lambda k: NOT contains(lower(answer), lower(k))) AS missing FROM w_tok""",
    "w_pct": "SELECT *, CASE WHEN len(expected_keywords)>0 THEN len(found)/len(expected_keywords)::DOUBLE ELSE 1.0::DOUBLE END AS pct FROM w_kw",
    "w_graded": "SELECT *, pct*100 AS kw_pct, CASE WHEN pct>=0.6 THEN 'PASS' WHEN pct>0 THEN 'PARTIAL' ELSE 'FAIL' END AS grade FROM w_pct",
    "w_scored": f"""SELECT *, CASE WHEN length(answer)=0 THEN 0.0::DOUBLE WHEN len(ans_t)=0 THEN 1.0::DOUBLE ELSE round({both('ans_t', 'c_t')}/len(ans_t)::DOUBLE,4) END AS faithfulness,
        CASE WHEN query_type='direct' THEN CASE grade WHEN 'PASS' THEN 0.92::DOUBLE WHEN 'PARTIAL' THEN 0.65 WHEN 'FAIL' THEN 0.18 ELSE 0.5 END WHEN len(relevant_docs)=0 THEN 1.0::DOUBLE
          ELSE round(len(list_filter(relevant_docs, lambda x: list_contains(retrieved_docs,x)))/len(relevant_docs)::DOUBLE,4) END AS context_recall,
        CASE WHEN length(answer)=0 OR {_bad} THEN 0.0::DOUBLE WHEN len(ans_t)*len(q_t)=0 THEN 0.0::DOUBLE ELSE round({both('ans_t', 'q_t')}/sqrt(len(ans_t)*len(q_t)),4) END AS answer_relevancy FROM w_graded""",
    "w_cited": """SELECT *, answer || CASE WHEN conv_id % 2 = 0 THEN chr(10) || 'Sources : [2], [9], [2], [1]' ELSE ' SOURCES: [1]' END AS cited FROM v_answers WHERE answer <> ''""",
    "w_words": "SELECT doc_id, list_filter(string_split_regex(text,'[ \t\r\n]+'), lambda w: length(w)>0) AS w FROM documents",
    "w_slide0": "SELECT doc_id, w, unnest(generate_series(0, greatest(len(w)-51,0), 150)) AS s FROM w_words WHERE len(w)>0",
    "w_slide": "SELECT doc_id, (s/150)::BIGINT AS chunk_no, array_to_string(w[s+1:s+200],' ') AS text, len(w[s+1:s+200])::BIGINT AS tokens FROM w_slide0",
    "w_cterm": f"SELECT doc_id || '_' || chunk_no AS vec_id, unnest({words_of('text')}) AS term FROM w_slide",
    "w_cdf": "SELECT term, count(DISTINCT vec_id) AS df FROM w_cterm GROUP BY term",
    "w_cvec": unit_sql("w_cterm", "vec_id", "(SELECT count(*) FROM w_slide)", "w_cdf"),
    "w_qterm": f"SELECT conv_id || '_' || turn AS query_id, unnest({words_of('question')}) AS term FROM v_questions",
    "w_qvec": unit_sql("w_qterm", "query_id", "(SELECT count(*) FROM w_slide)", "w_cdf"),
    "w_found": """SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM
        (SELECT query_id, vec_id, round(sum(q.w*c.w),9) AS score FROM w_qvec q JOIN w_cvec c USING (term) GROUP BY ALL) x QUALIFY rank<=5""",
    "w_dterm": f"SELECT doc_id, unnest({words_of('text')}) AS term FROM documents",
    "w_ddf": "SELECT term, count(DISTINCT doc_id) AS df FROM w_dterm GROUP BY term",
    "w_cent0": "SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding,1) AS i FROM embeddings) e GROUP BY ALL",
    "w_cent": "SELECT label AS query_id, list(m/n ORDER BY i) AS q FROM (SELECT *, sqrt(sum(m*m) OVER (PARTITION BY label)) AS n FROM w_cent0) c GROUP BY label",
    "w_hits": """SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score,9) DESC, vec_id) AS rank FROM
        (SELECT query_id, vec_id, list_dot_product(q, embedding::DOUBLE[]) AS score FROM w_cent, embeddings) x QUALIFY rank<=5""",
}
reg = Registry(EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def docs(s, d):
    return V.table(s, d, "documents")


def records(s, d):
    """Answer records with contexts, retrieved and relevant documents."""
    a = V.answers(s, d)
    reply, asked = F.concat(F.lit("reply_"), "conv_id"), F.concat(F.lit("asked_"), "conv_id")
    other = F.concat(F.lit("asked_"), F.col("conv_id") + F.col("conv_id") % 2)
    return (a.withColumn("contexts", F.array_compact(F.array("context", "question")))
            .withColumn("retrieved_docs", F.array_compact(F.array(F.when(F.col("context").isNotNull(), reply), asked)))
            .withColumn("relevant_docs", F.when(F.col("conv_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(reply, other))))


def retrieved(s, d):
    """Retrieved chunks in long form: (id, rank, chunk_id, doc_name, similarity, text)."""
    a = V.answers(s, d)
    chunk = lambda kind, turn, sim, text: F.struct(
        F.concat(F.lit(kind), "conv_id").alias("doc_name"),
        F.concat(F.lit(kind), "conv_id", F.lit("_chunk_"), F.format_string("%03d", turn)).alias("chunk_id"), F.lit(sim).alias("similarity"), F.col(text).alias("text"))
    both_ = F.array_compact(F.array(F.when(F.col("context").isNotNull(), chunk("reply_", F.col("turn") - 1, 0.75, "context")), chunk("asked_", F.col("turn"), 0.5, "question")))
    x = a.select("id", F.posexplode(both_).alias("p", "c"))
    return x.select("id", (F.col("p") + 1).alias("rank"), "c.doc_name", "c.chunk_id", "c.similarity", "c.text")


def scored(s, d):
    return A.score_answers(records(s, d))


# --- text functions ---

@query("f08_string_functions", "SELECT doc_id, substr(lower(text || ' ' || lang),1,200) AS head, length(text) AS n, substr(source,1,8) || '...' AS short FROM documents")
def _(s, d):
    return docs(s, d).select("doc_id", F.substring(F.lower(F.concat_ws(" ", "text", "lang")), 1, 200).alias("head"), F.length("text").cast("bigint").alias("n"),
                             F.concat(F.substring("source", 1, 8), F.lit("...")).alias("short"))


@query("f10_token_sets", f"SELECT doc_id, len({toks('text')})::BIGINT AS n, coalesce(array_to_string(list_sort({toks('text')}),' '),'') AS tokens FROM documents")
def _(s, d):
    t = token_set(F.col("text"))
    return docs(s, d).select("doc_id", F.size(t).cast("bigint").alias("n"), F.array_join(F.array_sort(t), " ").alias("tokens"))


_sp = "len(list_filter(list_transform(string_split_regex(text, '{p}'), lambda x: trim(x, ' \t\r\n')), lambda x: length(x)>0))::BIGINT"


@query("f11_text_splits", f"SELECT doc_id, {_sp.format(p=chr(10) + chr(10))} AS paragraphs, {_sp.format(p=chr(10))} AS lines, {_sp.format(p='[.' + chr(10) + '|]')} AS sentences FROM documents")
def _(s, d):
    n = lambda p: F.size(split_clean(F.col("text"), p)).cast("bigint")
    return docs(s, d).select("doc_id", n("\n\n").alias("paragraphs"), n("\n").alias("lines"), n("[.\n|]").alias("sentences"))


@query("f12_formatted_numbers", "SELECT o_orderkey, format('{:,.2f}', round(o_totalprice,6)) AS price, format('{:.1f}', round(o_totalprice/1000,6)) || '%' AS pct FROM orders")
def _(s, d):
    from ..functions.text import fixed, plain

    return V.table(s, d, "orders").select("o_orderkey", fixed("o_totalprice", 2).alias("price"), F.concat(plain(F.col("o_totalprice") / 1000, 1), F.lit("%")).alias("pct"))


@query("u04_token_set_ops", f"SELECT id, {both('ans_t', 'q_t')}::BIGINT AS shared, (len(ans_t)-{both('ans_t', 'q_t')})::BIGINT AS answer_only FROM w_tok")
def _(s, d):
    a, q = token_set(F.col("answer")), token_set(F.col("question"))
    return V.answers(s, d).select("id", F.size(F.array_intersect(a, q)).cast("bigint").alias("shared"), F.size(F.array_except(a, q)).cast("bigint").alias("answer_only"))


@query("p21_constant_fill", "SELECT id, coalesce(context,'') AS context, coalesce(length(context),0)::BIGINT AS n, context IS NOT NULL AS has_context FROM v_answers")
def _(s, d):
    x = V.answers(s, d).select("id", "context", F.length("context").cast("bigint").alias("n"), F.when(F.col("context").isNotNull(), True).alias("has_context"))
    return x.na.fill({"context": "", "n": 0, "has_context": False})


@query("p22_text_fallback", "SELECT id, substr(coalesce(context, question),1,600) AS text FROM v_answers")
def _(s, d):
    return V.answers(s, d).select("id", F.substring(F.coalesce("context", "question"), 1, 600).alias("text"))


# --- chunks and vectors ---

@query("r06_greedy_chunks")
def _(s, d):
    return K.greedy_chunks(docs(s, d), "doc_id", "text")


@query("r07_sliding_chunks", "SELECT * FROM w_slide")
def _(s, d):
    return K.sliding_chunks(docs(s, d), "doc_id", F.col("text"))


@query("r08_chunk_statistics", "SELECT doc_id, count(*) AS chunks, round(avg(tokens),6) AS mean_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens, count(*) FILTER (tokens>180) AS over_limit FROM w_slide GROUP BY doc_id")
def _(s, d):
    return r(K.chunk_stats(K.sliding_chunks(docs(s, d), "doc_id", F.col("text")), "doc_id", 180), mean_tokens=6)


@query("v01_unit_vectors", """SELECT vec_id, i::BIGINT AS pos, round(x/sqrt(list_dot_product(e,e)),8) AS value FROM (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding,1)-1 AS i FROM embeddings) v""")
def _(s, d):
    e = V.table(s, d, "embeddings").select("vec_id", F.posexplode(unit(F.col("embedding"))).alias("pos", "value"))
    return r(e.withColumn("pos", F.col("pos").cast("bigint")), value=8)


@query("v02_text_vectors", f"""SELECT doc_id, count(*) AS terms, round(max(w),8) AS heaviest, round(sum(w),6) AS total, round(sqrt(sum(w*w)),8) AS length FROM ({unit_sql('w_dterm', 'doc_id', '(SELECT count(*) FROM documents)', 'w_ddf')}) v GROUP BY doc_id""")
def _(s, d):
    v = I.build_index(docs(s, d), "doc_id", "text").forward
    w = F.transform("terms", lambda t: t["weight"])
    total = lambda square: F.aggregate(w, F.lit(0.0), lambda a, x: a + (x * x if square else x))
    return r(v.select(F.col("id").alias("doc_id"), F.size("terms").cast("long").alias("terms"), F.array_max(w).alias("heaviest"), total(False).alias("total"), F.sqrt(total(True)).alias("length")), heaviest=8, total=6, length=8)


def text_search(s, d):
    """(questions, chunks, hits): the five best chunks of all documents for each question."""
    chunks = K.sliding_chunks(docs(s, d), "doc_id", F.col("text")).withColumn("vec_id", F.format_string("%d_%d", "doc_id", "chunk_no"))
    q = V.questions(s, d).withColumn("query_id", F.format_string("%d_%d", "conv_id", "turn"))
    return q, chunks, I.search(q, I.build_index(chunks, "vec_id", "text"), 5)


@query("v03_text_search", "SELECT query_id, vec_id, rank::INT AS rank, round(score,6) AS score FROM w_found")
def _(s, d):
    return r(text_search(s, d)[2], score=6)


def vector_search(s, d):
    e = V.table(s, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    q = R.centroids(e, "label").withColumnRenamed("label", "query_id")
    return N.top_k_search(q, e, 5)


@query("v03_vector_search", "SELECT query_id::BIGINT AS query_id, vec_id, rank::INT AS rank, round(score,6) AS score FROM w_hits")
def vector_query(s, d):
    return r(vector_search(s, d), score=6)


@query("j11_queries_by_vectors", "SELECT query_id::BIGINT AS query_id, vec_id, label, rank::INT AS rank FROM w_hits JOIN embeddings USING (vec_id)")
def _(s, d):
    e = V.table(s, d, "embeddings").select("vec_id", "label")
    return vector_search(s, d).join(e, "vec_id").select("query_id", "vec_id", "label", "rank")


@query("v04_text_cosine", f"SELECT id, CASE WHEN len(ans_t)*len(q_t)=0 THEN 0.0::DOUBLE ELSE round({both('ans_t', 'q_t')}/sqrt(len(ans_t)*len(q_t)),8) END AS cosine, CASE WHEN len(q_t)=0 THEN 0.5::DOUBLE ELSE round({both('ans_t', 'q_t')}/len(q_t)::DOUBLE,8) END AS overlap FROM w_tok")
def _(s, d):
    return V.answers(s, d).select("id", F.round(R.token_cosine(F.col("answer"), F.col("question")), 8).alias("cosine"),
                                  F.round(R.token_overlap(F.col("question"), F.col("answer")), 8).alias("overlap"))


@query("v05_term_presence", "SELECT id, rank::INT AS rank, array_to_string(list_filter(['the','que','und','tion'], lambda t: contains(lower(text),t)),',') AS terms FROM w_got")
def _(s, d):
    low = F.lower("text")
    return retrieved(s, d).select("id", "rank", F.array_join(F.filter(F.array(*map(F.lit, ["the", "que", "und", "tion"])), lambda t: F.contains(low, t)), ",").alias("terms"))


# --- routing ---

@query("x01_classify_questions", "SELECT conv_id, turn, query_type, metric FROM w_class")
def _(s, d):
    return X.classify(V.questions(s, d)).select("conv_id", "turn", "query_type", "metric")


@query("x02_direct_answers", f"SELECT conv_id, turn, metric, round(value,4) AS raw_value, {_text} AS answer FROM w_class JOIN w_kpis USING (metric)")
def _(s, d):
    x = X.direct_answers(X.classify(V.questions(s, d)), sales.kpis(s, d))
    return r(x.select("conv_id", "turn", "metric", "raw_value", "answer"), raw_value=4)


_best = f"""SELECT id, conv_id, turn, CASE WHEN len(ss)=0 THEN substr(text,1,400) ELSE list_sort(list_transform(range(1,len(ss)+1), lambda i: {{'h': {both(toks('ss[i]'), 'q')}, 'p': -i, 's': ss[i]}}), 'DESC')[1].s
    || ' [Source: ' || doc_name || ']' END AS answer FROM (SELECT a.id, a.conv_id, a.turn, g.text, g.doc_name, {toks('a.question')} AS q,
    list_filter(list_transform(string_split_regex(g.text,'[.\n|]'), lambda x: trim(x,' \t\r\n')), lambda x: length(x)>15) AS ss FROM v_answers a JOIN w_got g ON g.id=a.id AND g.rank=1) z"""


def extracted(s, d):
    a, top = V.answers(s, d).select("id", "conv_id", "turn", "question"), retrieved(s, d).filter("rank = 1").select("id", "text", "doc_name")
    return A.extractive_answer(a.join(top, "id", "left")).select("id", "conv_id", "turn", "answer")


@query("x06_extractive_answers", _best)
def _(s, d):
    return extracted(s, d)


@query("x03_route_union", f"""SELECT conv_id, turn, query_type, metric, round(value,4) AS raw_value, {_text} AS answer, 'computed' AS source FROM w_class JOIN w_kpis USING (metric)
    UNION ALL SELECT c.conv_id, c.turn, query_type, metric, NULL, coalesce(e.answer,'No relevant context found in the knowledge base.'), 'retrieval' FROM w_class c LEFT JOIN ({_best}) e ON e.conv_id=c.conv_id AND e.turn=c.turn WHERE query_type='rag'""")
def _(s, d):
    return r(X.route(X.classify(V.questions(s, d)), sales.kpis(s, d), extracted(s, d), ["conv_id", "turn"]), raw_value=4)


@query("x03_route_without_index", f"""SELECT conv_id, turn, query_type, metric, round(value,4) AS raw_value, {_text} AS answer, 'computed' AS source FROM w_class JOIN w_kpis USING (metric)
    UNION ALL SELECT conv_id, turn, query_type, metric, NULL, 'RAG pipeline not initialized.', 'retrieval' FROM w_class WHERE query_type='rag'""")
def _(s, d):
    return r(X.route(X.classify(V.questions(s, d)), sales.kpis(s, d), None, ["conv_id", "turn"]), raw_value=4)


@query("x03_question_to_answer", f"""SELECT query_id, vec_id, round(score,6) AS score, CASE WHEN vec_id IS NULL THEN NULL WHEN len(ss)=0 THEN substr(text,1,400) ELSE list_sort(list_transform(range(1,len(ss)+1), lambda i: {{'h': {both(toks('ss[i]'), 'qt')}, 'p': -i, 's': ss[i]}}), 'DESC')[1].s
    || ' [Source: ' || doc_id || ']' END AS answer FROM (SELECT q.conv_id || '_' || q.turn AS query_id, h.vec_id, h.score, w.text, w.doc_id, {toks('q.question')} AS qt,
    list_filter(list_transform(string_split_regex(w.text,'[.\n|]'), lambda x: trim(x,' \t\r\n')), lambda x: length(x)>15) AS ss FROM v_questions q LEFT JOIN (SELECT * FROM w_found WHERE rank=1) h ON h.query_id=q.conv_id || '_' || q.turn
    LEFT JOIN w_slide w ON w.doc_id || '_' || w.chunk_no=h.vec_id) z""")
def _(s, d):
    """Question to answer over the documents: inverted index, top-5 search, best sentence."""
    q, chunks, hits = text_search(s, d)
    best = hits.filter("rank = 1").join(chunks.select("vec_id", "text", "doc_id"), "vec_id")
    x = q.select("query_id", "question").join(best.withColumn("doc_name", F.col("doc_id").cast("string")), "query_id", "left")
    return r(A.extractive_answer(x).select("query_id", "vec_id", "score", "answer"), score=6)


@query("x04_context_blocks", """SELECT id, string_agg('[SOURCE ' || rank || '] | doc: ' || doc_name || ' | chunk: ' || chunk_id || ' | relevance: ' || format('{:.4f}',similarity) || chr(10) || text,
    chr(10)||chr(10)||'---'||chr(10)||chr(10) ORDER BY rank) AS context FROM w_got GROUP BY id""")
def _(s, d):
    return R.context_block(retrieved(s, d))


@query("x04_prompts")
def _(s, d):
    c = R.context_block(retrieved(s, d)).withColumnRenamed("context", "block")
    return V.answers(s, d).join(c, "id").select("id", R.prompt(F.col("question"), F.col("block")).alias("prompt"))


def cited(s, d):
    tail = F.when(F.col("conv_id") % 2 == 0, F.lit("\nSources : [2], [9], [2], [1]")).otherwise(F.lit(" SOURCES: [1]"))
    a = V.answers(s, d).filter(F.col("answer") != "").withColumn("answer", F.concat("answer", tail))
    return A.parse_citations(a, retrieved(s, d))


_SRC = "(?i)SOURCES\\s*:\\s*([\\[\\d\\],\\s]+)"


@query("x05_clean_answers", f"SELECT id, regexp_replace(substr(cited, 1, instr(cited, regexp_extract(cited,'{_SRC}'))-1), '\\s+$', '') AS clean_answer FROM w_cited")
def _(s, d):
    return cited(s, d)[0].select("id", "clean_answer")


@query("x05_citation_cards", f"""SELECT DISTINCT id, rank::INT AS source_num, chunk_id, doc_name, similarity, substr(text,1,200) || '...' AS text_preview FROM
    (SELECT id, unnest(regexp_extract_all(regexp_extract(cited,'{_SRC}',1),'\\d+'))::INT AS rank FROM w_cited) c JOIN w_got USING (id, rank)""")
def _(s, d):
    return cited(s, d)[1]


# --- answer quality ---

@query("x07_keyword_grade", f"SELECT {rounded('id grade kw_pct:6')}, array_to_string(found,',') AS found, array_to_string(missing,',') AS missing FROM w_graded")
def _(s, d):
    g = A.grade(V.answers(s, d))
    return r(g.select("id", "grade", "kw_pct", F.array_join("found", ",").alias("found"), F.array_join("missing", ",").alias("missing")), kw_pct=6)


for _n, _c in (("x08_faithfulness", "faithfulness"), ("x09_context_recall", "context_recall"), ("x10_answer_relevancy", "answer_relevancy")):
    query(_n, f"SELECT id, {_c} FROM w_scored")(lambda s, d, c=_c: scored(s, d).select("id", c))


@query("x11_range_guard", " UNION ALL ".join(f"SELECT '{m}_in_range' AS check, count(*) FILTER (NOT coalesce({m} BETWEEN 0 AND 1,false))=0 AS passed, count(*) FILTER (NOT coalesce({m} BETWEEN 0 AND 1,false)) AS violations, 'values outside [0,1]' AS note FROM w_scored" for m in A.SCORES))
def _(s, d):
    return A.range_guard(scored(s, d))


_miss = "' Missing: ' || array_to_string(missing,', ')"
_diag = f"""CASE WHEN grade='PASS' THEN NULL WHEN query_type='direct' THEN 'Routing error: a lookup that needs context was answered from a single metric.' || {_miss}
    WHEN grade='FAIL' THEN 'Nothing relevant in the answer; context recall ' || format('{{:.2f}}',round(context_recall,6)) || '.' || {_miss}
    ELSE 'Partly correct at ' || format('{{:.0f}}',round(kw_pct,6)) || '% keyword coverage.' || {_miss} END"""


@query("x12_failure_diagnosis", f"SELECT id, query_type, grade, {_diag} AS reason FROM w_scored")
def _(s, d):
    return scored(s, d).select("id", "query_type", "grade", A.diagnosis().alias("reason"))


_rates = ", ".join(f"round(avg({m}),6) AS {m}" for m in A.SCORES) + ", " + ", ".join(f"round(avg(CASE WHEN grade='{g}' THEN 1.0::DOUBLE ELSE 0 END),6) AS {n}" for g, n in (("PASS", "pass_rate"), ("PARTIAL", "partial_rate"), ("FAIL", "fail_rate")))
_report = f"""SELECT 'overall' AS scope, 'all' AS member, count(*) AS n, {_rates} FROM w_scored UNION ALL SELECT 'category', category, count(*), {_rates} FROM w_scored GROUP BY category
    UNION ALL SELECT 'complexity', CASE WHEN query_type='direct' THEN 'simple' ELSE 'complex' END, count(*), {_rates} FROM w_scored GROUP BY 2"""
_rd = {c: 6 for c in (*A.SCORES, "pass_rate", "partial_rate", "fail_rate")}


def report(s, d):
    return r(A.quality_report(scored(s, d), F.col("query_type") == "direct"), **_rd)


@query("x13_evaluation_report", _report)
def _(s, d):
    return report(s, d)


@query("a26_quality_by_category", f"SELECT * FROM ({_report}) x WHERE scope='category'")
def _(s, d):
    return report(s, d).filter("scope = 'category'")


@query("a27_grades_by_route", """SELECT query_type, count(*) FILTER (grade='PASS') AS "PASS", count(*) FILTER (grade='PARTIAL') AS "PARTIAL", count(*) FILTER (grade='FAIL') AS "FAIL" FROM w_graded GROUP BY query_type""")
def _(s, d):
    return A.grades_by_route(A.grade(V.answers(s, d)))


@query("a31_question_profile", "SELECT category, count(*) AS questions FROM v_answers GROUP BY category")
def _(s, d):
    return V.answers(s, d).groupBy("category").agg(F.count("*").alias("questions"))


@query("w14_worst_answers", f"SELECT id, category, grade, query_type, round(kw_pct,6) AS kw_pct, substr(answer,1,300) AS excerpt, {_diag} AS reason FROM w_scored WHERE grade<>'PASS' ORDER BY kw_pct, id LIMIT 3")
def _(s, d):
    return r(A.worst_answers(scored(s, d)).select("id", "category", "grade", "query_type", "kw_pct", F.substring("answer", 1, 300).alias("excerpt"), A.diagnosis().alias("reason")), kw_pct=6)


@query("s10_unanswered", "SELECT id, question FROM v_answers WHERE id NOT IN (SELECT id FROM v_answers WHERE context IS NOT NULL)")
def _(s, d):
    a = V.answers(s, d)
    return A.unanswered(a.select("id", "question"), a.filter(F.col("context").isNotNull()))


@query("s11_source_preference", "SELECT id, CASE WHEN context IS NOT NULL THEN context ELSE answer END AS text, CASE WHEN context IS NOT NULL THEN 0 ELSE 1 END AS source_rank FROM v_answers")
def _(s, d):
    a = V.answers(s, d)
    return A.preferred([a.filter(F.col("context").isNotNull()).select("id", F.col("context").alias("text")), a.select("id", F.col("answer").alias("text"))])
