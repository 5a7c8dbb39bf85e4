"""Answers from retrieved text, citations, and answer-quality scores. Row expressions wherever a row is enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.fixed_values import DIRECT_RECALL, DIRECT_RECALL_DEFAULT, NON_ANSWERS
from ..functions.semantics import any_of, count_true
from ..functions.text import fixed, raw_tokens, split_clean, token_set
from .retrieval import set_cosine

SCORES = ("faithfulness", "context_recall", "answer_relevancy")


def extractive_answer(df: DataFrame, question: str = "question", text: str = "text", doc: str = "doc_name", out: str = "answer") -> DataFrame:
    """Sentence of the text with most question tokens (the first on ties), else its first 400 characters."""
    sentences = F.filter(split_clean(F.col(text), r"[.\n|]"), lambda s: F.length(s) > 15)
    x = df.withColumns({"_s": sentences, "_q": token_set(F.col(question))})
    # stop words are already out of the question side, so raw sentence tokens give the same hits
    hits = lambda s: F.size(F.array_intersect(raw_tokens(s), F.col("_q")))
    x = x.withColumn("_best", F.array_max(F.transform("_s", lambda s, i: F.struct(hits(s).alias("hits"), (-i).alias("pos"), s.alias("s")))))
    answer = (F.when(F.col(text).isNull(), "No relevant context found in the knowledge base.").when(F.size("_s") == 0, F.substring(text, 1, 400))
              .otherwise(F.concat(F.col("_best.s"), F.lit(" [Source: "), F.col(doc), F.lit("]"))))
    return x.withColumn(out, answer).drop("_s", "_q", "_best")


def parse_citations(answers: DataFrame, retrieved: DataFrame, id_col: str = "id", text: str = "answer") -> tuple[DataFrame, DataFrame]:
    """(answers without the SOURCES line, cards of the cited chunks). Numbers outside the list are ignored, repeats keep the first."""
    pattern = r"(?i)SOURCES\s*:\s*([\[\d\],\s]+)"
    hit = F.regexp_extract(text, pattern, 0)
    clean = answers.withColumn("clean_answer", F.when(F.length(hit) > 0, F.regexp_replace(F.left(F.col(text), F.instr(F.col(text), hit) - 1), r"\s+$", "")).otherwise(F.col(text)))
    numbers = F.regexp_extract_all(F.regexp_extract(text, pattern, 1), F.lit(r"\d+"), 0)
    cited = answers.select(id_col, F.posexplode(F.array_distinct(F.transform(numbers, lambda n: n.cast("int")))).alias("_pos", "rank"))
    cards = cited.join(retrieved, [id_col, "rank"])
    first = W.partitionBy(id_col, "chunk_id").orderBy("_pos")
    cards = cards.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") == 1)
    return clean, cards.select(id_col, F.col("rank").alias("source_num"), "chunk_id", "doc_name", F.round("similarity", 4).alias("similarity"),
                               F.concat(F.substring("text", 1, 200), F.lit("...")).alias("text_preview"))


def found_keywords(answer: Column, expected: Column) -> Column:
    low = F.lower(answer)
    return F.filter(expected, lambda k: F.contains(low, F.lower(k)))


def grade(df: DataFrame, answer: str = "answer", expected: str = "expected_keywords") -> DataFrame:
    """PASS from 60 percent of the expected keywords, PARTIAL above none, else FAIL; nothing expected passes."""
    found = found_keywords(F.col(answer), F.col(expected))
    pct = F.when(F.size(expected) > 0, F.size(found) / F.size(expected)).otherwise(F.lit(1.0)).cast("double")
    return (df.withColumn("found", found).withColumn("missing", F.filter(expected, lambda k: ~F.contains(F.lower(F.col(answer)), F.lower(k))))
            .withColumn("kw_pct", pct * 100).withColumn("grade", F.when(pct >= 0.6, "PASS").when(pct > 0, "PARTIAL").otherwise("FAIL")))


def faithfulness(answer: Column, contexts: Column, a: Column | None = None, c: Column | None = None) -> Column:
    """Share of answer tokens present in the contexts; ``a`` and ``c`` may hold the token sets already."""
    a = token_set(answer) if a is None else a
    c = token_set(F.array_join(contexts, " ")) if c is None else c
    return (F.when((F.length(answer) == 0) | (F.size(contexts) == 0), F.lit(0.0)).when(F.size(a) == 0, F.lit(1.0))
            .otherwise(F.round(F.size(F.array_intersect(a, c)) / F.size(a), 4)).cast("double"))


def context_recall(retrieved_docs: Column, relevant_docs: Column, grade_col: Column, query_type: Column) -> Column:
    """Share of relevant documents retrieved; the direct route has a fixed value per grade."""
    fixed_value = None
    for g, v in DIRECT_RECALL.items():
        fixed_value = F.when(grade_col == g, v) if fixed_value is None else fixed_value.when(grade_col == g, v)
    hits = F.size(F.filter(relevant_docs, lambda x: F.array_contains(retrieved_docs, x)))
    return (F.when(query_type == "direct", fixed_value.otherwise(DIRECT_RECALL_DEFAULT)).when(F.size(relevant_docs) == 0, F.lit(1.0))
            .otherwise(F.round(hits / F.size(relevant_docs), 4)).cast("double"))


def answer_relevancy(question: Column, answer: Column, q: Column | None = None, a: Column | None = None) -> Column:
    """Cosine of question and answer, 0 for an empty answer or a fixed non-answer."""
    bad = any_of([F.contains(F.lower(answer), F.lit(p)) for p in NON_ANSWERS])
    cosine = set_cosine(token_set(question) if q is None else q, token_set(answer) if a is None else a)
    return F.when((F.length(answer) == 0) | bad, F.lit(0.0)).otherwise(F.round(cosine, 4)).cast("double")


def score_answers(df: DataFrame) -> DataFrame:
    """Grade plus the three quality scores for (question, answer, contexts, retrieved_docs, relevant_docs, query_type).

    Token sets are columns of their own, so that each text is tokenised once.
    """
    x = grade(df).withColumns({"_a": token_set(F.col("answer")), "_q": token_set(F.col("question")), "_c": token_set(F.array_join("contexts", " "))})
    return (x.withColumn("faithfulness", faithfulness(F.col("answer"), F.col("contexts"), F.col("_a"), F.col("_c")))
            .withColumn("context_recall", context_recall(F.col("retrieved_docs"), F.col("relevant_docs"), F.col("grade"), F.col("query_type")))
            .withColumn("answer_relevancy", answer_relevancy(F.col("question"), F.col("answer"), F.col("_q"), F.col("_a"))).drop("_a", "_q", "_c"))


def range_guard(scored: DataFrame) -> DataFrame:
    from .quality import check_table

    one = scored.agg(*[count_true(~F.coalesce(F.col(m).between(0.0, 1.0), F.lit(False))).alias(m) for m in SCORES])
    return check_table(one, [(f"{m}_in_range", F.col(m), F.lit("values outside [0,1]")) for m in SCORES])


def diagnosis() -> Column:
    """Why an answer failed, by route and grade; null for a pass."""
    miss = F.concat(F.lit(" Missing: "), F.concat_ws(", ", "missing"))
    pct = F.concat(fixed("kw_pct", 0), F.lit("%"))
    retr = F.col("query_type").isin("rag", "retrieval_only")
    return (F.when(F.col("grade") == "PASS", None)
            .when(F.col("query_type") == "direct", F.concat(F.lit("Routing error: a lookup that needs context was answered from a single metric."), miss))
            .when(retr & (F.col("grade") == "FAIL"), F.concat(F.lit("Nothing relevant in the answer; context recall "), fixed("context_recall", 2), F.lit("."), miss))
            .when(retr, F.concat(F.lit("Partly correct at "), pct, F.lit(" keyword coverage."), miss))
            .otherwise(F.concat(F.lit("Low keyword coverage "), pct, F.lit("."), miss)))


def _rates():
    share = lambda g: F.avg(F.when(F.col("grade") == g, 1.0).otherwise(0.0).cast("double"))
    return [F.count("*").alias("n"), *[F.avg(m).alias(m) for m in SCORES], share("PASS").alias("pass_rate"), share("PARTIAL").alias("partial_rate"), share("FAIL").alias("fail_rate")]


def quality_report(scored: DataFrame, simple: Column) -> DataFrame:
    """Means and rates overall, by category, and for simple against complex questions, in one pass."""
    x = scored.withColumn("complexity", F.when(simple, "simple").otherwise("complex"))
    g = x.groupingSets([[], ["category"], ["complexity"]], "category", "complexity").agg(F.grouping_id().alias("_g"), *_rates())
    scope = F.when(F.col("_g") == 3, "overall").when(F.col("_g") == 1, "category").otherwise("complexity")
    return g.select(scope.alias("scope"), F.coalesce("category", "complexity", F.lit("all")).alias("member"), "n", *SCORES, "pass_rate", "partial_rate", "fail_rate")


def grades_by_route(graded: DataFrame) -> DataFrame:
    return graded.groupBy("query_type").pivot("grade", ["PASS", "PARTIAL", "FAIL"]).agg(F.count(F.lit(1))).na.fill(0)


def worst_answers(scored: DataFrame, n: int = 3) -> DataFrame:
    return scored.filter(F.col("grade") != "PASS").orderBy("kw_pct", "id").limit(n)


def unanswered(questions: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    """Questions the result table does not hold yet; appended after answering, so a restart goes on where it ended."""
    return questions.join(results.select(key), key, "left_anti")


def preferred(sources: list[DataFrame], key: str = "id") -> DataFrame:
    """One row per key from the first source that has it."""
    cols = [c for c in sources[0].columns if c != key]
    u = None
    for i, s in enumerate(sources):
        p = s.withColumn("_p", F.lit(i))
        u = p if u is None else u.unionByName(p)
    best = u.groupBy(key).agg(F.min_by(F.struct(*cols, "_p"), "_p").alias("b"))
    return best.select(key, *[F.col(f"b.{c}").alias(c) for c in cols], F.col("b._p").alias("source_rank"))
