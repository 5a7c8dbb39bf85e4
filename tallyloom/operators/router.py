"""Sending a question to a computed metric or to retrieval, and the answers of both routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fixed_values import ANSWER_TEMPLATES, COMPLEX_WORDS, DIRECT_PATTERNS
from ..functions.text import fixed, trim_space

ANSWER_SCHEMA = ("query_type", "metric", "raw_value", "answer", "source")


def whole_words(words) -> str:
    """Any of the words with non-word characters around; unlike \\b this is equal in every regex engine."""
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(words) + r")([^\p{L}\p{N}_]|$)"


def direct_metric(question: Column) -> Column:
    """Metric of the first matching pattern, null when none matches."""
    q = trim_space(F.lower(question))
    out = F.when(q.rlike(DIRECT_PATTERNS[0][0]), DIRECT_PATTERNS[0][1])
    for pattern, metric in DIRECT_PATTERNS[1:]:
        out = out.when(q.rlike(pattern), metric)
    return out


def classify(questions: DataFrame, question: str = "question") -> DataFrame:
    """Comparison words win over metric patterns; no match goes to retrieval."""
    q = trim_space(F.lower(F.col(question)))
    hard = q.rlike(whole_words(COMPLEX_WORDS))
    x = questions.withColumn("metric", F.when(~hard, direct_metric(F.col(question))))
    return x.withColumn("query_type", F.when(F.col("metric").isNotNull(), "direct").otherwise("rag"))


def answer_text(metric: Column, value: Column) -> Column:
    out = None
    for name, (before, digits, after) in ANSWER_TEMPLATES.items():
        text = F.concat(F.lit(before), fixed(value, digits), F.lit(after))
        out = F.when(metric == name, text) if out is None else out.when(metric == name, text)
    return out.otherwise(F.lit("I could not find a direct computation for this query."))


def direct_answers(classified: DataFrame, kpis: DataFrame) -> DataFrame:
    """Answers of the direct route; the metric table has nine rows by construction."""
    k = F.broadcast(kpis.withColumnRenamed("value", "raw_value"))
    d = classified.filter(F.col("query_type") == "direct").join(k, "metric", "left")
    return d.withColumn("answer", answer_text(F.col("metric"), F.col("raw_value"))).withColumn("source", F.lit("computed"))


def route(classified: DataFrame, kpis: DataFrame, retrieved_answers: DataFrame | None, key: list[str]) -> DataFrame:
    """Both routes in one schema. Without a retrieval table, or without context, the fall-back text is the answer."""
    rag = classified.filter(F.col("query_type") == "rag")
    if retrieved_answers is None:
        rag = rag.withColumn("answer", F.lit("RAG pipeline not initialized."))
    else:
        rag = rag.join(retrieved_answers.select(*key, "answer"), key, "left").withColumn(
            "answer", F.coalesce("answer", F.lit("No relevant context found in the knowledge base.")))
    rag = rag.withColumn("raw_value", F.lit(None).cast("double")).withColumn("source", F.lit("retrieval"))
    cols = [*key, "query_type", "metric", "raw_value", "answer", "source"]
    return direct_answers(classified, kpis).select(*cols).unionByName(rag.select(*cols))
