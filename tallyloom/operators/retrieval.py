"""Mean vectors, token overlaps, and search results as context."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import clamp
from ..functions.text import token_set


def centroids(vectors: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Unit-length mean vector per key; vectors are summed per task first."""
    v = vectors.select(F.col(key).cast("bigint").alias(key), array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    m = v.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return Normalizer(inputCol="_m", outputCol="_u").transform(m).select(key, vector_to_array("_u").alias(vec))


def set_cosine(a: Column, b: Column) -> Column:
    """Cosine of two token sets as binary vectors, 0 if either is empty, clamped to [0, 1]."""
    den = F.sqrt(F.size(a).cast("double") * F.size(b))
    return F.when(den > 0, clamp(F.size(F.array_intersect(a, b)) / den, 0.0, 1.0)).otherwise(F.lit(0.0))


def token_cosine(a: Column, b: Column) -> Column:
    """Cosine of the binary token vectors of two texts."""
    return set_cosine(token_set(a), token_set(b))


def token_overlap(question: Column, answer: Column) -> Column:
    """Share of question tokens found in the answer; 0.5 when the question has none."""
    q = token_set(question)
    return F.when(F.size(q) > 0, F.size(F.array_intersect(q, token_set(answer))) / F.size(q)).otherwise(F.lit(0.5)).cast("double")


def context_block(retrieved: DataFrame, id_col: str = "id") -> DataFrame:
    """Numbered sources joined in rank order; a question has at most k retrieved rows."""
    head = F.concat(F.lit("[SOURCE "), F.col("rank").cast("string"), F.lit("] | doc: "), F.col("doc_name"), F.lit(" | chunk: "), F.col("chunk_id"),
                    F.lit(" | relevance: "), F.format_number(F.round("similarity", 6), 4), F.lit("\n"), F.col("text"))
    rows = F.array_sort(F.collect_list(F.struct(F.col("rank"), head.alias("part"))))
    return retrieved.groupBy(id_col).agg(F.array_join(F.transform(rows, lambda x: x["part"]), "\n\n---\n\n").alias("context"))


INSTRUCTION = ("Answer only from the numbered sources below. Give figures exactly as written. "
               "End with one line: SOURCES: [numbers you used]")


def prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit(INSTRUCTION), F.lit("\n\nCONTEXT\n"), context, F.lit("\n\nQUESTION: "), question, F.lit("\nANSWER:"))
