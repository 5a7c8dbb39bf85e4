"""Transaction cleaning, de-duplication and eligibility filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import count_true

# the rules in the order they are applied
CLEANING_RULES = ("null_customer", "cancelled_invoice", "non_positive_quantity", "non_positive_price")


def failed_rule() -> Column:
    """First cleaning rule a row breaks, null for a good row; one expression instead of four passes."""
    return (F.when(F.col("customer_id").isNull(), CLEANING_RULES[0])
            .when(F.startswith(F.col("invoice_no"), F.lit("C")), CLEANING_RULES[1])
            .when(~(F.col("quantity") > 0), CLEANING_RULES[2]).when(~(F.col("unit_price") > 0), CLEANING_RULES[3]))


def clean_transactions(txn: DataFrame) -> DataFrame:
    return txn.filter(failed_rule().isNull()).withColumn("customer_id", F.col("customer_id").cast("bigint"))


def drop_report(txn: DataFrame) -> DataFrame:
    """Rows dropped and rows remaining after each rule, rules without a hit included."""
    rule = failed_rule()
    one = txn.select(rule.alias("rule")).agg(F.count("*").alias("total"), *[count_true(F.col("rule") == r).alias(r) for r in CLEANING_RULES])
    dropped, structs = F.lit(0), []
    for i, r in enumerate(CLEANING_RULES):
        dropped = dropped + F.col(r)
        structs.append(F.struct(F.lit(i + 1).alias("step"), F.lit(r).alias("rule"), F.col(r).alias("dropped"),
                                (F.col("total") - dropped).alias("remaining")))
    return one.select(F.inline(F.array(*structs)))


def with_revenue(txn: DataFrame) -> DataFrame:
    return txn.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total rows, distinct rows and surplus copies over all columns."""
    g = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.count("*").alias("distinct_rows"), (F.sum("_n") - F.count("*")).alias("duplicates"))


def eligibility(summary: DataFrame, min_days: int = 90) -> DataFrame:
    """How many customers are old enough to train on, and their share."""
    keep = F.col("T") >= min_days
    return summary.agg(count_true(keep).alias("kept"), count_true(~keep).alias("excluded"),
                       (F.avg(F.when(keep, 1.0).otherwise(0.0).cast("double")) * 100).alias("kept_pct"))


def repeat_buyers(summary: DataFrame) -> DataFrame:
    return summary.filter((F.col("frequency") > 0) & (F.col("monetary_value") > 0))


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, nulls and distinct values (without and with null) per column, long form."""
    one = df.agg(F.count("*").alias("rows"), *[count_true(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
                 *[F.count_distinct(c).alias(f"dist_{c}") for c in columns])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col("rows"), F.col(f"null_{c}").alias("nulls"), F.col(f"dist_{c}").alias("distinct_values"),
        (F.col(f"dist_{c}") + F.when(F.col(f"null_{c}") > 0, 1).otherwise(0)).alias("distinct_with_null")) for c in columns])))
