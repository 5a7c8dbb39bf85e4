"""Customer summaries: order-based and in the repeat-purchase convention.

The age of a customer needs the last purchase of all customers. The summary is written once and that
date is taken from it, so the transactions are joined and shuffled once, not twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.semantics import floor_days, ratio
from ..session import materialize


def manual_summary(clean: DataFrame) -> DataFrame:
    """Order totals, then per customer: orders - 1, mean order total, recency and age in elapsed days."""
    per_order = clean.groupBy("customer_id", "invoice_no", "invoice_date").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("order_total"))
    # invoices are unique after the next step, so counting rows counts them
    per_invoice = per_order.groupBy("customer_id", "invoice_no").agg(
        F.min("invoice_date").alias("lo"), F.max("invoice_date").alias("hi"), F.sum("order_total").alias("s"), F.count("order_total").alias("c"))
    per = materialize(per_invoice.groupBy("customer_id").agg(
        F.min("lo").alias("first_purchase"), F.max("hi").alias("last_purchase"),
        (F.count("invoice_no") - 1).alias("frequency"), (F.sum("s") / F.sum("c")).cast("double").alias("monetary_value")), "order-summary")
    end = per.agg(F.max("last_purchase").alias("m")).scalar()
    return (per.withColumn("_end", end).withColumn("recency_days", floor_days("first_purchase", "last_purchase"))
            .withColumn("T_days", floor_days("first_purchase", "_end")).drop("_end"))


def repeat_summary(clean: DataFrame) -> DataFrame:
    """One row per customer-day first; frequency counts the days after the first, and so does the mean spend.

    A customer with very many rows only sends one row per day and task to the second stage.
    """
    days = clean.groupBy("customer_id", F.to_date("invoice_date").alias("day")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("total"))
    per = materialize(days.groupBy("customer_id").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.count("*").alias("n"),
        F.sum("total").alias("total"), F.min_by("total", "day").alias("first_total")), "day-summary")
    end = per.agg(F.max("last").alias("m")).scalar()
    spend = ratio(F.col("total") - F.col("first_total"), F.col("n") - 1, 0.0)
    return per.select("customer_id", (F.col("n") - 1).cast("double").alias("frequency"),
                      F.date_diff("last", "first").cast("double").alias("recency"),
                      F.date_diff(end, F.col("first")).cast("double").alias("T"), spend.alias("monetary_value"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per column; quartiles exact and distributed."""
    from .ordered import exact_quantiles

    out = None
    for c in columns:
        base = df.filter(F.col(c).isNotNull()).agg(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
        q = exact_quantiles(df, c, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).select(F.struct("p25", "p50", "p75").alias("q")).scalar()
        row = base.withColumn("_q", q).select(F.lit(c).alias("column"), "count", "mean", "std", "min",
                                              "_q.p25", "_q.p50", "_q.p75", "max")
        out = row if out is None else out.unionByName(row)
    return out
