"""Physical plans: what must be pushed down, and what must not appear."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filter_and_columns_reach_the_scan(spark, sf):
    from pyspark.sql import functions as F

    from tallyloom.plans.views import table

    late = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_totalprice")
    p = plan(late)
    assert "GreaterThanOrEqual(o_orderdate" in p and "o_orderstatus" not in p
    assert "o_orderdate" not in plan(QUERIES["s04_parquet_scan"](spark, sf))


def test_delivery_report_reads_only_keys_of_the_lines(spark, sf):
    p = plan(QUERIES["a10_delivery_by_region"](spark, sf))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<l_orderkey:bigint>" in schemas


FAST = [n for n in QUERIES if n[0] in "apjfwrcmq" and n not in {
    "m04_classifiers", "m05_resampled_cross_validation", "m09_feature_importance", "m18_tree_attribution", "c01_fit_purchases", "c02_penalty_sweep", "c03_fit_spend"}]


@pytest.mark.parametrize("name", FAST)
def test_no_product_joins(spark, sf, name):
    p = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p  # no row-at-a-time functions
