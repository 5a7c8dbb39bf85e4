"""Sales, seller, delivery and review reporting over the marketplace star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.fixed_values import COMPLAINT_THEMES
from ..functions.semantics import any_of, count_true, floor_days, ratio, share_true, sum0
from ..functions.text import fixed
from ..session import materialize
from .joins import heavy_hitters, left_join


def map_with_default(key: Column, mapping: dict[str, str], default: str = "Other") -> Column:
    """Look a key up in a fixed dictionary; unknown and null keys get the default."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def distinct_pairs(items: DataFrame) -> DataFrame:
    """One row per (order, seller): keeps a later join from multiplying reviews."""
    return items.select("order_id", "seller_id").distinct()


def with_order_times(orders: DataFrame) -> DataFrame:
    return (orders.withColumn("purchase_month", F.date_format("purchased_at", "yyyy-MM"))
            .withColumn("days_to_deliver", floor_days("purchased_at", "delivered_at"))
            .withColumn("delivery_delay_days", floor_days("estimated_at", "delivered_at")))


def master(orders, items, products, sellers, customers) -> DataFrame:
    """Wide table, left all the way: an order without items stays as one row with null price."""
    # a line of which much is sold, a large seller, a frequent customer: spread; the narrow sides get their attributes before the wide rows are made, so these move once
    lines = left_join(left_join(items, products, "product_id"), sellers, "seller_id", hot=heavy_hitters(items, "seller_id"))
    wide = left_join(with_order_times(orders), customers, "customer_id", hot=heavy_hitters(orders, "customer_id")).join(lines, "order_id", "left")
    return wide.withColumn("revenue", F.col("price") + F.col("freight_value"))


def delivered_lines(orders, items, products) -> DataFrame:
    """Delivered rows with a category: the part of the wide table the monthly report needs."""
    o = with_order_times(orders.filter(F.col("order_status") == "delivered")).select("order_id", "purchase_month")
    return (o.join(items, "order_id", "left").join(products, "product_id", "left")
            .filter(F.col("category").isNotNull())
            .select("order_id", "purchase_month", "category", (F.col("price") + F.col("freight_value")).alias("revenue")))


def order_category_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id", "purchase_month", "category").agg(sum0("revenue").alias("order_total"))


def monthly_totals(lines: DataFrame) -> DataFrame:
    """Revenue and orders per month. Collapsing to the order first makes the distinct count a plain count."""
    per_order = lines.groupBy("order_id", "purchase_month").agg(sum0("revenue").alias("r"))
    return per_order.groupBy("purchase_month").agg(sum0("r").alias("total_revenue"), F.count("*").alias("total_orders"))


def category_month(lines: DataFrame) -> DataFrame:
    """Month x category with the mean of order totals, not of rows."""
    return order_category_totals(lines).groupBy("purchase_month", "category").agg(
        sum0("order_total").alias("total_revenue"), F.count("*").alias("num_orders"),
        F.avg("order_total").alias("avg_order_value"))


def category_ranking(lines: DataFrame) -> DataFrame:
    t = order_category_totals(lines).groupBy("category").agg(
        sum0("order_total").alias("total_revenue"), F.count("*").alias("num_orders"))
    w = W.orderBy(F.round("total_revenue", 4).desc(), "category")
    return t.withColumn("rank", F.row_number().over(w).cast("bigint"))


def sales_levels(lines: DataFrame) -> DataFrame:
    """Month, month x category and category in one aggregation over per-order totals. An order counts where its first category of the month stands, so no level has to collect distinct orders."""
    first = F.row_number().over(W.partitionBy("order_id", "purchase_month").orderBy("category")) == 1
    known = F.col("order_id").isNotNull()
    base = order_category_totals(lines).withColumns({"any": known.cast("long"), "once": (known & first).cast("long")})
    return (base.groupingSets([["purchase_month"], ["purchase_month", "category"], ["category"]],
                              "purchase_month", "category")
            .agg(F.grouping_id().cast("bigint").alias("level"), sum0("order_total").alias("total_revenue"),
                 F.when(F.grouping("category") == 1, F.sum("once")).otherwise(F.sum("any")).alias("num_orders"), F.avg("order_total").alias("avg_order_total")))


def top_categories(cat_month: DataFrame, n: int = 3) -> DataFrame:
    w = W.partitionBy("purchase_month").orderBy(F.round("total_revenue", 4).desc(), "category")
    return cat_month.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)


def seller_review_means(reviews: DataFrame, items: DataFrame) -> DataFrame:
    """Each order's review counts once for every seller of the order."""
    return (reviews.select("order_id", "review_score").join(distinct_pairs(items), "order_id")
            .filter(F.col("seller_id").isNotNull())
            .groupBy("seller_id").agg(F.avg("review_score").alias("avg_review_score")))


def seller_stats(orders, items, sellers, reviews) -> DataFrame:
    """Per seller: revenue, orders, mean delivery and delay over item rows, mean review."""
    o = with_order_times(orders.filter(F.col("order_status") == "delivered")).select(
        "order_id", "days_to_deliver", "delivery_delay_days")
    # join first: the grouping by (order, seller) then reuses the partitioning by order
    pairs = (items.filter(F.col("seller_id").isNotNull()).join(o, "order_id")
             .groupBy("order_id", "seller_id", "days_to_deliver", "delivery_delay_days")
             .agg(F.sum(F.col("price") + F.col("freight_value")).alias("revenue"), F.count("*").alias("n")))
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("n")).otherwise(0)
    wavg = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n")).cast("double"), F.sum(known(c)))
    per = (pairs.groupBy("seller_id")
           .agg(sum0("revenue").alias("total_revenue"), F.count("*").alias("total_orders"),
                wavg("days_to_deliver").alias("avg_delivery_days"), wavg("delivery_delay_days").alias("avg_delay_days")))
    return (per.join(sellers, "seller_id").filter(F.col("seller_state").isNotNull())
            .join(seller_review_means(reviews, items), "seller_id", "left"))


def seller_overall(stats: DataFrame) -> DataFrame:
    """Means over sellers (a mean of seller means, not of orders)."""
    return stats.agg(F.count("*").alias("num_sellers"), F.avg("avg_delivery_days").alias("mean_of_means_delivery"),
                     F.avg("avg_review_score").alias("mean_of_means_review"))


def state_rollup(stats: DataFrame) -> DataFrame:
    return stats.groupBy("seller_state").agg(
        F.count("seller_id").alias("num_sellers"), sum0("total_revenue").alias("total_revenue"),
        F.avg("avg_review_score").alias("avg_review"), F.avg("avg_delivery_days").alias("avg_delivery"))


def delivery_stats(orders, items, customers, state_region) -> DataFrame:
    """Delivery figures by region and by region and state (state null = whole region).

    Items only matter as a row weight, so they are counted per order before the join; the delivery
    days are small integers, so the exact median works on (value, weight) pairs.
    """
    o = with_order_times(orders.filter((F.col("order_status") == "delivered") & F.col("delivered_at").isNotNull()))
    n = items.groupBy("order_id").agg(F.count("*").alias("n"))
    cells = (o.select("order_id", "customer_id", "days_to_deliver", "delivery_delay_days")
             .join(n, "order_id", "left").withColumn("n", F.coalesce("n", F.lit(1)))
             .join(customers, "customer_id", "left").filter(F.col("customer_state").isNotNull())
             .groupBy("customer_state", "days_to_deliver", "delivery_delay_days")
             .agg(F.count("*").alias("orders"), F.sum("n").alias("n")))
    # the few hot state keys meet the region table only after everything is collapsed
    cells = cells.join(state_region, "customer_state", "left").withColumn("region", F.coalesce("region", F.lit("Other")))
    wavg = lambda c: F.sum(F.col(c) * F.col("n")).cast("double") / F.sum("n")
    late = F.sum(F.when(F.col("delivery_delay_days") > 0, F.col("n")).otherwise(0)).cast("double") * 100 / F.sum("n")
    return (cells.groupingSets([["region"], ["region", "customer_state"]], "region", "customer_state")
            .agg(F.sum("orders").alias("num_orders"), F.sum("n").alias("num_rows"),
                 wavg("days_to_deliver").alias("avg_delivery_days"),
                 F.percentile("days_to_deliver", 0.5, F.col("n")).alias("median_delivery_days"),
                 F.max("days_to_deliver").alias("max_delivery_days"),
                 wavg("delivery_delay_days").alias("avg_days_vs_eta"), late.alias("pct_late")))


def delivery_extremes(stats: DataFrame) -> DataFrame:
    """Slowest, fastest and most-late region."""
    k = lambda c: F.struct(F.round(c, 6), F.col("region"))
    r = stats.filter(F.col("customer_state").isNull())
    pick = lambda name, by, val, fn: r.agg(fn("region", k(by)).alias("region"), fn(val, k(by)).alias("value")).select(
        F.lit(name).alias("extreme"), "region", "value")
    return (pick("slowest", "avg_delivery_days", "avg_delivery_days", F.max_by)
            .unionByName(pick("fastest", "avg_delivery_days", "avg_delivery_days", F.min_by))
            .unionByName(pick("most_late", "pct_late", "pct_late", F.max_by)))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Count and share per value; the window runs over the handful of grouped values."""
    g = df.groupBy(col).agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.col("n") * F.lit(100.0).cast("double") / F.sum("n").over(W.partitionBy()))


def sentiment(reviews: DataFrame) -> DataFrame:
    s = F.col("review_score")
    return reviews.agg(
        F.count("*").alias("total"), count_true(s <= 2).alias("negative"), count_true(s == 3).alias("neutral"),
        count_true(s >= 4).alias("positive"), (share_true(s <= 2) * 100).alias("pct_negative"),
        (share_true(s >= 4) * 100).alias("pct_positive"))


def scores_by_status(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    return (reviews.select("order_id", "review_score").join(orders.select("order_id", "order_status"), "order_id", "left")
            .filter(F.col("order_status").isNotNull())
            .groupBy("order_status").agg(F.avg("review_score").alias("mean_score"), F.count("review_score").alias("n")))


def theme_counts(reviews: DataFrame, themes: dict[str, list[str]] | None = None) -> DataFrame:
    """Reviews with score <= 2 that mention a theme: one pass over whole texts.

    A theme is an alternation of literal words, so plain substring tests give the same answer as the
    escaped pattern and cost less.
    """
    themes = themes or COMPLAINT_THEMES
    text = F.lower(F.concat_ws(" ", F.coalesce("message", F.lit("")), F.coalesce("title", F.lit(""))))
    neg = reviews.filter(F.col("review_score") <= 2).select(text.alias("t"))
    one = neg.agg(F.count("*").alias("negatives"),
                  *[count_true(any_of([F.contains(F.col("t"), F.lit(w)) for w in ws])).alias(f"c{i}") for i, ws in enumerate(themes.values())])
    pairs = F.array(*[F.struct(F.lit(t).alias("theme"), F.col(f"c{i}").alias("mentions")) for i, t in enumerate(themes)])
    return one.select("negatives", F.inline(pairs)).withColumn(
        "pct_of_negatives", ratio("mentions", "negatives", 0.0) * 100).drop("negatives")


def kpis(orders, items, reviews, sellers, customers, products, distinct=F.count_distinct) -> DataFrame:
    """Nine named metrics in long form (metric, value); ``distinct=F.approx_count_distinct`` trades exactness for speed."""
    done = with_order_times(orders.filter(F.col("order_status") == "delivered"))

    def long(df: DataFrame, **metrics: Column) -> DataFrame:
        one = df.agg(*[c.cast("double").alias(name) for name, c in metrics.items()])
        return one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in metrics])))

    # one scan per table, several metrics from it
    parts = [
        long(done, total_delivered_orders=distinct("order_id"), avg_delivery_days=F.avg("days_to_deliver")),
        long(sellers, total_sellers=distinct("seller_id")),
        long(customers, total_customers=distinct("customer_id")),
        long(reviews, total_reviews=F.count("*"), avg_review_score=F.avg("review_score"),
             pct_negative_reviews=share_true(F.col("review_score") <= 2) * 100),
        long(items.join(done.select("order_id"), "order_id", "left_semi"), total_revenue=sum0(F.col("price") + F.col("freight_value"))),
        long(products, total_products=distinct("product_id")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_messages(reviews: DataFrame, score: int = 1, min_len: int = 20, n: int = 10, cut: int = 200) -> DataFrame:
    """First n long enough messages of one score; the cut is the display width of the report."""
    return (reviews.filter((F.col("review_score") == score) & (F.length("message") > min_len))
            .orderBy("review_id").limit(n).select("review_id", F.substring("message", 1, cut).alias("sample")))


# --- report line tables -------------------------------------------------------------------------------

def _lines(df: DataFrame, section: int, order: list, text: Column) -> DataFrame:
    """Number the rows of an aggregated (small) table and render one line each."""
    w = W.orderBy(*order)
    return df.select(F.lit(section).alias("section_no"), F.row_number().over(w).cast("bigint").alias("line_no"), text.alias("text"))


def _heading(spark, section: int, *texts: str) -> DataFrame:
    rows = [(section, i - len(texts), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "section_no int, line_no bigint, text string")


def _report(name: str, *parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(name).alias("report"), "section_no", "line_no", "text")


def monthly_report(lines: DataFrame) -> DataFrame:
    m, cm, rank = monthly_totals(lines), top_categories(category_month(lines)), category_ranking(lines)
    h = lambda n, *t: _heading(lines.sparkSession, n, *t)
    return _report(
        "monthly_sales_summary",
        h(1, "MONTHLY SALES SUMMARY BY CATEGORY", "OVERALL MONTHLY TOTALS"),
        _lines(m, 1, ["purchase_month"], F.concat(
            F.lit("Month "), "purchase_month", F.lit(": Revenue BRL "), fixed(F.round("total_revenue", 4), 2),
            F.lit(", Orders "), F.format_number("total_orders", 0))),
        h(2, "TOP 3 CATEGORIES PER MONTH"),
        _lines(cm, 2, ["purchase_month", "rank"], F.concat(
            F.lit("Month "), "purchase_month", F.lit(" Category '"), "category", F.lit("': Revenue BRL "),
            fixed(F.round("total_revenue", 4), 2), F.lit(", Orders "), F.col("num_orders").cast("string"),
            F.lit(", Avg Order Value BRL "), fixed("avg_order_value", 2))),
        h(3, "ALL-TIME CATEGORY REVENUE RANKING"),
        _lines(rank, 3, ["rank"], F.concat(
            F.lit("Rank "), F.col("rank").cast("string"), F.lit(": '"), "category", F.lit("' -- Revenue BRL "),
            fixed(F.round("total_revenue", 4), 2), F.lit(", Orders "), F.col("num_orders").cast("string"))))


def seller_report(stats: DataFrame) -> DataFrame:
    h = lambda n, *t: _heading(stats.sparkSession, n, *t)
    rev = F.round("total_revenue", 4)
    or_na = lambda c, d: F.coalesce(fixed(F.col(c), d), F.lit("N/A"))
    top = stats.orderBy(rev.desc(), "seller_id").limit(10)
    bottom = stats.orderBy(rev, F.col("seller_id").desc()).limit(10)
    who = [F.lit(" | Seller "), F.substring(F.col("seller_id").cast("string"), 1, 8), F.lit("... | State: "), F.col("seller_state"),
           F.lit(" | Revenue: BRL "), fixed(rev, 2), F.lit(" | Orders: "), F.col("total_orders").cast("string")]
    rank_w = W.orderBy(rev.desc(), "seller_id")
    return _report(
        "seller_performance_report",
        h(1, "SELLER PERFORMANCE REPORT"),
        _lines(seller_overall(stats), 1, [F.col("num_sellers")], F.concat(
            F.lit("Total active sellers: "), F.format_number("num_sellers", 0), F.lit(" | Overall avg delivery days: "),
            fixed("mean_of_means_delivery", 1), F.lit(" | Overall avg review score: "), fixed("mean_of_means_review", 2), F.lit(" / 5.0"))),
        h(2, "TOP 10 SELLERS BY REVENUE"),
        _lines(top.withColumn("rk", F.row_number().over(rank_w)), 2, ["rk"], F.concat(
            F.lit("Rank "), F.col("rk").cast("string"), *who, F.lit(" | Avg Delivery: "), or_na("avg_delivery_days", 1),
            F.lit(" days | Avg Delay vs ETA: "), or_na("avg_delay_days", 1), F.lit(" days | Rating: "),
            or_na("avg_review_score", 2), F.lit("/5"))),
        h(3, "BOTTOM 10 SELLERS BY REVENUE"),
        _lines(bottom.withColumn("rk", F.row_number().over(rank_w)), 3, ["rk"], F.concat(
            F.lit("Bottom-"), F.col("rk").cast("string"), *who, F.lit(" | Rating: "), or_na("avg_review_score", 2), F.lit("/5"))),
        h(4, "SELLER PERFORMANCE BY STATE"),
        _lines(state_rollup(stats), 4, [F.round("total_revenue", 4).desc(), "seller_state"], F.concat(
            F.lit("State "), "seller_state", F.lit(": "), F.col("num_sellers").cast("string"), F.lit(" sellers, Revenue BRL "),
            fixed(F.round("total_revenue", 4), 2), F.lit(", Avg Rating "), or_na("avg_review", 2), F.lit(", Avg Delivery "),
            or_na("avg_delivery", 1), F.lit(" days"))))


def delivery_report(stats: DataFrame) -> DataFrame:
    h = lambda n, *t: _heading(stats.sparkSession, n, *t)
    region, state = stats.filter(F.col("customer_state").isNull()), stats.filter(F.col("customer_state").isNotNull())
    slow = F.round("avg_delivery_days", 6).desc()
    ext = F.when(F.col("extreme") == "most_late", F.lit("MOST LATE ORDERS (% basis): ")).when(
        F.col("extreme") == "slowest", F.lit("SLOWEST absolute delivery: ")).otherwise(F.lit("FASTEST absolute delivery: "))
    tail = F.when(F.col("extreme") == "most_late", F.concat(fixed("value", 1), F.lit("% of orders arrived after estimated date."))).otherwise(
        F.concat(F.lit("avg "), fixed("value", 1), F.lit(" days.")))
    return _report(
        "delivery_performance_report",
        h(1, "ORDER DELIVERY PERFORMANCE BY REGION"),
        _lines(region.agg(F.sum("num_rows").alias("r"), F.sum("num_orders").alias("o")), 1, [F.col("r")], F.concat(
            F.lit("Total delivered order lines analysed: "), F.format_number("r", 0), F.lit(" in "), F.format_number("o", 0), F.lit(" orders"))),
        h(2, "REGIONAL SUMMARY (slowest first)"),
        _lines(region, 2, [slow, "region"], F.concat(
            F.lit("Region: "), "region", F.lit(" | Orders: "), F.format_number("num_orders", 0), F.lit(" | Avg Delivery: "),
            fixed("avg_delivery_days", 1), F.lit(" days | Median: "), fixed("median_delivery_days", 1),
            F.lit(" days | Avg Days vs ETA: "), fixed("avg_days_vs_eta", 1), F.lit(" (neg=early) | Late Orders: "), fixed("pct_late", 1), F.lit("%"))),
        h(3, "STATE-LEVEL DELIVERY PERFORMANCE (slowest first)"),
        _lines(state, 3, [slow, "customer_state"], F.concat(
            F.lit("State "), "customer_state", F.lit(" ("), "region", F.lit(") | Orders: "), F.format_number("num_orders", 0),
            F.lit(" | Avg: "), fixed("avg_delivery_days", 1), F.lit(" days | Max: "), F.col("max_delivery_days").cast("string"),
            F.lit(" days | Avg Days vs ETA: "), fixed("avg_days_vs_eta", 1), F.lit(" (neg=early) | Late%: "), fixed("pct_late", 1), F.lit("%"))),
        h(4, "DELIVERY PERFORMANCE EXTREMES"),
        _lines(delivery_extremes(stats), 4, [F.col("extreme")], F.concat(ext, "region", F.lit(" region -- "), tail)))


def complaint_report(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    h = lambda n, *t: _heading(reviews.sparkSession, n, *t)
    pct = lambda c: F.concat(fixed(c, 1), F.lit("%"))
    return _report(
        "customer_complaints_report",
        h(1, "CUSTOMER COMPLAINT THEMES FROM REVIEWS"),
        _lines(value_shares(reviews, "review_score"), 1, ["review_score"], F.concat(
            F.lit("Score "), F.col("review_score").cast("string"), F.lit("/5: "), F.format_number("n", 0), F.lit(" reviews ("), pct("pct"), F.lit(")"))),
        _lines(sentiment(reviews), 2, [F.col("total")], F.concat(
            F.lit("Total reviews: "), F.format_number("total", 0), F.lit(" | Negative (1-2): "), F.format_number("negative", 0),
            F.lit(" ("), pct("pct_negative"), F.lit(") | Positive (4-5): "), F.format_number("positive", 0), F.lit(" ("), pct("pct_positive"),
            F.lit(") | Neutral (3): "), F.format_number("neutral", 0))),
        h(3, "COMPLAINT THEME ANALYSIS (score 1-2)"),
        _lines(theme_counts(reviews), 3, [F.col("mentions").desc(), "theme"], F.concat(
            F.lit("Theme '"), "theme", F.lit("': "), F.format_number("mentions", 0), F.lit(" mentions ("), pct("pct_of_negatives"), F.lit(" of negative reviews)"))),
        h(4, "AVERAGE REVIEW SCORE BY ORDER STATUS"),
        _lines(scores_by_status(reviews, orders), 4, [F.round("mean_score", 6), "order_status"], F.concat(
            F.lit("Status '"), "order_status", F.lit("': avg score "), fixed("mean_score", 2), F.lit(" ("), F.col("n").cast("string"), F.lit(" reviews)"))),
        h(5, "SAMPLE NEGATIVE REVIEW MESSAGES (score = 1, non-empty)"),
        _lines(sample_messages(reviews), 5, ["review_id"], F.concat(F.lit("Sample: "), "sample")))
