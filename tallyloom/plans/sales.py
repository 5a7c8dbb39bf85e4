"""Registered sales, delivery and review queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed_values import COMPLAINT_THEMES
from ..functions.semantics import floor_days, sum0
from ..functions.text import any_keyword
from ..operators import sales as S
from ..session import materialize
from . import views as V
from .registry import Registry, r
from .views import with_views as sql

DAYS = "floor(date_diff('microsecond', {a}, {b}) / 86400000000.0)::BIGINT"
EXTRA = {
    "w_orders": f"""SELECT *, strftime(purchased_at,'%Y-%m') AS purchase_month,
        {DAYS.format(a='purchased_at', b='delivered_at')} AS days_to_deliver,
        {DAYS.format(a='estimated_at', b='delivered_at')} AS delivery_delay_days FROM v_orders""",
    "w_master": """SELECT o.*, i.product_id, i.seller_id, i.price, i.freight_value, i.price+i.freight_value AS revenue,
        p.category, s.seller_state, c.customer_state
        FROM w_orders o LEFT JOIN v_items i USING (order_id) LEFT JOIN v_products p ON p.product_id=i.product_id
        LEFT JOIN v_sellers s ON s.seller_id=i.seller_id LEFT JOIN v_customers c ON c.customer_id=o.customer_id""",
    "w_lines": "SELECT * FROM w_master WHERE order_status='delivered' AND category IS NOT NULL",
    "w_order_cat": """SELECT order_id, purchase_month, category, sum(revenue) AS order_total FROM w_lines GROUP BY ALL""",
    "w_cat_month": """SELECT purchase_month, category, sum(order_total) AS total_revenue, count(DISTINCT order_id) AS num_orders,
        avg(order_total) AS avg_order_value FROM w_order_cat GROUP BY ALL""",
    "w_month": """SELECT purchase_month, sum(revenue) AS total_revenue, count(DISTINCT order_id) AS total_orders
        FROM w_lines GROUP BY ALL""",
    "w_cat_rank": """SELECT *, row_number() OVER (ORDER BY round(total_revenue,4) DESC, category) AS rank FROM
        (SELECT category, sum(revenue) AS total_revenue, count(DISTINCT order_id) AS num_orders FROM w_lines GROUP BY ALL) c""",
    "w_top3": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY purchase_month
        ORDER BY round(total_revenue,4) DESC, category) AS rank FROM w_cat_month) t WHERE rank<=3""",
    "w_seller_rev": """SELECT seller_id, avg(review_score) AS avg_review_score FROM v_reviews
        JOIN (SELECT DISTINCT order_id, seller_id FROM v_items) os USING (order_id) GROUP BY seller_id""",
    "w_sellers": """SELECT m.*, r.avg_review_score FROM (SELECT seller_id, seller_state, sum(revenue) AS total_revenue,
        count(DISTINCT order_id) AS total_orders, avg(days_to_deliver) AS avg_delivery_days, avg(delivery_delay_days) AS avg_delay_days
        FROM w_master WHERE order_status='delivered' AND seller_id IS NOT NULL AND seller_state IS NOT NULL GROUP BY ALL) m
        LEFT JOIN w_seller_rev r USING (seller_id)""",
    "w_states": """SELECT seller_state, count(*) AS num_sellers, sum(total_revenue) AS total_revenue, avg(avg_review_score) AS avg_review,
        avg(avg_delivery_days) AS avg_delivery FROM w_sellers GROUP BY ALL""",
    "w_delivery": """SELECT region, customer_state, count(DISTINCT order_id) AS num_orders, count(*) AS num_rows,
        avg(days_to_deliver) AS avg_delivery_days, median(days_to_deliver) AS median_delivery_days, max(days_to_deliver) AS max_delivery_days,
        avg(delivery_delay_days) AS avg_days_vs_eta, avg(CASE WHEN delivery_delay_days>0 THEN 1.0::DOUBLE ELSE 0 END)*100 AS pct_late
        FROM (SELECT m.*, coalesce(r.region,'Other') AS region FROM w_master m LEFT JOIN v_state_region r USING (customer_state)
              WHERE order_status='delivered' AND days_to_deliver IS NOT NULL AND customer_state IS NOT NULL) x
        GROUP BY GROUPING SETS ((region),(region,customer_state))""",
    "w_extremes": """SELECT 'slowest' AS extreme, region, avg_delivery_days AS value FROM (SELECT * FROM w_delivery WHERE customer_state IS NULL
          ORDER BY round(avg_delivery_days,6) DESC, region DESC LIMIT 1) a
        UNION ALL SELECT 'fastest', region, avg_delivery_days FROM (SELECT * FROM w_delivery WHERE customer_state IS NULL
          ORDER BY round(avg_delivery_days,6), region LIMIT 1) b
        UNION ALL SELECT 'most_late', region, pct_late FROM (SELECT * FROM w_delivery WHERE customer_state IS NULL
          ORDER BY round(pct_late,6) DESC, region DESC LIMIT 1) c""",
    "w_dist": """SELECT review_score, count(*) AS n, count(*)*100.0::DOUBLE/(SELECT count(*) FROM v_reviews) AS pct FROM v_reviews GROUP BY ALL""",
    "w_senti": """SELECT count(*) AS total, count(*) FILTER (review_score<=2) AS negative, count(*) FILTER (review_score=3) AS neutral,
        count(*) FILTER (review_score>=4) AS positive, avg(CASE WHEN review_score<=2 THEN 1.0::DOUBLE ELSE 0 END)*100 AS pct_negative,
        avg(CASE WHEN review_score>=4 THEN 1.0::DOUBLE ELSE 0 END)*100 AS pct_positive FROM v_reviews""",
    "w_status": """SELECT order_status, avg(review_score) AS mean_score, count(*) AS n FROM v_reviews JOIN v_orders USING (order_id) GROUP BY ALL""",
    "w_neg": "SELECT lower(coalesce(message,'') || ' ' || coalesce(title,'')) AS t FROM v_reviews WHERE review_score<=2",
    "w_themes": " UNION ALL ".join(
        f"SELECT '{t}' AS theme, count(*) FILTER (regexp_matches(t, '{any_keyword(ws)}')) AS mentions, "
        f"count(*) FILTER (regexp_matches(t, '{any_keyword(ws)}'))*100.0::DOUBLE/count(*) AS pct_of_negatives FROM w_neg"
        for t, ws in COMPLAINT_THEMES.items()),
    "w_sample": """SELECT review_id, substr(message,1,200) AS sample FROM v_reviews WHERE review_score=1 AND length(message)>20
        ORDER BY review_id LIMIT 10""",
    "w_kpis": """SELECT 'total_delivered_orders' AS metric, count(DISTINCT order_id)::DOUBLE AS value FROM v_orders WHERE order_status='delivered'
        UNION ALL SELECT 'total_sellers', count(DISTINCT seller_id)::DOUBLE FROM v_sellers
        UNION ALL SELECT 'total_customers', count(DISTINCT customer_id)::DOUBLE FROM v_customers
        UNION ALL SELECT 'total_reviews', count(*)::DOUBLE FROM v_reviews
        UNION ALL SELECT 'total_revenue', sum(price+freight_value) FROM v_items WHERE order_id IN (SELECT order_id FROM v_orders WHERE order_status='delivered')
        UNION ALL SELECT 'avg_delivery_days', avg(days_to_deliver) FROM w_orders WHERE order_status='delivered'
        UNION ALL SELECT 'avg_review_score', avg(review_score) FROM v_reviews
        UNION ALL SELECT 'pct_negative_reviews', avg(CASE WHEN review_score<=2 THEN 1.0::DOUBLE ELSE 0 END)*100 FROM v_reviews
        UNION ALL SELECT 'total_products', count(DISTINCT product_id)::DOUBLE FROM v_products""",
}

reg = Registry(EXTRA)
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def master(s, d):
    return S.master(V.orders(s, d), V.items(s, d), V.products(s, d), V.sellers(s, d), V.customers(s, d))


def lines(s, d):
    return S.delivered_lines(V.orders(s, d), V.items(s, d), V.products(s, d))


def stats(s, d):
    return S.seller_stats(V.orders(s, d), V.items(s, d), V.sellers(s, d), V.reviews(s, d))


def delivery(s, d):
    return S.delivery_stats(V.orders(s, d), V.items(s, d), V.customers(s, d), V.state_region(s, d))


@query("s04_parquet_scan", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(s, d):
    return V.table(s, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("p02_revenue", "SELECT order_id, product_id, round(price+freight_value,4) AS revenue FROM v_items")
def _(s, d):
    return V.items(s, d).select("order_id", "product_id", F.round(F.col("price") + F.col("freight_value"), 4).alias("revenue"))


@query("p14_key_pair_dedup", "SELECT DISTINCT order_id, seller_id FROM v_items")
def _(s, d):
    return S.distinct_pairs(V.items(s, d))


@query("p15_null_fallback", "SELECT product_id, category FROM v_products")
def _(s, d):
    return V.products(s, d)


@query("p16_dictionary_map", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'MACHINERY' THEN 'Industry'
    WHEN 'AUTOMOBILE' THEN 'Industry' ELSE 'Other' END AS sector FROM customer""")
def _(s, d):
    seg = {"BUILDING": "Construction", "MACHINERY": "Industry", "AUTOMOBILE": "Industry"}
    return V.table(s, d, "customer").select("c_custkey", S.map_with_default(F.col("c_mktsegment"), seg).alias("sector"))


@query("p19_sample_by_predicate", "SELECT * FROM w_sample")
def _(s, d):
    return S.sample_messages(V.reviews(s, d))


@query("j01_dimension_enrichment", "SELECT product_id, category FROM v_products")
def _(s, d):
    return V.products(s, d)


@query("j02_master_table", """SELECT order_id, customer_id, order_status, product_id, seller_id, category, seller_state, customer_state,
    purchase_month, days_to_deliver, delivery_delay_days, round(revenue,4) AS revenue FROM w_master""")
def _(s, d):
    return master(s, d).select("order_id", "customer_id", "order_status", "product_id", "seller_id", "category", "seller_state",
                               "customer_state", "purchase_month", "days_to_deliver", "delivery_delay_days",
                               F.round("revenue", 4).alias("revenue"))


@query("j03_fact_to_aggregate", "SELECT seller_id, round(avg_review_score,6) AS avg_review_score, total_orders FROM w_sellers")
def _(s, d):
    return r(stats(s, d).select("seller_id", "avg_review_score", "total_orders"), avg_review_score=6)


@query("j04_inner_after_dedup", "SELECT seller_id, round(avg_review_score,6) AS avg_review_score FROM w_seller_rev")
def _(s, d):
    return r(S.seller_review_means(V.reviews(s, d), V.items(s, d)), avg_review_score=6)


@query("j05_left_attribute", "SELECT review_id, review_score, order_status FROM v_reviews LEFT JOIN v_orders USING (order_id)")
def _(s, d):
    return V.reviews(s, d).join(V.orders(s, d).select("order_id", "order_status"), "order_id", "left").select(
        "review_id", "review_score", "order_status")


@query("j08_semi_join", """SELECT round(sum(price+freight_value),4) AS revenue, count(*) AS lines FROM v_items
    WHERE order_id IN (SELECT order_id FROM v_orders WHERE order_status='delivered')""")
def _(s, d):
    done = V.orders(s, d).filter(F.col("order_status") == "delivered")
    return V.items(s, d).join(done, "order_id", "left_semi").agg(
        F.round(sum0(F.col("price") + F.col("freight_value")), 4).alias("revenue"), F.count("*").alias("lines"))


@query("a03_monthly_totals", "SELECT purchase_month, round(total_revenue,4) AS total_revenue, total_orders FROM w_month")
def _(s, d):
    return r(S.monthly_totals(lines(s, d)), total_revenue=4)


@query("a04_category_month", """SELECT purchase_month, category, round(total_revenue,4) AS total_revenue, num_orders,
    round(avg_order_value+3.3e-7,4) AS avg_order_value FROM w_cat_month""")
def _(s, d):
    return r(S.category_month(lines(s, d)), total_revenue=4, avg_order_value=4, nudge=['avg_order_value'])


@query("a05_category_ranking", "SELECT category, rank, num_orders, round(total_revenue,4) AS total_revenue FROM w_cat_rank")
def _(s, d):
    return r(S.category_ranking(lines(s, d)), total_revenue=4)


@query("a06_sales_levels", """SELECT purchase_month, category, grouping_id(purchase_month, category)::BIGINT AS level,
    round(sum(order_total),4) AS total_revenue, count(DISTINCT order_id) AS num_orders, round(avg(order_total)+3.3e-7,4) AS avg_order_total
    FROM w_order_cat GROUP BY GROUPING SETS ((purchase_month),(purchase_month,category),(category))""")
def _(s, d):
    return r(S.sales_levels(lines(s, d)), total_revenue=4, avg_order_total=4, nudge=['avg_order_total'])


@query("a07_seller_stats", """SELECT seller_id, seller_state, total_orders, round(total_revenue,4) AS total_revenue,
    round(avg_delivery_days,6) AS avg_delivery_days, round(avg_delay_days,6) AS avg_delay_days,
    round(avg_review_score,6) AS avg_review_score FROM w_sellers""")
def _(s, d):
    return r(stats(s, d), total_revenue=4, avg_delivery_days=6, avg_delay_days=6, avg_review_score=6)


@query("a08_mean_of_means", """SELECT count(*) AS num_sellers, round(avg(avg_delivery_days),6) AS mean_of_means_delivery,
    round(avg(avg_review_score),6) AS mean_of_means_review FROM w_sellers""")
def _(s, d):
    return r(S.seller_overall(stats(s, d)), mean_of_means_delivery=6, mean_of_means_review=6)


@query("a09_state_rollup", """SELECT seller_state, num_sellers, round(total_revenue,4) AS total_revenue, round(avg_review,6) AS avg_review,
    round(avg_delivery,6) AS avg_delivery FROM w_states""")
def _(s, d):
    return r(S.state_rollup(stats(s, d)), total_revenue=4, avg_review=6, avg_delivery=6)


@query("a10_delivery_by_region", """SELECT region, customer_state, num_orders, num_rows, round(avg_delivery_days,6) AS avg_delivery_days,
    round(median_delivery_days,6) AS median_delivery_days, max_delivery_days, round(avg_days_vs_eta,6) AS avg_days_vs_eta,
    round(pct_late,6) AS pct_late FROM w_delivery""")
def delivery_query(s, d):
    return r(delivery(s, d), avg_delivery_days=6, median_delivery_days=6, avg_days_vs_eta=6, pct_late=6)


@query("a11_delivery_extremes", "SELECT extreme, region, round(value,6) AS value FROM w_extremes")
def _(s, d):
    return r(S.delivery_extremes(materialize(delivery(s, d), "delivery")), value=6)


@query("a12_score_distribution", "SELECT review_score, n, round(pct,6) AS pct FROM w_dist")
def _(s, d):
    return r(S.value_shares(V.reviews(s, d), "review_score"), pct=6)


@query("a13_sentiment", """SELECT total, negative, neutral, positive, round(pct_negative,6) AS pct_negative,
    round(pct_positive,6) AS pct_positive FROM w_senti""")
def _(s, d):
    return r(S.sentiment(V.reviews(s, d)), pct_negative=6, pct_positive=6)


@query("a14_scores_by_status", "SELECT order_status, n, round(mean_score,6) AS mean_score FROM w_status")
def _(s, d):
    return r(S.scores_by_status(V.reviews(s, d), V.orders(s, d)), mean_score=6)


def kpis(s, d):
    return S.kpis(V.orders(s, d), V.items(s, d), V.reviews(s, d), V.sellers(s, d), V.customers(s, d), V.products(s, d))


@query("a15_kpis", "SELECT metric, round(value,4) AS value FROM w_kpis")
def _(s, d):
    return r(kpis(s, d), value=4)


@query("w01_top_categories", """SELECT purchase_month, category, rank, num_orders, round(total_revenue,4) AS total_revenue,
    round(avg_order_value+3.3e-7,4) AS avg_order_value FROM w_top3""")
def _(s, d):
    return r(S.top_categories(S.category_month(lines(s, d))), total_revenue=4, avg_order_value=4, nudge=['avg_order_value'])


@query("w03_top_bottom_sellers", """SELECT 'top' AS side, seller_id, round(total_revenue,4) AS total_revenue FROM
      (SELECT * FROM w_sellers ORDER BY round(total_revenue,4) DESC, seller_id LIMIT 10) a
    UNION ALL SELECT 'bottom', seller_id, round(total_revenue,4) FROM
      (SELECT * FROM w_sellers ORDER BY round(total_revenue,4), seller_id DESC LIMIT 10) b""")
def _(s, d):
    st, rev = materialize(stats(s, d).select("seller_id", F.round("total_revenue", 4).alias("total_revenue")), "sellers"), F.col("total_revenue")
    top = st.orderBy(rev.desc(), "seller_id").limit(10).withColumn("side", F.lit("top"))
    return top.unionByName(st.orderBy(rev, F.col("seller_id").desc()).limit(10).withColumn("side", F.lit("bottom")))


@query("r05_theme_counts", "SELECT theme, mentions, round(pct_of_negatives,6) AS pct_of_negatives FROM w_themes")
def _(s, d):
    return r(S.theme_counts(V.reviews(s, d)), pct_of_negatives=6)


@query("f04_elapsed_days", """SELECT order_id, days_to_deliver, delivery_delay_days FROM w_orders""")
def _(s, d):
    return S.with_order_times(V.orders(s, d)).select("order_id", "days_to_deliver", "delivery_delay_days")


@query("f06_month_period", "SELECT order_id, purchase_month FROM w_orders")
def _(s, d):
    return S.with_order_times(V.orders(s, d)).select("order_id", "purchase_month")


@query("f09_escaped_alternation", r"""SELECT doc_id, regexp_matches(lower(text), 'a\.|the \(|\[x|ion') AS hit FROM documents""")
def _(s, d):
    return V.table(s, d, "documents").select("doc_id", F.lower("text").rlike(any_keyword(["a.", "the (", "[x", "ion"])).alias("hit"))


# --- report line tables as SQL ---

def _num(x, n=2):
    return f"format('{{:,.{n}f}}', round({x},6))"


def _int(x):
    return f"format('{{:,}}', {x})"


def _rev(x="total_revenue"):
    return f"format('{{:,.2f}}', round({x},4))"


def _head(report, section, *texts):
    return [f"SELECT '{report}' AS report, {section} AS section_no, {i - len(texts)}::BIGINT AS line_no, '{t}' AS text"
            for i, t in enumerate(texts)]


def _body(report, section, order, text, src):
    return [f"SELECT '{report}', {section}, row_number() OVER (ORDER BY {order}), {text} FROM {src}"]


def _na(x, n):
    return f"coalesce({_num(x, n)}, 'N/A')"


_who = f"""' | Seller ' || substr(seller_id::VARCHAR,1,8) || '... | State: ' || seller_state || ' | Revenue: BRL ' || {_rev()}
    || ' | Orders: ' || total_orders"""

_M, _S, _D, _C = "monthly_sales_summary", "seller_performance_report", "delivery_performance_report", "customer_complaints_report"
REPORT_SQL = {
    "r01_monthly_report": _head(_M, 1, "MONTHLY SALES SUMMARY BY CATEGORY", "OVERALL MONTHLY TOTALS")
    + _body(_M, 1, "purchase_month", f"'Month ' || purchase_month || ': Revenue BRL ' || {_rev()} || ', Orders ' || {_int('total_orders')}", "w_month")
    + _head(_M, 2, "TOP 3 CATEGORIES PER MONTH")
    + _body(_M, 2, "purchase_month, rank", f"""'Month ' || purchase_month || ' Category ''' || category || ''': Revenue BRL ' || {_rev()}
        || ', Orders ' || num_orders || ', Avg Order Value BRL ' || {_num('avg_order_value')}""", "w_top3")
    + _head(_M, 3, "ALL-TIME CATEGORY REVENUE RANKING")
    + _body(_M, 3, "rank", f"'Rank ' || rank || ': ''' || category || ''' -- Revenue BRL ' || {_rev()} || ', Orders ' || num_orders", "w_cat_rank"),
    "r02_seller_report": _head(_S, 1, "SELLER PERFORMANCE REPORT")
    + _body(_S, 1, "1", f"""'Total active sellers: ' || {_int('count(*)')} || ' | Overall avg delivery days: ' || {_num('avg(avg_delivery_days)', 1)}
        || ' | Overall avg review score: ' || {_num('avg(avg_review_score)', 2)} || ' / 5.0'""", "w_sellers")
    + _head(_S, 2, "TOP 10 SELLERS BY REVENUE")
    + _body(_S, 2, "rk", f"""'Rank ' || rk || {_who} || ' | Avg Delivery: ' || {_na('avg_delivery_days', 1)} || ' days | Avg Delay vs ETA: '
        || {_na('avg_delay_days', 1)} || ' days | Rating: ' || {_na('avg_review_score', 2)} || '/5'""",
            "(SELECT *, row_number() OVER (ORDER BY round(total_revenue,4) DESC, seller_id) AS rk FROM w_sellers QUALIFY rk<=10) t")
    + _head(_S, 3, "BOTTOM 10 SELLERS BY REVENUE")
    + _body(_S, 3, "rk", f"'Bottom-' || rk || {_who} || ' | Rating: ' || {_na('avg_review_score', 2)} || '/5'",
            """(SELECT *, row_number() OVER (ORDER BY round(total_revenue,4) DESC, seller_id) AS rk FROM
               (SELECT * FROM w_sellers ORDER BY round(total_revenue,4), seller_id DESC LIMIT 10) b) t""")
    + _head(_S, 4, "SELLER PERFORMANCE BY STATE")
    + _body(_S, 4, "round(total_revenue,4) DESC, seller_state", f"""'State ' || seller_state || ': ' || num_sellers || ' sellers, Revenue BRL ' || {_rev()}
        || ', Avg Rating ' || {_na('avg_review', 2)} || ', Avg Delivery ' || {_na('avg_delivery', 1)} || ' days'""", "w_states"),
    "r03_delivery_report": _head(_D, 1, "ORDER DELIVERY PERFORMANCE BY REGION")
    + _body(_D, 1, "1", f"'Total delivered order lines analysed: ' || {_int('sum(num_rows)::BIGINT')} || ' in ' || {_int('sum(num_orders)::BIGINT')} || ' orders'",
            "w_delivery WHERE customer_state IS NULL")
    + _head(_D, 2, "REGIONAL SUMMARY (slowest first)")
    + _body(_D, 2, "round(avg_delivery_days,6) DESC, region", f"""'Region: ' || region || ' | Orders: ' || {_int('num_orders')} || ' | Avg Delivery: '
        || {_num('avg_delivery_days', 1)} || ' days | Median: ' || {_num('median_delivery_days', 1)} || ' days | Avg Days vs ETA: '
        || {_num('avg_days_vs_eta', 1)} || ' (neg=early) | Late Orders: ' || {_num('pct_late', 1)} || '%'""", "w_delivery WHERE customer_state IS NULL")
    + _head(_D, 3, "STATE-LEVEL DELIVERY PERFORMANCE (slowest first)")
    + _body(_D, 3, "round(avg_delivery_days,6) DESC, customer_state", f"""'State ' || customer_state || ' (' || region || ') | Orders: ' || {_int('num_orders')}
        || ' | Avg: ' || {_num('avg_delivery_days', 1)} || ' days | Max: ' || max_delivery_days || ' days | Avg Days vs ETA: '
        || {_num('avg_days_vs_eta', 1)} || ' (neg=early) | Late%: ' || {_num('pct_late', 1)} || '%'""", "w_delivery WHERE customer_state IS NOT NULL")
    + _head(_D, 4, "DELIVERY PERFORMANCE EXTREMES")
    + _body(_D, 4, "extreme", f"""CASE extreme WHEN 'most_late' THEN 'MOST LATE ORDERS (% basis): ' WHEN 'slowest' THEN 'SLOWEST absolute delivery: '
        ELSE 'FASTEST absolute delivery: ' END || region || ' region -- ' || CASE extreme WHEN 'most_late' THEN {_num('value', 1)}
        || '% of orders arrived after estimated date.' ELSE 'avg ' || {_num('value', 1)} || ' days.' END""", "w_extremes"),
    "r04_complaint_report": _head(_C, 1, "CUSTOMER COMPLAINT THEMES FROM REVIEWS")
    + _body(_C, 1, "review_score", f"'Score ' || review_score || '/5: ' || {_int('n')} || ' reviews (' || {_num('pct', 1)} || '%)'", "w_dist")
    + _body(_C, 2, "1", f"""'Total reviews: ' || {_int('total')} || ' | Negative (1-2): ' || {_int('negative')} || ' (' || {_num('pct_negative', 1)}
        || '%) | Positive (4-5): ' || {_int('positive')} || ' (' || {_num('pct_positive', 1)} || '%) | Neutral (3): ' || {_int('neutral')}""", "w_senti")
    + _head(_C, 3, "COMPLAINT THEME ANALYSIS (score 1-2)")
    + _body(_C, 3, "mentions DESC, theme", f"'Theme ''' || theme || ''': ' || {_int('mentions')} || ' mentions (' || {_num('pct_of_negatives', 1)} || '% of negative reviews)'", "w_themes")
    + _head(_C, 4, "AVERAGE REVIEW SCORE BY ORDER STATUS")
    + _body(_C, 4, "round(mean_score,6), order_status", f"'Status ''' || order_status || ''': avg score ' || {_num('mean_score', 2)} || ' (' || n || ' reviews)'", "w_status")
    + _head(_C, 5, "SAMPLE NEGATIVE REVIEW MESSAGES (score = 1, non-empty)")
    + _body(_C, 5, "review_id", "'Sample: ' || sample", "w_sample"),
}
SQL.update({k: sql("\nUNION ALL ".join(v), EXTRA) for k, v in REPORT_SQL.items()})
QUERIES.update({
    # the aggregates behind a report are written once and feed all its sections
    "r01_monthly_report": lambda s, d: S.monthly_report(
        materialize(S.order_category_totals(lines(s, d)), "order-categories").withColumnRenamed("order_total", "revenue")),
    "r02_seller_report": lambda s, d: S.seller_report(materialize(stats(s, d), "sellers")),
    "r03_delivery_report": lambda s, d: S.delivery_report(materialize(delivery(s, d), "delivery")),
    "r04_complaint_report": lambda s, d: S.complaint_report(V.reviews(s, d), V.orders(s, d)),
})
