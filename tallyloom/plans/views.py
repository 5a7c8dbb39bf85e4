"""Domain views over the given tables: one DataFrame builder each, and the same view as SQL text.

The SQL text only serves the side-by-side check; the builders below are independent of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.semantics import clock_micros

V_FEATURES = [f"v{i}" for i in range(1, 29)]
RARE_SHIFT = {"v4": 0.15, "v11": 0.1, "v14": -0.2}
CARD_COLUMNS = ["time_s", *V_FEATURES, "amount", "label"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus(ts: str, days, hours) -> Column:
    return F.expr(f"{ts} + make_dt_interval({days}, {hours}, 0, 0)")


def txn(spark, d) -> DataFrame:
    """Retail transactions with null customers, cancelled invoices, negative quantities, zero prices."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_linestatus")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat(F.when(F.col("o_orderstatus") == "P", "C").otherwise(""), F.col("o_orderkey")).alias("invoice_no"),
        F.col("l_partkey").alias("stock_code"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") <= 2), -F.col("l_quantity"))
         .otherwise(F.col("l_quantity")).alias("quantity"),
        _plus("o_orderdate", 0, "cast(o_orderkey % 24 as int)").alias("invoice_date"),
        F.when(F.col("l_linenumber") == 7, F.lit(0.0))
         .otherwise(F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).cast("double").alias("customer_id"))


def orders(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
         .otherwise("canceled").alias("order_status"),
        _plus("o_orderdate", 0, "cast(o_orderkey % 24 as int)").alias("purchased_at"),
        _plus("o_orderdate", 25, 0).alias("estimated_at"))
    arrived = F.expr("purchased_at + make_dt_interval(cast(order_id % 40 as int), cast(customer_id % 24 as int), 0, 0)")
    return o.withColumn("delivered_at", F.when((F.col("order_status") == "delivered") & (F.col("order_id") % 97 != 0),
                                               arrived))


def items(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))


def products(spark, d) -> DataFrame:
    """Products with a translated category and fall-backs: translation, original name, 'unknown'."""
    p = table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 83 != 0, F.col("p_type")).alias("category_name"))
    return p.join(F.broadcast(translation(spark)), "category_name", "left").select(
        "product_id", F.coalesce("category_english", "category_name", F.lit("unknown")).alias("category"))


TRANSLATION = {"ECONOMY": "economy", "STANDARD": "standard", "PROMO": "promotional", "SMALL": "compact"}


def translation(spark) -> DataFrame:
    """A fixed five-line dictionary; a type without a line keeps its own name."""
    return spark.createDataFrame(list(TRANSLATION.items()), "category_name string, category_english string")


def sellers(spark, d) -> DataFrame:
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"))


def customers(spark, d) -> DataFrame:
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_state"))


def state_region(spark, d) -> DataFrame:
    """State to region; one state has no region so that the default is used."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("customer_state"),
        F.when(F.col("n_name") != "NATION_24", F.col("r_name")).alias("region"))


def reviews(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("doc_id").alias("order_id"),
        (F.lit(1) + (F.col("doc_id") * 7) % 5).cast("int").alias("review_score"),
        F.when(F.col("doc_id") % 11 == 0, F.col("source")).alias("title"),
        F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("message"))


def daily(spark, d) -> DataFrame:
    """Daily sales of all orders and by region: closed days are zero, the last ten days wind down to 500."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, d, "region")
    amount = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).otherwise(F.lit(0.0))
    by_region = (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
                 .join(r, n.n_regionkey == r.r_regionkey)
                 .groupBy(F.col("r_name").alias("series_id"), F.to_date("o_orderdate").alias("ds"))
                 .agg(F.sum(amount).alias("raw")))
    rows = (by_region.groupBy(F.lit("ALL").alias("series_id"), "ds")
            .agg(F.sum("raw").alias("raw")).unionByName(by_region))
    last = table(spark, d, "orders").agg(F.to_date(F.max("o_orderdate")).alias("m")).scalar()
    closed = F.date_format("ds", "MM-dd").isin("12-25", "01-01")
    return rows.select("series_id", "ds", F.when(closed, F.lit(0.0)).when(F.col("ds") > F.date_sub(last, 10), F.lit(500.0))
                       .otherwise(F.round("raw", 2)).alias("y"))


def card(spark, d) -> DataFrame:
    """Card-like transactions: seconds since the first event, 28 components, amount, rare label."""
    e = table(spark, d, "events")
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    first = e.agg(F.min("ts").alias("t0")).scalar()
    n = emb.agg(F.count("*").alias("n")).scalar()
    base = e.withColumn("t0", first).select("event_id", (F.col("event_id") % n).alias("vec_id"),
                    F.floor((clock_micros("ts") - clock_micros("t0")) / 1_000_000).cast("double").alias("time_s"),
                    F.col("value").alias("amount"),
                    F.when((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0), 1).otherwise(0).alias("label"))
    # rare rows differ in a few components, so that there is something to learn
    comps = [(F.col("embedding")[i].cast("double") + F.lit(RARE_SHIFT.get(c, 0.0)) * F.col("label")).alias(c) for i, c in enumerate(V_FEATURES)]
    return base.join(emb, "vec_id").select("event_id", "time_s", *comps, "amount", "label")


def scored(spark, d) -> DataFrame:
    """Scores in 1/10000 units; ties and scores exactly on a threshold happen on purpose."""
    e = table(spark, d, "events")
    label = F.when((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0), 1).otherwise(0)
    return e.select("event_id", "ts", label.alias("label"), F.col("value").alias("amount"),
                    ((F.col("event_id") * 7919) % 1000 * 7 + label * 2500).cast("bigint").alias("score_e4"))


QUESTION_STEMS = (
    "How many delivered orders are in the data?",
    "How many active sellers do we have?",
    "What is total revenue from delivered orders?",
    "What is the overall average delivery time?",
    "What percentage of reviews are negative?",
    "Which region has the slowest delivery time?",
    "Why do some sellers have lower revenue?",
    "How did monthly revenue change from year to year?",
    "How many unique products are sold?",
    "Average review score, please.",
    "Tell me about:",
)


def questions(spark, d) -> DataFrame:
    """One question per user turn: a stem in turn, then the whole text of the turn."""
    stems = F.array(*[F.lit(s) for s in QUESTION_STEMS])
    idx = ((F.col("conv_id") * 3 + F.col("turn")) % len(QUESTION_STEMS) + 1).cast("int")
    c = table(spark, d, "conversations").filter(F.col("role") == "user")
    return c.select("conv_id", "turn", F.concat(F.element_at(stems, idx), F.lit(" "), F.col("text")).alias("question"))


def answers(spark, d) -> DataFrame:
    """Question, answer (the next turn), contexts (the turn before and the asked turn) and expectations."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    ask = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    ans = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                       F.col("text").alias("answer"))
    prev = c.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") + 1).alias("turn"),
                                                        F.col("text").alias("context"))
    words = F.split(F.regexp_replace("question", r"[^\p{L} ]", ""), " +")
    key = F.format_string("%d_%d", "conv_id", "turn")
    return (ask.join(ans, ["conv_id", "turn"], "left").join(prev, ["conv_id", "turn"], "left")
            .select(key.alias("id"), "conv_id", "turn", "question", F.coalesce("answer", F.lit("")).alias("answer"), "context",
                    F.slice(F.filter(words, lambda w: F.length(w) > 1), 1, 3).alias("expected_keywords"),
                    F.when(F.col("conv_id") % 7 == 0, "direct").when(F.col("conv_id") % 7 == 1, "retrieval_only")
                     .otherwise("rag").alias("query_type"),
                    F.element_at(F.array(*map(F.lit, ["lookup", "trend", "cause", "compare"])),
                                 (F.col("conv_id") % 4 + 1).cast("int")).alias("category")))


VIEW_SQL = {
    "v_txn": """SELECT (CASE WHEN o_orderstatus='P' THEN 'C' ELSE '' END) || o_orderkey AS invoice_no,
      l_partkey AS stock_code,
      CASE WHEN l_linestatus='O' AND l_quantity<=2 THEN -l_quantity ELSE l_quantity END AS quantity,
      o_orderdate + to_hours((o_orderkey % 24)::INT) AS invoice_date,
      CASE WHEN l_linenumber=7 THEN 0.0::DOUBLE ELSE l_extendedprice/l_quantity END AS unit_price,
      CASE WHEN o_custkey % 50 <> 0 THEN o_custkey::DOUBLE END AS customer_id
      FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "v_orders0": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
      CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
      o_orderdate + to_hours((o_orderkey % 24)::INT) AS purchased_at, o_orderdate + INTERVAL 25 DAY AS estimated_at
      FROM orders""",
    "v_orders": """SELECT *, CASE WHEN order_status='delivered' AND order_id % 97 <> 0
      THEN purchased_at + to_days((order_id % 40)::INT) + to_hours((customer_id % 24)::INT) END AS delivered_at
      FROM v_orders0""",
    "v_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
      l_extendedprice*(1-l_discount) AS price, l_extendedprice*l_tax AS freight_value FROM lineitem""",
    "v_products": """SELECT product_id, CASE category_name WHEN 'ECONOMY' THEN 'economy' WHEN 'STANDARD' THEN 'standard'
      WHEN 'PROMO' THEN 'promotional' WHEN 'SMALL' THEN 'compact' ELSE coalesce(category_name,'unknown') END AS category
      FROM (SELECT p_partkey AS product_id, CASE WHEN p_partkey % 83 <> 0 THEN p_type END AS category_name FROM part) p""",
    "v_sellers": """SELECT s_suppkey AS seller_id, n_name AS seller_state FROM supplier
      LEFT JOIN nation ON s_nationkey=n_nationkey""",
    "v_customers": """SELECT c_custkey AS customer_id, n_name AS customer_state FROM customer
      LEFT JOIN nation ON c_nationkey=n_nationkey""",
    "v_state_region": """SELECT n_name AS customer_state, CASE WHEN n_name <> 'NATION_24' THEN r_name END AS region
      FROM nation JOIN region ON n_regionkey=r_regionkey""",
    "v_reviews": """SELECT doc_id AS review_id, doc_id AS order_id, (1+(doc_id*7)%5)::INT AS review_score,
      CASE WHEN doc_id % 11 = 0 THEN source END AS title, CASE WHEN doc_id % 11 <> 0 THEN text END AS message
      FROM documents""",
    "v_daily": """SELECT series_id, ds, CASE WHEN strftime(ds,'%m-%d') IN ('12-25','01-01') THEN 0.0::DOUBLE
        WHEN ds > (SELECT max(o_orderdate)::DATE FROM orders) - 10 THEN 500.0::DOUBLE ELSE round(raw,2) END AS y
      FROM (SELECT coalesce(r_name,'ALL') AS series_id, o_orderdate::DATE AS ds,
              sum(CASE WHEN o_orderstatus<>'P' THEN o_totalprice ELSE 0 END) AS raw
            FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
            JOIN region ON n_regionkey=r_regionkey
            GROUP BY GROUPING SETS ((r_name, o_orderdate::DATE), (o_orderdate::DATE))) g""",
    "v_card": """SELECT event_id, date_diff('microsecond', (SELECT min(ts) FROM events), ts)//1000000*1.0::DOUBLE AS time_s,
      """ + ", ".join(f"embedding[{i}]::DOUBLE + {RARE_SHIFT.get(f'v{i}', 0.0)!r}::DOUBLE * (CASE WHEN event_type='error' AND user_id % 10 = 0 THEN 1 ELSE 0 END) AS v{i}" for i in range(1, 29)) + """,
      value AS amount, CASE WHEN event_type='error' AND user_id % 10 = 0 THEN 1 ELSE 0 END AS label
      FROM events JOIN embeddings ON vec_id = event_id % (SELECT count(*) FROM embeddings)""",
    "v_scored": """SELECT event_id, ts, label, amount, ((event_id*7919)%1000*7 + label*2500)::BIGINT AS score_e4
      FROM (SELECT event_id, ts, value AS amount,
        CASE WHEN event_type='error' AND user_id % 10 = 0 THEN 1 ELSE 0 END AS label FROM events) e""",
    "v_questions": "SELECT conv_id, turn, ([" + ", ".join("'" + s.replace("'", "''") + "'" for s in QUESTION_STEMS)
      + f"])[((conv_id*3+turn) % {len(QUESTION_STEMS)} + 1)::INT] || ' ' || text AS question "
      + "FROM conversations WHERE role='user'",
    "v_answers": """SELECT a.conv_id || '_' || a.turn AS id, a.conv_id, a.turn, a.text AS question, coalesce(b.text,'') AS answer,
      p.text AS context,
      list_filter(string_split_regex(regexp_replace(a.text,'[^\\p{L} ]','','g'), ' +'), lambda w: length(w)>1)[1:3]
        AS expected_keywords,
      CASE WHEN a.conv_id%7=0 THEN 'direct' WHEN a.conv_id%7=1 THEN 'retrieval_only' ELSE 'rag' END AS query_type,
      (['lookup','trend','cause','compare'])[(a.conv_id%4+1)::INT] AS category
      FROM conversations a LEFT JOIN conversations b ON b.conv_id=a.conv_id AND b.turn=a.turn+1 AND b.role='assistant'
      LEFT JOIN conversations p ON p.conv_id=a.conv_id AND p.turn=a.turn-1 AND p.role='assistant'
      WHERE a.role='user'""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the views it names, in dependency order."""
    defs = {**VIEW_SQL, **(extra or {})}
    ordered: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b[vw]_[a-z0-9_]+\b", text):
            if name in defs and name not in seen:
                seen.add(name)
                visit(defs[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in ordered)
    body = body.strip()
    if any("RECURSIVE" in defs[n] for n in ordered):
        ctes = "RECURSIVE " + ctes.replace("/*RECURSIVE*/", "")
    return f"WITH {ctes}" + (",\n" + body[5:] if body[:5].upper() == "WITH " else "\n" + body)
