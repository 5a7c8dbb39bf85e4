"""Registered streaming, source and sink queries with their SQL check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.semantics import as_clock, as_instant
from ..session import fresh_path
from ..sources import readers as RD, writers as WR
from ..streaming import monitor as Z
from . import assist, sales, views as V
from .registry import Registry, r

THRESHOLD = 6000
reg = Registry({
    **sales.EXTRA,
    "w_flag": f"SELECT *, score_e4>={THRESHOLD} AS flagged FROM v_scored",
    "w_week": """SELECT w AS week_start, count(*) FILTER (label=1 AND flagged) AS tp, count(*) FILTER (label=1 AND NOT flagged) AS fn, count(*) FILTER (label=0 AND flagged) AS fp, count(*) FILTER (label=0 AND NOT flagged) AS tn
        FROM (SELECT *, time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS w FROM w_flag) x GROUP BY w""",
    "w_day": "SELECT ts::DATE AS day, sum(value) AS value, count(*) AS n FROM events GROUP BY 1",
    "w_lines3": "\nUNION ALL ".join(sales.REPORT_SQL["r03_delivery_report"]), "w_lines4": "\nUNION ALL ".join(sales.REPORT_SQL["r04_complaint_report"]),
    "w_rep": "SELECT report, string_agg(text, chr(10) ORDER BY section_no, line_no) AS value FROM (SELECT * FROM w_lines3 UNION ALL SELECT * FROM w_lines4) x GROUP BY report",
    **{k: assist.EXTRA[k] for k in ("w_words", "w_slide0", "w_class0", "w_class")}, "w_chunks": assist.EXTRA["w_slide"],
})
QUERIES, SQL, query = reg.queries, reg.sql, reg.query


def stream(s, d):
    return Z.event_stream(s, d, "events.parquet")


def scored_stream(s, d):
    label = F.when((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0), 1).otherwise(0)
    return stream(s, d).select("event_id", as_instant("ts").alias("ts"), label.alias("label"), ((F.col("event_id") * 7919) % 1000 * 7 + label * 2500).cast("bigint").alias("score_e4"))


@query("z01_score_and_flag", "SELECT event_id, label, score_e4, flagged FROM w_flag")
def _(s, d):
    return Z.run_to_table(Z.flag(scored_stream(s, d), THRESHOLD).select("event_id", "label", "score_e4", "flagged"), "flagged")


@query("z02_weekly_monitor", """SELECT week_start, tp, fn, fp, tn, round(coalesce(tp/nullif(tp+fn,0)::DOUBLE,0),8) AS recall, round(coalesce(fp/nullif(fp+tn,0)::DOUBLE,0),8) AS false_alarm,
    coalesce(tp/nullif(tp+fn,0)::DOUBLE,0)<0.75 OR coalesce(fp/nullif(fp+tn,0)::DOUBLE,0)>0.003 AS breach FROM w_week""")
def _(s, d):
    t = Z.weekly_monitor(Z.flag(scored_stream(s, d), THRESHOLD))
    return r(t.withColumn("week_start", as_clock("week_start")), recall=8, false_alarm=8)


@query("z03_sliding_sum", """SELECT e AS window_end, round(sum(value),4) AS total, sum(n)::BIGINT AS events FROM (SELECT (day + k::INT)::TIMESTAMP AS e, value, n FROM w_day, generate_series(1,30) g(k)) x GROUP BY e""")
def _(s, d):
    e = stream(s, d).select(as_instant("ts").alias("ts"), "value")
    t = Z.sliding_sum(Z.daily_sum(e))
    return r(t.withColumn("window_end", as_clock("window_end")), total=4)


@query("z04_customer_state", """SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*)-1 AS frequency, (max(day)-min(day))::INT AS recency,
    round(coalesce(avg(CASE WHEN day>f THEN total END),0)+3.3e-7,4) AS monetary_value FROM (SELECT *, min(day) OVER (PARTITION BY user_id) AS f FROM (SELECT user_id, ts::DATE AS day, sum(value) AS total FROM events GROUP BY ALL) y) x GROUP BY user_id""")
def _(s, d):
    return r(Z.customer_state(stream(s, d).select("user_id", "ts", "value")), nudge=["monetary_value"], monetary_value=4)


@query("s10_answer_stream", "SELECT conv_id, turn, query_type, metric FROM w_class")
def _(s, d):
    """Questions arrive as files, are answered batch by batch and merged by id; the folder holds some of them twice."""
    from ..operators import router as X

    asked = V.questions(s, d).withColumn("id", F.format_string("%d_%d", "conv_id", "turn"))
    folder = fresh_path(s, "questions")
    asked.repartition(3).write.parquet(folder)
    asked.filter("turn = 0").write.mode("append").parquet(folder)
    return Z.answered(Z.event_stream(s, folder, files_per_batch=1), X.classify).select("conv_id", "turn", "query_type", "metric")


@query("z05_exactly_once", "SELECT event_id, user_id, value FROM events")
def _(s, d):
    e = lambda: stream(s, d).select("event_id", "user_id", "value", as_instant("ts").alias("ts"))
    return Z.deduplicated(e().union(e())).select("event_id", "user_id", "value")


# --- sources and sinks: written from the tables, read back, compared with the tables ---

@query("s01_latin1_csv", "SELECT invoice_no, quantity, round(unit_price,9) AS unit_price, customer_id, invoice_date FROM v_txn")
def _(s, d):
    p = fresh_path(s, "latin1")
    t = V.txn(s, d).select("invoice_no", "quantity", "unit_price", "customer_id", F.date_format("invoice_date", "MM/dd/yyyy HH:mm").alias("invoice_date"), F.lit("café ñandú").alias("country"))
    WR.csv(t, p, encoding="ISO-8859-1")
    back = RD.latin1_csv(s, p, "invoice_no string, quantity double, unit_price double, customer_id double, invoice_date string, country string", {"invoice_date": "MM/dd/yyyy HH:mm"})
    return r(back.filter(F.col("country") == "café ñandú").drop("country"), unit_price=9)


@query("s02_typed_csv", "SELECT order_id, order_status, purchased_at, delivered_at FROM v_orders")
def _(s, d):
    p = fresh_path(s, "typed")
    WR.csv(V.orders(s, d), p, ["order_id", "order_status", "purchased_at", "delivered_at"])
    return RD.typed_csv(s, p, "order_id bigint, order_status string, purchased_at timestamp_ntz, delivered_at timestamp_ntz")


@query("s03_daily_csv", "SELECT ds, y FROM v_daily WHERE series_id='ALL'")
def _(s, d):
    p = fresh_path(s, "daily")
    WR.csv(V.daily(s, d).filter("series_id = 'ALL'").select(F.date_format("ds", "M/d/yyyy").alias("Date"), F.col("y").alias("Total Sales")), p)
    return RD.daily_csv(s, p)


@query("s05_json_documents", "SELECT id, question, answer, category, len(expected_keywords)::BIGINT AS keywords FROM v_answers")
def _(s, d):
    p = fresh_path(s, "json")
    WR.json(V.answers(s, d), p)
    back = RD.json_documents(s, p, "id string, question string, answer string, category string, expected_keywords array<string>")
    return back.select("id", "question", "answer", "category", F.size("expected_keywords").cast("bigint").alias("keywords"))


@query("s06_csv_sink", "SELECT series_id AS series, ds AS day, round(y,1) AS y FROM v_daily")
def _(s, d):
    p = fresh_path(s, "csv")
    WR.csv(V.daily(s, d), p, ["series_id", "ds", "y"], {"series_id": "series", "ds": "day"}, 1)
    return s.read.schema("series string, day date, y double").option("header", True).csv(p)


@query("s07_split_parquet", "SELECT conv_id, turn, role AS split, length(text)::BIGINT AS n FROM conversations")
def _(s, d):
    p = fresh_path(s, "split")
    WR.split_parquet(V.table(s, d, "conversations").withColumnRenamed("role", "split"), p)
    return s.read.schema("conv_id bigint, turn bigint, text string, split string").parquet(p).select("conv_id", "turn", "split", F.length("text").cast("bigint").alias("n"))


@query("s08_json_sink", "SELECT doc_id, chunk_no, tokens FROM w_chunks")
def _(s, d):
    from ..operators.chunking import sliding_chunks

    p = fresh_path(s, "chunks")
    WR.json(sliding_chunks(V.table(s, d, "documents"), "doc_id", F.col("text")), p)
    return s.read.schema("doc_id bigint, chunk_no bigint, tokens bigint").json(p)


@query("s09_text_reports", "SELECT report, value FROM w_rep")
def _(s, d):
    p = fresh_path(s, "reports")
    WR.text_reports(sales.QUERIES["r03_delivery_report"](s, d).unionByName(sales.QUERIES["r04_complaint_report"](s, d)), p)
    back = s.read.text(p, wholetext=True)
    return back.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.txt$", 1).alias("report"), F.regexp_replace("value", r"\n$", "").alias("value"))
