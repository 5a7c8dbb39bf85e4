"""Properties of the operators without a SQL form, and edge cases of the others."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import answers as A, chunking as K, cleaning as C, fitting as FT, forecast as FC, models as ML, resample as R, rfm, router as X, sales as SL, series as SR
from tallyloom.session import fresh_path
from tallyloom.sources import writers as WR
from tallyloom.streaming import monitor as Z


# --- oversampling ---

@pytest.fixture(scope="module")
def rare(spark):
    rng = np.random.default_rng(2)
    n = 600
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n), "label": (np.arange(n) % 20 == 0).astype("int32")})
    return spark.createDataFrame(pdf)


def test_oversample_reaches_the_ratio(rare):
    up = R.oversample(rare, "id", ["a", "b"], target_ratio=0.5)
    n = {r.label: r["count"] for r in up.groupBy("label").count().collect()}
    assert n[1] == int(0.5 * n[0])
    lim = rare.filter("label = 1").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    out = up.filter("synthetic AND NOT (a BETWEEN {} AND {} AND b BETWEEN {} AND {})".format(*lim)).count()
    assert out == 0
    assert up.filter("synthetic").select("id").distinct().count() == up.filter("synthetic").count()


def test_oversample_is_reproducible(rare):
    rows = lambda df: sorted(map(tuple, R.oversample(df, "id", ["a", "b"], target_ratio=0.3).collect()))
    assert rows(rare) == rows(rare.repartition(5))


def test_oversample_without_minority(spark):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 0.1, 0)], "id bigint, a double, label int")
    assert R.oversample(df, "id", ["a"]).count() == 2


# --- chunks ---

def words(n, w="w"):
    return " ".join(f"{w}{i}" for i in range(n))


COUNT = lambda t: len(t.split())


def test_chunks_keep_every_word():
    text = "\n\n".join([words(10, "a"), words(60, "b"), words(50, "c"), "\n".join(words(30, f"d{i}_") for i in range(12)), words(5, "z")])
    chunks = K.pack(text, 75, 200, COUNT)
    assert " ".join(chunks).split() == text.split()
    assert all(COUNT(c) >= 75 for c in chunks[:-1])


def test_small_paragraph_before_a_large_one_is_carried():
    text = words(10, "a") + "\n\n" + "\n".join(words(40, f"d{i}_") for i in range(8))
    chunks = K.pack(text, 75, 200, COUNT)
    assert chunks[0].startswith("a0") and "d0_0" in chunks[0]


def test_short_tail_joins_the_last_chunk():
    assert len(K.pack(words(190, "a") + "\n\n" + words(20, "b"), 75, 200, COUNT)) == 1
    assert K.pack("", 75, 200, COUNT) == [] and K.pack("one", 75, 200, COUNT) == ["one"]


def test_sliding_window_covers_the_text(spark):
    t = words(430)
    rows = K.sliding_chunks(spark.createDataFrame([(1, t), (2, "a b"), (3, "  ")], "id int, t string"), "id", F.col("t")).orderBy("id", "chunk_no").collect()
    assert [r.tokens for r in rows if r.id == 1] == [200, 200, 130] and [r.text for r in rows if r.id == 2] == ["a b"] and not [r for r in rows if r.id == 3]


# --- series ---

def test_interpolation_by_row_position(spark):
    d = lambda i: dt.date(2020, 1, i)
    rows = [("s", d(1), None), ("s", d(2), 10.0), ("s", d(3), None), ("s", d(9), 20.0), ("s", d(10), None)]
    got = SR.interpolate(spark.createDataFrame(rows, "series_id string, ds date, y double")).orderBy("ds").collect()
    assert [r.y for r in got] == [10.0, 10.0, 15.0, 20.0, 20.0]


def test_forecast_beats_the_mean_and_orders_its_band(spark):
    days = pd.date_range("2018-01-01", periods=800)
    t = np.arange(800)
    y = (1000 + t) * (1 + 0.3 * np.sin(2 * np.pi * t / 7)) + np.random.default_rng(0).normal(0, 20, 800)
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "ds": days.date, "y": y}))
    lab = SR.split_label(df, "2020-01-01")
    test = lab.filter("split = 'test'").drop("split")
    e = SR.evaluate(test, FC.predict_test(lab)).first()
    assert e.mae_pct_of_mean < 5 and e.safe and e.in_bounds_pct > 40
    out = FC.forecast(df, 90).toPandas()
    assert len(out) == 90 and (out.yhat_lower <= out.yhat).all() and (out.yhat <= out.yhat_upper).all() and out.ds.min() == dt.date(2020, 3, 11)
    assert SR.audit(df, spark.createDataFrame(out)).filter("NOT passed").count() == 0


def test_sparse_solution_meets_its_conditions():
    rng = np.random.default_rng(2)
    t = np.linspace(0, 1, 400)
    x = np.column_stack([np.ones(400), t, np.maximum(t[:, None] - np.linspace(0, 0.9, 31)[1:], 0), rng.normal(size=(400, 4))])
    y = 1 + 2 * t - 3 * np.maximum(t - 0.45, 0) + x[:, -1] * 0.5 + rng.normal(size=400) * 0.05
    for weight in (1e-4, 0.01, 0.3, 50.0):
        lasso, ridge = np.zeros(36), np.full(36, 1e-6)
        lasso[2:32], ridge[2:32] = weight, 0.0
        b = FC.sparse_solution(x.T @ x, x.T @ y, lasso, ridge)
        slope = x.T @ (y - x @ b) - ridge * b
        on = (lasso > 0) & (b != 0)
        assert np.abs(slope[lasso == 0]).max() < 1e-6 and np.abs(slope[on] - weight * np.sign(b[on])).max(initial=0) < 1e-6
        assert (np.abs(slope[(lasso > 0) & (b == 0)]) <= weight * (1 + 1e-6) + 1e-8).all()
    assert not b[2:32].any()  # a strong prior leaves a straight line


def test_fit_is_the_same_for_one_and_for_many_tasks(spark):
    days = pd.date_range("2018-01-01", periods=700)
    y = 500 + np.arange(700) + 60 * np.sin(np.arange(700) * 2 * np.pi / 7)
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "ds": days.date, "y": y}))
    a, b = (FC.forecast(df.repartition(n), 30).orderBy("ds").toPandas() for n in (1, 6))
    assert np.allclose(a[["yhat", "yhat_lower", "yhat_upper"]], b[["yhat", "yhat_lower", "yhat_upper"]], rtol=1e-6)


def test_band_widens_and_covers_held_out_days(spark):
    """Slopes that keep changing: a constant band would miss the far end."""
    rng, rows = np.random.default_rng(4), []
    days = pd.date_range("2017-01-01", periods=1000)
    for k in range(12):
        slope = np.repeat(rng.laplace(0, 0.5, 25).cumsum(), 40)  # the slope changes every forty days
        rows.append(pd.DataFrame({"series_id": f"s{k}", "ds": days.date, "y": 20_000 + slope.cumsum() + rng.normal(0, 8, 1000)}))
    df = spark.createDataFrame(pd.concat(rows))
    lab = SR.split_label(df, "2019-06-30")
    out = FC.predict_test(lab, FC.Settings(scale=0.5, multiplicative=False, yearly=0)).join(lab.select("series_id", "ds", "y"), ["series_id", "ds"]).toPandas().sort_values("ds")
    width = (out.yhat_upper - out.yhat_lower).groupby(out.ds).mean().to_numpy()
    assert width[-10:].mean() > 2 * width[:10].mean()
    covered = ((out.yhat_lower <= out.y) & (out.y <= out.yhat_upper)).mean()
    assert 0.6 < covered < 0.97


def test_logistic_forecast_stays_below_the_cap(spark):
    days = pd.date_range("2019-01-01", periods=400)
    df = spark.createDataFrame(pd.DataFrame({"series_id": "s", "ds": days.date, "y": np.linspace(10, 100, 400)}))
    out = FC.forecast(df, 90, FC.Settings(logistic=True)).toPandas()
    assert out.yhat_upper.max() <= 150 + 1e-6 and out.yhat.min() >= 0


# --- customers ---

def test_repeat_summary_ignores_the_first_day(spark):
    ts = lambda d, h: dt.datetime(2020, 1, d, h)
    rows = [(1, "a", ts(1, 9), 1.0, 100.0), (1, "b", ts(1, 20), 1.0, 50.0), (1, "c", ts(5, 1), 2.0, 10.0), (1, "d", ts(9, 1), 1.0, 40.0), (2, "e", ts(11, 1), 1.0, 5.0)]
    df = spark.createDataFrame(rows, "customer_id bigint, invoice_no string, invoice_date timestamp_ntz, quantity double, unit_price double")
    a, b = rfm.repeat_summary(df).orderBy("customer_id").collect()
    assert (a.frequency, a.recency, a["T"], a.monetary_value) == (2, 8, 10, 30.0)
    assert (b.frequency, b.recency, b["T"], b.monetary_value) == (0, 0, 0, 0.0)


def test_summary_with_one_hot_customer(spark):
    """One customer holds a third of all rows; the result is that of a plain pandas computation."""
    rng = np.random.default_rng(8)
    n = 3000
    cust = np.where(np.arange(n) % 3 == 0, 1, rng.integers(2, 60, n))
    ts = pd.Timestamp("2021-01-01") + pd.to_timedelta(rng.integers(0, 24 * 200, n), unit="h")
    pdf = pd.DataFrame({"customer_id": cust, "invoice_no": np.arange(n).astype(str), "invoice_date": ts, "quantity": rng.integers(1, 9, n).astype(float), "unit_price": np.round(rng.random(n) * 20 + 1, 2)})
    df = spark.createDataFrame(pdf).withColumn("invoice_date", F.col("invoice_date").cast("timestamp_ntz"))
    got = rfm.repeat_summary(df.repartition(9)).toPandas().set_index("customer_id").sort_index()
    day = pdf.assign(day=pdf.invoice_date.dt.normalize(), total=pdf.quantity * pdf.unit_price).groupby(["customer_id", "day"]).total.sum().reset_index()
    for c, g in day.groupby("customer_id"):
        rest = g.sort_values("day").total.iloc[1:]
        assert got.loc[c].frequency == len(g) - 1 and got.loc[c].recency == (g.day.max() - g.day.min()).days
        assert got.loc[c]["T"] == (day.day.max() - g.day.min()).days and got.loc[c].monetary_value == pytest.approx(rest.mean() if len(rest) else 0)


def test_cleaning_counts_the_first_broken_rule(spark):
    rows = [(None, "C1", -1.0, 0.0), (1.0, "C2", -1.0, 1.0), (1.0, "3", 0.0, 1.0), (1.0, "4", 1.0, 0.0), (1.0, "5", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "customer_id double, invoice_no string, quantity double, unit_price double")
    assert [(r.dropped, r.remaining) for r in C.drop_report(df).orderBy("step").collect()] == [(1, 4), (1, 3), (1, 2), (1, 1)]
    assert C.clean_transactions(df).count() == 1


def test_fit_finds_a_stationary_point(spark):
    rng = np.random.default_rng(4)
    n = 1500
    x = rng.poisson(rng.gamma(1.2, 2.0, n)).astype(float)
    T = np.full(n, 364.0)
    rec = np.where(x > 0, np.floor(T * rng.random(n) * 0.9), 0.0)
    df = spark.createDataFrame(pd.DataFrame({"customer_id": np.arange(n), "frequency": x, "recency": rec, "T": T}))
    p, best = FT.fit_purchases(df, 0.01)
    table = FT.purchase_table(df)
    th = np.array([p[k] for k in ("r", "alpha", "a", "b")])
    near = np.vstack([th * f for f in ([1, 1, 1, 1], [1.05, 1, 1, 1], [0.95, 1, 1, 1], [1, 1.05, 1, 1], [1, 0.95, 1, 1], [1, 1, 1.05, 1], [1, 1, 0.95, 1], [1, 1, 1, 1.05], [1, 1, 1, 0.95])])
    obj = -FT.likelihood_sums(table, FT.bgnbd_ll, near) / n + 0.01 * (near ** 2).sum(1)
    assert obj.argmin() == 0 and obj[0] == pytest.approx(best.value) and best.converged and best.gradient <= 1e-6


def test_penalty_sweep_and_spend_fit_converge(spark):
    rng = np.random.default_rng(6)
    n = 1200
    p = rng.beta(1.5, 4, n)
    x = np.minimum(rng.geometric(p) - 1, rng.poisson(rng.gamma(1.5, 2.0, n))).astype(float)
    rec = np.where(x > 0, np.floor(364 * (0.2 + 0.7 * rng.random(n))), 0.0)
    spend = (1 / rng.gamma(6, 1, n)) * rng.gamma(4 * np.maximum(x, 1), 1, n) / np.maximum(x, 1) * 100
    df = spark.createDataFrame(pd.DataFrame({"customer_id": np.arange(n), "frequency": x, "recency": rec, "T": 364.0, "monetary_value": np.where(x > 0, spend, 0.0)}))
    sweep = FT.penalty_sweep(df, (0.001, 0.1)).collect()
    assert all(r.converged for r in sweep) and sum(r.chosen for r in sweep) <= 1 and sweep[0].objective < sweep[1].objective
    found, fit = FT.fit_spend(df.filter("frequency > 0"))
    assert fit.converged and not fit.bounds and 2 < found["p"] < 8 and 3 < found["q"] < 12


# --- models ---

def test_tree_contributions_add_up(spark, rare):
    df = rare.withColumn("label", (F.col("a") + F.col("b") > 0.5).cast("int"))
    x = ML.assemble(df, ["a", "b"], keep=["id"]).withColumn("weight", F.lit(1.0))
    m = ML.classifiers(trees=5)["random_forest"].fit(x)
    from pyspark.ml.functions import vector_to_array

    p = m.transform(x).select("id", vector_to_array("probability")[1].alias("p"))
    s = ML.tree_contributions(m, df, "id", ["a", "b"]).groupBy("id").agg(F.sum("contribution").alias("s"))
    assert s.join(p, "id").filter(F.abs(F.col("s") - F.col("p")) > 1e-9).count() == 0


# --- routing and answers ---

CASES = [("How many delivered orders are in the dataset?", "direct"), ("How many active sellers are on the platform?", "direct"), ("What is total revenue from delivered orders?", "direct"),
         ("What is the overall average delivery time?", "direct"), ("What percentage of reviews are negative?", "direct"), ("Which region has the slowest delivery time?", "rag"),
         ("Why do bottom sellers have lower revenue?", "rag"), ("How did monthly revenue change from 2017 to 2018?", "rag"), ("Which category appears most in top-3 monthly rank?", "rag")]


def test_routes(spark):
    got = X.classify(spark.createDataFrame([(q,) for q, _ in CASES], "question string")).collect()
    assert {r.question: r.query_type for r in got} == dict(CASES)


def test_citations(spark):
    a = spark.createDataFrame([(1, "Fine text.\nsources : [2], [7], [1], [2]"), (2, "No list")], "id int, answer string")
    got = spark.createDataFrame([(1, 1, "c1", "d", 0.5, "t1"), (1, 2, "c2", "d", 0.4, "t2")], "id int, rank int, chunk_id string, doc_name string, similarity double, text string")
    clean, cards = A.parse_citations(a, got)
    assert {r.id: r.clean_answer for r in clean.collect()} == {1: "Fine text.", 2: "No list"}
    assert sorted((r.id, r.source_num, r.chunk_id) for r in cards.collect()) == [(1, 1, "c1"), (1, 2, "c2")]


def test_grade_edges(spark):
    df = spark.createDataFrame([(1, "Alpha beta", ["alpha", "x"]), (2, "nothing", ["x"]), (3, "abc", []), (4, "A B C", ["a", "b", "z"])], "id int, answer string, expected_keywords array<string>")
    assert [r.grade for r in A.grade(df).orderBy("id").collect()] == ["PARTIAL", "FAIL", "PASS", "PASS"]


def test_quality_score_edges(spark):
    c = lambda a, ctx: spark.createDataFrame([(a, ctx)], "a string, c array<string>").select(A.faithfulness(F.col("a"), F.col("c")).alias("v")).first().v
    assert (c("", ["x"]), c("word", []), c("the of", ["x"]), c("red blue", ["red car"])) == (0.0, 0.0, 1.0, 0.5)


def test_state_region_default(spark):
    from tallyloom.functions.fixed_values import STATE_REGION

    df = spark.createDataFrame([("SP",), ("XX",), (None,)], "s string")
    assert [r.v for r in df.select(SL.map_with_default(F.col("s"), STATE_REGION).alias("v")).collect()] == ["Southeast", "Other", "Other"]


# --- sinks and streams ---

def test_answers_continue_after_a_restart(spark):
    path = fresh_path(spark, "answers")
    q = spark.createDataFrame([(i, f"q{i}") for i in range(6)], "id int, question string")
    WR.append_results(q.filter("id < 4"), path)
    todo = A.unanswered(q, spark.read.parquet(path))
    assert sorted(r.id for r in todo.collect()) == [4, 5]
    WR.append_results(todo, path)
    assert A.unanswered(q, spark.read.parquet(path)).count() == 0


def test_stream_equals_batch_in_several_batches(spark):
    folder = fresh_path(spark, "in")
    e = spark.range(90).select(F.col("id").alias("event_id"), (F.col("id") % 3).alias("user_id"), F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id div 9 as int), cast(id % 9 as int), 0, 0)").alias("ts"), (F.col("id") * 1.5).alias("value"))
    for part in range(3):
        e.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(folder)
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = Z.customer_state(s).orderBy("user_id").toPandas()
    want = e.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.sum("value").alias("v")).groupBy("user_id").agg((F.count("*") - 1).alias("f"), F.sum("v").alias("t"), F.min_by("v", "d").alias("a")).orderBy("user_id").toPandas()
    assert list(got.frequency) == list(want.f) and np.allclose(got.monetary_value, (want.t - want.a) / want.f)


def test_rare_rows_can_be_learnt_and_ranked_exactly(spark, sf):
    from tallyloom.operators import metrics as M
    from tallyloom.plans import fitted as FQ

    train, test, _raw = FQ._assembled(spark, sf)
    model = ML.classifiers(rows=train.count())["logistic_regression"].fit(train)
    scored = ML.scored_by(model, test.unionByName(train.select(*test.columns))).toPandas()
    pos, neg = scored.score[scored.label == 1].to_numpy(), scored.score[scored.label == 0].to_numpy()
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    got = M.metric_suite(spark.createDataFrame(scored), 0.5, score="score").first()
    assert got.roc_auc == pytest.approx(wins, abs=1e-12) and wins > 0.8


def test_rows_on_both_sides_are_compared_whole_in_parts_of_bounded_size(spark, monkeypatch):
    from tallyloom import session
    from tallyloom.operators.splits import row_overlap

    monkeypatch.setattr(session, "SPREAD_FROM", 4)  # parts of 20 rows
    none, nan = None, float("nan")
    shared = [(1.0, "a"), (1.0, "a"), (0.0, "z"), (nan, "n"), (none, "x"), (none, none)]
    train = spark.createDataFrame([*shared, (2.0, none), *((float(i), "t") for i in range(300))], "x double, y string")
    test = spark.createDataFrame([(1.0, "a"), (-0.0, "z"), (nan, "n"), (none, "x"), (none, none), (none, none), (none, "2"), *((float(i), "u") for i in range(93))], "x double, y string")
    found = row_overlap(train, test, ["x", "y"])
    assert found.first()["overlap"] == train.intersect(test).count() == 5
    assert row_overlap(train, test.limit(0), ["x", "y"]).first()["overlap"] == 0
    # 407 rows, 20 a part: rows are dealt to as many tasks before they are grouped
    assert "hashpartitioning(_h" in (plan := found._jdf.queryExecution().toString()) and ", 21), REPARTITION_BY_NUM" in plan


# --- fits side by side ---

def test_importance_fits_its_models_side_by_side(spark, monkeypatch):
    import threading
    from types import SimpleNamespace

    from tallyloom.plans import fitted

    here = threading.Barrier(3, timeout=20)  # broken unless all three fits are under way at a time

    class Waiting:
        def __init__(self, j):
            self.j = j

        def fit(self, _train):
            here.wait()
            return SimpleNamespace(coefficients=SimpleNamespace(toArray=lambda: np.eye(len(fitted.FEATURES))[self.j]))

    names = ("logistic_regression", "random_forest", "boosted_trees_a", "boosted_trees_b")
    monkeypatch.setattr(fitted, "_assembled", lambda s, d: (s.range(3), None, None))
    monkeypatch.setattr(ML, "classifiers", lambda **_: {k: Waiting(j) for j, k in enumerate(names)})
    got = {x["feature"]: x for x in fitted.QUERIES["m09_feature_importance"](spark, "").collect()}
    assert [got[fitted.FEATURES[j]][k] for j, k in enumerate(names) if k != "boosted_trees_a"] == [1.0, 1.0, 1.0]


def test_the_forest_is_the_same_with_rows_that_keep_their_nodes(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=400), "b": rng.normal(size=400)}).assign(label=lambda x: (x.a + 0.3 * rng.normal(size=400) > 0).astype(int), w=1.0)
    x = ML.assemble(spark.createDataFrame(pdf), ["a", "b"], keep=["w"]).withColumnRenamed("w", "weight").cache()
    forest = ML.classifiers(trees=5)["random_forest"]
    assert forest.getCacheNodeIds()
    assert forest.fit(x).toDebugString.split("\n")[1:] == forest.copy().setCacheNodeIds(False).fit(x).toDebugString.split("\n")[1:]


def test_many_synthetic_rows_are_made_beside_their_rare_row_and_equal_the_joined_ones(spark, monkeypatch):
    from tallyloom.operators import resample

    rows = [(i, float(i * i % 17), float(i % 5), int(i % 40 == 0)) for i in range(300)] + [(40, 3.5, 1.0, 1), (600, 1.0, None, 0)]  # a repeated rare id, a missing value
    df = spark.createDataFrame(rows, "id long, x double, y double, label int")
    taken = lambda: resample.oversample(df, "id", ["x", "y"])
    listed = lambda one: sorted(map(tuple, one.collect()), key=repr)
    joined = listed(taken())
    monkeypatch.setattr(resample, "SPREAD_FROM", 10)
    monkeypatch.setattr(resample, "STEP", 3)
    made = taken()
    assert listed(made) == joined and len(joined) > 500
    assert "Range (" not in made._jdf.queryExecution().optimizedPlan().toString()  # no row is made apart from its rare row and moved to it
    assert resample.sizes_after(df)[1] == resample.sizes_after(df)[2] - len(rows)


def test_rows_are_not_moved_by_class_to_meet_the_cuts(spark):
    from tallyloom.operators import splits

    df = spark.range(2000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"))
    few, many = (splits.stratified_split(df, "id", many=x) for x in (False, True))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert "strategy=broadcast" in many._jdf.queryExecution().optimizedPlan().toString()


def test_large_tables_are_written_once_in_equal_parts(spark, monkeypatch):
    from tallyloom import session

    names, write = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name: (names.append(df.rdd.getNumPartitions()), write(df, name))[1])
    df = spark.range(1000).coalesce(1)
    assert session.materialize_spread(df, 10, "small", "id").count() == session.materialize_spread(df, session.SPREAD_FROM, "large", "id").count() == 1000
    assert names == [1, spark.sparkContext.defaultParallelism]


def test_rows_keep_their_nodes_only_where_these_fit_into_memory(spark):
    kept = lambda rows: ML.classifiers(rows=rows)["random_forest"].getCacheNodeIds()
    assert kept(None) and kept(1_000_000) and not kept(60_000_000)
