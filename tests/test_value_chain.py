"""From fitted purchase and spend models to scores and report: DuckDB recomputes the figures from the written parameters."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from tallyloom.plans import customer_value as CV


@pytest.fixture(scope="module")
def chain(spark, sf):
    return lambda name: entry.queries()[name](spark, sf).toPandas()


@pytest.fixture(scope="module")
def scores(chain):
    return chain("c07_fitted_scores")


@pytest.fixture(scope="module")
def con(scores):
    first = scores.iloc[0]
    p, g = ({k: float(first[f"{m}_{k}"]) for k in names} for m, names in (("purchase", ("r", "alpha", "a", "b")), ("spend", ("p", "q", "v"))))
    con = duckdb.connect()
    con.register("scores", scores)
    con.execute("CREATE VIEW w_rfm AS SELECT customer_id, frequency, recency, T, monetary_value FROM scores")
    series = CV._series("w_rfm", p, CV.WEEKS)
    con.execute(f"CREATE TABLE w_series AS WITH RECURSIVE w_series AS ({series['w_series'].replace('/*RECURSIVE*/', '')}) SELECT * FROM w_series")
    con.execute(f"CREATE TABLE w_predicted AS {series['w_predicted']}")
    con.execute(f"""CREATE TABLE w_spend AS SELECT *, ({g['q']!r}-1)/({g['p']!r}*frequency+{g['q']!r}-1)*({g['v']!r}*{g['p']!r}/({g['q']!r}-1))
        + {g['p']!r}*frequency/({g['p']!r}*frequency+{g['q']!r}-1)*monetary_value AS expected_avg_spend FROM w_predicted""")
    for view in ("w_scored", "w_quart", "w_segment", "w_hist", "w_ratio", "w_report"):
        con.execute(f"CREATE TABLE {view} AS {CV.EXTRA[view]}")
    return con


def test_scores_come_from_the_fitted_parameters(scores, con):
    want = con.execute("SELECT * FROM w_scored ORDER BY customer_id").df()
    got = scores.sort_values("customer_id")
    for c in ("predicted_purchases", "prob_alive", "expected_avg_spend", "cltv_90d"):
        assert np.allclose(got[c], want[c], rtol=1e-6, atol=1e-8), c
    assert got["at_risk"].tolist() == want["at_risk"].tolist()
    assert got["customer_id"].is_unique and np.isfinite(got["cltv_90d"]).all()


def test_report_and_segments_follow_the_scores(chain, con):
    for name, view, columns in (("c10_fitted_report", "w_report", ["tier", "rfm_grade", "confidence_flag", "verdict"]), ("c09_fitted_segments", "w_segment", ["cltv_segment"])):
        got, want = (t.sort_values("customer_id")[["customer_id", *columns]].to_numpy().tolist() for t in (chain(name), con.execute(f"SELECT * FROM {view}").df()))
        assert got == want, name


def test_shares_are_of_repeat_buyers_and_sum_up(chain, con):
    shares = chain("c12_fitted_tier_shares")
    assert abs(shares["revenue_pct"].sum() - 100) < 1e-3 and abs(shares["customer_pct"].sum() - 100) < 1e-3
    assert set(shares["tier"]) == {t for t, in con.execute("SELECT DISTINCT tier FROM w_report WHERE tier <> 'Unscored'").fetchall()}


def test_fitted_model_minimises_the_chosen_penalised_objective(spark, sf, scores):
    """A penalised fit need not have the higher likelihood, but no other parameters may have the better objective."""
    from pyspark.sql import functions as F
    from tallyloom.operators import fitting as FT
    from tallyloom.plans import fitted

    p = {k: float(scores.iloc[0][f"purchase_{k}"]) for k in FT.PURCHASE_NAMES}
    rows = fitted.eligible(spark, sf)
    coef = FT.penalty_sweep(rows).filter("chosen").first()["coef"]
    others = [CV.MODEL, *({**p, k: p[k] * f} for k in ("r", "alpha") for f in (0.8, 1.25))]
    mean = lambda q: FT.log_likelihood(rows, q).select(F.lit(1).alias("one"), "ll").groupBy("one").agg(F.avg("ll").alias("m")).first()["m"]
    objective = lambda q: coef * sum(v * v for v in q.values()) - mean(q)
    assert all(objective(p) < objective(q) for q in others)


def test_shrinkage_theory_is_that_of_the_fitted_spend_model(chain, scores):
    row = scores.iloc[0]
    theory = chain("a21_fitted_shrinkage").set_index("cohort")["theory"]
    assert abs(theory["freq=1"] - row["spend_q"] / (row["spend_p"] + row["spend_q"])) < 1e-5
