"""Closed forms, special functions and the row-wise meaning of the column helpers."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import semantics as S, special, text as TX
from tallyloom.operators import clv
from tallyloom.operators.fitting import bgnbd_ll


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_lgamma_matches_math(spark):
    xs = [0.001, 0.01, 0.3457, 1.0, 2.0, 7.5, 120.0, 1200.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(special.lgamma(F.col("x")).alias("v")).collect()
    for x, row in zip(xs, got):
        assert abs(row.v - math.lgamma(x)) < 1e-9 * max(1, abs(math.lgamma(x)))
    assert np.allclose(special.np_lgamma(np.array(xs)), [math.lgamma(x) for x in xs], rtol=1e-10, atol=1e-10)


def direct_2f1(a, b, c, z, terms=20_000):
    term = total = 1.0
    for k in range(terms):
        term *= (a + k) * (b + k) / ((c + k) * (k + 1)) * z
        total += term
        if abs(term) < 1e-18 * abs(total):
            break
    return total


def expected(x, t, T, s, p):
    """Direct, slowly converging form of the expectation."""
    r, al, a, b = p["r"], p["alpha"], p["a"], p["b"]
    z = s / (al + T + s)
    top = (a + b + x - 1) / (a - 1) * (1 - ((al + T) / (al + T + s)) ** (r + x) * direct_2f1(r + x, b + x, a + b + x - 1, z))
    return top / (1 + (a / (b + x - 1) * ((al + T) / (al + t)) ** (r + x) if x > 0 else 0))


@pytest.mark.parametrize("x,t,T", [(0, 0, 20), (1, 5, 20), (2, 30, 38.86), (20, 40, 52), (7, 3, 60)])
def test_expected_purchases_against_direct_series(spark, x, t, T):
    p = {"r": 0.243, "alpha": 4.414, "a": 0.793, "b": 2.426}
    row = spark.createDataFrame([(float(x), t * 7.0, T * 7.0)], "frequency double, recency double, T double").select(clv.expected_purchases(13.0, p).alias("e")).first()
    assert row.e == pytest.approx(expected(x, t, T, 13.0, p), rel=1e-7)


def test_no_dropout_limit(spark):
    """With a, b near zero and x >= 2 the expectation is (r+x) s / (alpha+T)."""
    p = {"r": 0.3457, "alpha": 4.5401, "a": 1e-9, "b": 1e-9}
    row = spark.createDataFrame([(5.0, 140.0, 210.0)], "frequency double, recency double, T double").select(clv.expected_purchases(10.0, p).alias("e")).first()
    assert row.e == pytest.approx((0.3457 + 5) * 10 / (4.5401 + 30), rel=1e-5)


def test_alive_probability_edges(spark):
    p = {"r": 0.3457, "alpha": 4.5401, "a": 1e-9, "b": 1e-9}
    rows = spark.createDataFrame([(0.0, 0.0, 70.0), (1.0, 70.0, 70.0), (1.0, 7.0, 350.0), (4.0, 7.0, 350.0)], "frequency double, recency double, T double").select(clv.prob_alive(p).alias("v")).collect()
    assert rows[0].v == 1.0 and rows[1].v == pytest.approx(0.5) and rows[2].v < 0.5 and rows[3].v > 0.99


def test_spend_conventions():
    assert clv.implied_mean_spend() == pytest.approx(305.66, abs=0.1)
    assert clv.implied_mean_spend(convention="published") == pytest.approx(365.1, abs=0.1)
    assert clv.variation(0.3457) == pytest.approx(1.7008, abs=1e-3)
    assert clv.purchase_rate()[1] == pytest.approx(0.979, abs=1e-3)


def test_gamma_quantile():
    assert special.gamma_quantile(0.9, 1.0, 2.0) == pytest.approx(-2 * math.log(0.1), rel=1e-9)
    assert special.gamma_quantile(0.5, 5.0, 1.0) == pytest.approx(4.67090888279598, rel=1e-9)


def test_likelihood_is_highest_near_the_truth():
    rng = np.random.default_rng(1)
    n, r, al, a, b = 4000, 0.8, 6.0, 0.9, 2.5
    lam, p, T = rng.gamma(r, 1 / al, n), rng.beta(a, b, n), np.full(n, 52.0)
    x, t = np.zeros(n), np.zeros(n)
    for i in range(n):
        now = 0.0
        while True:
            now += rng.exponential(1 / lam[i])
            if now > T[i]:
                break
            x[i], t[i] = x[i] + 1, now
            if rng.random() < p[i]:
                break
    th = np.array([[r, al, a, b], [2.0, 6.0, 0.9, 2.5], [0.8, 20.0, 0.9, 2.5], [0.8, 6.0, 5.0, 2.5]])
    ll = bgnbd_ll(th, x, t, T).sum(1)
    assert ll.argmax() == 0


def test_floor_days_crosses_midnight_and_goes_negative(spark):
    d = dt.datetime
    rows = [(d(2020, 1, 1, 23), d(2020, 1, 2, 1)), (d(2020, 1, 2, 1), d(2020, 1, 1, 23)), (d(2020, 1, 1), d(2020, 1, 3)), (d(2020, 1, 1), None)]
    got = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").select(S.floor_days("a", "b").alias("v")).collect()
    assert [x.v for x in got] == [0, -1, 2, None]


def test_sums_and_shares_with_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(S.sum0("x").alias("s")).first().s == 0.0
    df = spark.createDataFrame([(None,), (1.0,), (-1.0,), (3.0,)], "x double")
    assert df.agg(S.share_true(F.col("x") > 0).alias("s")).first().s == 0.5


def test_ratio_guards_zero(spark):
    r = one(spark, S.ratio(F.lit(1.0), F.lit(0.0)), S.ratio(F.lit(1.0), F.lit(0.0), 7.0), S.ratio(F.lit(1), F.lit(4)))
    assert (r.c0, r.c1, r.c2) == (None, 7.0, 0.25)


def test_tokens(spark):
    r = one(spark, F.array_sort(TX.token_set(F.lit("The price is 12.50. Não vai, THE Price_2 ok."))), TX.fixed(F.lit(1234567.891), 2), TX.plain(F.lit(1234.5), 0))
    assert r.c0 == ["12.50", "ok", "price", "price_2", "vai"] and r.c1 == "1,234,567.89" and r.c2 == "1234"


def test_escaped_words_are_literal(spark):
    pat = TX.any_keyword(["a.b", "(x"])
    r = one(spark, F.lit("aXb").rlike(pat), F.lit("a.b").rlike(pat), F.lit("f(x)").rlike(pat))
    assert (r.c0, r.c1, r.c2) == (False, True, True)


def test_hash_orders_of_two_seeds_are_unrelated(spark):
    ids = spark.range(20_000)
    first = lambda seed, use: {r.id for r in ids.orderBy(S.order_hash("id", seed, use)).limit(4000).collect()}
    a = first(42, "split")
    for other in (first(43, "split"), first(42, "sample")):
        assert 600 < len(a & other) < 1000  # a fifth of a fifth


def test_clock_time_survives_any_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        t = dt.datetime(2024, 3, 10, 2, 30, 0, 123456)  # does not exist on the clocks of that zone
        df = spark.createDataFrame([(t,)], "t timestamp_ntz").withColumn("i", S.as_instant("t"))
        assert df.select(S.as_clock("i").alias("v")).first().v == t
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_working_folder_is_the_one_the_session_names(spark):
    from tallyloom.session import fresh_path, materialize, shared_dir

    assert spark.conf.get("spark.checkpoint.dir") in shared_dir(spark) and fresh_path(spark, "x") != fresh_path(spark, "x")
    assert materialize(spark.range(3), "three").count() == 3
    assert any("three" in f for f in materialize(spark.range(3), "three").inputFiles())


def test_series_goes_on_until_it_settles_or_says_so():
    from tallyloom.functions.special import np_hyp2f1

    a, b, c, z = 0.5, 1.5, np.array([3.0, 2.5]), np.array([0.99, 0.995])  # far more than 150 terms
    term = total = np.ones(2)
    for k in range(20_000):
        term = term * ((a + k) * (b + k) / ((c + k) * (k + 1.0)) * z)
        total = total + term
    assert np.allclose(np_hyp2f1(a, b, c, z), total, rtol=1e-12)
    with pytest.raises(ArithmeticError):
        np_hyp2f1(a, b, c, z, terms=150)


def test_likelihood_works_out_a_frequency_and_a_day_once(monkeypatch):
    from tallyloom.operators import fitting as FT

    seen, rng = [], np.random.default_rng(5)
    monkeypatch.setattr(FT, "np_lgamma", lambda x: seen.append(np.size(x)) or special.np_lgamma(x))
    x, T = np.arange(4000) % 5.0, rng.integers(90, 900, 4000) / 7.0
    t, th = np.where(x > 0, T / 2, 0.0), np.exp(rng.normal(size=(3, 4)))
    many = FT.bgnbd_ll(th, x, t, T)
    assert max(seen) == 3 * 5
    seen.clear()
    one = np.array([[FT.bgnbd_ll(th[i:i + 1], x[j:j + 1], t[j:j + 1], T[j:j + 1])[0, 0] for j in range(0, 4000, 97)] for i in range(3)])
    assert np.allclose(many[:, ::97], one, rtol=1e-12)
    spend, single = FT.gamma_gamma_ll(th[:, :3], x + 1, T, 0 * T), FT.gamma_gamma_ll(th[:, :3], x[7:8] + 1, T[7:8], T[7:8])
    assert np.allclose(spend[:, 7:8], single, rtol=1e-12)
