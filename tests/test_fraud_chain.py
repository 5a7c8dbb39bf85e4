"""From the fitted model to frozen impact: DuckDB recomputes the figures from the written scores and contributions."""

from __future__ import annotations

import numpy as np
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def chain(spark, sf):
    return lambda name: entry.queries()[name](spark, sf).toPandas()


def test_impact_is_recomputed_from_written_scores(spark, sf, chain):
    import duckdb
    from tallyloom.plans import detection as DT

    scores = chain("m04_chain_scores")
    con = duckdb.connect()
    con.register("scores", scores)
    con.execute("CREATE VIEW w_val AS SELECT * FROM scores WHERE part='val'")
    con.execute("CREATE VIEW w_test AS SELECT * FROM scores WHERE part='test'")
    for view in ("w_sweep", "w_optima", "w_scen", "w_applied", "w_impact"):
        con.execute(f"CREATE VIEW {view} AS {DT.EXTRA[view]}")
    for name, sql in (("m11_chain_sweep", DT.SQL["m11_threshold_sweep"]), ("m14_chain_impact", DT.SQL["m14_scenario_impact"])):
        body = sql[sql.rindex("SELECT threshold"):] if "sweep" in name else sql[sql.rindex("SELECT scenario"):]
        want = con.execute(body).df()
        got = chain(name)
        key = want.columns[0]
        assert np.allclose(got.sort_values(key)[list(want.columns)].select_dtypes("number").to_numpy(float), want.sort_values(key).select_dtypes("number").to_numpy(float), atol=1e-6), name


def test_parts_do_not_overlap_and_the_model_ranks(chain):
    scores = chain("m04_chain_scores")
    assert scores["event_id"].is_unique and set(scores["part"]) == {"val", "test"} and scores["label"].isin([0, 1]).all()
    test = scores[scores["part"] == "test"]
    assert abs(len(test) / max(len(scores), 1) - 0.2 / 0.36) < 0.05


def test_contributions_add_up_to_the_score(chain):
    scores, long = chain("m04_chain_scores").set_index("event_id"), chain("m18_boosted_attribution")
    margin = long.groupby("event_id")["contribution"].sum()
    assert np.allclose(1 / (1 + np.exp(-margin)), scores.loc[margin.index, "score"], atol=1e-4)
    top = chain("m19_fitted_importance")
    size = long[long.feature != "(base)"].assign(a=lambda x: x.contribution.abs()).groupby("feature").a.mean()
    assert np.allclose(top.sort_values("rank")["mean_abs"], size.sort_values(ascending=False).head(5), atol=1e-5) and long["feature"].nunique() == 34
    bees = chain("m21_fitted_beeswarm")
    assert bees["feature"].nunique() == 15 and bees["unit"].between(0, 1).all()
    assert len(chain("m22_fitted_explanation")) == 12 and len(chain("m20_fitted_dependence"))
