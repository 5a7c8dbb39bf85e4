"""Streams over unordered files, one a batch, with a restart in the middle, against the same figures of the whole table."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.streaming import monitor as Z


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 600
    ts = pd.Timestamp("2021-03-01") + pd.to_timedelta(rng.integers(0, 90 * 24 * 3600, n), unit="s")
    return pd.DataFrame({"event_id": np.arange(n), "user_id": np.where(np.arange(n) % 3 == 0, 1, rng.integers(2, 25, n)), "ts": ts, "value": np.round(rng.random(n) * 50, 2), "label": (rng.random(n) < 0.2).astype(int), "flagged": rng.random(n) < 0.5})


def written(spark, folder, parts):
    """One file for each part; later files are read later."""
    import os
    import time

    for name, part in parts:
        spark.createDataFrame(part).coalesce(1).write.parquet(f"{folder}/tmp-{name}")
        file = next(f for f in os.listdir(f"{folder}/tmp-{name}") if f.startswith("part-"))
        os.makedirs(f"{folder}/in", exist_ok=True)
        os.rename(f"{folder}/tmp-{name}/{file}", f"{folder}/in/{name}.parquet")
        time.sleep(0.02)


def newest_first(table, parts=4):
    """Files in reverse order of time."""
    order = table.sort_values("ts", ascending=False).reset_index(drop=True)
    return [(f"f{i}", c) for i, c in enumerate(np.array_split(order, parts))]


def in_two_runs(spark, folder, table, run):
    """The stream of the first files, a stop, and the rest with the same state."""
    files = newest_first(table)
    written(spark, folder, files[:2])
    run(Z.event_stream(spark, f"{folder}/in", files_per_batch=1))
    written(spark, folder, files[2:])
    return run(Z.event_stream(spark, f"{folder}/in", files_per_batch=1))


def test_weekly_figures_and_day_sums_do_not_depend_on_files(spark, table, tmp_path):
    got = in_two_runs(spark, str(tmp_path), table, lambda s: Z.weekly_monitor(s, f"{tmp_path}/weekly")).orderBy("week_start").toPandas()
    whole = Z.week_counts(spark.createDataFrame(table)).orderBy("week_start").toPandas()
    assert len(got) >= 12 and (got[["tp", "fn", "fp", "tn"]].to_numpy() == whole[["tp", "fn", "fp", "tn"]].to_numpy()).all()
    days = Z.daily_sum(Z.event_stream(spark, f"{tmp_path}/in", files_per_batch=1)).orderBy("day").toPandas()
    want = table.groupby(table.ts.dt.normalize()).value.agg(["sum", "count"])
    assert np.allclose(days["value"], want["sum"]) and (days["n"].to_numpy() == want["count"].to_numpy()).all()


def test_customer_state_equals_the_table_after_a_restart(spark, table, tmp_path):
    got = in_two_runs(spark, str(tmp_path), table, lambda s: Z.customer_state(s.select("user_id", "ts", "value"), f"{tmp_path}/customers")).toPandas().set_index("user_id").sort_index()
    day = table.assign(day=table.ts.dt.normalize()).groupby(["user_id", "day"]).value.sum().reset_index()
    assert len(got) == day.user_id.nunique()
    for user, g in day.groupby("user_id"):
        row, rest = got.loc[user], g.sort_values("day").value.iloc[1:]
        assert (row.first_day, row.last_day, row.frequency, row.recency) == (g.day.min().date(), g.day.max().date(), len(rest), (g.day.max() - g.day.min()).days)
        assert row.monetary_value == pytest.approx(rest.mean() if len(rest) else 0.0)


def test_copies_in_other_files_and_late_ones_are_found(spark, table, tmp_path):
    late = pd.concat([table, table.sample(200, random_state=1).assign(ts=lambda x: x.ts + dt.timedelta(hours=30)), table.head(50)])
    got = in_two_runs(spark, str(tmp_path), late, lambda s: Z.deduplicated(s, path=f"{tmp_path}/unique"))
    assert got.count() == 600 and got.select("event_id").distinct().count() == 600
    assert got.columns == list(table.columns)


def test_answers_are_given_once_over_files_and_restarts(spark, table, tmp_path):
    asked = pd.concat([table, table.head(100)])[["event_id", "user_id", "ts"]]
    seen = []

    def answer(batch):
        return batch.select(F.col("event_id").alias("id"), (F.col("user_id") * 2).alias("answer"))

    def run(stream):
        out = Z.answered(stream.withColumn("id", F.col("event_id")), answer, path=f"{tmp_path}/answers")
        seen.append(out.count())
        return out

    got = in_two_runs(spark, str(tmp_path), asked, run)
    assert seen[0] < 600 and got.count() == 600 and got.select("id").distinct().count() == 600
    assert {r.id: r.answer for r in got.collect()} == dict(zip(table.event_id, table.user_id * 2))
    assert run(Z.event_stream(spark, f"{tmp_path}/in", files_per_batch=1)).count() == 600  # nothing new: the same table


def test_report_sink_streams_lines_in_order_and_names_files_on_commit(spark, tmp_path):
    from tallyloom.sources import writers as WR

    rows = [(f"r{k}", i // 1000, i % 1000, f"line {i}" if i % 7 else None) for k in range(3) for i in range(5000 if k else 3)]
    lines = spark.createDataFrame(rows, "report string, section_no int, line_no int, text string").repartition(6)
    WR.text_reports(lines, f"file:{tmp_path}/out")
    import os

    assert sorted(os.listdir(tmp_path / "out")) == ["r0.txt", "r1.txt", "r2.txt"]
    for k in range(3):
        assert (tmp_path / "out" / f"r{k}.txt").read_text() == "".join((t or "") + "\n" for r, _, _, t in rows if r == f"r{k}")
    with pytest.raises(Exception):
        WR.text_reports(lines.withColumn("text", F.raise_error(F.lit("stop"))), f"{tmp_path}/bad")
    assert not [f for f in os.listdir(tmp_path / "bad")] if os.path.isdir(tmp_path / "bad") else True
