"""Decomposable forecaster: piecewise-linear trend plus yearly and weekly seasonality, many series at once.

The trend changes have a Laplace prior, so most of them are zero; the fit needs only the sums X'X and X'y of a series, which Spark adds up for all series (and, when tuning, all
candidate settings) in the same pass. A series may be as long as it likes; only the days ahead of one series are a group.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize
from .series import future_frame

# fixed values: candidate flexibilities of the trend
SCALES = (0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.5)
OUT = "series_id string, ds date, yhat double, yhat_lower double, yhat_upper double"


@dataclass(frozen=True)
class Settings:
    scale: float = 0.05            # prior width of the trend changes
    changepoints: int = 50
    changepoint_range: float = 0.9
    season_scale: float = 10.0
    multiplicative: bool = True
    logistic: bool = False         # saturate between 0 and cap_factor x max
    cap_factor: float = 1.5
    level: float = 0.80            # interval coverage
    yearly: int = 10
    weekly: int = 3


def _waves(day: np.ndarray, period: float, order: int) -> np.ndarray:
    ang = 2 * np.pi * np.outer(day, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(ang), np.cos(ang)])


class Design:
    """Columns of the regression for rows (day, first and last training day, holiday): level, slope, trend changes, seasons, holidays."""

    def __init__(self, s: Settings, holidays: int):
        self.s, self.holidays = s, holidays
        self.trend = 2 + s.changepoints
        self.width = self.trend + 2 * (s.yearly + s.weekly) + holidays
        self.knots = np.linspace(0, s.changepoint_range, s.changepoints + 1)[1:]

    def columns(self, day, first, last, holiday) -> tuple[np.ndarray, np.ndarray]:
        t = (day - first) / np.maximum(last - first, 1.0)
        trend = np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - self.knots, 0)])
        return trend, np.hstack([_waves(day, 365.25, self.s.yearly), _waves(day, 7.0, self.s.weekly), holiday[:, None] == np.arange(self.holidays)])

    def target(self, y, top):
        """``y`` on the scale of the fit."""
        y = y / top
        if self.s.logistic:
            p = np.clip(y / self.s.cap_factor, 1e-3, 1 - 1e-3)
            y = np.log(p / (1 - p))
        return y

    def value(self, v, top):
        """A fitted number as a value of the series, not below zero."""
        return np.maximum(self.s.cap_factor * top / (1 + np.exp(-v)) if self.s.logistic else v * top, 0.0)

    def rows(self, day, first, last, holiday, beta: np.ndarray | None) -> np.ndarray:
        """The design with the seasons scaled by the trend of ``beta`` (rows x width), if the model is multiplicative."""
        trend, season = self.columns(day, first, last, holiday)
        if beta is not None and self.rounds > 1:
            season = season * np.maximum((trend * beta[:, :self.trend]).sum(axis=1), 1e-3)[:, None]
        return np.hstack([trend, season])

    @property
    def rounds(self) -> int:
        return 4 if self.s.multiplicative and not self.s.logistic else 1


def sparse_solution(gram: np.ndarray, cross: np.ndarray, lasso: np.ndarray, ridge: np.ndarray, start: np.ndarray | None = None, sweeps: int = 4000) -> np.ndarray:
    """Minimum of b'Gb/2 - c'b + sum(lasso |b|) + sum(ridge b^2)/2 by coordinate descent.

    Columns without ``lasso`` are solved for exactly and put back at the end. The descent stops as soon as the linear system of its non-zero columns has a solution of
    the same signs that also meets the conditions of all the others.
    """
    free, bound = np.flatnonzero(lasso == 0), np.flatnonzero(lasso > 0)
    full = gram + np.diag(ridge)
    if not len(bound):
        return np.linalg.solve(full, cross)
    turn = np.linalg.solve(full[np.ix_(free, free)], np.column_stack([full[np.ix_(free, bound)], cross[free]]))
    g = full[np.ix_(bound, bound)] - full[np.ix_(bound, free)] @ turn[:, :-1]
    g, c, weight = (g + g.T) / 2, cross[bound] - full[np.ix_(bound, free)] @ turn[:, -1], lasso[bound]
    b = np.zeros(len(bound)) if start is None else start[bound].copy()
    pull, size = c - g @ b, np.maximum(np.diag(g), 1e-300)
    room = 1e-9 * np.maximum(weight, np.abs(c).max() * 1e-6)
    for sweep in range(sweeps):
        for j in range(len(b)):
            z = pull[j] + size[j] * b[j]
            new = np.sign(z) * max(abs(z) - weight[j], 0.0) / size[j]
            if new != b[j]:
                pull -= g[:, j] * (new - b[j])
                b[j] = new
        if sweep % 5 == 4:
            on = np.flatnonzero(b)
            try:
                exact = np.linalg.solve(g[np.ix_(on, on)], c[on] - weight[on] * np.sign(b[on]))
            except np.linalg.LinAlgError:
                continue
            if (np.sign(exact) == np.sign(b[on])).all():
                rest = c - g[:, on] @ exact
                off = np.setdiff1d(np.arange(len(b)), on)
                if (np.abs(rest[off]) <= weight[off] + room[off]).all():
                    b[:] = 0.0
                    b[on] = exact
                    break
    out = np.zeros(len(cross))
    out[bound], out[free] = b, turn[:, -1] - turn[:, :-1] @ b
    return out


def _penalties(design: Design, scale: float, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the absolute trend changes (a Laplace prior of width ``scale``) and of the squares of the other coefficients (normal priors), for errors of variance ``noise``."""
    lasso, ridge = np.zeros(design.width), np.full(design.width, noise / design.s.season_scale ** 2)
    lasso[2:design.trend], ridge[:2], ridge[2:design.trend] = noise / scale, 1e-8, 0.0
    return lasso, ridge


SUMS = "series_id string, scale double, last array<double>, sums array<double>"
FITTED = "series_id string, scale double, beta array<double>, noise double"


def _gram_sums(rows: DataFrame, design: Design) -> DataFrame:
    """(series_id, scale, last, sums): X'X, X'y, y'y and the number of rows, added up in each task; ``last`` is the fit of the round before."""
    p = design.width

    def run(batches):
        held: dict = {}

        def flush():
            out = pa.RecordBatch.from_pydict({"series_id": [k[0] for k in held], "scale": pa.array([k[1] for k in held], pa.float64()), "last": pa.array([v[1] for v in held.values()], pa.list_(pa.float64())),
                                              "sums": pa.array([np.concatenate([v[0][0].ravel(), v[0][1]]) for v in held.values()], pa.list_(pa.float64()))}, schema=pa.schema([("series_id", pa.string()), ("scale", pa.float64()), ("last", pa.list_(pa.float64())), ("sums", pa.list_(pa.float64()))]))
            held.clear()
            return out

        for batch in batches:
            df = batch.to_pandas()
            for key, g in df.groupby(["series_id", "scale"], sort=False):
                last = g["beta"].iloc[0]
                beta = None if last is None else np.broadcast_to(np.asarray(last)[:p], (len(g), p))
                x = design.rows(*(g[c].to_numpy(float) for c in ("day", "first", "last", "holiday")), beta)
                y = design.target(g["y"].to_numpy(float), g["top"].to_numpy(float))
                both = np.column_stack([x, y])
                now = (both.T @ both, np.array([float(len(g))]))
                if key in held:
                    held[key][0][0][...] += now[0]
                    held[key][0][1][...] += now[1]
                else:
                    held[key] = (now, last)
                if len(held) >= 500:
                    yield flush()
        yield flush()

    return rows.mapInArrow(run, SUMS)


def _solved(sums: DataFrame, design: Design) -> DataFrame:
    """Coefficients of each (series, scale) from the sums of all tasks. The error variance is that of the round before, and comes out anew."""
    p = design.width

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v) for v in table.column("sums").to_pylist()], axis=0)
        return pa.table({"series_id": table.column("series_id").slice(0, 1), "scale": table.column("scale").slice(0, 1), "last": table.column("last").slice(0, 1).cast(pa.list_(pa.float64())), "sums": pa.array([total], pa.list_(pa.float64()))})

    def solve(table: pa.Table) -> pa.Table:
        total = np.sum([np.asarray(v) for v in table.column("sums").to_pylist()], axis=0)
        both, n = total[:-1].reshape(p + 1, p + 1), total[-1]
        gram, cross, square = both[:p, :p], both[:p, p], both[p, p]
        last, scale = table.column("last")[0].as_py(), table.column("scale")[0].as_py()
        noise, start = (0.05 ** 2, None) if last is None else (last[p], np.array(last[:p]))
        for _ in range(3 if last is None else 1):
            beta = sparse_solution(gram, cross, *_penalties(design, scale, noise), start)
            noise, start = max(float(square - 2 * cross @ beta + beta @ gram @ beta) / max(n, 1.0), 1e-8), beta
        return pa.table({"series_id": table.column("series_id").slice(0, 1), "scale": table.column("scale").slice(0, 1), "beta": pa.array([[*beta, noise]], pa.list_(pa.float64())), "noise": pa.array([noise])})

    # tasks of a long series first meet in sixteen groups
    first = sums.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16))).groupBy("series_id", "scale", "part").applyInArrow(add, SUMS)
    return first.groupBy("series_id", "scale").applyInArrow(solve, FITTED)


def _prepared(rows: DataFrame, holidays: DataFrame | None) -> tuple[DataFrame, int]:
    """Rows (series_id, ds, y, ...) with day number, the series' training range and largest value, and the holiday's number (-1: none). Rows of series with fewer than two values drop out."""
    known = F.col("y").isNotNull() & ~F.isnan("y")
    day = F.datediff("ds", F.lit("1970-01-01")).cast("double")
    rows = rows.withColumn("y", F.when(known, F.col("y").cast("double"))).withColumn("day", day)
    span = rows.filter("y IS NOT NULL").groupBy("series_id").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.greatest(F.max(F.abs("y")), F.lit(1e-9)).alias("top"), F.count("*").alias("_n"))
    rows = rows.join(span.filter("_n >= 2").drop("_n"), "series_id")
    if holidays is None:
        return rows.withColumn("holiday", F.lit(-1)), 0
    names = sorted(r["holiday"] for r in holidays.select("holiday").filter("holiday IS NOT NULL").distinct().collect())  # names, not days
    number = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col("holiday")).cast("int") - 1, F.lit(-1)) if names else F.lit(-1)
    one = holidays.groupBy("ds").agg(F.min("holiday").alias("holiday"))
    return rows.join(one, "ds", "left").withColumn("holiday", number), len(names)


def fit_series(rows: DataFrame, settings: Settings, holidays: int) -> DataFrame:
    """(series_id, scale, beta, noise) for prepared rows with a ``scale``: every round is one pass whose sums Spark adds up, so a long series is no single group."""
    design = Design(settings, holidays)
    train = materialize(rows.filter("y IS NOT NULL").select("series_id", "scale", "day", "first", "last", "top", "holiday", "y"), "training")
    fitted = None
    for _ in range(design.rounds):
        with_last = train.withColumn("beta", F.lit(None).cast("array<double>")) if fitted is None else train.join(fitted.select("series_id", "scale", "beta"), ["series_id", "scale"])
        fitted = materialize(_solved(_gram_sums(with_last, design), design), "fitted")
    return fitted


def predicted(rows: DataFrame, fitted: DataFrame, settings: Settings, holidays: int, keep: list[str]) -> DataFrame:
    """(keep..., fit, spread, yhat): prepared rows with their fitted number, the fit's error deviation, and the value."""
    design = Design(settings, holidays)
    rows = rows.join(fitted, ["series_id", "scale"]).select(*keep, "day", "first", "last", "holiday", "top", "beta", "noise")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                num = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("day", "first", "last", "holiday", "top", "noise")}
                beta = batch.column("beta").flatten().to_numpy().reshape(len(num["day"]), -1)[:, :design.width]
                fit = (design.rows(num["day"], num["first"], num["last"], num["holiday"], beta) * beta).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(fit), pa.array(np.sqrt(num["noise"])), pa.array(design.value(fit, num["top"]))], names=[*keep, "fit", "spread", "yhat"])

    return rows.mapInArrow(run, f"{kinds}, fit double, spread double, yhat double")


def simulated_band(day: np.ndarray, first: float, last: float, top: float, beta: np.ndarray, noise: float, fit: np.ndarray, scaled: np.ndarray, design: Design, seed: int, paths: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of simulated values: as many trend changes as in the past, each of their average size, at random times ahead, and random errors.

    ``scaled`` says how much of a change of the trend reaches the fit (seasons that scale with the trend do).
    """
    random = np.random.default_rng(seed)
    t = (day - first) / max(last - first, 1.0)
    size = float(np.abs(beta[2:design.trend]).mean()) if design.s.changepoints else 0.0
    ahead = max(float(t.max()) - 1.0, 0.0)
    count = random.poisson(design.s.changepoints / design.s.changepoint_range * ahead, paths)
    drift = np.zeros((paths, len(t)))
    for i, n in enumerate(count.tolist()):
        at, change = 1.0 + random.random(n) * ahead, random.laplace(0.0, size, n) if size else np.zeros(n)
        drift[i] = (np.maximum(t[None, :] - at[:, None], 0.0) * change[:, None]).sum(axis=0)
    value = fit + drift * scaled + random.normal(0.0, np.sqrt(noise), (paths, len(t)))
    low, high = np.quantile(design.value(value, top), [(1 - design.s.level) / 2, (1 + design.s.level) / 2], axis=0)
    return low, high


def _with_scale(rows: DataFrame, settings: Settings, scales: DataFrame | None) -> DataFrame:
    if scales is None:
        return rows.withColumn("scale", F.lit(float(settings.scale)))
    return rows.join(scales.select("series_id", F.col("scale").alias("_chosen")), "series_id", "left").withColumn("scale", F.coalesce("_chosen", F.lit(float(settings.scale)))).drop("_chosen")


def _banded(rows: DataFrame, fitted: DataFrame, settings: Settings, holidays: int, seed: int) -> DataFrame:
    """Forecast with its band for prepared rows after the training range; a group is the days ahead of one series."""
    design = Design(settings, holidays)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ds")
        num = {c: table.column(c).to_numpy().astype(float) for c in ("day", "first", "last", "holiday", "top")}
        beta, noise = np.array(table.column("beta")[0].as_py())[:design.width], table.column("noise")[0].as_py()
        wide = np.broadcast_to(beta, (len(num["day"]), design.width))
        x = design.rows(num["day"], num["first"], num["last"], num["holiday"], wide)
        fit = (x * beta).sum(axis=1)
        _, season = design.columns(num["day"], num["first"], num["last"], num["holiday"])
        scaled = 1.0 + season @ beta[design.trend:] if design.rounds > 1 else np.ones(len(fit))
        name, top = table.column("series_id")[0].as_py(), float(num["top"][0])
        low, high = simulated_band(num["day"], num["first"][0], num["last"][0], top, beta, noise, fit, scaled, design, zlib.crc32(f"{seed}:{name}".encode()))
        yhat = design.value(fit, top)
        return pa.table({"series_id": table.column("series_id"), "ds": table.column("ds"), "yhat": yhat, "yhat_lower": np.minimum(low, yhat), "yhat_upper": np.maximum(high, yhat)})

    return rows.join(fitted, ["series_id", "scale"]).select("series_id", "ds", "day", "first", "last", "holiday", "top", "beta", "noise").groupBy("series_id").applyInArrow(run, OUT)


def forecast(history: DataFrame, horizon: int = 90, settings: Settings = Settings(), holidays: DataFrame | None = None, include_history: bool = False,
             scales: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Forecast ``horizon`` days after each series' last day with a band that widens with the distance.

    ``holidays`` is an optional (ds, holiday) table; ``scales`` an optional (series_id, scale) choice for each series. Fitted days get a band of the error deviation.
    """
    past = history.select("series_id", "ds", F.col("y").cast("double").alias("y"), F.lit(False).alias("ahead"))
    frame = past.unionByName(future_frame(history, horizon).withColumn("y", F.lit(None).cast("double")).withColumn("ahead", F.lit(True)))
    rows, names = _prepared(_with_scale(frame, settings, scales), holidays)
    rows = materialize(rows, "series-rows")
    fitted = fit_series(rows, settings, names)
    out = _banded(rows.filter("ahead"), fitted, settings, names, seed)
    if not include_history:
        return out
    design, half = Design(settings, names), float(NormalDist().inv_cdf((1 + settings.level) / 2))
    near = predicted(rows.filter("NOT ahead"), fitted, settings, names, ["series_id", "ds", "top"])
    value = lambda v: F.greatest(F.lit(settings.cap_factor) * F.col("top") / (1 + F.exp(-v)) if design.s.logistic else v * F.col("top"), F.lit(0.0))
    return out.unionByName(near.select("series_id", "ds", "yhat", value(F.col("fit") - half * F.col("spread")).alias("yhat_lower"), value(F.col("fit") + half * F.col("spread")).alias("yhat_upper")))


def predict_test(labelled: DataFrame, settings: Settings = Settings(), seed: int = 42) -> DataFrame:
    """Fit on split='train', predict the dates of split='test'."""
    rows = labelled.select("series_id", "ds", "split", F.when(F.col("split") != "test", F.col("y")).alias("y"))
    rows, names = _prepared(_with_scale(rows, settings, None), None)
    rows = materialize(rows, "series-rows")
    return _banded(rows.filter("split = 'test'"), fit_series(rows, settings, names), settings, names, seed)


def tune(labelled: DataFrame, scales=SCALES, settings: Settings = Settings()) -> DataFrame:
    """Test error of every candidate for every series; the sums of all fits are made in the same passes."""
    rows = labelled.select("series_id", "ds", "split", F.col("y").alias("actual"), F.when(F.col("split") != "test", F.col("y")).alias("y"))
    rows, names = _prepared(rows, None)
    rows = materialize(rows.withColumn("scale", F.explode(F.array(*[F.lit(float(x)) for x in scales]))), "series-rows")
    out = predicted(rows.filter("split = 'test'"), fit_series(rows, settings, names), settings, names, ["series_id", "scale", "actual"])
    error = F.avg(F.abs(F.col("actual") - F.col("yhat")))
    return out.groupBy("series_id", "scale").agg(error.alias("mae"), (error / F.avg("actual") * 100).alias("mae_pct"))


def best_setting(tuned: DataFrame) -> DataFrame:
    """Lowest error per series, the smallest candidate on ties."""
    w = W.partitionBy("series_id").orderBy("mae", "scale")
    return tuned.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")
