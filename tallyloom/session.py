"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split hot join keys even where that costs one more exchange
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in {**defaults, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir, or below the warehouse where that is unset: both are shared by all executors.

    It is made once and removed by its file system when the application ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tallyloom-{app}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[app] = files.makeQualified(path).toString()
    return _FOLDERS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: short lineage, survives executor loss."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


SPREAD_FROM = 100_000  # rows; fewer stay as they lie


def spread(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """A written table, written again in parts of nearly equal size for all cores, for steps with much work a row: joins leave small tables in a few files of unlike sizes, and the largest is waited for.

    The number of parts is that of the cores until a part holds 500,000 rows, since learners send sums of each part.
    """
    n = df.count()
    if n < SPREAD_FROM:
        return df
    return materialize(df.repartition(parts_of(df.sparkSession, n), *keys), name)


def materialize_spread(df: DataFrame, rows: int, name: str, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows, written once, in the parts of ``spread``; small tables keep their layout."""
    if rows < SPREAD_FROM:
        return materialize(df, name)
    return materialize(df.repartition(parts_of(df.sparkSession, rows), *keys), name)


def parts_of(spark: SparkSession, rows: int) -> int:
    """Parts for all cores, of at most 500,000 rows, whatever the number of rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // (5 * SPREAD_FROM)))
