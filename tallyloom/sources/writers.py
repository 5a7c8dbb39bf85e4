"""Sinks: CSV, Parquet, JSON and one text file per report. All write from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .report_sink import write_reports


def csv(df: DataFrame, path: str, columns: list[str] | None = None, rename: dict[str, str] | None = None, digits: int | None = None,
        encoding: str = "UTF-8", mode: str = "errorifexists") -> None:
    """Column subset, optional renames and rounding; dates as yyyy-MM-dd."""
    out = df.select(*columns) if columns else df
    for name, kind in out.dtypes:
        if digits is not None and kind in ("double", "float"):
            out = out.withColumn(name, F.round(name, digits))
    out = out.withColumnsRenamed(rename or {})
    out.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("encoding", encoding).csv(path)


def split_parquet(df: DataFrame, path: str, by: str = "split", mode: str = "errorifexists") -> None:
    """Both parts of a split in one table, one folder per part, so that a filter on it prunes files."""
    df.write.mode(mode).partitionBy(by).parquet(path)


def json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def text_reports(lines: DataFrame, path: str, report: str = "report") -> None:
    """One text file for each report, lines in section and line order, streamed from the tasks."""
    write_reports(lines, path, report)


def append_results(df: DataFrame, path: str) -> None:
    """Append newly answered questions to the result table."""
    df.write.mode("append").parquet(path)
