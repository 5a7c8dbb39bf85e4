"""Synthetic oversampling of the rare class, reproducible under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.semantics import count_true, hash_number
from ..session import SPREAD_FROM, materialize, parts_of
from .nearest import k_neighbours
from .ordered import dense_index


def neighbours(minority: DataFrame, id_col: str, columns: list[str], k: int) -> DataFrame:
    return k_neighbours(minority.select(id_col, F.array(*columns).alias("_vec")), k, id_col, "_vec")


STEP = 1_000  # synthetic rows made of a rare row at a time


def sizes_after(train: DataFrame, label: str = "label", target_ratio: float = 1.0) -> tuple[int, int, int]:
    """(rare rows, synthetic rows to be made, rows of both classes with them)."""
    sizes = train.agg(count_true(F.col(label) == 1).alias("p"), count_true(F.col(label) == 0).alias("n")).first()
    new = max(int(target_ratio * sizes["n"]) - sizes["p"], 0) if sizes["p"] > 1 else 0
    return sizes["p"], new, sizes["p"] + sizes["n"] + new


def oversample(train: DataFrame, id_col: str, columns: list[str], label: str = "label", target_ratio: float = 1.0, k: int = 5, seed: int = 42) -> DataFrame:
    """Original rows plus interpolated minority rows until minority = ratio x majority.

    Synthetic row s starts from minority row s mod n; its neighbour and position come from an integer
    hash of s, so a lost task or another partitioning recreates the same rows. Many synthetic rows are made
    where their rare row lies beside its neighbours, and none of them is moved; few keep the layout that joins give them.
    """
    n_min, n_new, _rows = sizes_after(train, label, target_ratio)
    base = train.withColumn("synthetic", F.lit(False))
    if n_min < 2 or n_new == 0:
        return base.select(id_col, *columns, label, "synthetic")
    k = min(k, n_min - 1)
    # the rare rows are read several times below; writing them once keeps the lineage of ``train`` out of it
    minority = materialize(train.filter(F.col(label) == 1).select(id_col, *columns), "minority")
    indexed = dense_index(minority, id_col, name="_idx")
    near = neighbours(minority, id_col, columns, k)
    other = minority.select(F.col(id_col).alias("neighbour"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    drawn = lambda s: ((hash_number(s, seed, "neighbour") % k + 1).cast("int").alias("rank"), (hash_number(s, seed, "position") / float(16 ** 13)).alias("_u"))
    if n_new < SPREAD_FROM:
        s = train.sparkSession.range(n_new).select(F.col("id").alias("_s"), (F.col("id") % n_min).alias("_idx"), *drawn("id"))
        made = s.join(indexed, "_idx").join(near.select(id_col, "neighbour", "rank"), [id_col, "rank"]).join(other, "neighbour")
    else:
        around = near.select(id_col, "neighbour", "rank").join(other, "neighbour").groupBy(id_col).agg(F.collect_list(F.struct("rank", *[f"_b_{c}" for c in columns])).alias("_near"))
        turns = F.sequence(F.lit(0), F.lit((n_new - 1) // n_min // STEP))
        rare = indexed.join(around, id_col).withColumn("_turn", F.explode(turns)).repartition(parts_of(train.sparkSession, n_new), "_idx", "_turn")
        first = F.col("_idx") + F.col("_turn") * F.lit(STEP * n_min)
        last = F.least(first + F.lit((STEP - 1) * n_min), F.lit(n_new - 1))
        s = rare.filter(first <= last).withColumn("_s", F.explode(F.sequence(first, last, F.lit(n_min).cast("bigint")))).select("*", *drawn("_s"))
        made = s.withColumn("_o", F.explode(F.filter("_near", lambda x: x["rank"] == F.col("rank")))).select("_s", "_u", *columns, *[F.col(f"_o._b_{c}").alias(f"_b_{c}") for c in columns])
    new_rows = made.select((-F.col("_s") - 1).alias(id_col), *[(F.col(c) + F.col("_u") * (F.col(f"_b_{c}") - F.col(c))).alias(c) for c in columns],
                           F.lit(1).alias(label), F.lit(True).alias("synthetic"))
    return base.select(id_col, *columns, label, "synthetic").unionByName(new_rows)


def oversample_checks(before: DataFrame, after: DataFrame, columns: list[str], label: str = "label") -> DataFrame:
    """Grew, minority share up, no nulls, same columns, both classes."""
    from .quality import check_table

    prof = lambda df: df.agg(F.struct(F.count("*").alias("n"), F.avg(label).alias("share")).alias("x")).scalar()
    bad = lambda ok: F.when(ok, 0).otherwise(1)
    nulls = F.expr(" OR ".join(f"{c} IS NULL" for c in columns))
    one = after.agg(F.count("*").alias("n"), F.avg(label).alias("share"), count_true(nulls).alias("nulls"), F.count_distinct(label).alias("classes")).withColumn("b", prof(before))
    same = [c for c in columns if c in after.columns] == columns
    return check_table(one, [
        ("size_grew", bad(F.col("n") > F.col("b.n")), F.lit("rows must be added")), ("minority_share_up", bad(F.col("share") > F.col("b.share")), F.lit("share must rise")),
        ("no_nulls", F.col("nulls"), F.lit("rows with a null feature")), ("same_columns", F.lit(0 if same else 1), F.lit("feature columns kept")),
        ("both_classes", bad(F.col("classes") == 2), F.lit("two classes needed"))])


def leakage_checks(train: DataFrame, test: DataFrame, original_test: DataFrame, columns: list[str], id_col: str, label: str = "label") -> DataFrame:
    """Test rows unchanged, labels unchanged, same columns, no shared rows."""
    from .quality import check_table
    from .splits import row_overlap

    a = test.select(id_col, label).exceptAll(original_test.select(id_col, label)).agg(F.count("*").alias("x")).scalar()
    n0 = original_test.agg(F.count("*").alias("x")).scalar()
    one = test.agg(F.count("*").alias("n")).select(F.abs(F.col("n") - n0).alias("size"), a.alias("labels"), row_overlap(train, test, columns).scalar().alias("overlap"))
    parity = [c for c in columns if c not in train.columns or c not in test.columns]
    return check_table(one, [("test_size", F.col("size"), F.lit("row count change")), ("test_labels", F.col("labels"), F.lit("changed labels")),
                             ("column_parity", F.lit(len(parity)), F.lit("columns on one side only")), ("row_overlap", F.col("overlap"), F.lit("rows on both sides"))])
