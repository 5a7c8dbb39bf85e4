"""Near and exact duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import exact_dedup as E, jaccard as J, queries as Q
from tallyloom.llm.hashing import U
from tallyloom.llm.tables import components, likely_among, thinned
from pyspark.sql import functions as F


def words_of(text):
    import re

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(low))


def shingles(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def groups_by_hand(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_size = sorted((s for s in sets if s[1]), key=lambda s: len(s[1]))
    for a in range(len(by_size)):
        for b in range(a + 1, len(by_size)):
            (i, x), (j, y) = by_size[a], by_size[b]
            if len(y) * num > len(x) * den:
                break
            both = len(x & y)
            if both * den >= num * (len(x) + len(y) - both):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: (len(s), find(i)) for i, s in sets}


def test_query_same_as_brute_force(spark, sf, texts):
    want = groups_by_hand(texts.items(), 3, 90, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.QUERIES["op1_ngram_jaccard_join"](spark, sf).collect()}
    assert got == want and any(i != c for i, (_, c) in got.items())


@pytest.mark.parametrize("blocks", [None, 64])
def test_skewed_near_copies(spark, blocks):
    """A third of all rows are copies or near copies of one text; near misses beside them."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(240):
        if i % 3:
            text = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 150))]
        else:
            text = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 4, 8))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=3, similarity=(9, 10), blocks=blocks).collect()}
    assert got == groups_by_hand(rows, 3, 9, 10)


def test_small_near_copies_with_a_number_of_blocks(spark):
    """A word more at either end, or another end word, at every size from 4 to 60 shingles."""
    rows = []
    for n in range(4, 61):
        for change in range(4):
            text = [f"n{n}c{change}w{i}" for i in range(n + 4)]
            other = (text + ["new"], ["new"] + text, text[:-1] + ["new"], ["new"] + text[1:])[change]
            rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(other))]
    want = groups_by_hand(rows, 5, 8, 10)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=5, similarity=(8, 10), blocks=64).collect()}
    assert got == want and sum(i != c for i, (_, c) in want.items()) > 200


def test_larger_near_copies_with_a_number_of_blocks():
    """Pairs at the similarity itself, at the upper ends of bands, where blocks are fullest."""
    rng = np.random.default_rng(6)
    for n in (63, 93, 140, 210, 315):
        sets = []
        for _ in range(300):
            x = rng.integers(0, 2 ** 64, n + n // 9, dtype=U)
            sets += [np.sort(x[:n]), np.sort(x[n // 9:])]
        keys, at = J.block_keys(np.concatenate(sets), J.ends(np.array([len(s) for s in sets])), 8, 10, 64)
        parts = [set(keys[i:j].tolist()) for i, j in zip(at[:-1], at[1:])]
        assert sum(not x & y for x, y in zip(parts[::2], parts[1::2])) <= 1


def test_sketch_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 400):
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(U))
        b = np.unique(np.concatenate([a[n // 4:], rng.integers(0, 2 ** 63, n // 3 + 1).astype(U)]))
        apart = len(np.setxor1d(a, b))
        for blocks in (1, 3, 16):
            x, y = (J.parity(v, np.array([0, len(v)]), np.array([blocks]))[0] for v in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= apart


def test_linked_sets_share_a_block_key():
    rng = np.random.default_rng(4)
    for n in (3, 12, 30, 200, 1500):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2 ** 64, n, dtype=U))
            d = int(J.most_apart(2 * len(a), 9, 10))
            b = np.unique(np.concatenate([a[d // 2:], rng.integers(0, 2 ** 64, max(d - d // 2 - 1, 0), dtype=U)]))
            both = len(np.intersect1d(a, b))
            if both * 10 < 9 * (len(a) + len(b) - both):
                continue
            keys, at = J.block_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 9, 10, None)
            assert set(keys[:at[1]].tolist()) & set(keys[at[1]:].tolist())


def test_near_groups_edge_cases(edge_docs, empty_docs):
    rows = J.near_groups(edge_docs, k=3, similarity=(9, 10)).collect()
    assert len(rows) == edge_docs.count()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [got[i].n_shingles for i in (0, 1, 2, 3)] == [0, 0, 0, 1] and got[0].component_id == 0 and got[1].component_id == 1
    assert {got[i].component_id for i in (4, 5, 6)} == {4}
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert J.near_groups(empty_docs).collect() == []


def test_exact_groups_edge_cases(edge_docs, empty_docs):
    rows = E.exact_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert got[0].keep_id == 1 and got[0].group_size == 3 and not got[0].kept and got[1].kept
    assert got[4].keep_id == 6 and got[6].group_size == 4 and got[5].kept
    assert got[3].text_sha256 == hashlib.sha256(b"a").hexdigest()
    assert E.exact_groups(empty_docs).collect() == []


def test_exact_groups_skew(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    rows = E.exact_groups(docs).collect()
    hot = [r for r in rows if r.group_size > 1]
    assert len(rows) == 600 and len(hot) == 200 and {r.keep_id for r in hot} == {597} and sum(r.kept for r in hot) == 1


def test_filters_of_all_tasks_merge_without_loss(spark):
    prints = spark.range(3000).select((F.col("id") % 1000 * 7919 - 4_000_000).alias("fingerprint")).union(spark.range(500).select((-F.col("id") - 10 ** 15).alias("fingerprint")))
    got = {r.fingerprint: r.copies for r in E.repeated_fingerprints(prints.repartition(7), slots=13).collect()}
    assert got == {i * 7919 - 4_000_000: 3 for i in range(1000)}


def test_components_and_helpers(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    dense = spark.range(30).alias("x").join(spark.range(30).alias("y"), F.col("x.id") < F.col("y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    assert thinned(dense).count() < 60
    ids = spark.createDataFrame([(3,), (7,), (None,)], "i long")
    inside, outside = likely_among(spark.range(1000).union(spark.createDataFrame([(None,)], "id long")), "id", ids)
    kept = {r.id for r in inside.collect()}
    assert {3, 7} <= kept and len(kept) < 10 and outside.count() == 1001 - inside.count()


def test_large_families_are_cut_into_bands_and_chunks(spark, monkeypatch):
    """Tiles of a few documents: every pair of sets that can be linked still meets."""
    monkeypatch.setattr(J, "TILE_ROWS", 4)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[: rng.randrange(150, 400)])) for i in range(120)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=3, similarity=(9, 10)).collect()}
    assert got == groups_by_hand(rows, 3, 9, 10)
    members = spark.createDataFrame([(i, 100 + i, 1) for i in range(60)] + [(100, 5, 2), (101, 5, 2), (102, 9, 3)], "id long, n long, family long")
    seen = {}
    for r in J._tiles(members, 9, 10).collect():
        seen.setdefault((r.family, r.tile), set()).add(r.id)
    for i in range(60):
        for j in range(i + 1, 60):
            if (100 + i) * 10 >= (100 + j) * 9:
                assert any({i, j} <= ids for ids in seen.values())
    assert seen[2, "0-0-0-0"] == {100, 101} and not any(f == 3 for f, _ in seen)


def test_keys_are_moved_once_and_for_one_of_equal_sets(spark, monkeypatch):
    plans, keep = {}, J.keep
    monkeypatch.setattr(J, "keep", lambda df, name: (plans.__setitem__(name, df), keep(df, name))[1])
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(4)]
    rows = [(i, words[i % 3]) for i in range(30)] + [(50, words[0] + " more"), (60, words[3])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=3, similarity=(9, 10)).collect()}
    assert got == groups_by_hand(rows, 3, 9, 10)
    assert {r.id for r in plans["blocked"].select("id").distinct().collect()} == {0, 50}
    plan = plans["blocked"]._jdf.queryExecution().optimizedPlan().toString()
    before_rows_of_keys = plan[plan.index("Generate explode(keys"):]
    assert "LeftSemi" in before_rows_of_keys and plan.count("RepartitionByExpression [key") == 2  # the same exchange, for both sides of the join


def test_a_family_of_a_thousand_is_sent_once(spark):
    members = spark.createDataFrame([(i, 100, 1) for i in range(1000)], "id long, n long, family long")
    assert J._tiles(members, 9, 10).count() == 1000


@pytest.mark.parametrize("num", [4, 6, 9])
def test_subsets_of_the_largest_allowed_ratio_are_linked(spark, num):
    """A set and a part of it whose similarity is just enough: the sizes lie several bands apart at low similarities."""
    rows = []
    for i, n in enumerate([*range(1, 40, 3), 60, 111]):
        words = [f"t{i}w{j}" for j in range(n)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-(-n * num // 10)]))]
    got = {r.doc_id: r.component_id for r in J.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=1, similarity=(num, 10)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_pipeline_keeps_one_of_rows_that_repeat_id_and_text(spark):
    import corpus_pipeline

    rows = [(1, "a", "x"), (2, "a", "x"), (2, "a", "x"), (3, "b", "x"), (3, "c", "x"), (3, "c", "y"), (None, "a", "x"), (None, "d", "x"), (5, None, "x"), (5, "", "x"), (6, "e", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text or "") for r in corpus_pipeline.exact(spark, docs, "").collect()), key=repr)
    assert [g for g in got if g[0] in (1, 2, 3, 6)] == [(2, "a"), (3, "b"), (3, "c"), (6, "e")] and (None, "d") in got
    assert sum(g[0] == 5 for g in got) == 1  # a null text is an empty one


@pytest.mark.parametrize("entries,width", [(1, 64), (2, 64), (5, 60), (4096, 52), (5000, 64), (300, 12), (4096, 12)])
def test_quotient_filter_is_lossless_and_as_small_as_its_bits(entries, width):
    rng = np.random.default_rng(entries)
    pool = rng.integers(0, 1 << 63, entries * 3, dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, entries * 3, dtype=np.uint64)
    numbers = np.unique(pool >> np.uint64(64 - width))[:entries] if (1 << width) > 2 * entries else np.arange(entries, dtype=np.uint64)
    counts = np.where(rng.random(len(numbers)) < 0.1, rng.integers(2, 1 << 40, len(numbers)), 1)
    made = E.QuotientFilter.of(numbers, counts, width)
    back = made.read()
    assert (back[0] == numbers).all() and (back[1] == counts).all()
    if entries >= 4096 and width > 20:
        single = E.QuotientFilter.of(numbers, np.ones(len(numbers), np.int64), width)
        bits = 8 * single.size() / len(numbers)
        assert bits <= width - np.log2(len(numbers)) + 1 + 2 + 2.1  # remainder, run end and repeat mark, up to two quotient marks


def test_merged_filters_add_up_whatever_their_sizes():
    rng = np.random.default_rng(3)
    parts = [np.unique(rng.integers(0, 5000, n).astype(np.uint64)) for n in (1, 10, 900, 4000)]
    filters = [E.QuotientFilter.of(p, rng.integers(1, 5, len(p)), 40) for p in parts]
    want = {}
    for f in filters:
        for v, n in zip(*(x.tolist() for x in f.read())):
            want[v] = want.get(v, 0) + n
    numbers, counts = E.merged(filters)
    assert dict(zip(numbers.tolist(), counts.tolist())) == want and (np.diff(numbers.astype(np.int64)) > 0).all()
