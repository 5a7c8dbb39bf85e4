"""Neighbours, URL verdicts, quality, line alignment and the pipeline."""

import itertools
import math
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import line_dedup as D, multiprobe as M, quality_crf as C, queries as Q, url_filter as R


def nearest_by_hand(rows, n=20):
    good = {i: v for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    ids, x = np.array(list(good)), np.array(list(good.values()), float)
    out = {}
    for q in ids[ids % 20 == 0]:
        s = x @ np.array(good[q], float)
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:n]
        out[int(q)] = [(int(ids[k]), float(s[k])) for k in order]
    return out


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_neighbours_query(spark, sf):
    want = nearest_by_hand([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    got = as_lists(Q.QUERIES["op3_nearest_neighbours"](spark, sf).collect())
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want) and recall(got, want) >= 0.9
    exact = {q: dict(w) for q, w in want.items()}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q, g in got.items() for i, s in g if i in exact[q])


def test_neighbours_with_a_frequent_vector_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.5, -0.25] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)]
    rows += [(600, None), (620, [0.0, 0.0, 0.0]), (640, [1.0, float("nan"), 0.0]), (660, [1.0, None, 0.0]), (None, [1.0, 1.0, 1.0]), (680, [1.0, 2.0]), (700, [float("inf"), 0.0, 0.0]), (40, rows[40][1])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<double>, bucket int")
    got, want = as_lists(M.nearest(df).collect()), nearest_by_hand([r for r in rows if r[1] is None or len(r[1]) == 3])
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert M.nearest(df.limit(0)).collect() == []
    assert [r.vec_id for r in M.nearest(spark.createDataFrame([(20, [1.0]), (21, [2.0])], "vec_id long, embedding array<float>")).collect()] == [21]
    assert M.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def test_neighbours_of_clusters_over_many_buckets(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(80, 16)) * 3
    rows = [(i, (centres[i % 80] + rng.normal(size=16) * 0.3).tolist()) for i in range(9000)]
    got = as_lists(M.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)).collect())
    assert all(len({i for i, _ in g}) == len(g) == 20 for g in got.values())
    assert recall(got, nearest_by_hand(rows)) >= 0.9


URLS = ["http://a.com/x", "https://EXAMPLE.com/en/1?x=1", "https://www.Example.com/en/2", "http://x.net/es/1", "http://x.net/en/1", "http://net/fr/", "ftp://notexample.com/en/", "http://a.com", "http://a.com?x=/en/", "no scheme.com/x", None, "", "http://u:p@h.org:80/p/q.html#f?", "http://example.com/enx", "http://a.b.net/fr/1/2/3?a=1&b=2#c"]


def judged_by_hand(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate(str.maketrans(R.UPPER, R.LOWER)), rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in R.judge(df, Q.URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path, rule = judged_by_hand(u, Q.URL_RULES)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict in ("allow", "block") and (rule is None or got[i].verdict == Q.URL_RULES[rule])
    assert R.judge(df.limit(0), Q.URL_RULES).collect() == []
    assert {r.verdict for r in R.judge(df, {"com/": "block"}).collect()} == {"block"} and {r.verdict for r in R.judge(df, {}).collect()} == {"allow"}


def test_url_query_and_learnt_verdicts(spark, sf):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    got = {r.page_id: r for r in Q.QUERIES["op4_url_filters"](spark, sf).collect()}
    assert set(got) == set(pages)
    assert all((got[i].host, got[i].path, got[i].rule) == judged_by_hand(u, Q.URL_RULES) for i, u in pages.items())
    rng = random.Random(3)
    made = [(i, f"https://site{i % 9}.example/{'x' * rng.randrange(3, 9)}", 0) if i % 2 else (i, f"http://site{i % 9}.example/?{'&'.join(f'k{j}={rng.randrange(10 ** 6)}' for j in range(rng.randrange(3, 6)))}", 1) for i in range(400)]
    df = spark.createDataFrame(made, "id long, url string, label int")
    out = R.judge(df.filter("id >= 200").withColumnRenamed("id", "page_id"), {}, labelled=df.filter("id < 200")).collect()
    assert sum((r.verdict == "block") == (made[r.page_id][2] == 1) for r in out) >= 195


def test_url_plan_has_no_python(spark, sf):
    text = Q.QUERIES["op4_url_filters"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "MapInArrow" not in text


def chain_by_hand(evidence, ties):
    """P(good) of each line by trying all label chains."""
    total, good = 0.0, np.zeros(len(evidence))
    for labels in itertools.product((0, 1), repeat=len(evidence)):
        w = math.exp(sum(e for e, y in zip(evidence, labels) if y) + sum(ties[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        good += w * np.array(labels)
    return good / total, math.log(total)


def test_forward_backward_same_as_all_chains():
    rng = np.random.default_rng(5)
    lines = np.array([0, 1, 7, 9, 14])
    evidence, ties = rng.normal(size=14) * 2, rng.normal(size=(2, 2))
    prob, partition, pairs = C.forward_backward(evidence, lines, ties)
    for c, (a, b) in enumerate(zip(lines[:-1], lines[1:])):
        p, z = chain_by_hand(evidence[a:b], ties)
        assert prob[a:b] == pytest.approx(p) and partition[c] == pytest.approx(z)
    assert pairs.sum() == pytest.approx(14 - 4)


def test_quality_query_on_held_out_rows(spark, sf):
    from zlib import crc32

    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = Q.QUERIES["op5_quality_classifier"](spark, sf).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and known.get(r.doc_id) is not None]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.85 * len(held)


def test_quality_edge_cases(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(11)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = C.train(edge_docs, labels)
    rows = C.quality_scores(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = C.quality_scores(edge_docs, model, keep_rows=True)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert C.quality_scores(empty_docs, model).collect() == []
    assert {r.score for r in C.quality_scores(edge_docs, C.train(edge_docs, labels.limit(0))).collect()} == {0.5}


def test_alignment():
    a, b = list("abcdefg"), list("xbcdyfgz")
    assert D.align(a, b) == [(1, 1), (2, 2), (3, 3), (5, 5), (6, 6)]
    assert D.align(list("aab"), list("aab")) == [(0, 0), (1, 1), (2, 2)] and D.align([], [1]) == []
    rng = random.Random(7)
    for _ in range(200):
        x, y = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        found = D.align(x, y)
        assert all(x[i] == y[j] for i, j in found) and all(p < q and r < s for (p, r), (q, s) in zip(found, found[1:]))
    assert D.common_blocks(list("abcd"), list("xabyd"), [9, 9, 9, 9, 9], 18) == [1, 2]


def long(i):
    return " ".join(f"word{i}x{j}" for j in range(25))


def test_shared_passages_leave_the_later_document(spark, edge_docs, empty_docs):
    common = long(999)
    rows = [(i, "\n".join([long(i), common, f"short line {i}", "all rights reserved for us"])) for i in range(60)] + [(100, long(3) + "\n" + long(500)), (101, long(501))]
    got = {r.doc_id: r for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got[0].text == rows[0][1] and got[101].removed_lines == 0
    assert all(common not in got[i].text and long(i) in got[i].text and got[i].n_lines == 4 for i in range(1, 60))
    assert got[100].text == long(500) and got[100].removed_lines == 1
    out = D.dedup_lines(edge_docs).collect()
    assert len(out) == edge_docs.count() and all(r.removed_lines == 0 for r in out)
    assert D.dedup_lines(empty_docs).collect() == []


def test_every_shared_block_leaves_the_last_document(spark):
    """Passages whose lines occurred first in other documents, lines of few words, moved lines, other blank lines."""
    some = lambda i, n: " ".join(f"s{i}x{j}" for j in range(n))
    short = "\n".join(some(f"q{i}", 3) for i in range(8))
    p, q = some("p", 20), "\n".join([some("r", 15), some("t", 15), "end"])
    rows = [(1, some(1, 8)), (2, some(2, 12)), (3, f"{some(1, 8)}\n{some(2, 12)}\nthree"), (4, f"x\n{some(1, 8)}\n{some(2, 12)}\nfour"), (5, f"{short}\nfive"), (6, f"six\n{short}"),
            (7, f"{q}\n{p}"), (8, p), (9, f"{p}\nnine\n\n{q}"), (10, f"ten\n{some('r', 15)}\n\n{some('t', 15)}\nend")]
    got = {r.doc_id: r.text for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == {**{i: t for i, t in rows if i in (1, 2, 3, 5, 7)}, 4: "x\nfour", 6: "six", 8: "", 9: "nine\n", 10: "ten"}


def test_texts_of_one_id_lose_their_own_lines_only(spark):
    """Rows that repeat an id are texts of their own: what one shares is not cut out of another, whatever their numbers of lines."""
    p, own = long(1), lambda i, n: [f"mine {i} {j}" for j in range(n)]
    for n in (1, 2, 3, 9):
        rows = [(1, p), (2, "\n".join([p, *own(1, 2)])), (2, "\n".join(own(2, n))), (2, "\n".join([*own(3, n), p])), (3, "\n".join([long(5), p])), (3, long(5))]
        got = sorted((r.doc_id, r.text) for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
        assert got == sorted([(1, p), (2, "\n".join(own(1, 2))), (2, "\n".join(own(2, n))), (2, "\n".join(own(3, n))), (3, long(5)), (3, long(5))])


def test_passages_that_occur_twice_are_aligned(spark):
    assert D.align(list("PxPy"), list("zPw")) == [(0, 1)] and D.align(list("uPv"), list("zPqPw")) == [(1, 1)]
    assert D.align(list("uabcvabcw"), list("zabcq")) == [(1, 1), (2, 2), (3, 3)]
    p, some = long(7), lambda i: f"other {i}"
    rows = [(1, "\n".join([some(1), p, some(2), p, some(3)])), (2, f"{some(4)}\n{p}\n{some(5)}"), (3, f"{some(6)}\n{p}\n{some(7)}\n{p}\n{some(8)}")]
    got = {r.doc_id: r.text for r in D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: f"{some(4)}\n{some(5)}", 3: f"{some(6)}\n{some(7)}\n{some(8)}"}


def test_line_query_leaves_no_long_repeat(spark, sf, texts):
    got = {r.doc_id: r for r in Q.QUERIES["op10_line_dedup"](spark, sf).collect()}
    assert set(got) == set(texts) and all(got[i].n_lines == (t or "").count("\n") + 1 for i, t in texts.items())
    seen = set()
    for i in sorted(got):
        lines = {line for line in got[i].text.split("\n") if len(line.split()) >= D.BLOCK_WORDS}
        assert not lines & seen
        seen |= lines
    assert any(r.removed_lines for r in got.values())


def test_pipeline_stages(spark, sf, documents, texts):
    from test_near_and_exact import groups_by_hand
    from test_tokens import BYTE, packed_right
    from tokenizers import Tokenizer

    docs = documents
    kept = [set(texts)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.keep(stage(spark, docs, sf), name)
        assert docs.columns == documents.columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    scores = {r.doc_id: r.predicted for r in Q.QUERIES["op5_quality_classifier"](spark, sf).collect()}
    assert kept[1] == {i for i in texts if scores[i]}
    last = {texts[i]: i for i in sorted(kept[1])}
    assert kept[2] == set(last.values())
    groups = groups_by_hand([(i, texts[i]) for i in sorted(kept[2])], 5, 8, 10)
    assert kept[3] == {i for i, (_, c) in groups.items() if c == i} and len(kept[3]) < len(kept[2]) < len(kept[1]) < len(kept[0])
    t = Tokenizer.from_file(BYTE)
    rows = corpus_pipeline.run(spark, sf).collect()
    assert packed_right(rows, {i: texts[i] for i in kept[3]}, lambda x: t.encode(x or "", add_special_tokens=False).ids) < 4096


def test_scattered_queries_go_on_until_they_have_their_neighbours(spark):
    """Clusters settle the fit with few cells; rows far from all of them need more, and get all twenty."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 16)) * 3
    rows = [(i, (centres[i % 60] + rng.normal(size=16) * 0.2).tolist()) for i in range(6000)]
    rows += [(20_000 + 10 * i, (rng.normal(size=16) * 3).tolist()) for i in range(100)]
    got = as_lists(M.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)).collect())
    want = nearest_by_hand(rows)
    far = {q: w for q, w in want.items() if q >= 20_000}
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values()) and len(far) == 50
    assert recall({q: got[q] for q in far}, far) >= 0.9 and recall(got, want) >= 0.9


def test_many_functions_move_few_at_a_time():
    moves = M._moves(12, 1)
    assert len(np.unique(moves, axis=0)) == len(moves) == sum(__import__("math").comb(12, j) * 2 ** j for j in range(5)) and not moves[0].any()
    tables = M.Tables(8, 12, 3.0)
    at = tables.place(tables.query(np.random.default_rng(0).normal(size=(5, 8))), 0)
    chance = np.exp(tables.chances(at, np.full(5, 1.0)))
    assert (chance.sum(axis=1) <= 1 + 1e-9).all() and (np.diff(np.take_along_axis(chance, tables.order(at, 1.0), 1), axis=1) <= 1e-15).all()
