"""Tokens, packing, prefix counts and language-model scores against the libraries and brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import backoff_lm as B, lexicon as L, packing as K, prefix_counts as C, queries as Q
from tallyloom.llm.vocabulary import byte_bpe, fast_encoder, merge_words

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " \n\n x", "a<|endoftext|> b  <|endoftext|>", " 's don't'll !'s ''s I'm", "x" * 3000, "é  ñ  中文字符　 x\x85y\x1cz", "aaa\r\n\tccc   ", "\x00 \x1f a", " \U0001f600\U0001f600 ９９ Ⅷ ²", "▁▁a▁b ▁", "abab" * 50, " " * 100, "a<s> b </s><unk>"]


@pytest.fixture(scope="module")
def byte_ids():
    t = Tokenizer.from_file(BYTE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_merging_and_fast_encoder_same_as_library(byte_ids):
    model, fast = byte_bpe(BYTE), fast_encoder(BYTE)
    assert all(fast.ids(t).tolist() == byte_ids(t) for t in ODD)
    parts = [b"hello", b" tokenization", b"aaaaaaaaa", "中文".encode(), b"x"]
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    ids, at = merge_words(model.of_byte[np.frombuffer(b"".join(parts), np.uint8)], off, model.table)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [byte_ids(p.decode()) for p in parts]


def long_words(n):
    """Long words without blanks: random, repeating with several periods, of few characters, mixed."""
    rng, low = random.Random(7), "abcdefghijklmnopqrstuvwxyz"
    draw = lambda letters, k: "".join(rng.choices(letters, k=k))
    return [draw(low, n), draw(low + low.upper() + "0123456789+/", n), "a" * n, ("abcdefg" * n)[:n], ("the" * n)[:n], draw("acgt", n), draw("中文字符人大的", n), draw("é中\U0001f600a", n),
            " " * n, draw(low, n) + " " + draw("acgt", 300) + " " * 999 + draw(low, 257)]


@pytest.mark.parametrize("band", [3, 1 << 13])
def test_long_words_have_the_counts_of_the_library_at_every_prefix(band, monkeypatch):
    monkeypatch.setattr(C, "BAND", band)
    sp, counter, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE), C.PrefixCounter(PIECE), random.Random(3)
    texts = long_words(3000) + ["x" * n for n in (254, 255, 256, 257, 383, 384, 385)]
    total, at, off = counter.totals(texts)
    assert total.tolist() == [len(sp.encode(t)) for t in texts]
    for i, t in enumerate(texts):
        counts = counter.prefix_counts(at[off[i]:off[i + 1]])
        assert len(counts) == len(t) + 1
        assert all(counts[p] == len(sp.encode(t[:p])) for p in rng.sample(range(len(t) + 1), 40))


def test_long_words_have_the_ids_of_the_library(byte_ids):
    texts = long_words(20_000)
    ids, off = L.split_ids(texts, byte_bpe(BYTE))
    assert all(ids[a:b].tolist() == byte_ids(t) for a, b, t in zip(off[:-1], off[1:], texts))


def test_a_million_characters_without_blanks(spark, byte_ids):
    """Work grows with the length, so such a row does not hold up a task for minutes."""
    sp, words = sentencepiece.SentencePieceProcessor(model_file=PIECE), long_words(1_000_000)[:3]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in C.token_counts(docs, PIECE).collect()} == {i: len(sp.encode(t)) for i, t in enumerate(words)}
    rows = L.encode(docs, BYTE, L.compile_lexicon(docs, BYTE)).collect()
    assert all(r.ids == byte_ids(words[r.doc_id]) for r in rows) and len(rows) == 3


def test_automaton_is_minimal_and_numbers_its_words():
    words = sorted({w.encode() for w in ("tap taps top tops stop stops zap zaps a tapestry " + " ".join(f"pre{i}fix" for i in range(50))).split()})
    keys, targets, skips, final = L.minimal_automaton(words)
    moves = {}
    for k, t, s in zip(keys.tolist(), targets.tolist(), skips.tolist()):
        moves[k >> 8, k & 255] = t, s

    def number(word):
        state, total = 0, 0
        for b in word:
            if (state, b) not in moves:
                return -1
            state, skip = moves[state, b]
            total += skip
        return total if final[state] else -1

    assert [number(w) for w in words] == list(range(len(words)))
    assert number(b"ta") == number(b"tapsx") == -1
    rights = {}  # no two states accept the same ends
    def ends(state):
        if state not in rights:
            rights[state] = frozenset([""] if final[state] else []) | {chr(b) + e for (s, b), (t, _) in moves.items() if s == state for e in ends(t)}
        return rights[state]
    ends(0)
    assert len(set(rights.values())) == len(final) == len(rights)


def test_round_trip_query_same_as_library(spark, sf, texts, byte_ids):
    got = {r.doc_id: r for r in Q.QUERIES["op7_bpe_round_trip"](spark, sf).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = byte_ids(text)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_encode_and_decode_edge_cases(spark, edge_docs, empty_docs, byte_ids):
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")).repartition(1)
    name = L.compile_lexicon(docs, BYTE, words_kept=5)
    rows = L.encode(docs, BYTE, name, texts_back=True).collect()
    want = collections.Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert collections.Counter((r.doc_id, r.text) for r in rows) == want
    assert all(r.ids == byte_ids(r.text) for r in rows)
    back = L.decode(L.encode(docs, BYTE, name), BYTE).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == want
    assert L.encode(empty_docs, BYTE, L.compile_lexicon(empty_docs, BYTE)).collect() == []


def test_token_counts_query_same_as_library(spark, sf, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in Q.QUERIES["op8_token_counts"](spark, sf).collect()}
    want = {i: (len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in texts.items()}
    assert got == want


def test_counts_at_every_prefix(spark, edge_docs, empty_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    docs = spark.createDataFrame([(i, t[:120]) for i, t in enumerate(ODD)] + [(50, None)], "doc_id long, text string")
    rows = {r.doc_id: r.counts for r in C.prefix_table(docs, PIECE).collect()}
    for i, t in enumerate(ODD):
        t = t[:120]
        assert rows[i] == [len(sp.encode(t[:p])) for p in range(len(t) + 1)], t
    assert rows[50] == [0]
    cut = {r.doc_id: r.c for r in C.prefix_table(docs, PIECE).select("doc_id", C.longest_prefix("counts", 5).alias("c")).collect()}
    short = {r.doc_id: (r.n_tokens, r.over_limit, r.cut_chars) for r in C.token_counts(docs, PIECE, limit=5).collect()}
    assert all(short[i][2] == c for i, c in cut.items()) and short[50] == (0, False, 0)
    assert C.token_counts(edge_docs, PIECE).count() == edge_docs.count() and C.token_counts(empty_docs, PIECE).collect() == []


def packed_right(rows, texts, byte_ids, size=1024):
    """Whether each id of each text lies in one piece and sequences have no holes; the padding."""
    ids = {i: np.array(byte_ids(t) + [0], "<u4") for i, t in texts.items()}
    places, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        places[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, found in [*places.items(), *sequences.items()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
    assert {i: sum(n for _, n in p) for i, p in places.items()} == {i: len(x) for i, x in ids.items()}
    used = [sum(n for _, n in s) for s in sequences.values()]
    assert max(used) <= size
    return sum(size - u for u in used)


def test_packing_query(spark, sf, texts, byte_ids):
    assert packed_right(Q.QUERIES["op2_packing"](spark, sf).collect(), texts, byte_ids) < 1024 * 2


def test_packing_edge_cases(spark, edge_docs, empty_docs, byte_ids):
    docs = edge_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).repartition(5)
    rows = K.pack(docs, BYTE, size=64, windows=2, with_ids=True).collect()
    assert packed_right(rows, {r.doc_id: r.text for r in docs.collect()}, byte_ids, 64) < 64
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert K.pack(empty_docs, BYTE).collect() == []
    assert sum(r.length for r in K.pack(edge_docs, BYTE).collect()) == sum(len(byte_ids(r.text)) + 1 for r in edge_docs.collect())


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u3000", " \n"])
def test_long_runs_of_blanks_have_the_ids_of_the_library(blank, byte_ids):
    from tallyloom.llm.vocabulary import LONG_BLANK, fast_encoder

    encoder, run = fast_encoder(BYTE), blank * 20_000
    for text in (run, run + "word", run + " 's", f"one{run}two{run}", f"a {run}<|endoftext|>{run}7", run + "<|endoftext|>", "x" + blank * LONG_BLANK + "y", "x" + blank * (LONG_BLANK - 1)):
        assert encoder.ids(text).tolist() == byte_ids(text)


def test_packing_survives_three_million_blanks(spark, byte_ids):
    texts = {1: "before", 2: " " * 3_000_000, 3: "\n" * 1_000_000 + "end", 4: "a" + "\t" * 1_000_000, 5: "after"}
    rows = K.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1), BYTE).collect()
    assert packed_right(rows, texts, byte_ids) < 1024


def test_windows_are_placed_best_fit_and_the_fullest_is_emitted():
    out = []
    space = K.Windows(10, 2, out.append)
    piece = lambda n, doc: K.Piece(doc, 0, np.zeros(n, "<u4"), n)
    for doc, n in enumerate((6, 5, 3, 5)):  # 3 goes to the window with 6; 5 fills the one with 5
        space.add(piece(n, doc))
    assert [[p.doc for p in w] for w in out] == [[1, 3]] and [u for u, _ in space.open] == [9]
    space.add(piece(4, 4))
    space.add(piece(8, 5))  # fits nowhere: its head tops up the window with 9
    assert [(p.doc, len(p.ids)) for p in out[-1]] == [(0, 6), (2, 3), (5, 1)] and sorted(u for u, _ in space.open) == [4, 7]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def backoff_by_hand(texts):
    words = [words_of(t) for t in texts]
    grams = lambda w, n: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
    count = [collections.Counter(g for w in words for g in grams(w, n)) for n in (1, 2, 3)]
    total, out = sum(map(len, words)), []
    for w in words:
        own = [collections.Counter(grams(w, n)) for n in (1, 2, 3)]
        left = lambda g: count[len(g) - 1][g] - own[len(g) - 1][g]

        def score(context, word):
            if not context:
                return math.log(max(left((word,)), 1) / max(total - len(w), 1))
            if left((*context, word)) > 0 and left(context) > 0:
                return math.log(left((*context, word)) / left(context))
            return math.log(B.BACKOFF) + score(context[1:], word)

        out.append(sum(score(tuple(w[max(0, i - 2):i]), x) for i, x in enumerate(w)))
    return out


def test_backoff_query_same_as_brute_force(spark, sf, texts):
    want = dict(zip(texts, backoff_by_hand(texts.values())))
    got = {r.doc_id: r for r in Q.QUERIES["op9_backoff_scores"](spark, sf).collect()}
    assert set(got) == set(want)
    for i, s in want.items():
        assert got[i].log_score == pytest.approx(s, rel=1e-9, abs=1e-9) and got[i].n_words == len(words_of(texts[i]))


def test_backoff_edge_cases_and_many_blocks(spark, edge_docs, empty_docs):
    rng = random.Random(2)
    texts = ["the same passage again and again"] * 40 + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.log_score for r in B.backoff_scores(docs, block_bytes=500).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(backoff_by_hand(texts), rel=1e-9, abs=1e-9)
    rows = B.backoff_scores(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r.log_score == 0 and r.mean_log_score is None for r in rows if r.n_words == 0)
    assert B.backoff_scores(empty_docs).collect() == []
