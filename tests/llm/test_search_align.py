"""Alignment, lexical search and vector search against brute force, on rows
with nulls, empty and long texts, ties, repeated rows, extra columns, and on
empty tables."""

import functools
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plumbline.llm import lexical_search, token_align, vector_search
from plumbline.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 97} thé of\n日本 x{i}" for i in range(900))
TEXTS = [
    "a  b\tc", None, "", " \n ", LONG, "a b c", "a b c", "日本語 café 😀   don't", "<s>hi</s> <|endoftext|> <0x0A>", "a▁b c", "▁",
    "x" * 3000, " lead", "trail ", "nul \x00 \r\n end", "é́     z\u0085 y", LONG + " a▁b", "y " * 900 + "z" * 700 + " y" * 900,
]
DDL = "doc_id bigint, text string, pairs string, doc int, score string"


# ---- op11 ---------------------------------------------------------------


@functools.cache
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(text):
    """(id, bytes) of both for a whole text, or nothing."""
    a, b = tokenizers()
    table = token_align.byte_of()
    of_a = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
    of_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    data = f" {text}".encode()
    return (of_a, of_b) if text and all(b"".join(t for _, t in of) == data for of in (of_a, of_b)) else ([], [])


def brute_align(texts):
    rows, corpus = [], Counter()
    for text in texts:
        of_a, of_b = tokens(text or "")
        ends = [np.cumsum([len(t) for _, t in of]).tolist() for of in (of_a, of_b)]
        common = sorted(set(ends[0]) & set(ends[1]))
        where = [{e: i for i, e in enumerate(es)} for es in ends]
        groups, links, start = [], [], (0, 0)
        for end in common:
            stop = (where[0][end] + 1, where[1][end] + 1)
            groups.append("|".join(",".join(str(i) for i, _ in of[x:y]) for of, x, y in zip((of_a, of_b), start, stop)))
            links.append((of_a[stop[0] - 1][0], of_b[stop[1] - 1][0]))
            start = stop
        groups = ";".join(groups)
        corpus.update(links)
        rows.append((len(of_a), len(of_b), groups, links))
    best = Counter()
    for (_, j), n in corpus.items():
        best[j] = max(best[j], n)
    return [
        (n_a, n_b, len(groups.split(";")) if groups else 0, groups, len(links), sum(corpus[p] == best[p[1]] for p in links), sum(corpus[p] for p in links))
        for n_a, n_b, groups, links in rows
    ]


@pytest.mark.parametrize("size", [1 << 16, 900, 64])
def test_alignment_is_that_of_whole_texts(spark, size):
    rows = [(i if i % 5 else None, t, "x", i, None) for i, t in enumerate(TEXTS)]
    got = token_align.align(spark.createDataFrame(rows, DDL), A, B, size).drop("groups_sha256").collect()
    want = [(r[0], *w) for r, w in zip(rows, brute_align(TEXTS))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_stretches_are_tokenised_some_at_a_time(monkeypatch):
    monkeypatch.setattr(token_align, "LEARNT", 3, raising=False)
    plain, bounded = token_align.Aligner(A, B), token_align.Aligner(A, B)
    sizes = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sizes.append(len(texts))
            return plain.a.encode_batch_fast(texts, **how)

    bounded.a = Counting()
    wanted = {f"w{i}é" for i in range(10)} | {"y" * 70}
    bounded.learn(wanted)
    assert sum(sizes) == 11 and max(sizes) == 3
    monkeypatch.setattr(token_align, "LEARNT", 100, raising=False)
    plain.learn(wanted)
    assert bounded.known == plain.known and set(plain.known) == wanted


def test_many_stretches_are_tokenised_in_runs(monkeypatch):
    odd = {"", " lead", "trail ", "a\n", "\u0085z", "a▁b", "x▁", "ﬁ", "é́", "<s>", "<|endoftext|>", "日本語", "z" * 3000}
    wanted = odd | {f"w{i}é" for i in range(300)}
    one, runs = token_align.Aligner(A, B), token_align.Aligner(A, B)
    monkeypatch.setattr(token_align, "TOGETHER", 1 << 20, raising=False)
    one.learn(wanted)
    monkeypatch.setattr(token_align, "TOGETHER", 16, raising=False)
    sizes, own = [], runs.a

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sizes.append(len(texts))
            return own.encode_batch_fast(texts, **how)

    runs.a = Counting()
    runs.learn(wanted)
    assert sum(sizes) < len(wanted) / 2
    assert runs.known == one.known and set(one.known) == wanted
    # each as if it were a text of its own
    for s in wanted:
        n_a, n_b, _, groups, n_links, *_ = brute_align([s])[0]
        got = one.known[s]
        assert (got is None) if not n_a else (got[0], got[2], got[3], len(got[1]) // 8) == (groups, n_a, n_b, n_links)


def test_alignment_of_no_rows(spark):
    assert token_align.align(spark.createDataFrame([], DDL), A, B).collect() == []


def test_joining_fragments_is_associative():
    own = token_align.aligner_of(A, B)
    parts = [token_align.fragment(own, *r)[0] for r in token_align.ranges(LONG[:2000], 37, own)]
    rng = random.Random(3)
    left = token_align.finished(functools.reduce(token_align.joined, parts, token_align.NOTHING))
    for _ in range(20):
        some = list(parts)
        while len(some) > 1:
            i = rng.randrange(len(some) - 1)
            some[i : i + 2] = [token_align.joined(some[i], some[i + 1])]
        assert token_align.finished(some[0]) == left
    assert len(parts) > 20
    assert left["groups"] == brute_align([LONG[:2000]])[0][3]


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {
        (d["doc_id"], *w[:3], *w[4:], hashlib.sha256(w[3].encode()).hexdigest() if w[0] else "")
        for d, w in zip(docs, brute_align([d["text"] for d in docs]))
    }
    assert {tuple(r) for r in QUERIES["op11_token_align"](spark, SF).collect()} == want


# ---- op12 ---------------------------------------------------------------


def brute_ranks(docs, items, k=10):
    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_all, l_all = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, c, n in held:
            m = 10 + (90 * n * n_all) // l_all
            score = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_ranks_are_those_of_all_scores(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["THE", "of", "Élan", "日本", "x1"]
    docs = [(i, " ".join(rng.choices(words, weights=[1] * 60 + [60, 60, 5, 5, 5], k=rng.choice([3, 20, 90])))) for i in range(400)]
    docs += [(900 + i, "w1 w2, copy") for i in range(30)] + [(7, "w1 w2"), (None, "W1 w2"), (None, None), (950, ""), (951, " .,; "), (952, LONG)]
    items = [(1, "w1 w2"), (2, "the of"), (3, " ".join(words)), (4, None), (5, "absent"), (None, "w1"), (6, "w3"), (6, "w4 w3"), (7, "copy the"), (8, "élan ÉLAN 日本 日本")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, terms string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n int")
    want = brute_ranks(docs, items)
    assert sorted(map(tuple, lexical_search.ranked(frame, asked).collect()), key=str) == want
    # several passes over the documents give the same rows
    assert sorted(map(tuple, lexical_search.ranked(frame, asked, block_terms=20).collect()), key=str) == want


def test_lists_are_not_read_to_their_ends_when_the_best_are_known():
    class Read(np.ndarray):
        places = set()

        def __getitem__(self, key):
            if isinstance(key, slice) and key.start is not None:
                self.places.update(range(key.start, key.stop))
            return super().__getitem__(key)

    n = 1000
    docs = np.concatenate([np.arange(n), np.arange(n)]).view(Read)
    impacts = np.concatenate([np.r_[[10**6] * 3, np.arange(n - 3)[::-1]], np.r_[[10**6] * 3, np.arange(n - 3)[::-1]]])
    Read.places.clear()
    found, score = lexical_search.nra(docs, impacts, [(0, n, 5), (n, 2 * n, 7)], n, 3)
    assert found.tolist() == [0, 1, 2] and score.tolist() == [12 * 10**6] * 3
    assert len(Read.places) < n // 2


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert lexical_search.ranked(docs.limit(0), items).collect() == []
    assert lexical_search.ranked(docs, items.limit(0)).collect() == []


# ---- op13 ---------------------------------------------------------------

VDDL = "vec_id bigint, embedding array<float>, v string, ids int"


def brute_nearest(rows, queries, k):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def least(pairs):
        out = {}
        for i, v in pairs:
            if i is not None and good(v):
                v = tuple(float(np.float32(x)) for x in v)
                out[i] = min(out.get(i, v), v)
        return out

    points, out = least(rows), []
    for q, a in least(queries).items():
        scored = []
        for i, b in points.items():
            if i != q and len(a) == len(b):
                dot = lambda x, y: functools.reduce(lambda s, p: s + p[0] * p[1], zip(x, y), 0.0)
                scored.append((-max(-1.0, min(1.0, dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)))), i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, 8))
    rows = [(i, (middles[i % 12] + rng.normal(size=8) * 0.3).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(1100 + i, [2.0**i * x for x in rows[5][1]]) for i in range(9)]
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [1.0] * 7 + [float("nan")]), (2150, [None] + [1.0] * 7), (None, [1.0] * 8), (2200, [float("inf")] * 8)]
    return rows + [(50, rows[50][1]), (100, rows[7][1]), (3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3002, []), (-50, rows[9][1])]


@pytest.mark.parametrize("leaf", [4, 128])
def test_factor_one_is_exact(spark, monkeypatch, leaf):
    monkeypatch.setattr(vector_search.Tree.__init__, "__defaults__", (leaf,))
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VDDL)
    got = vector_search.nearest(frame, frame.where("vec_id % 50 = 0"))
    asked = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert sorted(map(tuple, got.collect())) == brute_nearest(rows, asked, 5)


def test_a_larger_factor_reads_less_and_finds_most():
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(40, 16))
    points = np.concatenate([m + rng.normal(size=(200, 16)) * 0.25 for m in middles])
    ids = np.full((len(points), 6), vector_search.NOBODY)
    ids[:, 0] = np.arange(len(points))
    queries, query_ids = points[::50], np.arange(len(points))[::50]
    runs = {}
    for factor in (1.0, 1.5, 3.0):
        s = vector_search.Search(points, ids, queries, query_ids, 5, factor)
        s.run()
        runs[factor] = s
    exact = (points / np.linalg.norm(points, axis=1)[:, None]) @ (queries / np.linalg.norm(queries, axis=1)[:, None]).T
    exact[query_ids, np.arange(len(queries))] = -2
    best = np.sort(exact, axis=0)[::-1][:5].T
    share = {f: (s.score >= best - 1e-9).mean() for f, s in runs.items()}
    assert share[1.0] == 1 and share[1.5] >= 0.9
    assert runs[3.0].read < runs[1.5].read < runs[1.0].read < points.shape[0] * len(queries)


def test_vector_search_of_empty_tables_and_of_few(spark):
    frame = spark.createDataFrame([(50, [1.0, 0.0], "x", 1), (51, [1.0, 1.0], "x", 1)], VDDL)
    assert vector_search.nearest(frame.limit(0), frame).collect() == []
    assert vector_search.nearest(frame, frame.limit(0)).collect() == []
    got = vector_search.nearest(frame, frame.where("vec_id = 50"))
    assert [tuple(r)[:3] for r in got.collect()] == [(50, 1, 51)]
    assert vector_search.recall(got, got) == 1
