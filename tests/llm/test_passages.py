"""Repeated byte passages against plain Python."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import passages

SPAN = 128


def marks(texts, span):
    seen = collections.Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    return [np.array([seen[t[i:i + span]] > 1 for i in range(max(0, len(t) - span + 1))], bool) for t in texts]


@pytest.mark.parametrize("span", [8, 16, 24, 6, 5, 128])
def test_construction_matches_brute_force(span):
    rng = random.Random(span)
    for trial in range(25):
        letters = "ab" if trial % 2 else "abcdefgh"
        shared = "".join(rng.choices(letters, k=span * 3)).encode()
        texts = []
        for _ in range(rng.randint(0, 12)):
            a, z = sorted(rng.choices(range(len(shared)), k=2))
            texts.append("".join(rng.choices(letters, k=rng.randint(0, 3 * span))).encode() + shared[a:z]
                         + bytes(rng.choices(range(256), k=rng.randint(0, 20))))
        texts += [b"", b"a" * (2 * span + 3), shared, shared][:rng.randint(0, 4)]
        for got, want in zip(passages.repeated_windows(texts, span), marks(texts, span), strict=True):
            assert got.tolist() == want.tolist()


def expected(rows, span):
    texts = [(r[1] or "").encode() for r in rows]
    out = []
    for r, t, m in zip(rows, texts, marks(texts, span)):
        gone = np.zeros(len(t), bool)
        for i in np.flatnonzero(m):
            gone[i:i + span] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1)
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((r[0], len(t), int(gone.sum()), len(edge), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def bytes_corpus():
    rng = random.Random(3)
    word = lambda k: "".join(rng.choices("abcdeé ", k=k))                                       # noqa: E731
    hot, edge = word(300), word(150)
    rows = [(i, word(rng.randint(0, 700)), "en", "s", 0) for i in range(120)]
    rows += [(200 + i, word(90) + hot + word(80), "en", "s", 0) for i in range(60)]
    rows += [(300 + i, word(200) + edge[i:] + word(10), "en", "s", 0) for i in range(20)]
    rows += [(400, "x" * 5000, "en", "s", 0), (401, None, None, None, None), (402, "", "en", "s", 0), (None, rows[3][1], "en", "s", 0),
             (403, word(40_000) + hot, "en", "s", 0), (404, word(133) * 4, "en", "s", 0), (405, "short", "en", "s", 0)]
    rows += [(408, hot + word(200) + edge, "en", "s", 0), rows[5], rows[5], (406, rows[130][1], "de", "t", 1), (None, None, None, None, None), (407, "short", "en", "s", 0)]
    return rows


@pytest.mark.parametrize("hot, piece", [(2000, 1 << 20), (10, 5000)])
def test_passages_match_brute_force(spark, bytes_corpus, monkeypatch, hot, piece):
    """Also with frequent minimisers dealt window by window and texts taken in pieces."""
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "PIECE", piece)
    df = spark.createDataFrame(bytes_corpus, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = expected(bytes_corpus, SPAN)
    assert sum(r[2] > 0 for r in want) > 60 and any(r[3] > 1 for r in want)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for d in (df, df.withColumns({c: F.lit(3) for c in ("block", "row", "key", "n", "seg", "first", "a.b")})):
        got = passages.remove_passages(d, SPAN, keep_text=True)
        assert sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in got.select(*names).collect()), key=str) == want
    spans = passages.remove_passages(df, SPAN).select("n_removed", "n_spans", "starts", "ends").collect()
    assert all(r["n_spans"] == len(r["starts"]) and r["n_removed"] == sum(r["ends"]) - sum(r["starts"]) for r in spans)


def test_passages_of_nothing(empty):
    assert passages.remove_passages(empty).collect() == []


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = passages.op12_passages(spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == [r[:5] for r in expected(rows, 400)]


def test_word_passages_keep_columns_of_any_name(spark):
    """The stage on repeated word windows carries columns whose names hold dots."""
    from docspark.llm import substring
    words = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, words, 5), (2, words + " end", 6)], "doc_id long, text string, `a.b` long")
    got = {r["doc_id"]: (r["text"], r["a.b"]) for r in substring.remove_repeats(df).collect()}
    assert got == {1: (words, 5), 2: ("end", 6)}
