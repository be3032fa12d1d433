"""Collocations and spelling variants against plain Python."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docspark.llm import collocations, spelling

LOW = str.maketrans(collocations.UPPER, collocations.LOWER)


def expected_collocations(rows, min_count, keep, inside=50, longest=3):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    dropped = set()
    for (lang, p), a in cands.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                sub = (lang, p[i:i + k])
                if 100 * a >= inside * f[sub]:
                    dropped.add(sub)
    out = collections.defaultdict(list)
    for (lang, p), a in cands.items():
        if (lang, p) not in dropped:
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                    for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:keep]))


@pytest.fixture(scope="module")
def phrases(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = [rng.choice(["new", "York", "city", "of", "the", "Äpfel", " x", "new york"]) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "]) for w in words)
        rows.append((i % 140, text, rng.choice(["en", "de", None]), "s", None))
    rows += [(500, None, "en", None, None), (None, "", "fr", None, None), (501, "the city " * 3000, "en", "s", 0),
             (502, "x" * 50_000, "xx", "s", 0), (503, "new new new new new", None, "s", 0)]
    return rows


@pytest.mark.parametrize("keep, longest, chunk, sample", [(2000, 3, 1 << 20, 0.01), (7, 3, 100, 1.0), (2000, 5, 1000, 1.0)])
def test_collocations_match_brute_force(spark, phrases, monkeypatch, keep, longest, chunk, sample):
    """Also with small chunks, and with the frequent pairs dealt to parts."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "SAMPLE", sample)
    df = spark.createDataFrame(phrases, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    for d in (df, df.withColumns({c: F.lit(3) for c in ("w1", "phrase", "f", "size", "a", "rank", "piece", "a.b")})):
        got = collocations.collocations(d, max_words=longest, keep=keep)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = expected_collocations(phrases, 10, keep, longest=longest)
        assert want and sorted(map(tuple, got.collect())) == want


def test_collocations_of_nothing(empty):
    assert collocations.collocations(empty).collect() == []


def test_collocations_count_longest_windows_once(spark, phrases):
    """The windows are generated for the longest order only, and the rollup starts from their counts."""
    df = spark.createDataFrame(phrases, "doc_id long, text string, lang string, source string, n_chars long")
    windows = collocations.windows(df)
    assert windows.columns == ["head", "tail"]
    assert windows.count() == sum(len(re.findall("[^ \t.,;:!?\x0a-\x0d]+", t or "")) for _, t, *_ in phrases)


def noisy(rows):
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            yield w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_variants(rows):
    n = {w: k for w, k in collections.Counter(noisy(rows)).items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(8)
    base = ["banana", "bananas", "bandana", "Straße", "straßen", "ébène", "ebene", "ÉBÈNE", "aabbaa", "aabba", "aaaaa", "aaaaaa",
            "information", "informations", "infomation", "abcd", "abcde", "b" * 200, "b" * 201, "q" * 3000, "q" * 2999 + "z"]
    rows = []
    for i in range(300):
        words = [rng.choice(base) if rng.random() < 0.6 else "".join(rng.choices("abé", k=rng.randint(4, 6))) for _ in range(20)]
        rows.append((i % 280, rng.choice([" ", ", ", "-", "1"]).join(words), "en", "s", 0))
    return rows + [(None, "banana bananä", "en", "s", 0), (7, None, "en", "s", 0), (8, "", None, None, None)]


@pytest.mark.parametrize("filter_bytes", [32 << 20, 256])
def test_spelling_matches_brute_force(spark, letters, monkeypatch, filter_bytes):
    """Also with filters so small that the vocabulary is cut into many slices."""
    monkeypatch.setattr(spelling, "FILTER_BYTES", filter_bytes)
    df = spark.createDataFrame(letters, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    want = expected_variants(letters)
    assert any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)
    for d in (df, df.withColumns({c: F.lit(3) for c in ("word", "n", "run", "id", "h", "near")})):
        got = spelling.variants(spelling.noisy_words(d))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect())) == want


def test_spelling_of_nothing(empty):
    assert spelling.variants(spelling.noisy_words(empty)).collect() == []


def test_filters_have_no_false_negatives(spark):
    words = ["".join(random.Random(i).choices("abcdefgé", k=5 + i % 70)) for i in range(3000)]
    vocab = spark.createDataFrame([(w, 3) for w in sorted(set(words))], "word string, n long")
    f, = spelling.build_filters(vocab, vocab.count())
    import pyarrow as pa
    for rows, letters in spelling._by_length(pa.array(words)):
        n = letters.shape[1]
        assert len(f.holds(spelling._finish(spelling._prefixes(letters)[:, n], n), spelling._shard(n))) == len(rows)
