"""Substring removal, near duplicates, mixing and tokenising against plain Python."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docspark.llm import arrow_files, bpe, kernel, minhash, mixing, stages, substring

FOLD = bytes(bytearray(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def words(text):
    return (text or "").encode().split()


def test_words_and_hashes():
    texts = ["a b  c", "", None, " x\x0by ", "b c a", "é\u00a0z a"]
    seen = {}
    for lo, hi, w in kernel.chunks(pa.array(texts)):
        found = [bytes(w.buf[a:z]) for a, z in zip(w.starts, w.ends)]
        assert found == [x for t in texts[lo:hi] for x in words(t)]
        assert w.counts.tolist() == [len(words(t)) for t in texts[lo:hi]]
        for x, h in zip(found, w.hashes()):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def expected_removal(rows, span=13):
    first = {}
    for i, text, *_ in rows:
        i = float("inf") if i is None else i
        w = words(text)
        for k in range(len(w) - span + 1):
            g = tuple(w[k:k + span])
            first[g] = min(first.get(g, float("inf")), i)
    out = []
    for i, text, *_ in rows:
        w, me = words(text), float("inf") if i is None else i
        gone = set()
        for k in range(len(w) - span + 1):
            if first[tuple(w[k:k + span])] < me:
                gone.update(range(k, k + span))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [5000, 3])
def test_substring_matches_brute_force(docs, clashing, corpus, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    want = expected_removal(corpus)
    assert any(r[2] for r in want)
    for df in (docs, clashing):
        assert sorted(map(tuple, substring.digests(df).collect()), key=str) == want


def test_substring_keeps_columns_and_rows(clashing, empty):
    out = substring.remove_repeats(clashing)
    assert out.columns == clashing.columns and out.count() == clashing.count()
    assert substring.digests(empty).count() == 0


def test_suffix_automaton_statistics():
    rng = random.Random(3)
    sequences = [[rng.choice("abc") for _ in range(rng.randint(1, 40))] for _ in range(12)]
    a = substring.SuffixAutomaton()
    for i, s in enumerate(sequences):
        a.add(s, i)
    a.close()
    text = ["".join(s) for s in sequences]
    probe = [rng.choice("abcd") for _ in range(200)]
    for at, (n, low) in enumerate(a.stream(probe, 4), start=1):
        p = "".join(probe)
        longest = max(k for k in range(5) if k <= at and any(p[at - k:at] in t for t in text))
        assert n == longest
        if n == 4:
            assert low == min(i for i, t in enumerate(text) if p[at - 4:at] in t)


def shingles(text):
    w = (text or "").encode().translate(FOLD).split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected_groups(rows):
    ids = [r[0] for r in rows]
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if ids[i] is not None and ids[j] is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    group = collections.defaultdict(list)
    for i in range(len(rows)):
        group[find(i)].append(i)
    out = []
    for i, r in enumerate(rows):
        c = None if r[0] is None else min(ids[j] for j in group[find(i)])
        out.append((r[0], len(sets[i]), c, r[0] is not None and c == r[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("big", [2000, 2])
def test_minhash_matches_brute_force(docs, clashing, corpus, monkeypatch, big):
    monkeypatch.setattr(minhash, "BIG", big)
    want = expected_groups(corpus)
    assert len({r[2] for r in want}) < len(want)
    for df in (docs, clashing) if big == 2000 else (docs,):
        assert sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str) == want


def test_minhash_signature_pairs_meet():
    """Any two signatures within MAX_DIFF share a key, however the differences lie."""
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 1 << 16, (400, minhash.HASHES)).astype("<u2")
    other = sig.copy()
    for r in range(len(sig)):
        at = rng.choice(minhash.HASHES, minhash.MAX_DIFF, replace=False)
        other[r, at] ^= 1
    keys = [np.concatenate([minhash.chunk_keys(s, c) for c in range(minhash.N_CHUNKS)], axis=1) for s in (sig, other)]
    assert all(set(a) & set(b) for a, b in zip(*keys))


def test_minhash_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_mixing_targets_and_budgets(spark, docs, clashing, empty, corpus):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(corpus)
    total = sum(len(words(r[1])) for r in corpus)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert sum(v[0]["target"] for v in by.values()) == pytest.approx(total)
    order = sorted(by, key=lambda s: (s is None, s))
    rate = [by[s][0]["target"] / (5, 2, 1)[k % 3] for k, s in enumerate(order)]
    for s, x in zip(order, rate):
        size, target = by[s][0]["source_size"], by[s][0]["target"]
        assert target == pytest.approx(3 * size) or x == pytest.approx(max(rate))
        assert sum(r["taken"] for r in by[s]) == int(target + 1e-9)
    again = mixing.mix(clashing.repartition(3)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mix(empty).count() == 0


def test_first_words():
    assert mixing.first_words(pa.array([" a  b c", None, "x"]), np.array([2, 1, 5])) == [" a  b", "", "x"]


def test_pipeline_mix_stage_takes_the_words(spark, docs, corpus):
    out = stages.mix_sources(spark, docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), "")
    assert out.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in
             mixing.mix(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    got = collections.Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert {k: v for k, v in taken.items() if v} == dict(got)


def test_pipeline_mix_stage_decides_per_row(spark, docs, corpus):
    """Null ids and rows that repeat an id, within a source and across sources, each take their own words."""
    more = [(i, f"n{k} " * (5 + k), "en", s, 0) for k, (i, s) in enumerate(
        [(7, "s0"), (7, "s1"), (7, "s2"), (7, "s3"), (None, "s0"), (None, "s2"), (None, "s3"), (None, None)] * 4)]
    odd = spark.createDataFrame([tuple(r) for r in corpus] + more, docs.schema).repartition(5)
    taken, got = collections.Counter(), collections.Counter()
    for r in mixing.mix(odd).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    texts = collections.defaultdict(list)
    for i, t, _, s, _ in [tuple(r) for r in corpus] + more:
        texts[i, s].append(words(t))
    for r in stages.mix_sources(spark, odd, "").collect():
        w = words(r["text"])
        got[r["doc_id"], r["source"]] += len(w)
        assert any(t[:len(w)] == w for t in texts[r["doc_id"], r["source"]])
    assert {k: v for k, v in taken.items() if v} == dict(got)


def test_near_copies_stage_judges_rows_of_one_id_by_their_texts(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(200)) for c in "ab")
    rows = [(2, b), (5, a), (5, a), (5, b + " end"), (6, a + " end"), (None, b), (None, b), (None, None), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in stages.drop_near_copies(spark, df, "").collect()]
    stay = [(2, b), (5, a), (5, a), (None, b), (None, b), (None, None), (7, None)]
    assert sorted(out, key=str) == sorted(stay, key=str)


@pytest.fixture(scope="module")
def byte_bpe():
    path = bpe.public_tokenizer("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    return path, Tokenizer.from_file(path), bpe.MergeTables(bpe.read_tokenizer(path))


def test_bpe_matches_library(docs, corpus, byte_bpe):
    path, lib, _ = byte_bpe
    got = sorted(map(tuple, bpe.round_trip(docs, path).collect()), key=str)
    want = []
    for i, text, *_ in corpus:
        ids = lib.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    text = {r[0]: r[1] for r in bpe.decode_documents(bpe.encode_documents(docs, path), path).collect()}
    assert text[154] == corpus[154][1]


@pytest.mark.parametrize("window", [8, 64, 512])
def test_bpe_streaming_is_exact(byte_bpe, window):
    _, lib, tables = byte_bpe
    assert tables.lookahead and tables.lookahead < 1000
    enc, rng = bpe.Encoder(tables, window), random.Random(window)
    alphabet = list("abehinrst019 \n\t\x1c\x85\u00a0'!=-éßñ你👍") + ["<|endoftext|>", "aaaaaaaa", "----", "    ", "'re"]
    for _ in range(150):
        run = "".join(rng.choices(rng.choice(["ab", "ehinrst", "=-", "aeinorst"]), k=rng.randint(100, 1500)))
        mixed = "".join(rng.choices(alphabet, k=rng.randint(0, 200)))
        for text in (run, mixed):
            assert np.frombuffer(enc.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_decoder_is_incremental(byte_bpe):
    _, lib, tables = byte_bpe
    ids = lib.encode("naïve 你好 👍🏽", add_special_tokens=False).ids
    dec = bpe.Decoder(tables)
    assert "".join(dec.feed([i]) for i in ids) + dec.feed((), True) == "naïve 你好 👍🏽"
    with pytest.raises(ValueError):
        dec.feed([10**6])


def test_sequence_files_round_trip(spark, docs, corpus, tmp_path):
    path = bpe.public_tokenizer("word_bpe_49k.json")
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(path)
    manifest = arrow_files.write_sequences(docs, path, str(tmp_path / "out"), length=64)
    got = [tuple(r) for r in arrow_files.read_documents(manifest).orderBy("start").collect()]
    want, start = [], 0
    for i, text, *_ in sorted(corpus, key=lambda r: -1 if r[0] is None else r[0]):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [r[0] for r in got] == [w[0] for w in want]
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted(w for w in want if w[0] is not None)
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    for f in manifest.collect():
        reader = arrow_files.SequenceReader(f["data"])
        rows = -(-f["n_ids"] // 64)
        assert sum(reader.sequence(i)[1].sum() for i in range(rows)) == f["n_ids"]


def test_words_of_known_letters_are_not_encoded_again(monkeypatch):
    """Case and trailing punctuation make no new word; any other text has the library's ids, too."""
    import random
    content = bpe.read_tokenizer(bpe.public_tokenizer("word_bpe_49k.json"))
    encoder = arrow_files.WordEncoder(content, "<u2")
    given, batch = [], encoder.batch
    monkeypatch.setattr(encoder, "batch", lambda texts, **k: (given.extend(texts), batch(texts, **k))[1])
    ids = lambda text: np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
    assert encoder.encode("river grün Wald, it's") == ids("river grün Wald, it's")
    given.clear()
    again = "River, RIVER river; Grün, grün wald Wald"
    assert encoder.encode(again) == ids(again)
    assert given == [";"]
    rng = random.Random(8)
    letters = "aAbBsStTdDmMwWéÉÀßÿ×÷'.,!<|>/-_`~@[{\u0301\u030a\u0307 \n\u0130\u0131\u1e9e\u03a3\u03c3\ud55c0129\U0001f600"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 20))) + rng.choice(["", "<|endoftext|>", "</w>", "W\u030a", "IT'S"])
        assert encoder.encode(text) == ids(text), text


def test_other_tokenizers_take_whole_words():
    """Words are split for the library only where its normaliser and pattern allow it."""
    import json
    spec = json.loads(bpe.read_tokenizer(bpe.public_tokenizer("word_bpe_49k.json")))
    assert arrow_files.WordEncoder(json.dumps(spec), "<u2").split
    spec["normalizer"]["normalizers"].pop()                                            # no lower-casing
    encoder = arrow_files.WordEncoder(json.dumps(spec), "<u2")
    text = "River, river RIVER"
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert not encoder.split and np.frombuffer(encoder.encode(text), "<u2").tolist() == want


def test_sequence_files_empty(empty, tmp_path):
    manifest = arrow_files.write_sequences(empty, bpe.public_tokenizer("word_bpe_49k.json"), str(tmp_path / "none"))
    assert arrow_files.read_documents(manifest).count() == 0
