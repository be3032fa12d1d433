"""Classifiers, URL rules, search and embeddings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docspark.llm import components, embeddings, quality, search, toxicity, urls

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("op, label, least", [(quality.op4_quality, "quality", 0.97), (toxicity.op3_toxicity, "toxic", 0.97)])
def test_held_out_accuracy(spark, op, label, least):
    got = op(spark, SF)
    known = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = got.join(known, "doc_id").where("held_out").collect()
    assert rows and got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(r["predicted"] == r[label] for r in rows) >= least * len(rows) - 2


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_without_labels_and_on_odd_rows(spark, docs, clashing, empty, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    model = module.fit(docs, none)
    for df in (docs, clashing):
        rows = module.score(df, model).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(empty, model).count() == 0
    some = docs.where("doc_id is not null").select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias(label))
    rows = module.score(docs, module.fit(docs, some)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_keep_good_keeps_columns(spark, clashing):
    model = quality.fit(clashing, spark.createDataFrame([], "doc_id long, quality int"))
    out = quality.keep_good(clashing, model)
    assert out.columns == clashing.columns and out.count() == clashing.count()


def test_label_model_recovers_a_rare_group():
    """Rows that only one accurate voter marks are not outvoted by a correlated majority."""
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.1
    kind = rng.random(4000) < 0.7
    votes = np.zeros((4000, 6))
    for v in range(5):
        votes[:, v] = y & kind & (rng.random(4000) < 0.7)
    votes[:, 5] = y & ~kind
    p = toxicity.label_model(votes, y.astype(int))
    assert ((p > 0.5) == y).mean() > 0.98


def fits(host, path, rule):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def test_urls_match_brute_force(spark):
    rng = random.Random(5)
    hosts = ["net", "a.net", "example.net", "x.example.net", "anexample.net", "org", "b.org", "EXAMPLE.com", "c.example.com:80", ""]
    rows = [(i, rng.choice(["http://", "https://", "", "x://"]) + rng.choice(hosts) + rng.choice(
        ["", "/", "/en/", "/en", "/de/x", "/fr/?q=/de/", "#/en/", "?a=http://b/de/", "/en/a/b"])) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "://"), (402, "://"), (None, "http://a.net/")]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, keys int, host string")
    many = [(f"h{i}.example", f"/p{i % 9}/", "block" if i % 2 else "allow") for i in range(500)] + urls.RULES
    pages2 = pages.select("page_id", "url").unionByName(spark.createDataFrame(
        [(1000 + i, f"http://s.h{rng.randrange(900)}.example/p{rng.randrange(9)}/x") for i in range(600)], "page_id long, url string"))
    for df, rules in ((pages, urls.RULES), (pages2, many), (pages, [])):
        frame = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = urls.judge(df, frame).collect()
        assert len(got) == df.count()
        for r in got:
            best = [x for x in rules if fits(r["host"], r["path"], x)]
            best = max(best, key=lambda x: (len(x[0] + x[1]), len(x[0])), default=None)
            assert (r["rule"], r["verdict"]) == ((best[0] + best[1], best[2]) if best else (None, "allow"))
    with pytest.raises(ValueError):
        urls.judge(pages, spark.createDataFrame([("", "/", "block")], "host string, path string, verdict string"))
    assert urls.judge(pages.limit(0), spark.createDataFrame(urls.RULES, "host string, path string, verdict string")).count() == 0


def test_search_matches_brute_force(spark, corpus):
    import collections
    rows = [(i, t) for i, t, *_ in corpus if i is not None] + [(None, "w1 w2 only here")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "id long, text string, score double")
    got = collections.defaultdict(list)
    for r in search.top_k(df, F.col("id") % 10 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["score"]))
    bags = [(i, collections.Counter((t or "").lower().encode().split())) for i, t in rows]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    frequency = collections.Counter(w for _, b in bags for w in b)
    for q, asked in {i: b for i, b in bags if i is not None and i % 10 == 0}.items():
        scored = []
        for i, b in bags:
            parts = [c * math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * b[w] * 2.2
                     / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for w, c in asked.items() if w in b]
            if parts:
                scored.append((i, math.fsum(parts)))
        scored.sort(key=lambda x: (-round(x[1], 9), math.inf if x[0] is None else x[0]))
        assert [x[0] for x in got[q]] == [x[0] for x in scored[:5]]
        assert np.allclose([x[1] for x in got[q]], [x[1] for x in scored[:5]])
    assert search.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


@pytest.mark.parametrize("frequent, together", [(16, 64), (2, 3), (10**6, 1)])
def test_search_looks_terms_up_once(spark, corpus, monkeypatch, frequent, together):
    """A shard looks up the distinct terms of a block of queries at once, not those of each query for each hit; sums
    over posting lists, block bounds and products give the same hits."""
    monkeypatch.setattr(search, "FREQUENT", frequent)
    monkeypatch.setattr(search, "TOGETHER", together)
    rows = [(i, t) for i, t, *_ in corpus if i is not None] + [(500 + i, "w1 w2 only here") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(1)
    index = search.build_index(df, 1)
    row = index.collect()[0].asDict()
    mean = row["words"] / row["n"]
    vectors = search.query_vectors(df.where("id % 3 = 0").dropDuplicates(["id"]), index, row["n"])
    queries = search.Queries(vectors.toArrow())
    shard = search.Shard(row, mean)
    calls, look = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: (calls.append(1), look(*a, **k))[1])
    got = shard.search(queries, 5)
    assert len(queries.ids) > 80 and len(calls) == 1
    # the list of ids holds a repeated row twice, as the shard does
    place = {t: k for k, t in enumerate(shard.terms.tolist())}
    impact = [{} for _ in range(shard.n)]
    for k in range(len(shard.terms)):
        for j in range(shard.starts[k], shard.starts[k + 1]):
            impact[shard.docs[j]][k] = float(shard.impact[j])
    want = []
    for i, q in enumerate(queries.ids):
        own = slice(queries.starts[i], queries.starts[i + 1])
        asked = {place[t]: w for t, w in zip(queries.terms[queries.places[own]].tolist(), queries.weights[own].tolist(), strict=True)}
        scored = [(math.fsum(w * x[k] for k, w in asked.items() if k in x), int(shard.ids[d])) for d, x in enumerate(impact)]
        want += [(q, *x) for x in sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1]))[:5]]
    assert got == want


def test_search_rounds_return_few_rows(spark, corpus, monkeypatch):
    """Hits are those of one shard, however many rounds there are; a floor keeps what can't be among the k best out."""
    rows = [(i, t) for i, t, *_ in corpus if i is not None] + [(None, "w1 w2 only here")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = []
    for shards, first in ((1, 1), (13, 0.25)):
        monkeypatch.setattr(search, "parts_for", lambda *a, n=shards: n)
        monkeypatch.setattr(search, "FIRST", first)
        found.append(search.top_k(df, F.col("id") % 3 == 0, k=4).collect())
    key = lambda r: (r["query_id"], r["rank"])                                                         # noqa: E731
    assert sorted(found[0], key=key) == sorted(found[1], key=key) and len(found[0]) > 150
    assert search._round_ends(13, 1) == [1, 2, 4, 8, 13] and search._round_ends(3, 12) == [3]
    index = search.build_index(df, 1)
    row = index.collect()[0].asDict()
    queries = search.Queries(search.query_vectors(df.where("id % 3 = 0").dropDuplicates(["id"]), index, row["n"]).toArrow())
    shard = search.Shard(row, row["words"] / row["n"])
    every = shard.search(queries, 4)
    least = {q: s for q, s, _ in every}
    floors = np.array([least.get(q, 0.0) for q in queries.ids])
    assert shard.search(queries, 4, floors) == every
    assert shard.search(queries, 4, floors * 1.5) == [x for x in every if x[1] >= 1.5 * least[x[0]]]


def test_search_prepares_a_shard_once(spark, corpus, monkeypatch):
    """A shard is prepared once for all blocks of queries, and one block at a time stays in memory."""
    class Sent:
        def __init__(self, value):
            self._path = value

        @property
        def value(self):
            return self.__dict__.setdefault("_value", self._path)

    rows = [(i, t) for i, t, *_ in corpus if i is not None]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    index = search.build_index(df, 2)
    assert index.rdd.getNumPartitions() == 2 and index.select("shard").distinct().count() == 2
    assert index.agg(F.sum("n")).first()[0] == len(rows)
    total = index.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    vectors = search.query_vectors(df.where("id % 3 = 0").dropDuplicates(["id"]), index, total["n"], 5).toArrow()
    assert sorted(vectors.to_pylist(), key=str) == sorted(
        search.query_vectors(df.where("id % 3 = 0").dropDuplicates(["id"]), index, total["n"]).toArrow().to_pylist(), key=str)
    shard, made = search.Shard, []
    monkeypatch.setattr(search, "Shard", lambda *a: (made.append(1), shard(*a))[1])
    found = []
    for size in (len(vectors), 20):
        asked = [Sent(search.Queries(vectors.slice(lo, size))) for lo in range(0, len(vectors), size)]
        made.clear()
        run = search._asking(asked, Sent(None), total["words"] / total["n"], 4)
        found.append(sorted(tuple(r.values()) for b in run(iter(index.toArrow().to_batches())) for r in b.to_pylist()))
        assert len(made) == 2 and (len(asked) == 1 or all("_value" not in a.__dict__ for a in asked))
    assert len(asked) >= 3 and found[0] == found[1] and len(found[0]) > 150


def test_search_puts_like_rows_together(spark):
    """Blocks hold rows of one vocabulary by length, so that a query skips the blocks of the others."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{min(int(rng.paretovariate(0.7)), 400)}" for _ in range(rng.randrange(10, 90)))) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, text string")
    index = search.build_index(df, 1)
    row = index.collect()[0].asDict()
    shard = search.Shard(row, row["words"] / row["n"])
    ends = [*shard.edges.tolist()[1:], shard.n]
    for lo, hi in zip(shard.edges.tolist(), ends, strict=True):
        assert 0 < hi - lo <= search.BLOCK and len(set((shard.ids[lo:hi] % 2).tolist())) == 1
        assert (np.diff(shard.lengths[lo:hi]) >= 0).all()
    assert sorted(shard.ids.tolist()) == list(range(5000)) and len(ends) >= 5
    queries = search.Queries(search.query_vectors(df.where("id % 500 = 7"), index, row["n"]).toArrow())
    products, size = [], [d.shape[1] for d in shard.dense]

    class Counted(np.ndarray):
        def __rmatmul__(self, other):
            products.append(len(other) * self.shape[1])
            return np.asarray(other) @ np.asarray(self)

    shard.dense = [d.view(Counted) for d in shard.dense]
    assert len(shard.search(queries, 3)) == 3 * len(queries.ids)
    assert 0 < sum(products) <= 0.5 * sum(size) * len(queries.ids)


def test_search_orders_hashes():
    rng = np.random.default_rng(4)
    for h in (rng.integers(0, 1 << 63, 999, np.uint64), rng.integers(0, 40, 999, np.uint64), np.zeros(0, np.uint64),
              np.array([(1 << 64) - 1, 3, 2, 2, 1], np.uint64)):
        assert search._order(h).tolist() == np.argsort(h, kind="stable").tolist()


def test_op9_asks_whole_documents(spark):
    import collections
    small = SF.replace("0.01", "0.001")
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = collections.defaultdict(list)
    for r in search.op9_search(spark, small).orderBy("query_doc_id", "rank").collect():
        got[r["query_doc_id"]].append((r["doc_id"], r["score"]))
    bags = {i: collections.Counter((t or "").encode().lower().split()) for i, t in rows.items()}
    n, mean = len(bags), sum(sum(b.values()) for b in bags.values()) / len(bags)
    frequency = collections.Counter(w for b in bags.values() for w in b)
    assert set(got) == {i for i in bags if i % 50 == 0 and bags[i]}
    for q in got:
        score = {i: math.fsum(
            c * math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * b[w] * 2.2
            / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for w, c in bags[q].items() if w in b)
            for i, b in bags.items()}
        best = sorted((x for x in score.items() if x[1] > 0), key=lambda x: (-round(x[1], 9), x[0]))[:10]
        assert [x[0] for x in got[q]] == [x[0] for x in best]
        assert np.allclose([x[1] for x in got[q]], [x[1] for x in best])


def test_embeddings_recall_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 32))
    near = base[:80] + rng.normal(size=(80, 32)) * 0.2 * np.abs(base[:80]).mean()
    x = np.vstack([base, near, base[:5], base[5:10] * 3])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.0] * 32), (903, [None] + [1.0] * 31), (904, [float("nan")] * 32),
             (905, [1.0] * 7), (None, x[0].tolist()), (0, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, code int").repartition(3)
    got = embeddings.near_duplicates(df).collect()
    assert len(got) == len(rows)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    true = linked.sum(1)
    n = {r["vec_id"]: r["n_links"] for r in got if r["n_links"]}
    assert all(n.get(i, 0) <= true[i] for i in range(len(x)))
    assert sum(n.values()) >= 0.9 * true.sum()
    assert not {900, 901, 902, 903, 904, 905, None} & set(n)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_recall_with_a_strong_mean_lengths_and_scales(spark):
    rng = np.random.default_rng(6)

    def pairs(n, dim, mean):
        x = rng.normal(size=(n, dim)) + mean * np.ones(dim)
        x /= np.linalg.norm(x, axis=1)[:, None]
        d = rng.normal(size=x.shape)
        d -= (d * x).sum(1)[:, None] * x
        d /= np.linalg.norm(d, axis=1)[:, None]
        return np.vstack([x, 0.955 * x + np.sqrt(1 - 0.955 ** 2) * d])

    blocks = [pairs(200, 64, 2.0), pairs(40, 48, 0.0)]
    rows = [(1000 * k + i, (v * 10.0 ** rng.choice([-200, 0, 200])).tolist()) for k, x in enumerate(blocks) for i, v in enumerate(x)]
    got = {r["vec_id"]: r["n_links"] for r in
           embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    for k, x in enumerate(blocks):
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        true = (unit @ unit.T >= 0.95).sum(1) - 1
        n = np.array([got[1000 * k + i] for i in range(len(x))])
        assert true.sum() and (n <= true).all() and n.sum() >= 0.9 * true.sum()


def test_components(spark):
    edges = [(i, i + 1) for i in range(50, 90)] + [(5, 3), (3, 9), (100, 9), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(50, 91)} == {50}
    assert [got[i] for i in (3, 5, 9, 100)] == [3] * 4 and 7 not in got
