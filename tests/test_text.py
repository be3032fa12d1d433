"""Text analysis and BM25."""

import math
import re
import random

from pyspark.sql import functions as F

from docspark.operators import text as X


def toks(spark, text, analyzer, search=False):
    df = spark.createDataFrame([("1", text)], "_id string, body string")
    return [r["token"] for r in X.tokens(df, "body", analyzer=analyzer, search_time=search).orderBy("pos").collect()]


def test_tokens_with_user_dictionary(spark):
    an = X.korean_analysis(user_dictionary_rules=["노트북", "삼성"])["index"]
    out = toks(spark, "삼성 노트북을 구매했습니다", an)
    assert "삼성" in out and "노트북" in out
    assert toks(spark, "Hello, WORLD-42!", X.Analyzer()) == ["hello", "world", "42"]


def test_decompound_modes_and_stoptags(spark):
    rules = ["삼성전자 삼성 전자"]
    assert toks(spark, "삼성전자", X.Analyzer(user_dictionary=tuple(rules), decompound="none")) == ["삼성전자"]
    assert toks(spark, "삼성전자", X.Analyzer(user_dictionary=tuple(rules), decompound="discard")) == ["삼성", "전자"]
    assert toks(spark, "삼성전자", X.Analyzer(user_dictionary=tuple(rules), decompound="mixed")) == ["삼성전자", "삼성", "전자"]
    assert toks(spark, "삼성전자 2024 abc", X.Analyzer(user_dictionary=tuple(rules), stoptags=("SN", "NNG"))) == ["abc"]


def test_synonym_rules_parse():
    m = X.parse_synonyms(["노트북, 랩탑", "tv => television", "bad => ", "a => b => c", "two words, x"])
    assert m == {"노트북": ["노트북", "랩탑"], "랩탑": ["노트북", "랩탑"], "tv": ["television"]}
    presets = X.korean_analysis(synonyms=["노트북,랩탑"])
    assert set(presets) == {"index", "search"} and set(X.korean_analysis()) == {"index"}


def test_match_korean_documents(spark):
    docs = spark.createDataFrame([("n1", "삼성 노트북 구매"), ("n2", "애플 아이폰 리뷰")], "_id string, title string")
    an = X.korean_analysis(user_dictionary_rules=["노트북"])["index"]
    hits = X.bm25(docs, "title", "노트북", index_analyzer=an).collect()
    assert [h["_id"] for h in hits] == ["n1"]


def test_search_time_synonyms(spark):
    presets = X.korean_analysis(synonyms=["노트북, 랩탑"])
    docs = spark.createDataFrame([("syn1", "노트북 추천 목록"), ("syn2", "휴대폰 리뷰")], "_id string, title string")
    hits = X.bm25(docs, "title", "랩탑", index_analyzer=presets["index"], search_analyzer=presets["search"]).collect()
    assert [h["_id"] for h in hits] == ["syn1"]
    assert X.bm25(docs, "title", "랩탑", index_analyzer=presets["index"]).count() == 0   # index chain has no synonyms


def test_bm25_matches_formula_and_index(spark, tmp_path):
    rows = [("a", "the cat sat on the mat"), ("b", "the dog"), ("c", "cats and dogs"), ("d", "")]
    docs = spark.createDataFrame(rows, "_id string, body string")
    got = {r["_id"]: r["_score"] for r in X.bm25(docs, "body", "the cat").collect()}
    lens = {"a": 6, "b": 2, "c": 3, "d": 0}
    n, avgdl = 4, 11 / 4
    def idf(df): return math.log(1 + (n - df + 0.5) / (df + 0.5))
    def part(tf, dl, df): return idf(df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
    want = {"a": part(2, 6, 2) + part(1, 6, 1), "b": part(1, 2, 2)}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    X.build_token_index(docs, "body", str(tmp_path / "idx"))
    via_index = {r["_id"]: r["_score"] for r in X.match_index(spark, str(tmp_path / "idx"), "the cat").collect()}
    assert set(via_index) == set(want) and all(abs(via_index[k] - want[k]) < 1e-9 for k in want)
    assert lens


def test_dictionary_and_repeated_ids(spark):
    rules = ("노트북", "삼성전자 삼성 전자", "ab")
    text = "삼성전자 노트북을 ABC 123"
    found = toks(spark, text, X.Analyzer(user_dictionary=rules, stoptags=("SN",)))
    assert found == ["삼성전자", "삼성", "전자", "노트북", "을", "ab", "c"]
    twice = spark.createDataFrame([("d", "foo x"), ("d", "foobar"), ("e", None)], "_id string, t string")
    an = X.Analyzer(user_dictionary=("foo",))
    rows = sorted(map(tuple, X.tokens(twice, "t", analyzer=an).collect()))
    assert rows == [("d", 0, "foo"), ("d", 0, "foo"), ("d", 1, "bar"), ("d", 1, "x")]
    assert len(X.query_tokens(spark, " ".join(f"t{i}" for i in range(3000)))) == 3000
    docs = spark.createDataFrame([("n1", "삼성 노트북 구매"), ("n2", "애플 아이폰 리뷰")], "_id string, title string")
    hits = X.bm25(docs, "title", "노트북을", index_analyzer=X.Analyzer(user_dictionary=rules)).collect()
    assert [h["_id"] for h in hits] == ["n1"]


def test_many_rules_give_the_same_tokens(spark):
    few = ("foo", "bar b ar")
    many = few + tuple(f"zz{i}" for i in range(30_000))
    for kind in X.SEGMENTATIONS:
        got = [toks(spark, "foobar foofoo xbar", X.Analyzer(user_dictionary=r, segmentation=kind)) for r in (few, many)]
        assert got[0] == got[1]
    assert got[0] == ["foo", "bar", "b", "ar", "foo", "foo", "x", "bar", "b", "ar"]


def _all_cuts(token, words):
    if not token:
        yield []
    for n in range(1, len(token) + 1):
        if token[:n] in words:
            yield from ([(token[:n], True), *rest] for rest in _all_cuts(token[n:], words))
    if token:
        yield from ([(token[0], False), *rest] for rest in _all_cuts(token[1:], words))


def test_cut_token_is_the_cheapest_of_all_cuts():
    rng = random.Random(3)
    for _ in range(300):
        words = {"".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(3)}
        token = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        matches = [(i, w) for w in words for i in range(len(token)) if token.startswith(w, i)]
        rng.shuffle(matches)
        cost = lambda cut: (sum(not k for _, k in cut), sum(k for _, k in cut), [-len(p) * k for p, k in cut])
        best = min(_all_cuts(token, words), key=cost)
        joined = []
        for piece, known in best:
            if joined and not known and not joined[-1][1]:
                joined[-1] = (joined[-1][0] + piece, False)
            else:
                joined.append((piece, known))
        assert X.cut_token(token, matches) == joined
    assert X.cut_token("", []) == []
    assert X.cut_token("aabbcc", [(0, "aa"), (2, "bb")]) == [("aa", True), ("bb", True), ("cc", False)]
    assert len(X.cut_token("ab" * 100_000, [(2 * i, "ab") for i in range(100_000)])) == 100_000


def test_synonyms_of_several_words(spark):
    an = X.Analyzer(synonyms=("a b => c", "x, a b d", "q => r s", "bad =>", "a => b => c"))
    assert an.synonym_rules()[("a", "b", "d")] == [("x",), ("a", "b", "d")]
    assert toks(spark, "a b a b d b q", an, search=True) == ["c", "x", "a", "b", "d", "b", "r", "s"]
    assert toks(spark, "a", an, search=True) == ["a"] and toks(spark, "", an, search=True) == []
    assert toks(spark, "a a b", an, search=True) == ["a", "c"]
    overlap = X.Analyzer(synonyms=("a b => p", "b c => q"))
    assert toks(spark, "a b c b c", overlap, search=True) == ["p", "c", "q"]


def test_scores_of_repeated_ids_agree_on_every_path(spark, tmp_path):
    docs = spark.createDataFrame([("a", "red red fox"), ("a", "red and a long text about nothing at all"), ("b", "fox"),
                                  ("c", None), ("d", "")], "_id string, t string")
    plain = {r["_id"]: r["_score"] for r in X.bm25(docs, "t", "red fox").collect()}
    ruled = X.Analyzer(user_dictionary=("zzz",))
    other = {r["_id"]: r["_score"] for r in X.bm25(docs, "t", "red fox", index_analyzer=ruled).collect()}
    X.build_token_index(docs, "t", str(tmp_path / "i"))
    index = {r["_id"]: r["_score"] for r in X.match_index(spark, str(tmp_path / "i"), "red fox").collect()}
    idf = lambda df: math.log(1 + (5 - df + 0.5) / (df + 0.5))
    gain = lambda tf, dl: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (13 / 5)))
    want = {"a": idf(2) * gain(2, 3) + idf(2) * gain(1, 3), "b": idf(2) * gain(1, 1)}
    for got in (plain, other, index):
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_many_queries_at_once(spark, tmp_path):
    docs = spark.createDataFrame([("a", "red fox"), ("b", "red hen red"), ("c", "blue hen"), ("d", "red fox"), ("e", None)],
                                 "_id string, t string")
    X.build_token_index(docs, "t", str(tmp_path / "i"))
    asked = spark.createDataFrame([(1, "red"), (2, "HEN blue"), (3, "nothing"), (4, None), (5, "fox")], "query_id int, query string")
    rows = X.match_many(spark, str(tmp_path / "i"), asked, k=2).collect()
    got = {(r["query_id"], r["rank"]): r["_id"] for r in rows}
    assert got == {(1, 1): "b", (1, 2): "a", (2, 1): "c", (2, 2): "b", (5, 1): "a", (5, 2): "d"}
    for q, text in ((1, "red"), (2, "hen blue")):
        one = {r["_id"]: r["_score"] for r in X.match_index(spark, str(tmp_path / "i"), text).collect()}
        assert all(abs(one[r["_id"]] - r["_score"]) < 1e-8 for r in rows if r["query_id"] == q)


def test_match_search_with_field_analysers(spark):
    from docspark.functions import predicates as P
    from docspark.schema import Collection, Field
    presets = X.korean_analysis(synonyms=["노트북, 랩탑"], user_dictionary_rules=["노트북"])
    coll = Collection("nori_article", {
        "id": Field("keyword"),
        "title": Field("text", analyzer="korean", search_analyzer="korean_search"),
        "lang": Field("keyword")},
        settings={"analysis": {"korean": presets["index"], "korean_search": presets["search"]}})
    docs = spark.createDataFrame([("a", "노트북을 샀다", "ko"), ("b", "노트북 노트북 추천", "ko"), ("c", "랩탑 리뷰", "en"),
                                  ("d", "휴대폰", "ko")], "_id string, title string, lang string")
    res = X.match_search(docs, coll, "title", "랩탑", filter=P.term("lang", "ko"))
    assert [r["_id"] for r in res.hits().collect()] == ["b", "a"] and res.total() == 2


def test_frequent_token_is_spread_over_files(spark, tmp_path):
    import pyarrow.parquet as pq
    docs = spark.range(4000).select(F.col("id").cast("string").alias("_id"), F.concat(F.lit("the w"), "id").alias("t"))
    X.build_token_index(docs, "t", str(tmp_path / "i"), partitions=8)
    files = [pq.read_table(f).column("token").to_pylist() for f in (tmp_path / "i" / "terms").glob("*.parquet")]
    assert sum("the" in f for f in files) >= 3
    assert X.match_index(spark, str(tmp_path / "i"), "the").count() == 4000


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_a_dictionary_moves_no_row(spark):
    docs = spark.range(0, 40, 1, 200).select(F.col("id").cast("string").alias("_id"), F.lit("foobar x").alias("t"))
    an = X.Analyzer(user_dictionary=("foo f oo",), decompound="discard", segmentation="whole")
    found = X.tokens(docs, "t", analyzer=an)
    assert _shuffles(found) == 0
    assert [r["token"] for r in found.where("_id = '7'").orderBy("pos").collect()] == ["f", "oo", "bar", "x"]


def test_building_an_index_moves_no_row_and_takes_no_rows(spark, tmp_path):
    docs = spark.range(0, 40, 1, 200).select(F.col("id").cast("string").alias("_id"), F.lit("b a b").alias("t"))
    X.build_token_index(docs, "t", str(tmp_path / "i"))
    assert not (tmp_path / "i" / "counts").exists()                       # no second copy of the postings
    rows = spark.read.parquet(str(tmp_path / "i" / "terms"))
    assert sorted({(r["token"], r["tf"], r["dl"]) for r in rows.collect()}) == [("a", 1, 3), ("b", 2, 3)] and rows.count() == 80
    X.build_token_index(docs.limit(0), "t", str(tmp_path / "none"))
    assert X.match_index(spark, str(tmp_path / "none"), "a").count() == 0


def test_many_queries_meet_the_index_rows_after_they_are_dealt(spark, tmp_path):
    docs = spark.range(30).select(F.col("id").cast("string").alias("_id"), F.lit("a b c").alias("t"))
    X.build_token_index(docs, "t", str(tmp_path / "i"))
    asked = spark.range(20).select(F.col("id").alias("query_id"), F.lit("a b c").alias("query"))
    found = X.match_many(spark, str(tmp_path / "i"), asked, k=3)
    assert not re.search(r"hashpartitioning\(query_id#\w+, _id#", found._jdf.queryExecution().executedPlan().toString())
    assert found.count() == 60
