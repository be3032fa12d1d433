"""Partial documents, odd keys, settings, snapshots and discovery through the store."""

import json

import pytest
from pyspark.sql import functions as F

from docspark import Collection, Field
from docspark.errors import BreakingChangeError, FieldLimitError
from docspark.operators import conform as C
from docspark.operators import text as X
from docspark.schema import join_path, named_columns, split_path
from docspark.sources import store as S


def source(store, name):
    return {r["_id"]: json.loads(r["j"]) for r in store.read(name).select("_id", F.to_json("_source").alias("j")).collect()}


def parts(spark, items):
    return spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in items], "_id string, doc string")


def test_sharded_analyzed_collection_takes_writes_and_additions(spark, store, docs):
    settings = {"analysis": {"lower": X.Analyzer()}}
    coll = Collection("notes", {"id": Field("keyword"), "t": Field("text", analyzer="lower")}, num_shards=3, settings=settings)
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a", "t": "Red Fox"}, {"id": "b", "t": "Blue Owl", "n": 1}]), id_field="id")
    store.bulk_index(coll, docs([{"id": "b", "t": "Blue Fox", "n": 2}, {"id": "c", "t": "Owl"}]), id_field="id")
    wider = Collection("notes", {**coll.fields, "extra": Field("long")}, num_shards=3, settings=settings)
    store.sync(wider)
    hits = X.match_search(store.read("notes"), wider, "t", "fox").hits().collect()
    assert sorted(r["_id"] for r in hits) == ["a", "b"] and {"n", "extra"} <= set(store.read("notes").columns)
    with pytest.raises(BreakingChangeError):
        store.sync(Collection("notes", wider.fields, num_shards=5, settings=settings))


def test_update_derives_what_depends_on_a_field(spark, store, docs):
    coll = Collection("things", {
        "id": Field("keyword"), "name": Field("text", fields={"raw": Field("keyword")}), "n": Field("integer"),
        "state": Field("keyword", null_value="NONE"),
        "at": Field("object", properties={"x": Field("long"), "y": Field("keyword", fields={"up": Field("text")})})}, dynamic=False)
    store.create(coll)
    store.bulk_index(coll, docs([{"id": k, "name": "old", "n": 1, "state": "s", "at": {"x": 1, "y": "k", "free": [1]}, "u": {"v": {"w": 1}}}
                                 for k in "abcde"]), id_field="id")
    res = store.update_docs(coll, parts(spark, [
        ("a", {"name": "new"}), ("b", {"state": None, "at": {"y": "q"}, "u": {"v": {"z": [2]}}}), ("c", {"n": "many"}),
        ("d", "no json"), ("zz", {"n": 2}), ("e", {"n": 5}), ("e", {"n": 7, "at": None})]))
    assert (res.total, res.updated, res.failed, res.unmatched) == (6, 3, 2, 1)
    assert [r["_id"] for r in res.unmatched_ids.collect()] == ["zz"]
    assert {r["_id"]: r["_errors"][0]["field"] for r in res.failed_docs.collect()} == {"c": "n", "d": "_root"}
    rows = {r["_id"]: r for r in store.read("things").collect()}
    assert rows["a"]["name"] == rows["a"]["name__raw"] == "new" and rows["a"]["n"] == 1
    assert rows["b"]["state"] == "NONE" and tuple(rows["b"]["at"]) == (1, "q", "q")
    assert rows["c"]["n"] == 1 and rows["d"]["name"] == "old" and rows["e"]["n"] == 7 and rows["e"]["at"] is None
    kept = source(store, "things")
    assert kept["b"] == {"id": "b", "name": "old", "n": 1, "state": None, "at": {"x": 1, "y": "q", "free": [1]},
                         "u": {"v": {"w": 1, "z": [2]}}}
    assert kept["c"]["n"] == 1


def test_update_with_columns_keeps_other_keys_and_sets_nulls(spark, store, docs):
    coll = Collection("cols", {"id": Field("keyword"), "n": Field("integer"), "o": Field("object", properties={"a": Field("long"), "b": Field("long")})},
                      dynamic="strict")
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a", "n": 1, "o": {"a": 1, "b": 2}}, {"id": "b", "n": 1}]), id_field="id")
    changes = spark.createDataFrame([("a", None, (5,), ["n", "o"]), ("b", 9, (6,), ["o"])],
                                    "_id string, n int, o struct<a:long>, _present array<string>")
    store.update(coll, changes)
    rows = {r["_id"]: (r["n"], r["o"] and tuple(r["o"])) for r in store.read("cols").collect()}
    assert rows == {"a": (None, (5, 2)), "b": (1, (6, None))}
    with pytest.raises(ValueError):
        store.update(coll, spark.createDataFrame([("a", 1)], "_id string, other int"))
    res = store.update_docs(coll, parts(spark, [("a", {"other": 1})]))
    assert res.failed == 1 and "other" in res.failed_docs.first()["_errors"][0]["reason"]


def test_update_discovers_fields_and_merges_deep_objects(spark, store, docs):
    coll = Collection("deep", {"id": Field("keyword")})
    store.create(coll)

    def nest(k, leaf):
        return {f"k{k}": nest(k - 1, leaf)} if k else leaf
    store.bulk_index(coll, docs([{"id": "a", "d": nest(7, {"p": 1})}]), id_field="id")
    store.update_docs(coll, parts(spark, [("a", {"d": nest(7, {"q": 2}), "new": "x"})]))
    assert source(store, "deep")["a"] == {"id": "a", "d": nest(7, {"p": 1, "q": 2}), "new": "x"}
    row = store.read("deep").select("new", "new__keyword", "d.k7.k6.k5.k4.k3.k2.k1.*").first()
    assert tuple(row) == ("x", "x", 1, 2)


ODD = {"Name": "x", "name": "y", "a.b": 1, "e`f": 2, "title": "t", "title__raw": "other", "title__keyword": "third", "_source": 3, "_errors": 4,
       "__json": 5, "sp ace": 6, "q'u\"o\\te": 7, "br[0]": 8, "": 9, "o": {"In": 1, "in": 2, "x.y": {"z": 3}}, "l": [{"K": 1, "k": 2}]}


def test_odd_keys_become_columns_of_their_own(spark, store, docs):
    coll = Collection("odd", {"id": Field("keyword"), "title": Field("text", fields={"raw": Field("keyword")})})
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a", "name": "first"}]), id_field="id")
    res = store.bulk_index(coll, docs([{"id": "b", **ODD}, {"id": "c", "NAME": "z"}]), id_field="id")
    assert (res.total, res.failed) == (2, 0)
    stored = coll.with_fields({k: Field.from_mapping(m) for k, m in store.stored_mapping("odd").items()})
    assert set(ODD) - {""} <= set(stored.fields)
    rows = {r["_id"]: r for r in store.read("odd").drop("_source").collect()}
    for key, value in ODD.items():
        if key not in ("o", "l", ""):
            assert rows["b"][stored.column_of(join_path("", key))] == value, key
    assert rows["a"]["name"] == "first" and rows["c"][stored.column_of("NAME")] == "z"
    paths = ["o.In", "o.in", join_path("o", "x.y") + ".z"]
    got = store.read("odd").where("_id = 'b'").select(*[F.col(stored.column_of(p)).alias(str(i)) for i, p in enumerate(paths)]).first()
    assert tuple(got) == (1, 2, 3) and sorted(rows["b"]["l"][0]) == [1, 2]
    store.update_docs(coll, parts(spark, [("b", {"Name": "changed", "a.b": 10})]))
    row = store.read("odd").where("_id = 'b'").first()
    assert (row[stored.column_of("Name")], row["name"], row[stored.column_of(r"a\.b")]) == ("changed", "y", 10)
    store.migrate(coll, coll.with_version(2))


def test_names_are_injective_and_stable():
    keys = ["a", "A", "a.b", "a_b", "a`b", "_id", "x", "x__raw"]
    named = named_columns({k: Field("text", fields={"raw": Field("keyword")}) if k == "x" else Field("long") for k in keys if k != "_id"})
    columns = [n.lower() for k, f in named.items() for n in f.columns(k)]
    assert len(set(columns)) == len(columns) and named_columns(named) == named
    for path in (["a", "b"], ["a.b", "c"], ["a\\", "b"], ["a\\.b"], ["", "x"], [".", "\\"]):
        joined = ""
        for i, k in enumerate(path):
            joined = join_path(joined, k) if i else join_path("", k)
        if path[0]:
            assert split_path(joined) == path


def test_too_many_fields_are_refused(spark, store, docs, monkeypatch):
    monkeypatch.setattr(S, "FIELD_LIMIT", 20)
    coll = Collection("wide", {"id": Field("keyword")})
    store.create(coll)
    with pytest.raises(FieldLimitError):
        store.bulk_index(coll, docs([{"id": "a", "by_user": {f"u{i}": i for i in range(40)}}]), id_field="id")
    store.bulk_index(coll, docs([{"id": "a", "n": 1}]), id_field="id")
    assert store.read("wide").first()["n"] == 1


def test_discovery_scans_once(spark, docs):
    deep = {"a": {"b": {"c": {"d": {"e": 1}}}}, "l": [{"x": 1}, {"x": "s"}, 3]}
    df = docs([deep]).select(F.try_parse_json("doc").alias("v"))
    plan = C.observed_paths(df, F.col("v"), depth=5, elements=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_parse_json") == 1 or plan.count("Scan") == 1
    got = {(r["path"], r["kind"]): r["n_docs"] for r in C.observed_paths(df, F.col("v"), elements=True).collect()}
    assert got[("a.b.c.d.e", "long")] == 1 and got[("l.x", "string")] == 1 and got[("l", "array<object>")] == 2 and got[("l", "array<long>")] == 1
    one = {"k0": 1}
    for i in range(1, 40):
        one = {f"k{i}": one}
    assert C.observed_paths(docs([one]).select(F.try_parse_json("doc").alias("v")), F.col("v")).count() == 40


def test_open_snapshots_keep_their_table(spark, store, docs):
    coll = Collection("pins", {"id": Field("keyword")}, dynamic=False)
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a"}]), id_field="id")
    one, two = store.open_snapshot("pins"), store.open_snapshot("pins")
    store.bulk_index(coll, docs([{"id": "b"}]), id_field="id")
    store.migrate(coll, coll.with_version(2), delete_old=True)
    store.drop_unused("pins")
    assert store.read_snapshot(one).count() == 1
    assert store.close_snapshot(one) and not store.close_snapshot(one)
    store.drop_unused("pins")
    assert store.read_snapshot(two).count() == 1
    assert store.close_snapshot(two)
    assert one.physical in store.drop_unused("pins") and not store.exists(one.physical)


def test_file_count_stays_at_the_buckets(spark, store, docs):
    coll = Collection("files", {"id": Field("keyword"), "n": Field("long")}, num_shards=4, dynamic=False)
    store.create(coll)
    for i in range(4):
        store.bulk_index(coll, docs([{"id": f"{i}-{k}", "n": k} for k in range(50)]), id_field="id")
    assert store.read("files").count() == 200
    assert len(store.spark.table(store._q(store.current("files"))).inputFiles()) == 4
