"""Collection lifecycle: create, additive evolution, versioned rebuild."""

import pytest
from pyspark.sql import functions as F

from docspark.errors import BreakingChangeError, MigrationError
from docspark.operators.drift import diff_collections, evolve_additive
from docspark.schema import Collection, Field

SHELF = Collection("shelf", {"id": Field("keyword"), "name": Field("text")})
SHELF_PRICE = Collection("shelf", {"id": Field("keyword"), "name": Field("text"), "price": Field("integer")})
SHELF_BREAKING = Collection("shelf", {"id": Field("keyword"), "name": Field("keyword")})
BIN = Collection("bin", {"id": Field("keyword")}, use_alias=False)
V1 = Collection("crate", {"id": Field("keyword"), "name": Field("text")}, version=1)
V2 = Collection("crate", {"id": Field("keyword"), "name": Field("text"), "price": Field("integer")}, version=2)


def _id():
    return F.try_variant_get(F.try_parse_json("doc"), "$.id", "string")


def test_create_is_idempotent_and_points_alias(store):
    assert store.create(SHELF) == "shelf_v1"
    assert store.exists("shelf") and store.exists("shelf_v1")
    assert store.current("shelf") == "shelf_v1"
    assert store.create(SHELF) == "shelf_v1"           # no-op
    assert store.create(BIN) == "bin" and store.current("bin") == "bin"
    with pytest.raises(MigrationError):
        store.create(SHELF.with_version(2))                 # alias already on v1


def test_diff_and_sync(spark, store, docs):
    assert diff_collections(SHELF, None).added_fields == ["id", "name"]
    store.create(SHELF)
    store.bulk_index(SHELF, docs([{"id": "p1", "name": "Hammer"}]), id_expr=_id())
    d = diff_collections(SHELF_PRICE, SHELF)
    assert d.added_fields == ["price"] and not d.is_breaking
    store.sync(SHELF, SHELF_PRICE)
    rows = store.read("shelf").collect()
    assert rows[0]["price"] is None and rows[0]["name"] == "Hammer"
    assert diff_collections(SHELF_BREAKING, SHELF).is_breaking
    with pytest.raises(BreakingChangeError) as e:
        store.sync(SHELF, SHELF_BREAKING)
    assert e.value.changed_fields == ["name"]


def test_nested_additive_sync(spark):
    old = Collection("n", {"seller": Field("object", properties={"id": Field("keyword")})})
    new = Collection("n", {"seller": Field("object", properties={"id": Field("keyword"), "rating": Field("integer")}),
                           "tags": Field("keyword", multi=True)})
    df = spark.createDataFrame([("1", ("s",)), ("2", None)], "_id string, seller struct<id:string>")
    out = {r["_id"]: r for r in evolve_additive(df, old, new).collect()}
    assert out["1"]["seller"]["id"] == "s" and out["1"]["seller"]["rating"] is None
    assert out["2"]["seller"] is None and out["1"]["tags"] is None


def test_migrate_v1_to_v2(spark, store, docs):
    store.create(V1)
    store.bulk_index(V1, docs([{"id": "m1", "name": "Hammer"}]), id_expr=_id())
    res = store.migrate(V1, V2)
    assert res.from_index.startswith("crate_v1") and (res.to_index, res.documents_reindexed) == ("crate_v2", 1)
    assert store.current("crate") == "crate_v2"
    row = store.read("crate").collect()[0]
    assert "price" in row.asDict() and row["price"] is None and row["name"] == "Hammer"
    assert store.exists(res.from_index)                         # kept unless delete_old
    dropped = store.drop_unused("crate")
    assert res.from_index in dropped and not store.exists(res.from_index) and store.read("crate").count() == 1
    with pytest.raises(MigrationError):
        store.migrate(V1, V2)                                   # already active


def test_migrate_failure_leaves_pointer(spark, store, docs):
    store.create(V1)
    store.bulk_index(V1, docs([{"id": "x1", "name": "ok"}, {"id": "x2", "name": "notanumber"}]), id_expr=_id())
    before = store.current("crate")
    strict_v2 = Collection("crate", {"id": Field("keyword"), "name": Field("integer", coerce=True)}, version=2)
    with pytest.raises(MigrationError):
        store.migrate(V1, strict_v2)
    assert store.current("crate") == before
    assert not store.exists("crate_v2")


def test_migrate_requires_alias(store):
    store.create(BIN)
    with pytest.raises(MigrationError):
        store.migrate(BIN, Collection("bin", {"id": Field("keyword")}, version=2, use_alias=False))


def test_additive_evolution_inside_nested_arrays(spark):
    old = Collection("n", {"lines": Field("nested", properties={"q": Field("integer")})})
    new = Collection("n", {"lines": Field("nested", properties={"q": Field("integer"), "note": Field("keyword"),
                                                                "who": Field("object", properties={"id": Field("keyword")})})})
    df = spark.createDataFrame([("1", [(1,), (2,)]), ("2", None)], "_id string, lines array<struct<q:int>>")
    out = {r["_id"]: r for r in evolve_additive(df, old, new).collect()}
    assert [(e["q"], e["note"], e["who"]) for e in out["1"]["lines"]] == [(1, None, None), (2, None, None)]
    assert out["2"]["lines"] is None


def test_partial_update_respects_present_keys(spark):
    from docspark.operators.writes import partial_update
    base = spark.createDataFrame([("a", 1, "x", ("s1", 5)), ("b", 2, "y", None)],
                                 "_id string, n int, t string, seller struct<id:string,rating:int>")
    changes = spark.createDataFrame([("a", None, "X", ("s9",), ["t", "seller"]), ("b", 20, None, ("s2",), ["n", "seller"]),
                                     ("zz", 1, "q", None, ["n"])],
                                    "_id string, n int, t string, seller struct<id:string>, _present array<string>")
    new, unmatched = partial_update(base, changes, order_col=None)
    rows = {r["_id"]: r for r in new.collect()}
    assert (rows["a"]["n"], rows["a"]["t"], rows["a"]["seller"]["id"], rows["a"]["seller"]["rating"]) == (1, "X", "s9", 5)
    assert (rows["b"]["n"], rows["b"]["t"], rows["b"]["seller"]["id"], rows["b"]["seller"]["rating"]) == (20, "y", "s2", None)
    assert [r["_id"] for r in unmatched.collect()] == ["zz"]


def test_writes_on_plain_table(spark, store, docs):
    store.create(BIN)
    res = store.bulk_index(BIN, docs([{"id": "a"}, {"id": "b"}]), id_field="id")
    assert res.succeeded == 2 and sorted(r["_id"] for r in store.read("bin").collect()) == ["a", "b"]
    store.delete(BIN, spark.createDataFrame([("a",)], "_id string"))
    assert [r["_id"] for r in store.read("bin").collect()] == ["b"]
    assert store.current("bin") == "bin"


def test_undeclared_fields_survive_writes(spark, store, docs):
    data = [{"id": "1", "extra": 5, "tags": ["a", "b"], "in": {"a": {"b": [1, 2]}}, "x.y": "dot"}, {"id": "2", "extra": "five"}]
    for name, mode in (("d_true", True), ("d_false", False), ("d_run", "runtime")):
        coll = Collection(name, {"id": Field("keyword")}, dynamic=mode)
        store.create(coll)
        assert store.bulk_index(coll, docs(data), id_field="id").succeeded == 2
        rows = store.read(name).withColumn("kept", F.try_variant_get("_source", "$.in.a.b[1]", "int"))
        got = {r["_id"]: r for r in rows.collect()}
        assert got["1"]["kept"] == 2
        assert ("extra" in rows.columns) == (mode is True)
    wide = {r["_id"]: r for r in store.read("d_true").collect()}
    assert (wide["1"]["extra"], wide["2"]["extra"], wide["1"]["tags"]) == ("5", "five", ["a", "b"])
    assert wide["1"]["in"]["a"]["b"] == [1, 2] and "x.y" not in wide["1"].asDict()
    coll = Collection("d_true", {"id": Field("keyword")})
    store.bulk_index(coll, docs([{"id": "3", "late": True}]), id_field="id")
    wide = {r["_id"]: r for r in store.read("d_true").collect()}
    assert len(wide) == 3 and wide["3"]["late"] is True and wide["1"]["extra"] == "5" and wide["3"]["extra"] is None


def test_ids_are_generated_where_missing_and_differ_between_writes(spark, store, docs):
    coll = Collection("anon", {"id": Field("keyword"), "n": Field("integer")})
    store.create(coll)
    for _ in range(2):
        res = store.bulk_index(coll, docs([{"n": 1}, {"n": 1}, {"id": "a", "n": 2}]), id_expr=_id())
        assert (res.total, res.succeeded) == (3, 3)
    assert store.read("anon").count() == 5
    with pytest.raises(Exception, match="no id"):
        from docspark.operators.writes import upsert
        base = spark.createDataFrame([("a", 1)], "_id string, n int")
        upsert(base, spark.createDataFrame([(None, 1, 0)], "_id string, n int, _ord int")).collect()


def test_last_partial_update_wins_and_source_follows(spark, store, docs):
    coll = Collection("upd", {"id": Field("keyword"), "n": Field("integer")}, dynamic=False)
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a", "n": 1, "other": 7}]), id_field="id")
    store.update(coll, spark.createDataFrame([("a", 9, 1), ("a", 20, 2), ("a", 3, 0)], "_id string, n int, seq int"), "seq")
    row = store.read("upd").select("n", F.try_variant_get("_source", "$.n", "int").alias("s"),
                                   F.try_variant_get("_source", "$.other", "int").alias("o")).first()
    assert tuple(row) == (20, 20, 7)


def test_plain_table_update_reports_unmatched(spark, store, docs):
    coll = Collection("plain_upd", {"id": Field("keyword"), "n": Field("integer")}, use_alias=False)
    store.create(coll)
    store.bulk_index(coll, docs([{"id": "a", "n": 1}]), id_field="id")
    unmatched = store.update(coll, spark.createDataFrame([("a", 2), ("zz", 3)], "_id string, n int"))
    assert [r["_id"] for r in unmatched.collect()] == ["zz"]
    assert store.read("plain_upd").first()["n"] == 2


def test_rebuild_keeps_absent_and_null_apart(spark, store, docs):
    fields = {"id": Field("keyword"), "t": Field("text", fields={"raw": Field("keyword")}),
              "s": Field("keyword", null_value="NV")}
    for dynamic in ("strict", False):
        name = f"rb_{str(dynamic).lower()}"
        v1, v2 = Collection(name, fields, dynamic=dynamic), Collection(name, fields, version=2, dynamic=dynamic)
        store.create(v1)
        store.bulk_index(v1, docs([{"id": "absent", "t": "x"}, {"id": "null", "t": "y", "s": None}]), id_field="id")
        before = sorted(tuple(r) for r in store.read(name).drop("_source").collect())
        assert store.migrate(v1, v2).documents_reindexed == 2
        assert sorted(tuple(r) for r in store.read(name).drop("_source").collect()) == before
        assert {r["_id"]: r["s"] for r in store.read(name).collect()} == {"absent": None, "null": "NV"}


def test_generation_numbers_are_not_used_again(spark, store, docs):
    store.create(SHELF)
    store.bulk_index(SHELF, docs([{"id": "a", "name": "x"}]), id_field="id")
    snap = store.snapshot("shelf")
    store.bulk_index(SHELF, docs([{"id": "b", "name": "x"}]), id_field="id")
    store.drop_unused("shelf")
    store.bulk_index(SHELF, docs([{"id": "c", "name": "x"}]), id_field="id")
    assert not store.exists(snap.physical) and store.read("shelf").count() == 3


def test_settings_and_stored_types_are_compared(spark, store, docs):
    coll = Collection("cfg", {"id": Field("keyword"), "n": Field("integer")}, settings={"analysis": {"a": 1}})
    store.create(coll)
    assert not store.schema_diff(coll).is_breaking
    other = Collection("cfg", coll.fields, settings={"analysis": {"a": 2}})
    assert store.schema_diff(other).changed_settings == {"analysis": ({"a": 1}, {"a": 2})}
    with pytest.raises(BreakingChangeError):
        store.sync(other)
    lying = Collection("cfg", {"id": Field("keyword"), "n": Field("text")}, settings=coll.settings)
    with pytest.raises(BreakingChangeError):
        store.sync(lying, lying)                             # what is stored counts, not the caller's word
    with pytest.raises(BreakingChangeError):
        evolve_additive(store.read("cfg"), lying, lying)
