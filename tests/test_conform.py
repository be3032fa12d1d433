import datetime as dt

from pyspark.sql import functions as F

from docspark.operators import conform as C
from docspark.schema import Collection, DynamicTemplate, Field


def conform(spark, docs, coll, **kw):
    df = docs(spark) if callable(docs) else docs
    return {r["id"]: r for r in C.conform_json(df, coll, "doc", **kw).collect()}


def reasons(row):
    return {e["field"]: e["reason"] for e in row["_errors"]}


def test_integer_rules(spark, docs):
    coll = Collection("c", {"id": Field("keyword"), "n": Field("integer")})
    rows = conform(spark, docs([{"id": "a", "n": 5}, {"id": "b", "n": 1.5}, {"id": "c", "n": "7"},
                                {"id": "d", "n": 2 ** 40}, {"id": "e", "n": True}, {"id": "f", "n": 3.0},
                                {"id": "g", "n": None}, {"id": "h"}]), coll)
    assert rows["a"]["n"] == 5 and rows["a"]["_errors"] == []
    assert "fractional" in reasons(rows["b"])["n"]
    assert "n" in reasons(rows["c"])                  # numeric strings rejected by default
    assert "out of range" in reasons(rows["d"])["n"]
    assert "n" in reasons(rows["e"])                  # a boolean is not a number
    assert rows["f"]["n"] == 3 and rows["f"]["_errors"] == []
    assert rows["g"]["n"] is None and rows["g"]["_errors"] == []
    assert rows["h"]["n"] is None and rows["h"]["_errors"] == []


def test_numeric_string_coerce(spark, docs):
    coll = Collection("c", {"id": Field("keyword"), "n": Field("long", coerce=True), "x": Field("double", coerce=True)})
    rows = conform(spark, docs([{"id": "a", "n": "7", "x": "2.5"}, {"id": "b", "n": "7.5", "x": "abc"}]), coll)
    assert rows["a"]["n"] == 7 and rows["a"]["x"] == 2.5
    assert set(reasons(rows["b"])) == {"n", "x"}


def test_dates_booleans_ip_geo(spark, docs):
    coll = Collection("c", {"id": Field("keyword"), "d": Field("date", format="strict_date_optional_time||epoch_millis"),
                            "d2": Field("date", format="yyyy/MM/dd"), "b": Field("boolean"), "ip": Field("ip"),
                            "g": Field("geo_point")})
    rows = conform(spark, docs([
        {"id": "a", "d": "2024-01-01T00:00:00Z", "d2": "2024/02/03", "b": "true", "ip": "192.168.0.1", "g": {"lat": 1, "lon": 2}},
        {"id": "b", "d": 1704067200000, "b": False, "ip": "2001:db8::1", "g": "41.5,-71.25"},
        {"id": "c", "d": "2024-13-45", "d2": "03.02.2024", "b": "yes", "ip": "300.1.1.1", "g": [200, 1]},
        {"id": "d", "d": "2024-01-01T10:20:30.123456+02:00", "g": [-71.25, 41.5]},
    ]), coll)
    assert rows["a"]["d"] == dt.datetime(2024, 1, 1) and rows["a"]["d2"] == dt.datetime(2024, 2, 3)
    assert rows["a"]["b"] is True and rows["a"]["g"]["lat"] == 1.0 and rows["a"]["_errors"] == []
    assert rows["b"]["d"] == dt.datetime(2024, 1, 1) and rows["b"]["b"] is False and rows["b"]["_errors"] == []
    assert rows["b"]["g"]["lon"] == -71.25
    assert set(reasons(rows["c"])) == {"d", "d2", "b", "ip", "g"}
    assert rows["d"]["d"] == dt.datetime(2024, 1, 1, 8, 20, 30, 123000)     # UTC, millisecond resolution
    assert rows["d"]["g"]["lat"] == 41.5


def test_strict_object_nested_and_multi(spark, docs):
    coll = Collection("c", {
        "id": Field("keyword"),
        "seller": Field("object", properties={"id": Field("keyword"), "rating": Field("integer")}, dynamic="strict"),
        "lines": Field("nested", properties={"q": Field("integer")}),
        "tags": Field("keyword", multi=True),
    })
    rows = conform(spark, docs([
        {"id": "a", "seller": {"id": "s", "rating": 5}, "lines": [{"q": 1}, {"q": 2}], "tags": ["x", "y"]},
        {"id": "b", "seller": {"id": "s", "extra": 1}, "lines": [{"q": 1.5}], "tags": "solo"},
        {"id": "c", "seller": "nope", "lines": 3, "undeclared": True},
    ]), coll)
    a = rows["a"]
    assert a["seller"]["rating"] == 5 and [x["q"] for x in a["lines"]] == [1, 2] and a["tags"] == ["x", "y"]
    assert a["_errors"] == []
    rb = reasons(rows["b"])
    assert "seller" in rb and "undeclared" in rb["seller"] and "lines.q" in rb
    assert rows["b"]["tags"] == ["solo"]
    rc = reasons(rows["c"])
    assert {"seller", "lines"} <= set(rc)                     # top level is dynamic=True: 'undeclared' is kept
    strict = Collection("s", {"id": Field("keyword")}, dynamic="strict")
    rows = conform(spark, docs([{"id": "a"}, {"id": "b", "zz": 1}]), strict)
    assert rows["a"]["_errors"] == [] and "zz" in reasons(rows["b"])["_root"]


def test_null_value_multifield_and_bad_json(spark, docs):
    coll = Collection("c", {"id": Field("keyword"), "status": Field("keyword", null_value="NONE"),
                            "name": Field("text", fields={"raw": Field("keyword")})})
    df = docs([{"id": "a", "status": None, "name": "Laptop"}, {"id": "b", "name": "Phone"}, "not json", "[1,2]"])
    out = C.conform_json(df, coll, "doc").collect()
    by = {r["id"]: r for r in out if r["id"]}
    assert by["a"]["status"] == "NONE" and by["b"]["status"] is None      # explicit null vs absent
    assert by["a"]["name__raw"] == "Laptop"
    bad = [r for r in out if r["id"] is None]
    assert len(bad) == 2 and all(reasons(r) == {"_root": "document is not a JSON object"} for r in bad)


def test_split_accepted_and_rejected(spark, docs):
    coll = Collection("c", {"id": Field("keyword"), "n": Field("integer")})
    ok, bad = C.split_valid(C.conform_json(docs([{"id": str(i), "n": i if i % 3 else "x"} for i in range(30)]), coll, "doc"))
    assert (ok.count(), bad.count()) == (20, 10)


def test_conform_frame_typed_and_variant_paths(spark):
    df = spark.createDataFrame([(1, 2.0, "2024-01-02", "x"), (2, 2.5, "bad", None)], "k long, v double, d string, e string")
    coll = Collection("c", {"k": Field("integer"), "v": Field("integer"), "d": Field("date")}, dynamic="strict")
    rows = {r["_id"]: r for r in C.conform_frame(df, coll, F.col("k")).collect()}
    assert rows["1"]["v"] == 2 and rows["1"]["d"] == dt.datetime(2024, 1, 2)
    r1 = reasons(rows["1"])
    assert "_root" in r1 and "e" in r1["_root"]               # strict: undeclared non-null column
    r2 = reasons(rows["2"])
    assert set(r2) == {"v", "d"}                              # 2.5 is fractional; 'bad' is not a date


def test_runtime_field_and_widen(spark, docs):
    coll = Collection("c", {"id": Field("keyword")}, dynamic="runtime")
    out = C.conform_json(docs([{"id": "a", "price": 10}, {"id": "b", "price": 20}]), coll, "doc")
    assert sorted(r[0] for r in out.select(C.runtime_field("price", "int")).collect()) == [10, 20]
    dyn = Collection("d", {"id": Field("keyword")}, dynamic=True,
                     dynamic_templates=(DynamicTemplate("codes", Field("keyword"), match_mapping_type="string", match="*_code"),))
    df = docs([{"id": "a", "zip_code": "123", "title": "t", "n": 1, "x": 1.5, "ok": True, "o": {"p": 1}}])
    seen = [(r["path"], r["kind"]) for r in C.observed_paths(df, F.try_parse_json("doc"), 2).collect()]
    wide = C.widen(dyn, seen)
    types = {k: f.type for k, f in wide.fields.items()}
    assert types == {"id": "keyword", "zip_code": "keyword", "title": "text", "n": "long", "x": "float",
                     "ok": "boolean", "o": "object"}
    assert wide.fields["title"].fields["keyword"].type == "keyword"
    assert wide.fields["o"].properties["p"].type == "long"


def test_a_task_that_conforms_does_not_grow_with_the_input(spark):
    """Few input partitions are dealt finer than one for each task slot when they are estimated large."""
    import re
    coll = Collection("sized", {"n": Field("long")})
    slots = spark.sparkContext.defaultParallelism

    def dealt(rows):
        docs = spark.range(0, rows, 1, 1).select(F.to_json(F.struct(F.col("id").alias("n"))).alias("doc"))
        plan = C.conform_json(docs, coll, "doc")._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"RoundRobinPartitioning\((\d+)\)", plan).group(1))

    assert dealt(100) == slots and dealt(3_000_000) > 2 * slots and dealt(10 ** 12) <= 16 * slots


def test_rows_with_and_without_errors(spark, docs):
    coll = Collection("mixed", {"n": Field("integer"), "s": Field("keyword")}, dynamic="strict")
    rows = C.conform_json(docs([{"n": 1, "s": "a"}, {"n": "x", "s": ["b"], "z": 0}, {"n": None}]), coll, "doc").collect()
    assert [[e["field"] for e in r["_errors"]] for r in rows] == [[], ["n", "s", "_root"], []]


def test_one_document_a_shape_shows_all_paths(spark, docs):
    texts = [{"a b": 1}, {"a": []}, {"a": [1, None]}, {"a": [1, 2.5]}, {"a": [1, "x"]}, {"a": [{"k": 1}, {"z": [1]}]},
             {"a": None, "b": 1.5, "d": 10 ** 25}, {"a": {"x": {"y": True}}}, {"a": [[1], [2]]}, {"a": {}}, {"": 1}, "[1]",
             "null", "no json"]
    rows = docs(texts * 3).select(F.try_parse_json("doc").alias("v"))
    paths = lambda df, c: {(r["path"], r["kind"]) for r in C.observed_paths(df, F.col(c), elements=True).collect()}
    assert paths(C.representatives(rows, F.col("v")), "doc") == paths(rows, "v")
    plain = docs([{"id": i, "x": i / 4, "s": str(i), "o": {"k": i}, "m": [i]} for i in range(500)])
    kept = C.representatives(plain, F.try_parse_json("doc"))
    assert kept.count() <= 2 and paths(kept, "doc") == paths(plain.select(F.try_parse_json("doc").alias("v")), "v")
