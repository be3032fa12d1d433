import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docspark.functions import predicates as P
from docspark.functions.sorting import SortSpec, reduce_array
from docspark.operators import search as Q


def _rows():
    rnd = random.Random(7)
    return [(f"id{i:03d}", rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b"]), rnd.random()) for i in range(40)]


def _py_order(rows, specs):
    def key(r):
        out = []
        for s in specs:
            v = r[{"a": 1, "b": 2, "c": 3, "_id": 0}[s.field]]
            missing = v is None
            null_rank = (0 if missing else 1) if s.missing == "_first" else (1 if missing else 0)
            out.append(null_rank)
            if not missing:
                out.append(v if not s.descending else (-v if isinstance(v, (int, float)) else _neg(v)))
            else:
                out.append(0)
        return out
    return [r[0] for r in sorted(rows, key=key)]


class _neg(str):
    def __lt__(self, other):
        return str.__gt__(self, other)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["asc", "desc"]),
                          st.sampled_from([None, "_first"])), min_size=1, max_size=2, unique_by=lambda t: t[0]),
       st.integers(min_value=3, max_value=9))
def test_cursor_pages_concatenate_to_full_order(spark, sort, size):
    rows = _rows()
    df = spark.createDataFrame(rows, "_id string, a int, b string, c double")
    specs = [SortSpec(f, o, missing=m) for f, o, m in sort]
    full = _py_order(rows, specs + [SortSpec("_id")])
    got = [r["_id"] for p in Q.pages(df, specs, size) for r in p.hits().collect()]
    assert got == full
    offset = [r["_id"] for r in Q.search(df, None, specs, size=size, from_=size).hits().collect()]
    assert offset == full[size:2 * size]


def test_predicates_and_multi_valued(spark):
    df = spark.createDataFrame([("1", [1, 5], "x"), ("2", [7], None), ("3", None, "y")], "_id string, v array<int>, s string")
    def ids(q):
        return sorted(r["_id"] for r in Q.search(df, q, size=10).hits().collect())
    assert ids(P.term("v", 5, multi=True)) == ["1"]
    assert ids(P.range_("v", gte=6, multi=True)) == ["2"]
    assert ids(P.bool_(must_not=[P.term("s", "x")])) == ["2", "3"]           # null counts as no match
    assert ids(P.bool_(should=[P.term("s", "y"), P.range_("v", gt=6, multi=True)])) == ["2", "3"]
    assert ids(P.exists("s")) == ["1", "3"] and ids(P.sql("s = 'x'")) == ["1"]


def test_sort_modes_on_arrays(spark):
    df = spark.createDataFrame([("1", [3.0, 1.0, 2.0, None]), ("2", [10.0]), ("3", []), ("4", None)], "_id string, v array<double>")
    from pyspark.sql import functions as F
    got = {r["_id"]: tuple(r[1:]) for r in df.select("_id", *[reduce_array(F.col("v"), m).alias(m) for m in
                                                               ("min", "max", "sum", "avg", "median")]).collect()}
    assert got["1"] == (1.0, 3.0, 6.0, 2.0, 2.0) and got["2"] == (10.0,) * 5
    assert got["3"] == (None,) * 5 and got["4"] == (None,) * 5
    res = Q.search(df, None, sort=[{"v": {"order": "desc", "mode": "sum", "missing": 0.0}}], size=10)
    assert [r["_id"] for r in res.hits().collect()] == ["2", "1", "3", "4"]


def test_cursor_over_timestamp_ntz_keys(spark):
    import datetime as dt
    rows = [(f"t{i}", dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=7 * (i % 5))) for i in range(12)]
    df = spark.createDataFrame(rows, "_id string, ts timestamp_ntz")
    got = [r["_id"] for p in Q.pages(df, [("ts", "desc")], 5) for r in p.hits().collect()]
    want = [r[0] for r in sorted(rows, key=lambda r: (-r[1].timestamp(), r[0]))]
    assert got == want


def test_global_index_over_many_partitions(spark):
    from docspark.operators import scan as S
    df = spark.range(3000).select(F.col("id").cast("string").alias("_id"), F.pmod(F.col("id") * 7919, F.lit(3001)).alias("v"))
    out = S.global_index(df, sort=[("v", "asc")], partitions=300)
    rows = out.orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(3000)) and [r["v"] for r in rows] == sorted(r["v"] for r in rows)
