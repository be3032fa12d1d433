import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from docspark.operators import aggs as A


@pytest.fixture
def nums(spark):
    rows = [(str(i), i % 7 if i % 11 else None, float(i * 3 % 17), dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * i),
             f"10.{i % 4}.0.{i}") for i in range(60)]
    return spark.createDataFrame(rows, "_id string, k int, x double, ts timestamp_ntz, ip string")


def test_terms_order_and_nulls(nums):
    out = [(r["key"], r["doc_count"]) for r in A.terms(nums, A.Terms("k", size=3)).collect()]
    counts = {}
    for r in nums.collect():
        if r["k"] is not None:
            counts[r["k"]] = counts.get(r["k"], 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert out == want


def test_terms_multi_counts_each_doc_once(spark):
    df = spark.createDataFrame([("a", ["x", "x", "y"]), ("b", ["x"]), ("c", None)], "_id string, tags array<string>")
    out = {r["key"]: r["doc_count"] for r in A.terms(df, A.Terms("tags", multi=True)).collect()}
    assert out == {"x": 2, "y": 1}


def test_metrics_mad_and_cardinality(spark, nums):
    xs = [r["x"] for r in nums.collect()]
    m = statistics.median(xs)
    mad = statistics.median([abs(v - m) for v in xs])
    out = A.aggregate(nums, {"mad": A.MedianAbsoluteDeviation("x"), "approx": A.MedianAbsoluteDeviation("x", approx=True),
                             "card": A.Cardinality("x"), "exact": A.Cardinality("x", exact=True),
                             "kcard": A.Cardinality("k", exact=True), "stats": A.Stats("x")})
    assert out["mad"].first()["value"] == pytest.approx(mad)
    assert abs(out["approx"].first()["value"] - mad) <= 1.0
    assert out["exact"].first()["value"] == len(set(xs))
    assert out["kcard"].first()["value"] == 7
    assert abs(out["card"].first()["value"] - len(set(xs))) <= max(1, 0.05 * len(set(xs)))
    st = out["stats"].first()
    assert (st["count"], st["min"], st["max"]) == (60, min(xs), max(xs)) and st["sum"] == pytest.approx(sum(xs))


def test_exact_quantile_with_hot_value(spark):
    vals = [5.0] * 500 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert A.exact_quantile(df, "x", 0.5) == statistics.median(vals)
    assert A.exact_quantile(df, "x", 0.0) == 0.0 and A.exact_quantile(df, "x", 1.0) == 99.0


def test_date_histogram_fills_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5),), (dt.datetime(2024, 3, 2),), (dt.datetime(2024, 3, 30),)], "ts timestamp_ntz")
    out = [(r["key_as_string"], r["doc_count"]) for r in
           A.date_histogram(df, A.DateHistogram("ts", calendar_interval="month")).orderBy("key").collect()]
    assert out == [("2024-01-01T00:00:00.000Z", 1), ("2024-02-01T00:00:00.000Z", 0), ("2024-03-01T00:00:00.000Z", 2)]
    fixed = A.date_histogram(df, A.DateHistogram("ts", fixed_interval="30d", min_doc_count=1)).collect()
    assert sum(r["doc_count"] for r in fixed) == 3


def test_ranges_overlap_and_ip(nums):
    out = {r["key"]: r["doc_count"] for r in
           A.range_agg(nums, A.Range("x", [{"to": 5}, {"from": 3, "to": 10}, {"from": 10, "key": "big"}])).collect()}
    xs = [r["x"] for r in nums.collect()]
    assert out == {"*-5.0": sum(v < 5 for v in xs), "3.0-10.0": sum(3 <= v < 10 for v in xs), "big": sum(v >= 10 for v in xs)}
    ip = {r["key"]: r["doc_count"] for r in
          A.ip_range_agg(nums, A.IpRange("ip", [{"mask": "10.1.0.0/16"}, {"from": "10.2.0.0"}])).collect()}
    assert ip == {"10.1.0.0/16": 15, "10.2.0.0-*": 30}
    dr = A.date_range_agg(nums, A.DateRange("ts", [{"to": "2024-01-02"}, {"from": "2024-01-02"}])).collect()
    assert sorted(r["doc_count"] for r in dr) == [5, 55]


def test_top_hits_and_significant_terms(spark, nums):
    top = A.top_hits(nums, A.TopHits("k", [("x", "desc")], size=2, source=["_id", "x"])).collect()
    by = {}
    for r in top:
        by.setdefault(r["bucket"], []).append((r["hit_rank"], r["x"], r["total"]))
    for k, hits in by.items():
        xs = sorted([r["x"] for r in nums.collect() if r["k"] == k], reverse=True)
        assert [h[1] for h in sorted(hits)] == xs[:2] and hits[0][2] == len(xs)
    df = spark.createDataFrame([(s, fg) for s, fg in [("a", True)] * 8 + [("a", False)] * 2 + [("b", True)] * 2 +
                                [("b", False)] * 38], "src string, fg boolean")
    sig = A.significant_terms(df, A.SignificantTerms("src", F.col("fg"))).collect()
    assert [r["key"] for r in sig] == ["a"] and sig[0]["doc_count"] == 8


def test_grouped_exact_median_with_hot_key(spark):
    rows = [("hot", float(i % 97)) for i in range(3000)] + [("a", 1.0), ("a", 4.0), ("b", 2.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("x").alias("m")).collect() if r["m"] is not None}
    got = {r["key"]: r["median"] for r in A.grouped_exact_median(df, "k", "x", partitions=5).collect()}
    assert got == want


def test_top_hits_above_spark_rank_limit(spark):
    rows = [(f"{i:05d}", i % 2, float((i * 7919) % 10007)) for i in range(9000)]
    df = spark.createDataFrame(rows, "_id string, b int, v double")
    for by in (None, "b"):
        out = A.top_hits(df, A.TopHits(by=by, size=2000, sort=[("v", "desc")]))
        want = {}
        for r in sorted(rows, key=lambda r: (-r[2], r[0])):
            want.setdefault("_all" if by is None else str(r[1]), []).append(r[0])
        got = {}
        for r in sorted(out.collect(), key=lambda r: r["hit_rank"]):
            got.setdefault(str(r["bucket"]), []).append(r["_id"])
        assert got == {k: v[:2000] for k, v in want.items()}
    plan = A.top_hits(df, A.TopHits(by=None, size=2000, sort=[("v", "desc")]))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_terms_key_as_string_for_dates_and_booleans(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), True), (dt.datetime(2024, 1, 1), False),
                                (dt.datetime(2024, 1, 2), True)], "d timestamp_ntz, b boolean")
    dates = [(r["key"], r["key_as_string"], r["doc_count"]) for r in A.terms(df, A.Terms("d")).collect()]
    assert dates == [(1704067200000, "2024-01-01T00:00:00.000Z", 2), (1704153600000, "2024-01-02T00:00:00.000Z", 1)]
    bools = [(r["key"], r["key_as_string"], r["doc_count"]) for r in A.terms(df, A.Terms("b")).collect()]
    assert bools == [(1, "true", 2), (0, "false", 1)]


def test_an_exact_count_stands_in_no_aggregation_with_a_sketch(spark):
    """Beside a distinct count, Spark holds the sketch's state once for every value."""
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), (F.col("id") % 500).alias("u"))
    both = {"near": A.Cardinality("u"), "exact": A.Cardinality("u", exact=True), "s": A.Stats("u")}

    def apart(out):
        plan = out._jdf.queryExecution().executedPlan().toString()
        return not any("approx_count_distinct" in x and "u#" in x.split("functions")[0] for x in plan.splitlines() if "Aggregate" in x)

    one = A.metrics(df, both)
    assert apart(one) and one.columns == ["near", "exact", "s_count", "s_min", "s_max", "s_avg", "s_sum"]
    row = one.first()
    assert row["exact"] == 500 and abs(row["near"] - 500) <= 15 and row["s_count"] == 3000
    found = A.terms(df, A.Terms("g", size=2, metrics={"near": A.Cardinality("u"), "exact": A.Cardinality("u", exact=True)}))
    assert apart(found) and found.columns == ["key", "doc_count", "near", "exact"]
    assert [(r["key"], r["doc_count"], r["exact"]) for r in found.collect()] == [(0, 1000, 500), (1, 1000, 500)]
