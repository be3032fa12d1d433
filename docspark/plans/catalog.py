"""Registered queries over the test tables, each with an equivalent DuckDB SQL oracle.

Every query reads whole tables (or data Spark derives from them) and calls the library operators; the SQL next to
it computes the same result independently so the driver can compare them. Doubles from sums, averages and scores
are rounded on both sides; every limited result carries a unique tiebreak and, where order matters, a ``rank``.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import conform as C
from ..operators import drift as D
from ..operators import scan as S
from ..operators import search as Q
from ..operators import text as X
from ..operators import writes as W
from ..functions.sorting import SortSpec
from ..schema import ERRORS_COL, ID_COL, Collection, Field
from ..session import compile_in_parts, ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def prep(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    compile_in_parts(spark)
    ensure_checkpoint_dir(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prep(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_id(df: DataFrame, *cols: str) -> DataFrame:
    key = F.col(cols[0]).cast("string") if len(cols) == 1 else F.concat_ws("-", *[F.col(c).cast("string") for c in cols])
    return df.select(key.alias(ID_COL), *df.columns)


def r4(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


# ----------------------------------------------------------------------------------------------------------------
# Declarations used by the queries
# ----------------------------------------------------------------------------------------------------------------

ORDERS = Collection("orders", {
    "o_orderkey": Field("long"), "o_custkey": Field("long"), "o_orderstatus": Field("keyword"),
    "o_totalprice": Field("double"), "o_orderdate": Field("date", format="strict_date_optional_time||epoch_millis"),
    "o_orderpriority": Field("keyword", fields={"raw": Field("keyword")}),
})

CUSTOMER = Collection("customer", {
    "c_custkey": Field("long"), "c_name": Field("keyword"), "c_nationkey": Field("integer"),
    "c_acctbal": Field("double"), "c_mktsegment": Field("keyword"),
})

EVENTS = Collection("events", {
    "event_id": Field("long"), "ts": Field("date"), "user_id": Field("long"), "event_type": Field("keyword"),
    "value": Field("double"), "props": Field("object", properties={"k": Field("integer")}),
}, dynamic="strict")


def orders(spark, sf) -> DataFrame:
    return with_id(read(spark, sf, "orders"), "o_orderkey")


def customers(spark, sf) -> DataFrame:
    return with_id(read(spark, sf, "customer"), "c_custkey")




# ----------------------------------------------------------------------------------------------------------------
# Flagship (entry): conform → bool(term, range) → terms with a per-bucket average
# ----------------------------------------------------------------------------------------------------------------

@register("flagship_terms_avg", """
SELECT o_orderpriority AS key, count(*) AS doc_count, round(avg(o_totalprice), 4) AS avg_price
FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000
GROUP BY o_orderpriority ORDER BY doc_count DESC, key LIMIT 10
""")
def flagship_terms_avg(spark, sf):
    conformed = C.conform_frame(read(spark, sf, "orders"), ORDERS, id_expr=F.col("o_orderkey"))
    docs, _ = C.split_valid(conformed)
    q = P.bool_(must=[P.term("o_orderstatus", "F")], filter=[P.range_("o_totalprice", gte=1000)])
    out = A.aggregate(docs, {"by_priority": A.Terms("o_orderpriority", size=10,
                                                    metrics={"avg_price": A.Avg("o_totalprice")})}, query=q)
    return out["by_priority"].select("key", "doc_count", r4("avg_price").alias("avg_price"))


# ----------------------------------------------------------------------------------------------------------------
# Search, sort, paging
# ----------------------------------------------------------------------------------------------------------------

@register("search_term_range", """
WITH f AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_totalprice < 300000)
SELECT row_number() OVER (ORDER BY o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS rank,
       CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey, o_totalprice, o_orderdate,
       (SELECT count(*) FROM f) AS total
FROM f ORDER BY rank LIMIT 100
""")
def search_term_range(spark, sf):
    q = P.bool_(must=[P.term("o_orderstatus", "F")], filter=[P.range_("o_totalprice", gte=100000, lt=300000)])
    res = Q.search(orders(spark, sf), q, sort=[("o_totalprice", "desc")], size=100)
    total = res.total()
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, "o_orderkey", "o_totalprice", "o_orderdate",
                                                   F.lit(total).cast("long").alias("total"))


_PAGE_SORT = [("o_orderpriority", "asc"), ("o_totalprice", "desc")]
_PAGE_SQL = """
SELECT row_number() OVER (ORDER BY o_orderpriority ASC, o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS rank,
       CAST(o_orderkey AS VARCHAR) AS _id, o_orderpriority, o_totalprice
FROM orders ORDER BY rank LIMIT {size} OFFSET {offset}
"""


@register("sort_topk", _PAGE_SQL.format(size=50, offset=0))
def sort_topk(spark, sf):
    res = Q.search(orders(spark, sf), None, sort=_PAGE_SORT, size=50)
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, "o_orderpriority", "o_totalprice")


@register("page_offset", _PAGE_SQL.format(size=50, offset=100))
def page_offset(spark, sf):
    res = Q.search(orders(spark, sf), None, sort=_PAGE_SORT, size=50, from_=100)
    return Q.with_rank(res.page, res.specs, offset=100).select("rank", ID_COL, "o_orderpriority", "o_totalprice")


@register("page_cursor", _PAGE_SQL.format(size=50, offset=100))
def page_cursor(spark, sf):
    """Third cursor page (search_after the second page's last hit) equals the offset-100 page."""
    df = orders(spark, sf)
    cursor = None
    for _ in range(2):
        cursor = Q.search(df, None, sort=_PAGE_SORT, size=50, after=cursor).next_cursor()
    res = Q.search(df, None, sort=_PAGE_SORT, size=50, after=cursor)
    return Q.with_rank(res.page, res.specs, offset=100).select("rank", ID_COL, "o_orderpriority", "o_totalprice")


def _line_key(spark, sf, mode: str, where=None) -> DataFrame:
    """O2/O4 on nested lines stored as child rows: one key per order from its lines by sort mode."""
    li = read(spark, sf, "lineitem")
    if where is not None:
        li = li.filter(where())
    if mode == "median":
        keys = A.grouped_exact_median(li, "l_orderkey", "l_extendedprice", "o_orderkey") \
            .withColumnRenamed("median", "line_key")
    else:
        agg = {"min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg}[mode]
        keys = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(agg("l_extendedprice").alias("line_key"))
    return orders(spark, sf).select(ID_COL, "o_orderkey").join(keys, "o_orderkey", "left")


_MODE_SQL = """
WITH k AS (SELECT l_orderkey, {fn}(l_extendedprice) AS line_key FROM lineitem {where} GROUP BY l_orderkey)
SELECT row_number() OVER (ORDER BY k.line_key {dir} NULLS LAST, CAST(o.o_orderkey AS VARCHAR)) AS rank,
       CAST(o.o_orderkey AS VARCHAR) AS _id, round(k.line_key, 4) AS sort_key
FROM orders o LEFT JOIN k ON o.o_orderkey = k.l_orderkey ORDER BY rank LIMIT 50
"""


def _mode_query(mode: str, order: str, where=None, where_sql: str = ""):
    def run(spark, sf):
        df = _line_key(spark, sf, mode, where)
        res = Q.search(df, None, sort=[SortSpec("line_key", order)], size=50)
        return Q.with_rank(res.page, res.specs).select("rank", ID_COL, r4("line_key").alias("sort_key"))
    fn = {"min": "min", "max": "max", "sum": "sum", "avg": "avg", "median": "median"}[mode]
    return run, _MODE_SQL.format(fn=fn, dir=order.upper(), where=where_sql)


for _mode, _order in (("min", "asc"), ("max", "desc"), ("sum", "desc"), ("avg", "asc"), ("median", "desc")):
    _fn, _sql = _mode_query(_mode, _order)
    register(f"sort_mode_{_mode}", _sql)(_fn)

_fn, _sql = _mode_query("max", "desc", lambda: F.col("l_returnflag") == "R", "WHERE l_returnflag = 'R'")
register("sort_nested", _sql)(_fn)


@register("sort_array_modes", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  [l_extendedprice, l_extendedprice * l_discount, l_extendedprice * l_tax, NULL] AS amounts
           FROM lineitem),
k AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS _id,
             list_median(amounts) AS med, list_sum(amounts) AS tot FROM d)
SELECT row_number() OVER (ORDER BY med DESC NULLS LAST, tot ASC NULLS LAST, _id) AS rank, _id,
       round(med, 4) AS med, round(tot, 4) AS tot
FROM k ORDER BY rank LIMIT 50
""")
def sort_array_modes(spark, sf):
    """O2 on an in-document multi-valued field: median mode descending, then sum mode ascending."""
    li = with_id(read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    docs = li.select(ID_COL, F.array(F.col("l_extendedprice"), F.col("l_extendedprice") * F.col("l_discount"),
                                     F.col("l_extendedprice") * F.col("l_tax"), F.lit(None).cast("double")).alias("amounts"))
    res = Q.search(docs, None, sort=[{"amounts": {"order": "desc", "mode": "median"}},
                                     {"amounts": {"order": "asc", "mode": "sum"}}], size=50)
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, r4("_k0").alias("med"), r4("_k1").alias("tot"))


@register("sort_missing", """
WITH d AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id,
                  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
           FROM orders)
SELECT row_number() OVER (ORDER BY price ASC NULLS FIRST, _id) AS rank, _id, price
FROM d ORDER BY rank LIMIT 60
""")
def sort_missing(spark, sf):
    """O3: missing values first."""
    df = orders(spark, sf).select(ID_COL, F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P"),
                                                 F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"))
    res = Q.search(df, None, sort=[{"price": {"order": "asc", "missing": "_first"}}], size=60)
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, "price")


@register("sort_missing_value", """
WITH d AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
           FROM orders)
SELECT row_number() OVER (ORDER BY coalesce(price, 450000.0) DESC, _id) AS rank, _id, price
FROM d ORDER BY rank LIMIT 60
""")
def sort_missing_value(spark, sf):
    """O3: a substitute value for missing keys."""
    df = orders(spark, sf).select(ID_COL, F.when(F.col("o_orderstatus") == "P", F.lit(None))
                                  .otherwise(F.col("o_totalprice")).alias("price"))
    res = Q.search(df, None, sort=[{"price": {"order": "desc", "missing": 450000.0}}], size=60)
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, "price")


# ----------------------------------------------------------------------------------------------------------------
# Aggregations
# ----------------------------------------------------------------------------------------------------------------

@register("agg_terms", """
SELECT user_id AS key, count(*) AS doc_count FROM events
WHERE event_type <> 'error' AND user_id IS NOT NULL
GROUP BY user_id ORDER BY doc_count DESC, key LIMIT 10
""")
def agg_terms(spark, sf):
    ev = read(spark, sf, "events")
    out = A.aggregate(ev, {"top_users": A.Terms("user_id", size=10)},
                      query=P.bool_(must_not=[P.term("event_type", "error")]))
    return out["top_users"]


@register("agg_terms_multi", r"""
WITH d AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS words
           FROM documents)
SELECT w AS key, count(*) AS doc_count FROM (SELECT unnest(words) AS w FROM d)
GROUP BY w ORDER BY doc_count DESC, key LIMIT 25
""")
def agg_terms_multi(spark, sf):
    """G1 on a multi-valued field: each document counts once per distinct value."""
    docs = read(spark, sf, "documents").select("doc_id", X.analyze(F.col("text")).alias("words"))
    return A.terms(docs, A.Terms("words", size=25, multi=True))


@register("agg_significant", """
WITH t AS (SELECT CAST(count(*) FILTER (WHERE lang = 'fr') AS DOUBLE) AS fg, CAST(count(*) AS DOUBLE) AS bg FROM documents),
g AS (SELECT source AS key, count(*) FILTER (WHERE lang = 'fr') AS doc_count, count(*) AS bg_count
      FROM documents WHERE source IS NOT NULL GROUP BY source)
SELECT key, doc_count, bg_count,
       round((doc_count / fg - bg_count / bg) * ((doc_count / fg) / (bg_count / bg)), 6) AS score
FROM g, t WHERE doc_count >= 3 AND doc_count / fg > bg_count / bg
ORDER BY score DESC, key LIMIT 10
""")
def agg_significant(spark, sf):
    docs = read(spark, sf, "documents")
    out = A.significant_terms(docs, A.SignificantTerms("source", F.col("lang") == "fr", size=10))
    return out.select("key", "doc_count", "bg_count", F.round("score", 6).alias("score"))


@register("agg_date_histogram", """
WITH c AS (SELECT date_trunc('month', o_orderdate) AS b, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
s AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 MONTH)) AS b FROM c)
SELECT epoch_ms(s.b) AS key, strftime(s.b, '%Y-%m-%dT%H:%M:%S.000Z') AS key_as_string,
       CAST(coalesce(c.n, 0) AS BIGINT) AS doc_count
FROM s LEFT JOIN c ON s.b = c.b
""")
def agg_date_histogram(spark, sf):
    out = A.date_histogram(read(spark, sf, "orders"), A.DateHistogram("o_orderdate", calendar_interval="month"))
    return out.select("key", "key_as_string", "doc_count")


@register("agg_date_histogram_fixed", """
WITH c AS (SELECT CAST(floor(epoch_ms(ts) / 21600000) AS BIGINT) * 21600000 AS k, count(*) AS n
           FROM events WHERE ts IS NOT NULL GROUP BY 1),
s AS (SELECT unnest(generate_series(min(k), max(k), 21600000)) AS k FROM c)
SELECT s.k AS key, strftime(make_timestamp(s.k * 1000), '%Y-%m-%dT%H:%M:%S.000Z') AS key_as_string,
       CAST(coalesce(c.n, 0) AS BIGINT) AS doc_count
FROM s LEFT JOIN c ON s.k = c.k
""")
def agg_date_histogram_fixed(spark, sf):
    out = A.date_histogram(read(spark, sf, "events"), A.DateHistogram("ts", fixed_interval="6h"))
    return out.select("key", "key_as_string", "doc_count")


@register("agg_range", """
SELECT '*-50000.0' AS key, CAST(NULL AS DOUBLE) AS "from", 50000.0 AS "to", count(*) FILTER (WHERE o_totalprice < 50000) AS doc_count FROM orders
UNION ALL SELECT '50000.0-150000.0', 50000.0, 150000.0, count(*) FILTER (WHERE o_totalprice >= 50000 AND o_totalprice < 150000) FROM orders
UNION ALL SELECT '100000.0-300000.0', 100000.0, 300000.0, count(*) FILTER (WHERE o_totalprice >= 100000 AND o_totalprice < 300000) FROM orders
UNION ALL SELECT 'expensive', 300000.0, CAST(NULL AS DOUBLE), count(*) FILTER (WHERE o_totalprice >= 300000) FROM orders
""")
def agg_range(spark, sf):
    ranges = [{"to": 50000}, {"from": 50000, "to": 150000}, {"from": 100000, "to": 300000},
              {"from": 300000, "key": "expensive"}]
    return A.aggregate(read(spark, sf, "orders"), {"price": A.Range("o_totalprice", ranges)})["price"]


@register("agg_date_range", """
SELECT '*-1995-01-01T00:00:00.000Z' AS key, CAST(NULL AS BIGINT) AS "from", CAST(NULL AS VARCHAR) AS from_as_string,
       epoch_ms(TIMESTAMP '1995-01-01') AS "to", '1995-01-01T00:00:00.000Z' AS to_as_string,
       count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-01-01') AS doc_count FROM orders
UNION ALL SELECT '1995-01-01T00:00:00.000Z-1997-07-01T00:00:00.000Z', epoch_ms(TIMESTAMP '1995-01-01'), '1995-01-01T00:00:00.000Z',
       epoch_ms(TIMESTAMP '1997-07-01'), '1997-07-01T00:00:00.000Z',
       count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-07-01') FROM orders
UNION ALL SELECT '1997-07-01T00:00:00.000Z-*', epoch_ms(TIMESTAMP '1997-07-01'), '1997-07-01T00:00:00.000Z',
       CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),
       count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1997-07-01') FROM orders
""")
def agg_date_range(spark, sf):
    ranges = [{"to": "1995-01-01"}, {"from": "1995-01-01", "to": "1997-07-01"}, {"from": "1997-07-01"}]
    return A.date_range_agg(read(spark, sf, "orders"), A.DateRange("o_orderdate", ranges))


def synthetic_ip(df: DataFrame) -> DataFrame:
    """Events get an IPv4 address derived from their ids: 10.(user_id mod 256).(event_id div 256 mod 256).(event_id mod 256)."""
    return df.withColumn("ip", F.concat_ws(".", F.lit("10"), F.pmod("user_id", F.lit(256)).cast("string"),
                                           F.pmod(F.floor(F.col("event_id") / 256), F.lit(256)).cast("string"),
                                           F.pmod("event_id", F.lit(256)).cast("string")))


_IP_NUM = "(10 * 16777216 + (user_id % 256) * 65536 + ((event_id // 256) % 256) * 256 + (event_id % 256))"


@register("agg_ip_range", f"""
SELECT '10.0.0.0/10' AS key, '10.0.0.0' AS "from", '10.64.0.0' AS "to",
       count(*) FILTER (WHERE {_IP_NUM} >= 167772160 AND {_IP_NUM} < 171966464) AS doc_count FROM events
UNION ALL SELECT '10.64.0.0-10.128.0.0', '10.64.0.0', '10.128.0.0',
       count(*) FILTER (WHERE {_IP_NUM} >= 171966464 AND {_IP_NUM} < 176160768) FROM events
UNION ALL SELECT '10.128.0.0-*', '10.128.0.0', CAST(NULL AS VARCHAR),
       count(*) FILTER (WHERE {_IP_NUM} >= 176160768) FROM events
""")
def agg_ip_range(spark, sf):
    ev = synthetic_ip(read(spark, sf, "events"))
    ranges = [{"mask": "10.0.0.0/10"}, {"from": "10.64.0.0", "to": "10.128.0.0"}, {"from": "10.128.0.0"}]
    return A.ip_range_agg(ev, A.IpRange("ip", ranges))


@register("agg_metrics", """
SELECT round(avg(o_totalprice), 4) AS avg_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
       round(sum(o_totalprice), 2) AS sum_price, count(o_orderdate) AS n_dates,
       count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderpriority) AS n_priorities,
       round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') / 1000.0, 4) AS open_value_k
FROM orders
""")
def agg_metrics(spark, sf):
    """G7-G10, G12, G13 (exact), G16, G18 fused into one aggregation."""
    row = A.metrics(read(spark, sf, "orders"), {
        "avg_price": A.Avg("o_totalprice"), "min_price": A.Min("o_totalprice"), "max_price": A.Max("o_totalprice"),
        "sum_price": A.Sum("o_totalprice"), "n_dates": A.ValueCount("o_orderdate"),
        "n_customers": A.Cardinality("o_custkey", exact=True), "n_priorities": A.Cardinality("o_orderpriority", exact=True),
        "open_value_k": A.Custom(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))) / 1000.0),
    })
    return row.select(r4("avg_price").alias("avg_price"), "min_price", "max_price", F.round("sum_price", 2).alias("sum_price"),
                      "n_dates", "n_customers", "n_priorities", r4("open_value_k").alias("open_value_k"))


@register("agg_stats", """
SELECT count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max,
       round(avg(o_totalprice), 4) AS avg, round(sum(o_totalprice), 2) AS sum
FROM orders WHERE o_orderstatus = 'O'
""")
def agg_stats(spark, sf):
    out = A.aggregate(read(spark, sf, "orders"), {"price": A.Stats("o_totalprice")}, query=P.term("o_orderstatus", "O"))
    return out["price"].select("count", "min", "max", r4("avg").alias("avg"), F.round("sum", 2).alias("sum"))


@register("agg_mad", """
SELECT round(mad(value), 6) AS value FROM events
""")
def agg_mad(spark, sf):
    out = A.aggregate(read(spark, sf, "events"), {"mad": A.MedianAbsoluteDeviation("value")})
    return out["mad"].select(F.round("value", 6).alias("value"))


@register("agg_cardinality_exact", """
SELECT count(DISTINCT user_id) AS value FROM events
""")
def agg_cardinality_exact(spark, sf):
    return A.aggregate(read(spark, sf, "events"), {"users": A.Cardinality("user_id", exact=True)})["users"]


@register("agg_cardinality_approx")
def agg_cardinality_approx(spark, sf):
    """HLL++ sketch (no distinct shuffle); checked against the exact count within its error bound in tests."""
    return A.aggregate(read(spark, sf, "events"), {"users": A.Cardinality("user_id", rsd=0.01)})["users"]


@register("agg_top_hits", """
WITH t AS (SELECT o_orderpriority AS bucket, count(*) OVER (PARTITION BY o_orderpriority) AS total,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, CAST(o_orderkey AS VARCHAR)) AS hit_rank,
                  CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice
           FROM orders WHERE o_orderpriority IS NOT NULL)
SELECT bucket, total, hit_rank, _id, o_totalprice FROM t WHERE hit_rank <= 3
""")
def agg_top_hits(spark, sf):
    out = A.top_hits(orders(spark, sf), A.TopHits("o_orderpriority", [("o_totalprice", "desc")], size=3,
                                                  source=[ID_COL, "o_totalprice"]))
    return out.select("bucket", "total", F.col("hit_rank").cast("long").alias("hit_rank"), ID_COL, "o_totalprice")


# ----------------------------------------------------------------------------------------------------------------
# Writes (S3-S11)
# ----------------------------------------------------------------------------------------------------------------

_CUST_COLS = "_id, c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment"


def _cust_out(df: DataFrame) -> DataFrame:
    return df.select(ID_COL, "c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"),
                     "c_mktsegment")


@register("upsert", f"""
WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
ch AS (
  SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment, 1 AS ord FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_custkey, c_name, c_nationkey, c_acctbal + 2, 'UPDATED', 2 FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_suppkey + 1000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER', 3 FROM supplier),
last AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ord DESC) = 1),
merged AS (SELECT * FROM base WHERE _id NOT IN (SELECT _id FROM last)
           UNION ALL SELECT _id, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM last)
SELECT {_CUST_COLS} FROM merged
""")
def upsert(spark, sf):
    base = customers(spark, sf)
    cust = read(spark, sf, "customer")
    sup = read(spark, sf, "supplier")
    ch1 = with_id(cust, "c_custkey").withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("_ord", F.lit(1))
    ch2 = with_id(cust.filter(F.col("c_mktsegment") == "BUILDING"), "c_custkey") \
        .withColumn("c_acctbal", F.col("c_acctbal") + 2).withColumn("c_mktsegment", F.lit("UPDATED")).withColumn("_ord", F.lit(2))
    ch3 = sup.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias(ID_COL),
                     (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
                     F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
                     F.lit("SUPPLIER").alias("c_mktsegment"), F.lit(3).alias("_ord"))
    changes = ch1.unionByName(ch2).unionByName(ch3)
    return _cust_out(W.upsert(base, changes, ID_COL, "_ord"))


@register("autoid_upsert", """
SELECT CAST(2 * count(*) AS BIGINT) AS n_rows, CAST(2 * count(*) AS BIGINT) AS n_distinct_ids,
       CAST(2 * count(*) AS BIGINT) AS n_accepted FROM supplier
""")
def autoid_upsert(spark, sf):
    """S4+S5: documents without ids (each supplier twice, identical content) all kept under distinct ids."""
    sup = read(spark, sf, "supplier")
    docs = sup.unionByName(sup).select(F.monotonically_increasing_id().alias("_ord"), F.to_json(F.struct(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"))).alias("doc"))
    conformed = C.conform_json(docs, CUSTOMER, "doc", keep=["_ord"], keep_source=False)
    ok, _ = C.split_valid(conformed)
    ok = ok.withColumn(ID_COL, C.generated_id(CUSTOMER.version, [c for c in ok.columns if c != "_ord"], F.col("_ord")))
    empty = spark.createDataFrame([], CUSTOMER.struct_type())
    merged = W.upsert(empty, ok, ID_COL, "_ord")
    return merged.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(ID_COL).alias("n_distinct_ids"),
                      F.count("c_custkey").alias("n_accepted"))


@register("get_many", """
WITH r AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS _id FROM orders),
c AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, c_name, c_acctbal FROM customer)
SELECT r._id, c._id IS NOT NULL AS found, c.c_name, c.c_acctbal FROM r LEFT JOIN c ON r._id = c._id
""")
def get_many(spark, sf):
    ids = read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias(ID_COL))
    out = W.get_many(customers(spark, sf), ids)
    return out.select(ID_COL, "found", "c_name", "c_acctbal")


@register("partial_update", f"""
WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, * FROM customer)
SELECT _id, c_custkey, c_name, c_nationkey,
       round(CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END, 2) AS c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 'DELINQUENT' ELSE c_mktsegment END AS c_mktsegment
FROM base
""")
def partial_update(spark, sf):
    """Only c_acctbal and c_mktsegment change; ids from nation (N…) match nothing and are reported."""
    base = customers(spark, sf)
    delinquent = base.filter(F.col("c_acctbal") < 0).select(ID_COL, F.lit(0.0).alias("c_acctbal"),
                                                           F.lit("DELINQUENT").alias("c_mktsegment"))
    ghosts = read(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias(ID_COL),
                                             F.lit(1.0).alias("c_acctbal"), F.lit("GHOST").alias("c_mktsegment"))
    new, unmatched = W.partial_update(base, delinquent.unionByName(ghosts), ID_COL, None)
    return _cust_out(new)


@register("partial_update_unmatched", """
SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS _id FROM nation
""")
def partial_update_unmatched(spark, sf):
    base = customers(spark, sf)
    ghosts = read(spark, sf, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias(ID_COL),
                                             F.lit(1.0).alias("c_acctbal"))
    _, unmatched = W.partial_update(base, ghosts, ID_COL, None)
    return unmatched


@register("delete_ids", f"""
WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, * FROM customer)
SELECT {_CUST_COLS} FROM base
WHERE _id NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)
""")
def delete_ids(spark, sf):
    ids = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").cast("string").alias(ID_COL))
    remaining, _ = W.delete_ids(customers(spark, sf), ids)
    return _cust_out(remaining)


@register("delete_where", f"""
WITH base AS (SELECT CAST(c_custkey AS VARCHAR) AS _id, * FROM customer)
SELECT {_CUST_COLS} FROM base WHERE NOT coalesce(c_mktsegment = 'AUTOMOBILE' OR c_acctbal < 0, false)
""")
def delete_where(spark, sf):
    pred = P.bool_(should=[P.term("c_mktsegment", "AUTOMOBILE"), P.range_("c_acctbal", lt=0)])
    return _cust_out(W.delete_where(customers(spark, sf), pred))


# ----------------------------------------------------------------------------------------------------------------
# Conform, bulk reports, dynamic modes
# ----------------------------------------------------------------------------------------------------------------

def event_docs(spark, sf, bad: bool = True) -> DataFrame:
    """Events rendered as JSON documents. With ``bad``: error events carry a non-numeric value and signup events an
    undeclared field, so a strict declaration rejects both."""
    ev = read(spark, sf, "events")
    value = F.col("value").cast("string")
    extra = []
    if bad:
        value = F.when(F.col("event_type") == "error", F.lit('"n/a"')).otherwise(value)
        extra = [F.when(F.col("event_type") == "signup", F.lit(True)).alias("debug")]
    doc = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", F.try_parse_json(value).alias("value"),
                             F.try_parse_json("props").alias("props"), *extra),
                    {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return ev.select("event_id", "event_type", doc.alias("doc"))


@register("bulk_report", """
SELECT count(*) AS total, count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS succeeded,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS failed
FROM events
""")
def bulk_report(spark, sf):
    conformed = C.conform_json(event_docs(spark, sf), EVENTS, "doc", F.col("event_id"), keep_source=False)
    bad = F.size(ERRORS_COL) > 0
    return conformed.agg(F.count(F.lit(1)).alias("total"), F.count_if(~bad).alias("succeeded"),
                         F.count_if(bad).alias("failed"))


@register("bulk_failures", """
SELECT CASE WHEN event_type = 'error' THEN 'value' ELSE '_root' END AS field, count(*) AS n_failed
FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1
""")
def bulk_failures(spark, sf):
    conformed = C.conform_json(event_docs(spark, sf), EVENTS, "doc", F.col("event_id"), keep_source=False)
    _, rejected = C.split_valid(conformed)
    return rejected.select(F.explode(ERRORS_COL).alias("e")).groupBy(F.col("e.field").alias("field")) \
        .agg(F.count(F.lit(1)).alias("n_failed"))


@register("conform_events", """
SELECT CAST(event_id AS VARCHAR) AS _id, event_id, date_trunc('millisecond', ts) AS ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS INTEGER) AS props_k
FROM events
""")
def conform_events(spark, sf):
    """Every event conforms back to its typed values (date text, object with an integer)."""
    conformed = C.conform_json(event_docs(spark, sf, bad=False), EVENTS, "doc", F.col("event_id"), keep_source=False)
    ok, _ = C.split_valid(conformed)
    return ok.select(ID_COL, "event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("props_k"))


@register("conform_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority, o_orderpriority AS o_orderpriority__raw, 0 AS n_errors
FROM orders
""")
def conform_orders(spark, sf):
    """S2 + C1 + C10: orders as JSON text → typed rows, with the ``raw`` multi-field."""
    docs = read(spark, sf, "orders").select(F.to_json(F.struct("*")).alias("doc"))
    conformed = C.conform_json(docs, ORDERS, "doc", keep_source=False, id_field="o_orderkey")
    return conformed.select(ID_COL, "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                            "o_orderpriority", "o_orderpriority__raw", F.size(ERRORS_COL).alias("n_errors"))


@register("conform_epoch_dates", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderdate FROM orders
""")
def conform_epoch_dates(spark, sf):
    """The same dates given as epoch milliseconds (format alternative ``epoch_millis``)."""
    src = read(spark, sf, "orders")
    docs = src.select(F.to_json(F.struct(F.col("o_orderkey"),
                                         F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"))).alias("doc"),
                      F.col("o_orderkey").alias("k"))
    only = Collection("orders_dates", {"o_orderkey": ORDERS.fields["o_orderkey"], "o_orderdate": ORDERS.fields["o_orderdate"]})
    conformed = C.conform_json(docs, only, "doc", F.col("k"), keep_source=False)
    return conformed.select(ID_COL, "o_orderdate")


@register("conform_null_value", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, CASE WHEN c_acctbal < 0 THEN 'UNKNOWN' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def conform_null_value(spark, sf):
    """An explicit JSON null takes the declared ``null_value``."""
    cust = read(spark, sf, "customer")
    seg = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    docs = cust.select(F.col("c_custkey"), F.to_json(F.struct(F.col("c_custkey"), seg.alias("c_mktsegment")),
                                                     {"ignoreNullFields": "false"}).alias("doc"))
    coll = Collection("cust_nv", {"c_custkey": Field("long"), "c_mktsegment": Field("keyword", null_value="UNKNOWN")})
    return C.conform_json(docs, coll, "doc", F.col("c_custkey"), keep_source=False).select(ID_COL, "c_mktsegment")


@register("conform_runtime", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_totalprice FROM orders WHERE o_totalprice > 300000
""")
def conform_runtime(spark, sf):
    """Only the key is declared; the price stays in the kept source and is read as a runtime field."""
    docs = read(spark, sf, "orders").select(F.to_json(F.struct("*")).alias("doc"))
    coll = Collection("orders_rt", {"o_orderkey": Field("long")}, dynamic="runtime")
    conformed = C.conform_json(docs, coll, "doc", id_field="o_orderkey")
    price = C.runtime_field("o_totalprice", "double")
    return conformed.filter(price > 300000).select(ID_COL, price.alias("o_totalprice"))


@register("conform_strict_nested", """
SELECT count(*) AS total,
       count(*) FILTER (WHERE l_returnflag = 'R') AS rejected
FROM lineitem
""")
def conform_strict_nested(spark, sf):
    """Lineitems with a nested ``charges`` array; the nested level is strict and returned items carry
    an undeclared key there, so exactly those are rejected."""
    li = read(spark, sf, "lineitem")
    charge = lambda kind, amt, extra: F.to_json(F.struct(F.lit(kind).alias("kind"), amt.alias("amount"), *extra))
    extra = [F.when(F.col("l_returnflag") == "R", F.lit("x")).alias("note")]
    doc = F.concat(F.lit('{"id":"'), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                   F.lit('","charges":['), charge("price", F.col("l_extendedprice"), []), F.lit(","),
                   charge("tax", F.col("l_extendedprice") * F.col("l_tax"), extra), F.lit("]}"))
    coll = Collection("lines", {"id": Field("keyword"),
                                "charges": Field("nested", properties={"kind": Field("keyword"), "amount": Field("double")},
                                                 dynamic="strict")})
    conformed = C.conform_json(li.select(doc.alias("doc")), coll, "doc", keep_source=False)
    return conformed.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size(ERRORS_COL) > 0).alias("rejected"))


@register("conform_multifield_terms", """
SELECT p_brand AS key, count(*) AS doc_count FROM part WHERE p_brand IS NOT NULL
GROUP BY p_brand ORDER BY doc_count DESC, key LIMIT 10
""")
def conform_multifield_terms(spark, sf):
    """C10 + G1: terms on the keyword multi-field of a text field."""
    coll = Collection("parts", {"p_partkey": Field("long"), "p_brand": Field("text", fields={"raw": Field("keyword")})})
    docs = C.conform_frame(read(spark, sf, "part").select("p_partkey", "p_brand"), coll, F.col("p_partkey"))
    return A.terms(docs, A.Terms("p_brand__raw", size=10))


# ----------------------------------------------------------------------------------------------------------------
# Drift and evolution
# ----------------------------------------------------------------------------------------------------------------

def drifted_event_docs(spark, sf) -> DataFrame:
    """Events as JSON where purchases gain a ``coupon`` string and clicks carry ``props.k`` as a string."""
    ev = read(spark, sf, "events")
    props = F.when(F.col("event_type") == "click",
                   F.to_json(F.struct(F.try_variant_get(F.try_parse_json("props"), "$.k", "string").alias("k"))))\
        .otherwise(F.col("props"))
    coupon = F.when(F.col("event_type") == "purchase", F.lit("C1"))
    doc = F.to_json(F.struct("event_id", "user_id", "event_type", F.try_parse_json(F.col("value").cast("string")).alias("value"),
                             F.try_parse_json(props).alias("props"), coupon.alias("coupon")))
    return ev.select(doc.alias("doc"))


@register("drift_report", """
WITH e AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events),
obs AS (
  SELECT 'event_id' AS path, 'long' AS kind, count(*) AS n FROM e
  UNION ALL SELECT 'user_id', 'long', count(*) FROM e
  UNION ALL SELECT 'event_type', 'string', count(*) FROM e
  UNION ALL SELECT 'value', CASE WHEN value = floor(value) THEN 'long' ELSE 'double' END, count(*) FROM e WHERE value IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'props', 'object', count(*) FROM e
  UNION ALL SELECT 'props.k', CASE WHEN event_type = 'click' THEN 'string' ELSE 'long' END, count(*) FROM e GROUP BY 2
  UNION ALL SELECT 'coupon', 'string', count(*) FROM e WHERE event_type = 'purchase'),
decl AS (SELECT * FROM (VALUES ('event_id', 'long'), ('ts', 'date'), ('user_id', 'long'), ('event_type', 'keyword'),
                               ('value', 'double'), ('props', 'object'), ('props.k', 'integer')) AS t(path, declared_type))
SELECT coalesce(obs.path, decl.path) AS path, obs.kind AS observed_kind, decl.declared_type,
       CASE WHEN decl.declared_type IS NULL THEN 'added' WHEN obs.kind IS NULL THEN 'removed'
            WHEN (decl.declared_type IN ('long', 'integer') AND obs.kind = 'long')
              OR (decl.declared_type IN ('double', 'float') AND obs.kind IN ('long', 'double'))
              OR (decl.declared_type = 'keyword' AND obs.kind IN ('string', 'long', 'double', 'boolean'))
              OR (decl.declared_type = 'object' AND obs.kind = 'object') THEN 'same' ELSE 'changed' END AS change,
       CAST(coalesce(obs.n, 0) AS BIGINT) AS n_docs
FROM obs FULL OUTER JOIN decl ON obs.path = decl.path
""")
def drift_report(spark, sf):
    docs = drifted_event_docs(spark, sf)
    return D.drift_report(docs, F.try_parse_json("doc"), EVENTS, depth=2)


@register("dynamic_widen", """
SELECT * FROM (VALUES ('coupon', 'text'), ('event_id', 'long'), ('event_type', 'keyword'), ('props', 'object'),
                      ('user_id', 'long'), ('value', 'float')) AS t(path, field_type)
WHERE (SELECT count(*) FROM events) > 0
""")
def dynamic_widen(spark, sf):
    """C4 + C9: undeclared fields seen in the data become typed fields (string → text unless a template says
    otherwise; here ``event_type`` matches a keyword template)."""
    from ..schema import DynamicTemplate
    docs = drifted_event_docs(spark, sf)
    coll = Collection("ev_dyn", {"event_id": Field("long")}, dynamic=True,
                      dynamic_templates=(DynamicTemplate("types_as_keyword", Field("keyword"), match_mapping_type="string",
                                                         match="*_type"),))
    seen = C.observed_paths(docs, F.try_parse_json("doc")).select("path", "kind").collect()    # one row per path and kind
    wide = C.widen(coll, [(r["path"], r["kind"]) for r in seen])
    rows = sorted((k, f.type) for k, f in wide.fields.items())
    return spark.createDataFrame(rows, "path string, field_type string")


EVOLVE_V1 = Collection("cust_evo", {
    "c_custkey": Field("long"), "c_name": Field("keyword"), "c_nationkey": Field("integer"), "c_acctbal": Field("double"),
    "c_mktsegment": Field("keyword"), "address": Field("object", properties={"nation": Field("integer")}),
})
EVOLVE_V2 = Collection("cust_evo", {
    **EVOLVE_V1.fields, "c_phone": Field("keyword"),
    "address": Field("object", properties={"nation": Field("integer"), "region": Field("integer")}),
})


@register("evolve_additive", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS c_phone, c_nationkey AS address_nation, CAST(NULL AS INTEGER) AS address_region
FROM customer
""")
def evolve_additive(spark, sf):
    """C12 + C13: the v2 declaration only adds fields (one nested), so stored rows gain typed nulls."""
    cust = customers(spark, sf)
    stored = cust.select(ID_COL, "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                         F.struct(F.col("c_nationkey").alias("nation")).alias("address"))
    diff = D.diff_collections(EVOLVE_V2, EVOLVE_V1)
    assert diff.added_fields == ["address.region", "c_phone"] or set(diff.added_fields) == {"address.region", "c_phone"}
    out = D.evolve_additive(stored, EVOLVE_V1, EVOLVE_V2)
    return out.select(ID_COL, "c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"),
                      "c_mktsegment", "c_phone", F.col("address.nation").alias("address_nation"),
                      F.col("address.region").alias("address_region"))


@register("rebuild_version", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS c_phone
FROM customer
""")
def rebuild_version(spark, sf):
    """Publish customer as v1 behind a logical name, rebuild it as v2, read through the name."""
    from ..sources.store import DocStore
    prep(spark)
    db = "docspark_catalog"
    loc = ensure_checkpoint_dir(spark).rstrip("/") + "/" + db
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}'")
    store = DocStore(spark, database=db)
    name = "cust_" + uuid.uuid4().hex[:8]
    v1 = Collection(name, {k: CUSTOMER.fields[k] for k in CUSTOMER.fields})
    v2 = Collection(name, {**v1.fields, "c_phone": Field("keyword")}, version=2)
    content = customers(spark, sf).select(ID_COL, *CUSTOMER.fields)
    store.create(v1, content)
    res = store.migrate(v1, v2, delete_old=True)
    assert res.to_index == v2.physical_name
    return store.read(name).select(ID_COL, "c_custkey", "c_name", "c_nationkey", F.round("c_acctbal", 2).alias("c_acctbal"),
                                   "c_mktsegment", "c_phone")


# ----------------------------------------------------------------------------------------------------------------
# Scans (S15, U1, U2)
# ----------------------------------------------------------------------------------------------------------------

_LINE_ID = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)"


@register("scan_batches", f"""
WITH d AS (SELECT {_LINE_ID} AS _id, l_shipdate FROM lineitem)
SELECT _id, CAST(row_number() OVER (ORDER BY l_shipdate ASC NULLS LAST, _id) - 1 AS BIGINT) AS row_index,
       CAST((row_number() OVER (ORDER BY l_shipdate ASC NULLS LAST, _id) - 1) // 1000 AS BIGINT) AS batch_id
FROM d
""")
def scan_batches(spark, sf):
    li = with_id(read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = S.scan_batches(li.select(ID_COL, "l_shipdate"), sort=["l_shipdate"], batch_size=1000)
    return out.select(ID_COL, "row_index", "batch_id")


@register("scan_consumer", f"""
WITH d AS (SELECT {_LINE_ID} AS _id, l_shipdate, l_quantity FROM lineitem WHERE l_returnflag <> 'R'),
i AS (SELECT (row_number() OVER (ORDER BY l_shipdate ASC NULLS LAST, _id) - 1) // 1000 AS batch_id, l_quantity FROM d)
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n, round(sum(l_quantity), 4) AS sum_qty FROM i GROUP BY batch_id
""")
def scan_consumer(spark, sf):
    """S15 with a query, U2 consumer per batch (pandas, one batch of at most 1000 rows per call)."""
    li = with_id(read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    batches = S.scan_batches(li.select(ID_COL, "l_shipdate", "l_quantity", "l_returnflag"),
                             query=F.col("l_returnflag") != "R", sort=["l_shipdate"], batch_size=1000)

    def consume(pdf):
        import pandas as pd
        return pd.DataFrame({"batch_id": [int(pdf["batch_id"].iloc[0])], "n": [len(pdf)],
                             "sum_qty": [round(float(pdf["l_quantity"].sum()), 4)]})

    return S.for_each_batch(batches.select("batch_id", "row_index", "l_quantity"), consume,
                            "batch_id long, n long, sum_qty double").select("batch_id", "n", r4("sum_qty").alias("sum_qty"))


# ----------------------------------------------------------------------------------------------------------------
# Text (T1-T8, P4, O5)
# ----------------------------------------------------------------------------------------------------------------

_TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


@register("tokens", f"""
WITH t AS (SELECT doc_id, {_TOKENS_SQL} AS toks FROM documents)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token
FROM t, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)
""")
def tokens(spark, sf):
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id")


# The user dictionary used by the dictionary query (words seen at the start of tokens in the data).
DICT_RULES = ("eau", "ouen ou en", "ment", "tion", "the", "nd")


def _dict_sql(rules, mode: str) -> str:
    words = {}
    for r in rules:
        ws = r.split()
        words[ws[0]] = ws[1:]
    order = sorted(words, key=len, reverse=True)
    match = "CASE " + " ".join(f"WHEN starts_with(t, '{w}') THEN '{w}'" for w in order) + " END"
    parts = "CASE " + " ".join(f"WHEN p.w = '{w}' THEN [{', '.join(repr(x) for x in ps)}]::VARCHAR[]"
                               for w, ps in words.items()) + " END"
    if mode == "none":
        emitted = "[p.w]"
    elif mode == "discard":
        emitted = f"CASE WHEN len({parts}) > 0 THEN {parts} ELSE [p.w] END"
    else:
        emitted = f"list_concat([p.w], {parts})"
    seg = (f"CASE WHEN p.w IS NULL THEN [p.t] ELSE list_concat({emitted}, "
           f"CASE WHEN length(p.t) > length(p.w) THEN [substr(p.t, length(p.w) + 1)] ELSE []::VARCHAR[] END) END")
    return (f"WITH t0 AS (SELECT doc_id, {_TOKENS_SQL} AS toks FROM documents), "
            f"t1 AS (SELECT doc_id, list_transform(toks, lambda t: {{'t': t, 'w': {match}}}) AS pairs FROM t0), "
            f"t2 AS (SELECT doc_id, flatten(list_transform(pairs, lambda p: {seg})) AS toks FROM t1) "
            f"SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token "
            f"FROM t2, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)")


@register("dict_tokens", _dict_sql(DICT_RULES, "mixed"))
def dict_tokens(spark, sf):
    """Longest dictionary prefix split off; compound rule emits word and parts (mixed)."""
    an = X.Analyzer(user_dictionary=DICT_RULES, decompound="mixed")
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", an)


@register("dict_tokens_discard", _dict_sql(DICT_RULES, "discard"))
def dict_tokens_discard(spark, sf):
    an = X.Analyzer(user_dictionary=DICT_RULES, decompound="discard")
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", an)


# Synonym rules used by the synonym query.
SYN_RULES = ("the, le, der", "and => et")


@register("synonym_tokens", f"""
WITH t AS (SELECT doc_id, flatten(list_transform({_TOKENS_SQL}, lambda x: CASE
              WHEN x IN ('the', 'le', 'der') THEN ['the', 'le', 'der']
              WHEN x = 'and' THEN ['et'] ELSE [x] END)) AS toks FROM documents)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token
FROM t, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)
""")
def synonym_tokens(spark, sf):
    """The search-time chain (synonyms) applied to the text as a query."""
    an = X.Analyzer(synonyms=SYN_RULES)
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", an, search_time=True)


MATCH_QUERY = "The ment, EAU and qui"
_MATCH_TOKENS = ["the", "ment", "eau", "and", "qui"]


def _bm25_sql(where: str = "", top: str = "") -> str:
    q = ", ".join(f"'{t}'" for t in _MATCH_TOKENS)
    return f"""
WITH d AS (SELECT doc_id, lang, {_TOKENS_SQL} AS toks FROM documents),
q AS (SELECT unnest([{q}]) AS t),
s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
tf AS (SELECT d.doc_id, d.lang, q.t, len(list_filter(d.toks, lambda x: x = q.t)) AS tf, len(d.toks) AS dl FROM d, q),
dfq AS (SELECT t, count(*) FILTER (WHERE tf > 0) AS df FROM tf GROUP BY t),
sc AS (SELECT tf.doc_id, sum(ln(1 + (s.n - dfq.df + 0.5) / (dfq.df + 0.5)) * tf.tf * 2.2
                          / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / s.avgdl))) AS score
       FROM tf JOIN dfq ON tf.t = dfq.t, s WHERE tf.tf > 0 {where} GROUP BY tf.doc_id)
{top}
"""


@register("match_bm25", _bm25_sql(top="SELECT doc_id, round(score, 6) AS score FROM sc"))
def match_bm25(spark, sf):
    """P4 + T7 + T8: every document matching any query token, with its BM25 score."""
    out = X.bm25(read(spark, sf, "documents"), "text", MATCH_QUERY, "doc_id")
    return out.select("doc_id", F.round("_score", 6).alias("score"))


@register("match_bool_top", _bm25_sql(where="AND tf.lang = 'en'", top="""
SELECT row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS rank, doc_id, round(score, 6) AS score
FROM sc ORDER BY rank LIMIT 20
"""))
def match_bool_top(spark, sf):
    """P5 + O5: bool(must=match, filter=lang) sorted by score; statistics over the whole collection."""
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang")
    coll = Collection("documents", {"doc_id": Field("long"), "text": Field("text"), "lang": Field("keyword")})
    res = X.match_search(docs, coll, "text", MATCH_QUERY, filter=P.term("lang", "en"), size=20, id_col="doc_id")
    page = res.page.withColumn("score", F.round("_score", 6))
    # rank by the rounded score (ties then by id), the same key the oracle orders by
    w = Window.orderBy(F.desc("score"), F.asc("doc_id"))      # over the 20-row page only
    return page.select("doc_id", "score").withColumn("rank", F.row_number().over(w).cast("long")) \
        .select("rank", "doc_id", "score")


# ----------------------------------------------------------------------------------------------------------------
# Stored templates
# ----------------------------------------------------------------------------------------------------------------

@register("search_template", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_totalprice >= 200000
ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 10
""")
def search_template(spark, sf):
    from ..operators.templates import TemplateRegistry
    reg = TemplateRegistry()
    reg.put("orders_by_priority",
            "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderpriority = :priority "
            "AND o_totalprice >= :min_price ORDER BY o_totalprice DESC, o_orderkey LIMIT :size OFFSET :from")
    return reg.search(spark, "orders_by_priority", {"priority": "2-HIGH", "min_price": 200000},
                      size=25, from_=10, frames={"orders": read(spark, sf, "orders")})


# ----------------------------------------------------------------------------------------------------------------
# More paths: keyset with nulls, bool clauses, stoptags, token index, multi-valued counts, unmatched deletes
# ----------------------------------------------------------------------------------------------------------------

@register("cursor_nulls_mixed", """
WITH d AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id,
                  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio, o_totalprice
           FROM orders)
SELECT row_number() OVER (ORDER BY prio DESC NULLS LAST, o_totalprice ASC, _id) AS rank, _id, prio, o_totalprice
FROM d ORDER BY prio DESC NULLS LAST, o_totalprice ASC, _id LIMIT 100 OFFSET 200
""")
def cursor_nulls_mixed(spark, sf):
    """O9 with a nullable first key (nulls last) in descending order: the third cursor page of 100."""
    df = orders(spark, sf).select(ID_COL, F.when(F.col("o_orderstatus") == "P", F.lit(None))
                                  .otherwise(F.col("o_orderpriority")).alias("prio"), "o_totalprice")
    sort = [("prio", "desc"), ("o_totalprice", "asc")]
    cursor = None
    for _ in range(2):
        cursor = Q.search(df, None, sort=sort, size=100, after=cursor).next_cursor()
    res = Q.search(df, None, sort=sort, size=100, after=cursor)
    return Q.with_rank(res.page, res.specs, offset=200).select("rank", ID_COL, "prio", "o_totalprice")


@register("search_bool_clauses", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus, o_orderpriority, o_totalprice FROM orders
WHERE o_totalprice >= 50000
  AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH' OR o_totalprice > 400000)
  AND NOT coalesce(o_orderstatus = 'F', false)
""")
def search_bool_clauses(spark, sf):
    """P5: filter + should (one must match) + must_not; every matching document."""
    q = P.bool_(filter=[P.range_("o_totalprice", gte=50000)],
                should=[P.term("o_orderpriority", "1-URGENT"), P.term("o_orderpriority", "2-HIGH"),
                        P.range_("o_totalprice", gt=400000)],
                minimum_should_match=1, must_not=[P.term("o_orderstatus", "F")])
    return Q.search(orders(spark, sf), q).filtered.select(ID_COL, "o_orderstatus", "o_orderpriority", "o_totalprice")


@register("tokens_stoptags", rf"""
WITH t AS (SELECT doc_id, list_filter({_TOKENS_SQL}, lambda x: NOT regexp_full_match(x, '\p{{N}}+')) AS toks FROM documents)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token
FROM t, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)
""")
def tokens_stoptags(spark, sf):
    """T5: tokens tagged as numbers (SN) removed by the part-of-speech filter."""
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", X.Analyzer(stoptags=("SN",)))


@register("match_token_index", _bm25_sql(top="SELECT doc_id, round(score, 6) AS score FROM sc"))
def match_token_index(spark, sf):
    """T7 + T8 through a persisted token index (terms sorted by token, lengths) in the checkpoint folder."""
    from .sizing import scratch_path
    docs = read(spark, sf, "documents")
    path = scratch_path(spark, "token-index")
    X.build_token_index(docs, "text", path, id_col="doc_id")
    return X.match_index(spark, path, MATCH_QUERY, id_col="doc_id").select("doc_id", F.round("_score", 6).alias("score"))


@register("agg_value_count_multi", rf"""
SELECT CAST(sum(len({_TOKENS_SQL})) AS BIGINT) AS n_tokens,
       CAST(count(*) AS BIGINT) AS n_docs,
       count(DISTINCT lang) AS n_langs
FROM documents
""")
def agg_value_count_multi(spark, sf):
    """G12 on a multi-valued field (every array element counts) fused with other metrics."""
    docs = read(spark, sf, "documents").select("doc_id", "lang", X.analyze(F.col("text")).alias("words"))
    return A.metrics(docs, {"n_tokens": A.ValueCount("words", multi=True), "n_docs": A.ValueCount("doc_id"),
                            "n_langs": A.Cardinality("lang", exact=True)})


@register("delete_ids_unmatched", """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS _id FROM orders
WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL
  AND CAST(o_custkey AS VARCHAR) NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)
""")
def delete_ids_unmatched(spark, sf):
    """The requested ids that matched no stored document are reported."""
    ids = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").cast("string").alias(ID_COL))
    _, unmatched = W.delete_ids(customers(spark, sf), ids)
    return unmatched


@register("agg_top_hits_all", """
SELECT '_all' AS bucket, count(*) OVER () AS total,
       row_number() OVER (ORDER BY l_extendedprice DESC, _id) AS hit_rank, _id, l_extendedprice
FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
                 || '-' || CAST(l_suppkey AS VARCHAR) AS _id FROM lineitem)
QUALIFY hit_rank <= 5
""")
def agg_top_hits_all(spark, sf):
    """G14 without buckets: the five most expensive line items and the total."""
    li = with_id(read(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = A.top_hits(li, A.TopHits(None, [("l_extendedprice", "desc")], size=5, source=[ID_COL, "l_extendedprice"]))
    return out.select("bucket", "total", F.col("hit_rank").cast("long").alias("hit_rank"), ID_COL, "l_extendedprice")


# ----------------------------------------------------------------------------------------------------------------
# Writes through the store: undeclared fields, ids, rebuilds, settings, snapshots
# ----------------------------------------------------------------------------------------------------------------

def _store(spark):
    from ..sources.store import DocStore
    prep(spark)
    db = "docspark_catalog"
    loc = ensure_checkpoint_dir(spark).rstrip("/") + "/" + db
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{loc}'")
    return DocStore(spark, database=db)


def _named(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _order_docs(spark, sf) -> DataFrame:
    """Orders as JSON; priority, an array and a deep object are undeclared."""
    o = read(spark, sf, "orders")
    doc = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.array("o_orderkey", "o_custkey").alias("keys"),
        F.struct(F.struct(F.struct(F.col("o_custkey").alias("c")).alias("b")).alias("a")).alias("deep")))
    return o.select(doc.alias("doc"))


@register("bulk_dynamic_true", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, o_orderpriority AS priority, o_orderpriority AS priority_raw,
       o_orderkey AS key0, o_custkey AS key1, o_custkey AS deep_c FROM orders
""")
def bulk_dynamic_true(spark, sf):
    """S4 + C4: a bulk write turns undeclared keys into typed columns: text with a keyword, a multi-valued long, an
    object three levels deep."""
    store, coll = _store(spark), Collection(_named("dyn"), {"id": Field("keyword"), "status": Field("keyword")})
    store.create(coll)
    store.bulk_index(coll, _order_docs(spark, sf), id_field="id")
    return store.read(coll.name).select(ID_COL, "status", "priority", F.col("priority__keyword").alias("priority_raw"),
                                        F.col("keys")[0].alias("key0"), F.col("keys")[1].alias("key1"),
                                        F.col("deep.a.b.c").alias("deep_c"))


@register("bulk_dynamic_false_source", """
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, o_orderpriority AS priority, o_custkey AS deep_c, 4 AS columns
FROM orders
""")
def bulk_dynamic_false_source(spark, sf):
    """S4 + C5: with dynamic false undeclared keys get no column and stay in the stored document."""
    store = _store(spark)
    coll = Collection(_named("fixed"), {"id": Field("keyword"), "status": Field("keyword")}, dynamic=False)
    store.create(coll)
    store.bulk_index(coll, _order_docs(spark, sf), id_field="id")
    rows = store.read(coll.name)
    return rows.select(ID_COL, "status", F.try_variant_get("_source", "$.priority", "string").alias("priority"),
                       F.try_variant_get("_source", "$.deep.a.b.c", "bigint").alias("deep_c"),
                       F.lit(len(rows.columns)).alias("columns"))


@register("bulk_runtime_stored", """
SELECT o_orderpriority AS key, count(*) AS doc_count FROM orders GROUP BY 1
""")
def bulk_runtime_stored(spark, sf):
    """An undeclared field of a stored collection, read at query time and aggregated."""
    store = _store(spark)
    coll = Collection(_named("run"), {"id": Field("keyword")}, dynamic="runtime")
    store.create(coll)
    store.bulk_index(coll, _order_docs(spark, sf), id_field="id")
    rows = store.read(coll.name).select(C.runtime_field("priority", "string").alias("priority"))
    return A.terms(rows, A.Terms("priority", size=100))


@register("bulk_missing_ids", """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS given_id, o_custkey AS cust,
       true AS id_ok FROM orders
""")
def bulk_missing_ids(spark, sf):
    """Where the id selector yields nothing the document gets an id of its own; no document is lost."""
    store = _store(spark)
    coll = Collection(_named("ids"), {"id": Field("keyword"), "cust": Field("long")}, dynamic=False)
    store.create(coll)
    o = read(spark, sf, "orders")
    given = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey").cast("string"))
    docs = o.select(F.to_json(F.struct(given.alias("id"), F.col("o_custkey").alias("cust"))).alias("doc"))
    store.bulk_index(coll, docs, id_expr=F.try_variant_get(F.try_parse_json("doc"), "$.id", "string"))
    return store.read(coll.name).select(F.col("id").alias("given_id"), "cust", F.coalesce(
        F.col("id") == F.col(ID_COL), F.length(ID_COL) == 32).alias("id_ok"))


@register("autoid_two_batches", """
SELECT c_mktsegment AS segment, 2 * count(*) AS docs, 2 * count(*) AS ids FROM customer GROUP BY 1
""")
def autoid_two_batches(spark, sf):
    """The same documents without ids, written twice, are stored twice."""
    store = _store(spark)
    coll = Collection(_named("auto"), {"segment": Field("keyword")}, dynamic=False)
    store.create(coll)
    docs = read(spark, sf, "customer").select(F.to_json(F.struct(F.col("c_mktsegment").alias("segment"))).alias("doc"))
    for _ in range(2):
        store.bulk_index(coll, docs)
    return store.read(coll.name).groupBy("segment").agg(F.count("*").alias("docs"), F.countDistinct(ID_COL).alias("ids"))


@register("rebuild_strict_multifield", """
SELECT CAST(p_partkey AS VARCHAR) AS _id, p_brand AS brand, p_brand AS brand_raw, CAST(NULL AS BIGINT) AS stock FROM part
""")
def rebuild_strict_multifield(spark, sf):
    """A strict collection with a multi-field is rebuilt under a version that adds a field."""
    store, name = _store(spark), _named("strict")
    fields = {"id": Field("keyword"), "brand": Field("text", fields={"raw": Field("keyword")})}
    v1 = Collection(name, fields, dynamic="strict")
    v2 = Collection(name, {**fields, "stock": Field("long")}, version=2, dynamic="strict")
    store.create(v1)
    docs = read(spark, sf, "part").select(F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"),
                                                             F.col("p_brand").alias("brand"))).alias("doc"))
    store.bulk_index(v1, docs, id_field="id")
    store.migrate(v1, v2)
    return store.read(name).select(ID_COL, "brand", F.col("brand__raw").alias("brand_raw"), "stock")


_NULL_DOCS = """CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'NONE' ELSE NULL END"""


@register("rebuild_null_value", f"""
SELECT CAST(c_custkey AS VARCHAR) AS _id, {_NULL_DOCS} AS before, {_NULL_DOCS} AS after FROM customer
""")
def rebuild_null_value(spark, sf):
    """C2 + S13: an explicit null takes the declared null value, an absent field none, before and after a rebuild."""
    store, name = _store(spark), _named("nulls")
    fields = {"id": Field("keyword"), "segment": Field("keyword", null_value="NONE")}
    v1, v2 = (Collection(name, fields, version=v, dynamic="strict") for v in (1, 2))
    store.create(v1)
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    docs = read(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 3 == 0, F.to_json(F.struct(key.alias("id"), segment.alias("segment"))))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit('{"id":"'), key, F.lit('","segment":null}')))
        .otherwise(F.to_json(F.struct(key.alias("id")))).alias("doc"))
    store.bulk_index(v1, docs, id_field="id")
    before = store.read_snapshot(store.snapshot(name)).select(ID_COL, F.col("segment").alias("before"))
    store.migrate(v1, v2)
    return store.read(name).select(ID_COL, F.col("segment").alias("after")).join(before, ID_COL)


@register("evolve_stored", """
SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS name, CAST(NULL AS DOUBLE) AS rating, 'rating' AS added, 'name' AS refused
FROM supplier
""")
def evolve_stored(spark, sf):
    """C12 + C13: declarations against what is stored: an addition is published, a change is refused."""
    from ..errors import BreakingChangeError
    store, name = _store(spark), _named("evo")
    v1 = Collection(name, {"id": Field("keyword"), "name": Field("keyword")}, dynamic=False)
    store.create(v1)
    docs = read(spark, sf, "supplier").select(F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("id"),
                                                                 F.col("s_name").alias("name"))).alias("doc"))
    store.bulk_index(v1, docs, id_field="id")
    wider = Collection(name, {**v1.fields, "rating": Field("double")}, dynamic=False)
    added = store.schema_diff(wider).added_fields
    store.sync(wider)
    refused = []
    try:
        store.sync(Collection(name, {**wider.fields, "name": Field("text")}, dynamic=False))
    except BreakingChangeError as e:
        refused = e.changed_fields
    return store.read(name).select(ID_COL, "name", "rating", F.lit(",".join(added)).alias("added"),
                                   F.lit(",".join(refused)).alias("refused"))


@register("bulk_sharded_analyzed", """
SELECT CAST(p_partkey AS VARCHAR) AS _id, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' two' ELSE p_brand || ' one' END AS label,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS size, CAST(NULL AS BIGINT) AS stock, 4 AS files,
       (SELECT count(*) FROM part WHERE p_partkey % 2 = 0) AS hits, 'num_shards' AS refused FROM part
""")
def bulk_sharded_analyzed(spark, sf):
    """S4 + C13: two bulk writes, an additive sync and an analysed search on a collection with shards and an analyser;
    the write keeps one file a bucket, and another number of shards is refused."""
    from ..errors import BreakingChangeError
    store, settings = _store(spark), {"analysis": {"plain": X.Analyzer()}}
    fields = {"id": Field("keyword"), "label": Field("text", analyzer="plain")}
    coll = Collection(_named("shards"), fields, num_shards=4, settings=settings)
    store.create(coll)
    p = read(spark, sf, "part")
    key = F.col("p_partkey").cast("string").alias("id")
    one = p.select(F.to_json(F.struct(key, F.concat("p_brand", F.lit(" one")).alias("label"))).alias("doc"))
    two = p.where("p_partkey % 2 = 0").select(F.to_json(F.struct(key, F.concat("p_brand", F.lit(" two")).alias("label"),
                                                                F.col("p_size").alias("size"))).alias("doc"))
    store.bulk_index(coll, one, id_field="id")
    store.bulk_index(coll, two, id_field="id")
    files = len(store.read(coll.name).inputFiles())
    wider = replace(coll, fields={**fields, "stock": Field("long")})
    store.sync(wider)
    refused = []
    try:
        store.sync(replace(wider, num_shards=5))
    except BreakingChangeError as e:
        refused = [c.removeprefix("settings.") for c in e.changed_fields]
    rows = store.read(coll.name)
    hits = X.match_search(rows, wider, "label", "TWO", size=1).total()
    return rows.select(ID_COL, "label", "size", "stock", F.lit(files).alias("files"), F.lit(hits).cast("long").alias("hits"),
                       F.lit(",".join(refused)).alias("refused"))


def _customers(spark, sf, fields: dict, doc: Column, **options):
    """A store with the customers as documents under the given fields."""
    store = _store(spark)
    coll = Collection(_named("cust"), fields, **options)
    store.create(coll)
    store.bulk_index(coll, read(spark, sf, "customer").select(doc.alias("doc")), id_field="id")
    return store, coll


def _cust_id() -> Column:
    return F.col("c_custkey").cast("string")


@register("update_multifield", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_mktsegment ELSE c_name END AS name,
       CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_mktsegment ELSE c_name END AS name_raw, c_nationkey AS nation,
       CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE NULL END AS city, c_custkey AS kept FROM customer
""")
def update_multifield(spark, sf):
    """S9 + C10: an update of a nested document sets the field, its multi-field and one nested key; the other nested
    keys, declared or not, stay."""
    home = F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_custkey").alias("k")).alias("free"))
    store, coll = _customers(spark, sf, {
        "id": Field("keyword"), "name": Field("text", fields={"raw": Field("keyword")}),
        "home": Field("object", properties={"nation": Field("integer"), "city": Field("long")})},
        F.to_json(F.struct(_cust_id().alias("id"), F.col("c_name").alias("name"), home.alias("home"))), dynamic=False)
    part = F.to_json(F.struct(F.concat(F.lit("new "), "c_mktsegment").alias("name"),
                              F.struct(F.col("c_custkey").alias("city")).alias("home")))
    store.update_docs(coll, read(spark, sf, "customer").where("c_custkey % 3 = 0").select(_cust_id().alias(ID_COL), part.alias("doc")))
    return store.read(coll.name).select(ID_COL, "name", F.col("name__raw").alias("name_raw"), "home.nation", "home.city",
                                        F.try_variant_get("_source", "$.home.free.k", "bigint").alias("kept"))


@register("update_null_value", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, CASE c_custkey % 3 WHEN 0 THEN 'NONE' ELSE c_mktsegment END AS segment,
       CASE c_custkey % 3 WHEN 1 THEN NULL ELSE c_nationkey END AS nation FROM customer
""")
def update_null_value(spark, sf):
    """S9 + C2: an update to null takes the declared null value, or clears a field that has none."""
    store, coll = _customers(spark, sf, {"id": Field("keyword"), "segment": Field("keyword", null_value="NONE"), "nation": Field("integer")},
                             F.to_json(F.struct(_cust_id().alias("id"), F.col("c_mktsegment").alias("segment"),
                                                F.col("c_nationkey").alias("nation"))), dynamic="strict")
    c = read(spark, sf, "customer")
    part = F.when(F.col("c_custkey") % 3 == 0, '{"segment":null}').when(F.col("c_custkey") % 3 == 1, '{"nation":null}')
    store.update_docs(coll, c.select(_cust_id().alias(ID_COL), part.alias("doc")).where("doc IS NOT NULL"))
    return store.read(coll.name).select(ID_COL, "segment", "nation")


@register("update_bad_values", """
SELECT CAST(c_custkey AS VARCHAR) AS _id, CASE c_custkey % 5 WHEN 0 THEN 'bad' WHEN 1 THEN 'updated' ELSE 'same' END AS state,
       CASE c_custkey % 5 WHEN 1 THEN -1 ELSE c_nationkey END AS nation,
       CASE c_custkey % 5 WHEN 0 THEN 'expected a number' END AS reason,
       (SELECT count(*) FROM customer WHERE c_custkey % 5 = 2) AS unmatched FROM customer
""")
def update_bad_values(spark, sf):
    """S9 + S6: of one batch the good changes are made, the bad ones reported by document, the others named as unmatched."""
    store, coll = _customers(spark, sf, {"id": Field("keyword"), "nation": Field("integer")},
                             F.to_json(F.struct(_cust_id().alias("id"), F.col("c_nationkey").alias("nation"))), dynamic="strict")
    c, rest = read(spark, sf, "customer"), F.col("c_custkey") % 5
    key = F.when(rest == 2, F.concat(F.lit("x"), _cust_id())).otherwise(_cust_id()).alias(ID_COL)
    part = F.when(rest == 0, '{"nation":"many"}').otherwise('{"nation":-1}').alias("doc")
    res = store.update_docs(coll, c.where(rest <= 2).select(key, part))
    bad = res.failed_docs.select(ID_COL, F.col("_errors")[0]["reason"].alias("reason"))
    state = F.when(F.col("reason").isNotNull(), "bad").when(F.col("nation") == -1, "updated").otherwise("same")
    return store.read(coll.name).join(bad, ID_COL, "left").select(ID_COL, state.alias("state"), "nation", "reason",
                                                                F.lit(res.unmatched).cast("long").alias("unmatched"))


@register("bulk_odd_keys", """
SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS upper, CAST(s_nationkey AS BIGINT) AS lower, s_suppkey AS dotted, s_suppkey + 1 AS ticked,
       s_suppkey + 2 AS system, s_name AS title, CAST(s_nationkey AS BIGINT) AS clash, s_suppkey + 3 AS inner_upper, s_suppkey + 4 AS inner_lower
FROM supplier
""")
def bulk_odd_keys(spark, sf):
    """C4: keys that differ by case, hold dots or backticks, or are named like system or multi-field columns."""
    store = _store(spark)
    coll = Collection(_named("odd"), {"id": Field("keyword"), "title": Field("text", fields={"raw": Field("keyword")})})
    store.create(coll)
    number = lambda k: (F.col("s_suppkey") + k).cast("string")                                             # noqa: E731
    name, nation = F.concat(F.lit('"'), "s_name", F.lit('"')), F.col("s_nationkey").cast("string")
    pairs = [("id", F.concat(F.lit('"'), number(0), F.lit('"'))), ("Name", name), ("name", nation),
             ("a.b", number(0)), ("e`f", number(1)), ("_source", number(2)), ("title", name),
             ("title__raw", nation)]
    inner = F.concat(F.lit('"o":{"In":'), number(3), F.lit(',"in":'), number(4), F.lit("}}"))
    doc = F.concat(F.lit("{"), *[F.concat(F.lit(f'"{k}":'), v, F.lit(",")) for k, v in pairs], inner)
    store.bulk_index(coll, read(spark, sf, "supplier").select(doc.alias("doc")), id_field="id")
    names = coll.with_fields({k: Field.from_mapping(m) for k, m in store.stored_mapping(coll.name).items()})
    paths = {"upper": "Name", "lower": "name", "dotted": r"a\.b", "ticked": "e`f", "system": "_source", "title": "title",
             "clash": "title__raw", "inner_upper": "o.In", "inner_lower": "o.in"}
    return store.read(coll.name).select(ID_COL, *[F.col(names.column_of(p)).alias(c) for c, p in paths.items()])


@register("snapshot_pins", """
SELECT CAST(s_suppkey AS VARCHAR) AS _id, round(s_acctbal, 2) AS pinned, true AS survived, true AS gone FROM supplier
""")
def snapshot_pins(spark, sf):
    """The table of an open snapshot outlives a rebuild that drops the old version and a clean-up; closed, it goes."""
    store = _store(spark)
    coll = Collection(_named("pin"), {"id": Field("keyword"), "balance": Field("double")}, dynamic=False)
    store.create(coll)
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_acctbal").alias("balance"))
    store.bulk_index(coll, s, raw_col=None, id_field="id")
    snap = store.open_snapshot(coll.name)
    store.delete_where(coll, P.term("id", "1"))
    store.migrate(coll, coll.with_version(2), delete_old=True)
    store.drop_unused(coll.name)
    survived = store.exists(snap.physical)
    rows = store.read_snapshot(snap).select(ID_COL, F.round("balance", 2).alias("pinned")).checkpoint()
    store.close_snapshot(snap)
    store.drop_unused(coll.name)
    return rows.select(ID_COL, "pinned", F.lit(survived).alias("survived"), F.lit(not store.exists(snap.physical)).alias("gone"))


@register("snapshot_read", """
SELECT CAST(s_suppkey AS VARCHAR) AS _id, round(s_acctbal, 2) AS pinned, CASE WHEN s_suppkey % 2 = 0 THEN -1.0 ELSE
       round(s_acctbal, 2) END AS now FROM supplier
""")
def snapshot_read(spark, sf):
    """A snapshot taken before an update keeps reading the old rows."""
    store = _store(spark)
    coll = Collection(_named("snap"), {"id": Field("keyword"), "balance": Field("double")}, dynamic=False)
    store.create(coll)
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_acctbal").alias("balance"))
    store.bulk_index(coll, s, raw_col=None, id_field="id")
    pinned = store.read_snapshot(store.snapshot(coll.name)).select(ID_COL, F.round("balance", 2).alias("pinned"))
    store.update(coll, s.where(F.col("id").cast("long") % 2 == 0).select(F.col("id").alias(ID_COL), F.lit(-1.0).alias("balance")))
    return store.read(coll.name).select(ID_COL, F.round("balance", 2).alias("now")).join(pinned, ID_COL)


@register("partial_update_duplicates", """
WITH last AS (SELECT l_orderkey, max(l_shipdate) AS d, max_by(l_quantity, (l_shipdate, l_linenumber, l_partkey, l_suppkey,
  l_quantity)) AS q FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, last.q AS quantity FROM orders
LEFT JOIN last ON o_orderkey = l_orderkey
""")
def partial_update_duplicates(spark, sf):
    """Of many updates to one document the last by the order column wins."""
    base = with_id(read(spark, sf, "orders"), "o_orderkey").select(
        ID_COL, F.col("o_orderstatus").alias("status"), F.lit(None).cast("double").alias("quantity"))
    li = read(spark, sf, "lineitem")
    changes = li.select(F.col("l_orderkey").cast("string").alias(ID_COL), F.col("l_quantity").alias("quantity"), F.struct(
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("seq"))
    return W.partial_update(base, changes, order_col="seq")[0]


@register("drift_deep", """
SELECT path, kind AS observed_kind, declared_type, change, n AS n_docs FROM (
  SELECT 'a' AS path, 'object' AS kind, 'object' AS declared_type, 'same' AS change, count(*) AS n FROM orders
  UNION ALL SELECT 'a.b', 'object', 'object', 'same', count(*) FROM orders
  UNION ALL SELECT 'a.b.c', 'object', NULL, 'added', count(*) FROM orders
  UNION ALL SELECT 'a.b.c.status', 'string', NULL, 'added', count(*) FROM orders
  UNION ALL SELECT 'a.b.n', CASE WHEN o_orderkey % 2 = 0 THEN 'long' ELSE 'string' END, 'integer',
    CASE WHEN o_orderkey % 2 = 0 THEN 'same' ELSE 'changed' END, count(*) FROM orders GROUP BY 2, 4
  UNION ALL SELECT 'a.b.gone', NULL, 'date', 'removed', 0) WHERE n > 0 OR change = 'removed'
""")
def drift_deep(spark, sf):
    """Drift at every level the documents and the declaration have."""
    o = read(spark, sf, "orders")
    n = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.lit('"x"'))
    doc = F.concat(F.lit('{"a":{"b":{"n":'), n, F.lit(',"c":{"status":"'), F.col("o_orderstatus"), F.lit('"}}}}'))
    coll = Collection("deep", {"a": Field("object", properties={"b": Field("object", properties={
        "n": Field("integer"), "gone": Field("date")})})})
    return D.drift_report(o.select(doc.alias("doc")), F.try_parse_json("doc"), coll)


@register("widen_arrays", """
SELECT * FROM (
  SELECT 'keys' AS path, 'long' AS type, true AS multi, count(*) > 0 AS seen FROM orders
  UNION ALL SELECT 'deep', 'object', false, count(*) > 0 FROM orders
  UNION ALL SELECT 'deep.a', 'object', false, count(*) > 0 FROM orders
  UNION ALL SELECT 'deep.a.b', 'object', false, count(*) > 0 FROM orders
  UNION ALL SELECT 'deep.a.b.c', 'long', false, count(o_custkey) > 0 FROM orders
  UNION ALL SELECT 'id', 'keyword', false, count(*) > 0 FROM orders
  UNION ALL SELECT 'priority', 'text', false, count(o_orderpriority) > 0 FROM orders
  UNION ALL SELECT 'status', 'text', false, count(o_orderstatus) > 0 FROM orders) WHERE seen
""")
def widen_arrays(spark, sf):
    """C4: arrays, and objects that hold only objects, are discovered at any depth."""
    from ..schema import flatten_paths
    docs = _order_docs(spark, sf)
    seen = C.observed_paths(docs, F.try_parse_json("doc"), elements=True).select("path", "kind").collect()
    wide = C.widen(Collection("w", {"id": Field("keyword")}), [(r["path"], r["kind"]) for r in seen])
    rows = [(p, f.type, bool(f.multi), True) for p, f in flatten_paths(wide.fields)]
    return spark.createDataFrame(rows, "path string, type string, multi boolean, seen boolean")


@register("conform_object_multifield", """
SELECT CAST(p_partkey AS VARCHAR) AS _id, p_brand AS brand, p_brand AS brand_raw, length(p_name) AS name_length FROM part
""")
def conform_object_multifield(spark, sf):
    """C10 inside an object and inside nested items."""
    text = Field("text", fields={"raw": Field("keyword")})
    coll = Collection("pm", {"id": Field("keyword"), "made": Field("object", properties={"brand": text}),
                             "names": Field("nested", properties={"name": text})})
    docs = read(spark, sf, "part").select(F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("id"), F.struct(F.col("p_brand").alias("brand")).alias("made"),
        F.array(F.struct(F.col("p_name").alias("name"))).alias("names"))).alias("doc"))
    rows = C.split_valid(C.conform_json(docs, coll, "doc", id_field="id", keep_source=False))[0]
    return rows.select(ID_COL, F.col("made.brand").alias("brand"), F.col("made.brand__raw").alias("brand_raw"),
                       F.length(F.col("names")[0]["name__raw"]).alias("name_length"))


@register("conform_object_dynamic", """
SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS found, s_nationkey AS kept, 'name' AS open_fields, 'id' AS closed_fields
FROM supplier
""")
def conform_object_dynamic(spark, sf):
    """In a collection that takes no new fields one object does (``open``), another keeps to its own (``closed``)."""
    store = _store(spark)
    coll = Collection(_named("objs"), {
        "id": Field("keyword"), "open": Field("object", properties={"id": Field("keyword")}, dynamic=True),
        "closed": Field("object", properties={"id": Field("keyword")})}, dynamic=False)
    store.create(coll)
    key = F.col("s_suppkey").cast("string")
    docs = read(spark, sf, "supplier").select(F.to_json(F.struct(
        key.alias("id"), F.struct(key.alias("id"), F.col("s_name").alias("name")).alias("open"),
        F.struct(key.alias("id"), F.col("s_nationkey").alias("nation")).alias("closed"))).alias("doc"))
    store.bulk_index(coll, docs, id_field="id")
    rows = store.read(coll.name)
    names = lambda c: ",".join(n for n in rows.schema[c].dataType.fieldNames() if "__" not in n and (c, n) != ("open", "id"))
    return rows.select(ID_COL, F.col("open.name").alias("found"), F.try_variant_get("_source", "$.closed.nation", "int").alias("kept"),
                       F.lit(names("open")).alias("open_fields"), F.lit(names("closed")).alias("closed_fields"))


@register("agg_cardinality_sketch", """
SELECT event_type AS key, count(DISTINCT user_id) AS exact, true AS within FROM events WHERE event_type IS NOT NULL GROUP BY 1
""")
def agg_cardinality_sketch(spark, sf):
    """Per bucket, the sketch stays within three times its stated relative error of the exact count."""
    ev = read(spark, sf, "events").where(F.col("event_type").isNotNull())
    got = A.bucket_metrics(ev.withColumnRenamed("event_type", "key"), "key", {
        "exact": A.Cardinality("user_id", exact=True), "sketch": A.Cardinality("user_id", rsd=0.01)})
    return got.select(
        "key", "exact", (F.abs(F.col("sketch") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.03)).alias("within"))


@register("sort_nested_array", """
WITH k AS (SELECT l_orderkey, max(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS key FROM lineitem GROUP BY 1)
SELECT row_number() OVER (ORDER BY key DESC NULLS LAST, CAST(l_orderkey AS VARCHAR)) AS rank,
       CAST(l_orderkey AS VARCHAR) AS _id, round(key, 4) AS sort_key FROM k ORDER BY rank LIMIT 50
""")
def sort_nested_array(spark, sf):
    """Sort by a field of nested items that pass a filter, on a real array column."""
    li = read(spark, sf, "lineitem")
    docs = li.groupBy(F.col("l_orderkey").cast("string").alias(ID_COL)).agg(F.collect_list(F.struct(
        F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"))).alias("lines"))
    spec = SortSpec("lines.price", "desc", mode="max", nested_path="lines", nested_filter=lambda x: x["flag"] == "R")
    res = Q.search(docs, None, sort=[spec], size=50)
    best = F.array_max(F.transform(F.filter("lines", lambda x: x["flag"] == "R"), lambda x: x["price"]))
    return Q.with_rank(res.page, res.specs).select("rank", ID_COL, r4(best).alias("sort_key"))


@register("aggregate_several", """
SELECT 'status' AS agg, o_orderstatus AS key, count(*) AS doc_count FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'mean', CAST(CAST(round(avg(o_totalprice), 2) AS DECIMAL(18, 2)) AS VARCHAR), count(o_totalprice) FROM orders
""")
def aggregate_several(spark, sf):
    """One request with two bucket aggregations and two metrics."""
    out = A.aggregate(orders(spark, sf), {"status": A.Terms("o_orderstatus", size=100), "priority": A.Terms("o_orderpriority", size=100),
                                          "mean": A.Avg("o_totalprice"), "n": A.ValueCount("o_totalprice")})
    parts = [out[k].select(F.lit(k).alias("agg"), "key", "doc_count") for k in ("status", "priority")]
    mean = out["mean"].crossJoin(out["n"].withColumnRenamed("value", "n")).select(              # one row each
        F.lit("mean").alias("agg"), F.col("value").cast("decimal(18,2)").cast("string").alias("key"),
        F.col("n").cast("long").alias("doc_count"))
    return parts[0].unionByName(parts[1]).unionByName(mean)


@register("bulk_throw_on_failure", """
SELECT event_type AS key, count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS stored_after,
       count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS failed FROM events GROUP BY 1
""")
def bulk_throw_on_failure(spark, sf):
    """A bulk write that must not fail in part publishes nothing; the same write without the flag stores the rest."""
    from ..errors import BulkPartialFailureError
    store = _store(spark)
    coll = Collection(_named("all"), EVENTS.fields, dynamic="strict")
    store.create(coll)
    docs = event_docs(spark, sf)
    before = store.current(coll.name)
    try:
        store.bulk_index(coll, docs, id_expr=F.col("event_id").cast("string"), throw_on_failure=True)
        raise AssertionError("a bulk write with bad documents went through")
    except BulkPartialFailureError as e:
        assert store.current(coll.name) == before and e.result.failed
    store.bulk_index(coll, docs, id_expr=F.col("event_id").cast("string"))
    ev = read(spark, sf, "events").select(F.col("event_id").cast("string").alias(ID_COL), "event_type")
    return (ev.join(store.read(coll.name).select(ID_COL, F.lit(1).alias("one")), ID_COL, "left")
            .groupBy(F.col("event_type").alias("key")).agg(F.count("one").alias("stored_after"),
                                                           F.sum(F.when(F.col("one").isNull(), 1).otherwise(0)).alias("failed")))


@register("delete_ids_missing", """
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS _id FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)
""")
def delete_ids_missing(spark, sf):
    """Order keys asked for as customer ids; those beyond the customers are reported."""
    ids = read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias(ID_COL))
    return W.delete_ids(customers(spark, sf), ids)[1]


@register("conform_strict_nested_ids", """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line, 'charges' AS field
FROM lineitem WHERE l_returnflag = 'R'
""")
def conform_strict_nested_ids(spark, sf):
    """Which documents a strict nested level rejects."""
    li = read(spark, sf, "lineitem")
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    note = F.when(F.col("l_returnflag") == "R", F.lit("x"))
    doc = F.to_json(F.struct(line.alias("id"), F.array(F.struct(F.lit("tax").alias("kind"), note.alias("note"))).alias("charges")))
    coll = Collection("lines", {"id": Field("keyword"), "charges": Field("nested", properties={"kind": Field("keyword")},
                                                                         dynamic="strict")})
    bad = C.split_valid(C.conform_json(li.select(line.alias("line"), doc.alias("doc")), coll, "doc", keep=["line"],
                                       keep_source=False))[1]
    return bad.select("line", F.col(ERRORS_COL)[0]["field"].alias("field"))


# ----------------------------------------------------------------------------------------------------------------
# Whole-token segmentation, synonyms of several words, many queries at once, distinct-count sketches
# ----------------------------------------------------------------------------------------------------------------

# Rules whose words can't overlap one another, so that cutting out every occurrence is the cheapest cut.
SEGMENT_RULES = ("eau", "qu", "en e n", "ti")


@register("dict_segments", rf"""
WITH t AS (SELECT doc_id, {_TOKENS_SQL} AS toks FROM documents),
p AS (SELECT doc_id, flatten(list_transform(toks, lambda t: list_filter(string_split(
          regexp_replace(t, '(eau|qu|en|ti)', chr(31) || '\1' || chr(31), 'g'), chr(31)), lambda x: x <> ''))) AS ps FROM t),
e AS (SELECT doc_id, flatten(list_transform(ps, lambda x: CASE WHEN x = 'en' THEN ['en', 'e', 'n'] ELSE [x] END)) AS toks FROM p)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token
FROM e, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)
""")
def dict_segments(spark, sf):
    """Every token cut into dictionary words and what lies between them, several words a token."""
    an = X.Analyzer(user_dictionary=SEGMENT_RULES, decompound="mixed", segmentation="whole")
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", an)


# Synonym rules with sides of several words.
SYN_PHRASES = ("the the => double", "the and, et", "is is is => triple", "is is => pair")


@register("synonym_phrases", rf"""
WITH t AS (SELECT doc_id, ' ' || array_to_string({_TOKENS_SQL}, '  ') || ' ' AS s FROM documents),
m AS (SELECT doc_id, regexp_replace(s, ' the  the | the  and | is  is  is | is  is | et ',
                                    ' ' || chr(1) || '\0' || chr(1) || ' ', 'g') AS s FROM t),
r AS (SELECT doc_id, replace(replace(replace(replace(replace(s,
          chr(1) || ' the  the ' || chr(1), 'double'), chr(1) || ' the  and ' || chr(1), 'the and et'),
          chr(1) || ' is  is  is ' || chr(1), 'triple'), chr(1) || ' is  is ' || chr(1), 'pair'),
          chr(1) || ' et ' || chr(1), 'the and et') AS s FROM m),
e AS (SELECT doc_id, list_filter(string_split(s, ' '), lambda x: x <> '') AS toks FROM r)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, toks[i] AS token
FROM e, LATERAL (SELECT unnest(generate_series(1, len(toks))) AS i)
""")
def synonym_phrases(spark, sf):
    """Rules of several words, the longest that fits from the left."""
    return X.tokens(read(spark, sf, "documents"), "text", "doc_id", X.Analyzer(synonyms=SYN_PHRASES), search_time=True)


@register("match_many", f"""
WITH d AS (SELECT doc_id, {_TOKENS_SQL} AS toks FROM documents),
s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
tok AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS t FROM d),
tf AS (SELECT doc_id, dl, t, count(*) AS tf FROM tok GROUP BY ALL),
dfq AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT DISTINCT item_id, unnest({_TOKENS_SQL}) AS t FROM benchmark),
sc AS (SELECT q.item_id, tf.doc_id, round(sum(ln(1 + (s.n - dfq.df + 0.5) / (dfq.df + 0.5)) * tf.tf * 2.2
                                    / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / s.avgdl))), 9) AS score
       FROM q JOIN tf ON tf.t = q.t JOIN dfq ON dfq.t = q.t, s GROUP BY q.item_id, tf.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc)
SELECT item_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
""")
def match_many(spark, sf):
    """P4 + T8: the ten best documents for every benchmark text, all queries in one plan over a stored token index."""
    from .sizing import scratch_path
    path = scratch_path(spark, "token-index")
    X.build_token_index(read(spark, sf, "documents"), "text", path, id_col="doc_id")
    hits = X.match_many(spark, path, read(spark, sf, "benchmark"), k=10, query_id="item_id", query_col="text", id_col="doc_id")
    return hits.select("item_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("_score", 6).alias("score"))


@register("agg_cardinality_merged", """
SELECT coalesce(event_type, '(all)') AS key, count(DISTINCT user_id) AS exact, true AS within
FROM events WHERE event_type IS NOT NULL GROUP BY GROUPING SETS ((event_type), ())
""")
def agg_cardinality_merged(spark, sf):
    """Sketches stored by day and type, merged by type and over all; within three times the stated error of the
    exact counts."""
    from .sizing import scratch_path
    ev = read(spark, sf, "events").where(F.col("event_type").isNotNull())
    path = scratch_path(spark, "sketches")
    A.cardinality_sketches(ev, "user_id", [F.to_date("ts").alias("day"), "event_type"]).write.parquet(path)
    stored = spark.read.parquet(path)
    found = A.merge_cardinality(stored, [F.col("event_type").alias("key")]).unionByName(
        A.merge_cardinality(stored).select(F.lit("(all)").alias("key"), "value"))
    exact = ev.groupBy(F.col("event_type").alias("key")).agg(F.countDistinct("user_id").alias("exact")).unionByName(
        ev.agg(F.countDistinct("user_id").alias("exact")).select(F.lit("(all)").alias("key"), "exact"))
    near = F.abs(F.col("value") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.05)
    return found.join(exact, "key").select("key", "exact", near.alias("within"))


@register("agg_cardinality_default", """
SELECT count(DISTINCT user_id) AS exact, true AS within FROM events
""")
def agg_cardinality_default(spark, sf):
    """G13 through the library's default form, beside its exact form, in one request."""
    got = A.metrics(read(spark, sf, "events"), {"value": A.Cardinality("user_id"), "exact": A.Cardinality("user_id", exact=True)})
    near = F.abs(F.col("value") - F.col("exact")) <= F.greatest(F.lit(2.0), F.col("exact") * 0.03)
    return got.select("exact", near.alias("within"))
