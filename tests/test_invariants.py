"""Invariants of writes and conforming."""

from pyspark.sql import functions as F

from docspark.operators import conform as C
from docspark.operators import drift as D
from docspark.operators import writes as W
from docspark.plans import catalog as K

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent(spark):
    base = K.customers(spark, SF)
    changes = base.withColumn("c_acctbal", F.col("c_acctbal") * 2).withColumn("_ord", F.lit(1)) \
        .unionByName(base.limit(0).withColumn("_ord", F.lit(0)))
    once = W.upsert(base, changes, "_id", "_ord")
    twice = W.upsert(once, changes, "_id", "_ord")
    assert _rows(once) == _rows(twice) and once.count() == base.count()


def test_drift_is_empty_after_conform(spark):
    docs = K.event_docs(spark, SF, bad=True)
    conformed, _ = C.split_valid(C.conform_json(docs, K.EVENTS, "doc", F.col("event_id"), keep_source=False))
    rendered = conformed.select(F.to_json(F.struct(*K.EVENTS.fields)).alias("doc"))
    report = D.drift_report(rendered, F.try_parse_json("doc"), K.EVENTS).collect()
    assert report and {r["change"] for r in report} == {"same"}


def test_accepted_plus_rejected_is_total(spark):
    docs = K.event_docs(spark, SF, bad=True)
    conformed = C.conform_json(docs, K.EVENTS, "doc", F.col("event_id"), keep_source=False)
    ok, bad = C.split_valid(conformed)
    assert ok.count() + bad.count() == docs.count() and bad.count() > 0
