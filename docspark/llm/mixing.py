"""Mixing sources to target weights by hash-random order and exact budgets.

Sources, in code-point order with null last, take the weights of a repeating cycle. Targets share the words of the
corpus by weight; a target stops at ``max_epochs`` times its source's size and the excess is shared again by weight
until no target is above. Within a source the documents stand in hash-random order (md5 of the id and a seed; ties by
id, then size); whole epochs of the source are taken as often as they fit and the rest is the prefix of that order
whose word count is exactly the remaining budget: the document on the cut gives its first words only.

The order is a range sort of (source, hash) over all partitions and the position of a document is a distributed
prefix sum (totals per partition, then running sums inside them), so a source of any size is spread over many tasks.
The texts are read once for their sizes and are not shuffled; the sorted rows hold ids and sizes only and are written
to the checkpoint folder, so their partition boundaries are the same for every later read.

Defined results: null texts have size 0; documents of size 0 take 0 words; a null source is a source of its own; a
null id hashes like an empty one and stands where that hash falls; repeated rows are separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from . import kernel as K
from .common import cut, parts_for, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 7


def word_counts(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), np.int64)
    for lo, hi, w in K.chunks(column):
        out[lo:hi] = w.counts
    return out


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
          row: Column | None = None) -> DataFrame:
    """(doc_id, source, size) per row, one scan; also ``row`` when given."""
    more = [] if row is None else [row.cast("long").alias("row")]
    names = ["doc_id", "source", "size", *(["row"] if more else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(word_counts(b.column(2))), *b.columns[3:]],
                                             names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        F.col(text_col).cast("string").alias("text"), *more)
            .mapInArrow(run, "doc_id long, source string, size long" + (", row long" if more else "")))


def running_sums(df: DataFrame, order: Sequence[str], value: str, group: str, parts: int) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of the same ``group`` (null counts as a group) that
    stand before the row in the order of ``group`` and ``order``. Range partitions, totals per partition, running
    sums inside partitions; the totals table has one row per partition and group in it."""
    keys = [F.col(group).asc_nulls_last(), *[F.col(c) for c in order]]
    rows = cut(df.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()))
    ahead = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = (rows.groupBy(group, "part").agg(F.sum(value).alias("total"))
              .select(F.col(group).alias("g"), F.col("part").alias("p"),
                      F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead")))
    inside = W.partitionBy(group, "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(totals, rows[group].eqNullSafe(F.col("g")) & (rows["part"] == F.col("p")))
            .withColumn("before", (F.col("inside") + F.col("ahead")).cast("long")).drop("inside", "ahead", "g", "p", "part"))


def targets(source_sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) → also (weight, target). The common rate (words per unit of weight) is raised until the
    sources that stop at their cap are the ones the rate would carry above it; each step is one aggregation."""
    numbered = _numbered(source_sizes.withColumn("one", F.lit(1)))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    t = cut(numbered.withColumn("weight", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")))
            .withColumn("cap", F.col("source_size") * max_epochs).drop("number"))
    rate = None
    while True:
        stopped = F.lit(False) if rate is None else F.col("cap") < F.lit(rate) * F.col("weight")
        r = t.agg(F.sum("source_size").alias("total"), F.sum(F.when(stopped, F.col("cap"))).alias("stopped"),
                  F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        if not r["weight"] or not r["total"]:
            break
        new = (r["total"] - (r["stopped"] or 0)) / r["weight"]
        if rate is not None and new <= rate:
            break
        rate = new
    share = F.lit(0.0) if rate is None else F.lit(float(rate)) * F.col("weight")
    return t.select("source", "source_size", "weight", F.least(F.col("cap").cast("double"), share).alias("target"))


def _numbered(sources: DataFrame) -> DataFrame:
    """A running number for each source in code-point order, null last."""
    s = sources.withColumn("nowhere", F.lit(None).cast("string")).withColumn("last", F.col("source").isNull())
    return (running_sums(s, ["last", "source"], "one", "nowhere", parts_for(s, 64, 1))
            .withColumnRenamed("before", "number").drop("nowhere", "last", "one"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row: ``taken`` words of the row go into the mix, whole
    epochs counted. ``row``, a number of its own for each row, is returned as well and breaks the last ties."""
    more = [] if row is None else ["row"]
    sized = sizes(docs, id_col, source_col, text_col, row).withColumn(
        "key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")))
    placed = cut(running_sums(sized, ["key", "doc_id", "size", *more], "size", "source", parts_for(docs, 256)))
    t = targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    t = t.withColumnRenamed("source", "of")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return (placed.join(t, placed["source"].eqNullSafe(t["of"]))
            .select("doc_id", "source", "size", "source_size", "target",
                    (epochs * F.col("size") + part).cast("long").alias("taken"), *more))


def first_words(column: pa.Array, counts: np.ndarray) -> list[str]:
    """The texts up to the end of their first ``counts`` words."""
    out: list[str] = []
    for lo, hi, w in K.chunks(column):
        for i in range(hi - lo):
            n = min(int(counts[lo + i]), int(w.counts[i]))
            end = w.ends[w.first[i] + n - 1] if n else w.offsets[i]
            out.append(w.buf[w.offsets[i]:end].tobytes().decode())
    return out


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


OP6_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':7') AS key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
    CASE number % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
step(i, rate) AS (
  SELECT 0, sum(source_size) / sum(weight) FROM w
  UNION ALL
  SELECT i + 1, (SELECT (sum(w.source_size) - coalesce(sum(w.cap) FILTER (w.cap < step.rate * w.weight), 0))
                        / sum(w.weight) FILTER (w.cap >= step.rate * w.weight) FROM w)
  FROM step WHERE i < 40),
r AS (SELECT max(rate) AS rate FROM step),
t AS (SELECT source, source_size, least(cap, rate * weight) AS target FROM w, r),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
e AS (SELECT p.doc_id, p.size, t.source_size, t.target, p.before,
    CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS epochs
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""
