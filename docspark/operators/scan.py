"""Full scans in ordered batches (S15) and per-batch consumers.

The whole snapshot is ordered once
and every row gets its global position without a single-task window:

1. filter, then range-partition and sort within partitions on the sort keys (``_id`` tiebreak);
2. checkpoint (reliable, to ``spark.checkpoint.dir``) so later passes see exactly these partitions, even after an
   executor loss;
3. one small aggregation gives the row count of each partition (one row per partition), prefix sums over
   that small table give the starts;
4. each row's position is its partition's start plus its offset inside the partition, which
   ``monotonically_increasing_id()`` encodes as ``(partition << 33) + offset`` on the checkpointed data;
5. ``batch_id = position div batch_size``.

Consumers run per batch with ``groupBy('batch_id').applyInPandas`` (each group is at most ``batch_size`` rows) or
per partition with ``foreachPartition``.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sorting import key_column, key_name, order_column, parse_sort, with_tiebreak
from ..schema import ID_COL
from ..plans.sizing import partitions_for
from ..session import ensure_checkpoint_dir

DEFAULT_BATCH_SIZE = 1000


def global_index(df: DataFrame, sort: Sequence | None = None, id_col: str = ID_COL, index_col: str = "row_index",
                 partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the (sort, ``_id``) order, computed without a global window."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    specs = with_tiebreak(parse_sort(sort), id_col)
    names = [key_name(i) for i in range(len(specs))]
    keyed = df.select("*", *[key_column(s).alias(n) for n, s in zip(names, specs)])
    n = partitions or partitions_for(keyed)
    orders = [order_column(nm, s) for nm, s in zip(names, specs)]
    ordered = keyed.repartitionByRange(n, *orders).sortWithinPartitions(*orders)
    ordered = ordered.checkpoint(eager=True)
    with_pos = ordered.withColumn("__mid", F.monotonically_increasing_id())
    with_pos = with_pos.withColumn("__pid", F.shiftright(F.col("__mid"), 33))
    starts = partition_starts(with_pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n")), "__pid", "__n")
    offset = F.col("__mid") - F.shiftleft(F.col("__pid"), 33)
    out = with_pos.join(F.broadcast(starts), "__pid").withColumn(index_col, F.col("__start") + offset)
    return out.drop("__mid", "__pid", "__start", *names)


def partition_starts(totals: DataFrame, pid: str, n: str) -> DataFrame:
    """(pid, __start): the sum of ``n`` over the partitions before each one. One row per partition of an ordered
    frame, so the table is as small as the list of its tasks and is broadcast to them."""
    ahead = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(pid, F.coalesce(F.sum(n).over(ahead), F.lit(0)).cast("long").alias("__start"))


def scan_batches(df: DataFrame, query: Column | None = None, sort: Sequence | None = None,
                 batch_size: int = DEFAULT_BATCH_SIZE, id_col: str = ID_COL,
                 partitions: int | None = None) -> DataFrame:
    """Every matching document with ``row_index`` and ``batch_id`` (batches of ``batch_size`` in order)."""
    if batch_size <= 0:
        raise ValueError("batch_size must be > 0")
    base = df if query is None else df.filter(query)
    idx = global_index(base, sort, id_col, "row_index", partitions)
    return idx.withColumn("batch_id", F.floor(F.col("row_index") / F.lit(batch_size)).cast("long"))


def for_each_batch(batches: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Run a pandas function once per batch (``fn(pdf) -> pdf``), rows in scan order inside the batch."""

    def run(pdf):
        return fn(pdf.sort_values("row_index", kind="stable"))

    return batches.groupBy("batch_id").applyInPandas(run, schema=schema)


def iter_batches(df: DataFrame, query: Column | None = None, sort: Sequence | None = None,
                 batch_size: int = DEFAULT_BATCH_SIZE, id_col: str = ID_COL, partitions: int | None = None):
    """S15 for a driver-side consumer: yields lists of at most ``batch_size`` rows in scan order.

    The matching documents are range-partitioned, sorted within partitions and checkpointed once; then
    ``toLocalIterator`` streams the partitions to the driver one at a time in partition order, so the driver holds
    at most one partition (sized by ``partitions_for``) plus one batch, never the collection."""
    if batch_size <= 0:
        raise ValueError("batch_size must be > 0")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    base = df if query is None else df.filter(query)
    specs = with_tiebreak(parse_sort(sort), id_col)
    names = [key_name(i) for i in range(len(specs))]
    keyed = base.select("*", *[key_column(s).alias(n) for n, s in zip(names, specs)])
    orders = [order_column(nm, s) for nm, s in zip(names, specs)]
    n = partitions or partitions_for(keyed)
    ordered = keyed.repartitionByRange(n, *orders).sortWithinPartitions(*orders).checkpoint(eager=True).drop(*names)
    batch = []
    for row in ordered.toLocalIterator():
        batch.append(row)
        if len(batch) == batch_size:
            yield batch
            batch = []
    if batch:
        yield batch
