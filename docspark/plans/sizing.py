"""Size checks that guard broadcasts and driver-side collection.

A side is broadcast only when a bounded count proves it small (``limit(n + 1).count()`` reads at most ``n + 1``
rows of it); otherwise the caller's plan keeps the shuffle join. Collections to the driver go through
:func:`collect_bounded`, which refuses instead of pulling an unbounded result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Default row bound for broadcasting a lookup side (ids, query tokens, dictionary rules, range tables).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20


def at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if at_most(df, max_rows) else df


def collect_bounded(df: DataFrame, max_rows: int, what: str = "result") -> list:
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; refusing to collect it to the driver")
    return rows


# With a byte target, tasks are made finer up to so many for each task slot.
TASKS_A_SLOT = 16


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """Spread CPU-heavy per-row work (parsing, tokenising) over the cluster when the input arrives in fewer
    partitions than there are task slots (e.g. one large unsplittable file). Large inputs already have many
    partitions and are returned unchanged, so this never adds a shuffle at scale. ``target_bytes`` (by the optimizer's
    size estimate) asks for more partitions where the input has few but long rows of work: a task then does not grow
    with the input until every slot has ``TASKS_A_SLOT`` of them."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if target_bytes:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size < 1 << 60:                  # else the optimizer does not know
            want = max(want, min(-(-size // target_bytes), sc.defaultParallelism * TASKS_A_SLOT))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    if "Exchange" in plan or "Union" in plan:
        return df                      # already redistributed (and counting partitions here could run the shuffle)
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def scratch_path(spark, name: str) -> str:
    """A fresh folder under the session's checkpoint directory (the shared folder on a cluster) for an
    intermediate result that cuts lineage."""
    import uuid
    from ..session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/docspark-{name}-{uuid.uuid4().hex[:12]}"


# Target bytes per partition for the partition counts this library chooses itself (range partitions for ordered
# scans and quantiles, buckets of stored collections).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(df: DataFrame, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Partition count for ``df``: its optimizer size estimate (file sizes of the scanned columns, no job is run)
    divided by ``target_bytes``, never below ``spark.sql.shuffle.partitions``."""
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return floor
    if size >= 1 << 60:                     # the optimizer does not know (rows made on the driver)
        return floor
    return int(max(floor, -(-size // target_bytes)))
