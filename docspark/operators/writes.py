"""Document writes as DataFrame transformations.

Each function maps (stored collection, change set) to the new collection content; :mod:`docspark.sources.store`
publishes the result as a new immutable version. Change sets are joined to the base on ``_id``. A change set is
broadcast only when a bounded count proves it small; otherwise both sides shuffle on ``_id`` (and a base written
bucketed by ``_id`` keeps its side in place). Duplicate ids in a change set are resolved by ``max_by`` on an order
column (partial aggregation, so one hot id costs one row per map task).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.sizing import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, at_most
from ..schema import ERRORS_COL, ID_COL

# Bytes assumed for a value in a broadcast row; document ids are keys of bounded length. Other types have no bound.
WIDTH = {"string": 64, "long": 8, "integer": 8, "short": 8, "byte": 8, "boolean": 8, "double": 8, "float": 8, "date": 8,
         "timestamp": 8, "timestamp_ntz": 8}
ORDER_COL = "_ord"
PRESENT_COL = "_present"


def _side(df: DataFrame, max_rows: int, bound: DataFrame | None = None) -> DataFrame:
    """Broadcast ``df`` when it is an id set (or narrow fixed-width rows) that a bounded count proves small. Sides with
    columns of unbounded width are not hinted: the optimizer broadcasts them by their measured size, or shuffles.
    ``bound`` is a cheaper frame with at least as many rows, counted instead of computing ``df`` twice."""
    width = sum(WIDTH.get(f.dataType.typeName(), 0) or BROADCAST_MAX_BYTES for f in df.schema.fields)
    rows = min(max_rows, BROADCAST_MAX_BYTES // max(width, 1))
    return F.broadcast(df) if rows and at_most(bound if bound is not None else df, rows) else df


def with_input_order(changes: DataFrame, order_col: str = ORDER_COL) -> DataFrame:
    """Attach the input position of each change (file scan order; call before any shuffle). A caller-supplied
    sequence column is preferable when the input is not a file scan."""
    return changes.withColumn(order_col, F.monotonically_increasing_id())


def last_per_id(changes: DataFrame, id_col: str = ID_COL, order_col: str | None = ORDER_COL) -> DataFrame:
    """One change per id: the one with the greatest ``order_col`` (last write wins)."""
    cols = [c for c in changes.columns if c not in (id_col, order_col)]
    if order_col is None or order_col not in changes.columns:
        # no order given: a deterministic choice among duplicates (greatest content)
        return (changes.groupBy(id_col).agg(F.max_by(F.struct(*cols), F.struct(*cols).cast("string")).alias("__r"))
                .select(id_col, "__r.*"))
    return (changes.groupBy(id_col).agg(F.max_by(F.struct(*cols), F.col(order_col)).alias("__r"))
            .select(id_col, "__r.*"))


def upsert(base: DataFrame, changes: DataFrame, id_col: str = ID_COL, order_col: str | None = ORDER_COL,
           broadcast_max_rows: int = BROADCAST_MAX_ROWS, unique: bool = False) -> DataFrame:
    """Create-or-replace by id; the last duplicate in the change set wins (``unique``: there are none). Columns
    that the base lacks and null ids are refused."""
    unknown = [c for c in changes.columns if c not in (*base.columns, id_col, order_col, ERRORS_COL)]
    if unknown:
        raise ValueError(f"the change set has columns that the collection lacks: {unknown}")
    ch = changes.drop(ERRORS_COL) if ERRORS_COL in changes.columns else changes
    if not unique:
        ch = last_per_id(ch, id_col, order_col)
    ch = ch.withColumn(id_col, F.when(F.col(id_col).isNull(), F.raise_error(F.lit("a document to write has no id")))
                       .otherwise(F.col(id_col)))
    kept = base.join(_side(ch.select(id_col), broadcast_max_rows, changes.select(id_col)), id_col, "left_anti")
    return kept.unionByName(ch.select(*[c for c in base.columns if c in ch.columns]), allowMissingColumns=True) \
        .select(*base.columns)


def upsert_in_buckets(base: DataFrame, changes: DataFrame, buckets: int, id_col: str = ID_COL,
                      rows_a_bucket: int = 200_000) -> DataFrame:
    """S4 on a base that is stored in ``buckets`` by id; ``changes`` has one row per id and (some of) the base's columns.
    One outer join with the changes dealt to the same buckets: the base is read where it lies, and each task holds all
    rows of its bucket, old and new, so it writes one file. Changes of a bounded number of rows are the hashed side,
    which saves sorting the base."""
    new = F.struct(*[F.col(f"`{c}`") for c in changes.columns if c in base.columns])
    ids = F.when(F.col(id_col).isNull(), F.raise_error(F.lit("a document to write has no id"))).otherwise(F.col(id_col))
    right = changes.select(ids.alias("__new_id"), new.alias("__new")).repartition(buckets, "__new_id")
    if at_most(changes.select(id_col), rows_a_bucket * buckets):
        right = right.hint("shuffle_hash")
    joined = base.join(right, F.col(id_col) == F.col("__new_id"), "full_outer")
    changed = F.col("__new_id").isNotNull()
    have = set(changes.columns)
    return joined.select(*[F.when(changed, F.col(f"__new.`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType))
                           .otherwise(F.col(f"`{f.name}`")).alias(f.name, metadata=f.metadata) for f in base.schema.fields])


def _merge(old: Column, new: Column, dtype: T.DataType, new_type: T.DataType) -> Column:
    """Objects merge field by field (recursively); anything else is replaced."""
    if isinstance(dtype, T.StructType) and isinstance(new_type, T.StructType):
        base = F.coalesce(old, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dtype.fields]))
        out = base
        for f in new_type.fields:
            if f.name in dtype.fieldNames():
                sub_old = base.getField(f.name)
                out = out.withField(f.name, _merge(sub_old, new.getField(f.name), dtype[f.name].dataType, f.dataType))
        return F.when(new.isNull(), F.lit(None).cast(dtype)).otherwise(out)
    return new


def partial_update(base: DataFrame, changes: DataFrame, id_col: str = ID_COL, order_col: str | None = ORDER_COL,
                   broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """Set the change set's fields on matching documents, leave the others untouched.
    Returns (new content, unmatched change ids). A ``_present`` array column (e.g. ``json_object_keys`` of the
    partial JSON) limits each row to the keys it really carries; without it every change column is applied."""
    ch = last_per_id(changes, id_col, order_col)
    upd = [c for c in ch.columns if c not in (id_col, PRESENT_COL) and c in base.columns]
    unknown = [c for c in ch.columns if c not in (id_col, PRESENT_COL) and c not in base.columns]
    if unknown:
        raise ValueError(f"update names undeclared fields: {unknown}")
    has_present = PRESENT_COL in ch.columns
    right = ch.select(F.col(id_col), *[F.col(c).alias(f"__new_{c}") for c in upd],
                      *([F.col(PRESENT_COL).alias("__present")] if has_present else []),
                      F.lit(True).alias("__matched"))
    joined = base.join(right, id_col, "left")         # wide rows: broadcast or shuffled by the optimizer's sizes
    types = {f.name: f.dataType for f in base.schema.fields}
    ntypes = {f.name: f.dataType for f in ch.schema.fields}
    out = []
    for c in base.columns:
        if c in upd:
            applies = F.col("__matched").isNotNull()
            if has_present:
                applies = applies & F.coalesce(F.array_contains(F.col("__present"), c), F.lit(False))
            merged = _merge(F.col(c), F.col(f"__new_{c}"), types[c], ntypes[c])
            out.append(F.when(applies, merged).otherwise(F.col(c)).cast(types[c]).alias(c))
        else:
            out.append(F.col(c))
    matched_ids = base.join(_side(ch.select(id_col), broadcast_max_rows, changes.select(id_col)), id_col,
                            "left_semi").select(id_col)
    unmatched = ch.select(id_col).join(matched_ids, id_col, "left_anti")
    return joined.select(*out), unmatched


def delete_ids(base: DataFrame, ids: DataFrame, id_col: str = ID_COL,
               broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """Remove documents by id; returns (remaining, ids that matched nothing)."""
    req = ids.select(F.col(id_col).cast("string").alias(id_col)).distinct()
    side = _side(req, broadcast_max_rows, ids.select(id_col))
    remaining = base.join(side, id_col, "left_anti")
    matched = base.join(side, id_col, "left_semi").select(id_col)
    return remaining, req.join(matched, id_col, "left_anti")


def delete_where(base: DataFrame, predicate: Column) -> DataFrame:
    """Remove documents matching a predicate (unknown counts as no match)."""
    return base.filter(~predicate | predicate.isNull())


def get_many(base: DataFrame, ids: DataFrame, id_col: str = ID_COL,
             broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """S8 for a set of ids: each requested id once with ``found`` and the stored fields (nulls when missing).
    The stored side is first cut to the requested ids (semi join with the broadcast id set), so the final join is
    between two id-sized frames."""
    req = ids.select(F.col(id_col).cast("string").alias(id_col)).distinct()
    found = base.join(_side(req, broadcast_max_rows, ids.select(id_col)), id_col, "left_semi") \
        .withColumn("__found", F.lit(True))
    return req.join(found, id_col, "left").withColumn("found", F.coalesce("__found", F.lit(False))).drop("__found")


@dataclass
class BulkResult:
    """``total == succeeded + failed``; ``failed_docs`` is the quarantine (lazy, with ``_errors``)."""
    total: int
    succeeded: int
    failed: int
    failed_docs: DataFrame | None = None

    def __post_init__(self):
        assert self.total == self.succeeded + self.failed


@dataclass
class UpdateResult:
    """``total == updated + failed + unmatched``, counted per id. ``failed_docs`` holds the documents that the change
    would have made invalid (``_id``, ``_errors``; they stay as they were), ``unmatched_ids`` the ids without a document."""
    total: int
    updated: int
    failed: int
    unmatched: int
    failed_docs: DataFrame
    unmatched_ids: DataFrame

    def __post_init__(self):
        assert self.total == self.updated + self.failed + self.unmatched
