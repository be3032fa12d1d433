"""Schema difference, data drift and additive evolution.

* :func:`diff_mappings` compares two mappings by path: added, changed (an option of the path itself differs) and
  removed (informational) paths, each reported at its topmost point; breaking iff something changed. Key order never
  matters. :func:`diff_settings` compares the static settings (analysis, number of shards), which are breaking too.
* :func:`drift_report` measures a dataset of JSON documents against a declaration: every (path, kind) seen in the
  data with its document count, joined to the declared paths → ``added`` / ``changed`` / ``removed`` / ``same``.
* :func:`evolve_additive` adds declared-but-missing fields to stored rows as typed nulls (a projection, not DDL).
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import BreakingChangeError
from ..schema import Collection, flatten_paths, join_path, split_path
from .conform import observed_paths


@dataclass
class SchemaDiff:
    """``changed_fields``: {field, before, after}; ``changed_settings``: {setting: (before, after)}."""
    added_fields: list[str] = field(default_factory=list)
    changed_fields: list[dict] = field(default_factory=list)
    removed_fields: list[str] = field(default_factory=list)
    changed_settings: dict = field(default_factory=dict)

    @property
    def is_breaking(self) -> bool:
        return bool(self.changed_fields or self.changed_settings)


def options_by_path(mapping: Mapping[str, dict]) -> dict[str, str]:
    """Every dotted path of a mapping → the canonical text of its own options (sub-properties left out)."""
    todo = deque((join_path("", k), m) for k, m in mapping.items())
    out: dict[str, str] = {}
    while todo:
        path, m = todo.popleft()
        own = {k: v for k, v in m.items() if k not in ("properties", "column")}       # the column's name is no option
        out[path] = json.dumps(own, sort_keys=True, default=str)
        todo.extend((join_path(path, k), v) for k, v in (m.get("properties") or {}).items())
    return out


def _topmost(paths: set[str], settled: set[str]) -> list[str]:
    """The paths that have no ancestor among ``settled``."""
    def ancestors(p: str):
        out, parts = "", split_path(p)
        for key in parts[:-1]:
            out = join_path(out, key)
            yield out
    return sorted(p for p in paths if settled.isdisjoint(ancestors(p)))


def _lookup(mapping: Mapping[str, dict], path: str) -> dict:
    first, *rest = split_path(path)
    m = mapping[first]
    for part in rest:
        m = m["properties"][part]
    return m


def diff_mappings(declared: Mapping[str, dict], actual: Mapping[str, dict] | None) -> SchemaDiff:
    """C12 on two mapping dicts. Both are flattened to path → options; added, changed and removed paths are set
    differences, and what lies below a path that is already reported is not reported again. ``actual=None``: there
    is no collection, so every top-level field is added."""
    want, have = options_by_path(declared), options_by_path(actual or {})
    changed = {p for p in want.keys() & have.keys() if want[p] != have[p]}
    added, removed = want.keys() - have.keys(), have.keys() - want.keys()
    settled = changed | added | removed
    return SchemaDiff(_topmost(added, settled),
                      [{"field": p, "before": _lookup(actual, p), "after": _lookup(declared, p)}
                       for p in _topmost(changed, settled)],
                      _topmost(removed, settled))


def diff_settings(declared: Mapping, actual: Mapping) -> dict:
    """Static settings that differ (a setting that is not declared is not compared)."""
    text = lambda v: json.dumps(v, sort_keys=True, default=str)                      # noqa: E731
    return {k: (actual.get(k), v) for k, v in declared.items() if text(actual.get(k)) != text(v)}


def diff_collections(declared: Collection, actual: Collection | None) -> SchemaDiff:
    if actual is None:
        return diff_mappings(declared.mapping(), None)
    out = diff_mappings(declared.mapping(), actual.mapping())
    out.changed_settings = diff_settings(declared.static_settings(), actual.static_settings())
    return out


# JSON kinds that conform to each declared type.
ACCEPTED_KINDS = {
    "keyword": ("string", "long", "double", "boolean"), "text": ("string", "long", "double", "boolean"),
    "integer": ("long",), "long": ("long",), "float": ("long", "double"), "double": ("long", "double"),
    "boolean": ("boolean",), "date": ("string", "long", "date"), "object": ("object",),
    "nested": ("array", "object"), "ip": ("string",), "geo_point": ("object", "string", "array"),
}


def declared_paths(collection: Collection) -> list[tuple[str, str, str]]:
    """(path, declared type, accepted kinds joined by ',') for every declared path."""
    return [(p, f.type, ",".join(ACCEPTED_KINDS[f.type] + (("array",) if f.multi else ())))
            for p, f in flatten_paths(collection.fields)]


def drift_report(df: DataFrame, doc: Column, collection: Collection, depth: int | None = None) -> DataFrame:
    """Data drift: (path, observed_kind, declared_type, change, n_docs).

    ``added``: a path the declaration lacks; ``changed``: a declared path seen with a kind its type does not
    accept; ``same``: an accepted kind; ``removed``: declared but never seen (n_docs 0). JSON nulls are ignored.
    Observed paths come from one explode per level and a partial-aggregated group-by, down to the deepest level the
    documents have (or ``depth`` levels on both sides); the declared side is a literal table, joined after the
    aggregation (so the join sees one row per distinct (path, kind))."""
    spark = df.sparkSession
    seen = observed_paths(df, doc, depth).filter(F.col("kind") != "null")
    decl_rows = [(p, t, k) for p, t, k in declared_paths(collection) if depth is None or len(split_path(p)) <= depth]
    decl = spark.createDataFrame(decl_rows, "path string, declared_type string, accepted string")
    j = seen.join(decl, "path", "full_outer")
    change = (F.when(F.col("declared_type").isNull(), "added")
              .when(F.col("kind").isNull(), "removed")
              .when(F.array_contains(F.split("accepted", ","), F.col("kind")), "same")
              .otherwise("changed"))
    return j.select("path", F.col("kind").alias("observed_kind"), "declared_type", change.alias("change"),
                    F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"))


def _only_adds(src: T.DataType, dst: T.DataType) -> bool:
    """Whether ``dst`` is ``src`` with at most more struct fields."""
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        to = {f.name: f.dataType for f in dst.fields}
        return all(f.name in to and _only_adds(f.dataType, to[f.name]) for f in src.fields)
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return _only_adds(src.elementType, dst.elementType)
    return src == dst


def _typed_null(dt: T.DataType) -> Column:
    return F.lit(None).cast(dt)


def reshape(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Bring a value of type ``src`` to type ``dst`` when ``dst`` only adds fields: structs are rebuilt field by
    field (new fields as typed nulls, a null struct stays null), arrays are reshaped element-wise with
    ``transform``, anything else is cast."""
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        fields = [(reshape(c.getField(f.name), have[f.name], f.dataType) if f.name in have else _typed_null(f.dataType))
                  .alias(f.name) for f in dst.fields]
        return F.when(c.isNull(), _typed_null(dst)).otherwise(F.struct(*fields))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        if src.elementType == dst.elementType:
            return c
        return F.transform(c, lambda e: reshape(e, src.elementType, dst.elementType))
    return c if src == dst else c.cast(dst)


def evolve_additive(df: DataFrame, old: Collection, new: Collection) -> DataFrame:
    """Add the fields ``new`` declares beyond ``old`` (also inside objects and nested arrays), refusing when
    any existing field changed. The result has the new table schema; existing values are untouched. A projection,
    not DDL, so it works on any table format."""
    d = diff_collections(new, old)
    if d.is_breaking:
        raise BreakingChangeError("breaking mapping change: " + ", ".join(c["field"] for c in d.changed_fields),
                                  [c["field"] for c in d.changed_fields])
    target = new.struct_type()
    have = {f.name: f.dataType for f in df.schema.fields}
    other = [f.name for f in target.fields if f.name in have and not _only_adds(have[f.name], f.dataType)]
    if other:                                    # the rows are not what ``old`` says
        raise BreakingChangeError("stored types differ from the declaration: " + ", ".join(other), other)
    cols = [reshape(F.col(f.name), have[f.name], f.dataType).alias(f.name) if f.name in have
            else _typed_null(f.dataType).alias(f.name) for f in target.fields if f.name in have or f.name != "_id"]
    extra = [F.col(c) for c in df.columns if c not in target.fieldNames()]
    return df.select(*cols, *extra)
