"""Sort specifications, per-document sort keys (O1-O6) and the keyset predicate for cursors.

Missing values sort last in both directions unless ``missing`` says otherwise. Every sort gets ``_id`` as the final
tiebreak so pages and cursors are stable across runs (storage order is not).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any, Callable, Sequence

from pyspark.sql import Column, functions as F

from ..schema import ID_COL, SCORE_COL

# The sort modes for multi-valued fields.
SORT_MODES = ("min", "max", "sum", "avg", "median")


@dataclass(frozen=True)
class SortSpec:
    field: str
    order: str = "asc"
    mode: str | None = None
    missing: Any = None          # None / "_last" → nulls last; "_first" → nulls first; a value → substituted
    nested_path: str | None = None
    nested_filter: Callable[[Column], Column] | None = None
    multi: bool = False

    @property
    def descending(self) -> bool:
        return self.order == "desc"

    @property
    def nulls_first(self) -> bool:
        return self.missing == "_first"


def parse_sort(sort: Sequence | None) -> list[SortSpec]:
    """Accepts ``["f", ("g", "desc"), {"h": "asc"}, {"k": {"order": "desc", "mode": "avg"}}, SortSpec(...)]``."""
    out: list[SortSpec] = []
    for item in sort or []:
        if isinstance(item, SortSpec):
            out.append(item)
        elif isinstance(item, str):
            out.append(SortSpec(item))
        elif isinstance(item, tuple):
            out.append(SortSpec(item[0], item[1]))
        elif isinstance(item, dict):
            for k, v in item.items():
                if isinstance(v, str):
                    out.append(SortSpec(k, v))
                else:
                    nested = v.get("nested") or {}
                    out.append(SortSpec(k, v.get("order", "asc"), v.get("mode"), v.get("missing"),
                                        nested.get("path"), nested.get("filter"), v.get("multi", False)))
        else:
            raise TypeError(f"bad sort clause {item!r}")
    for s in out:
        if s.order not in ("asc", "desc"):
            raise ValueError(f"bad sort order {s.order!r}")
        if s.mode is not None and s.mode not in SORT_MODES:
            raise ValueError(f"bad sort mode {s.mode!r}")
    return out


def with_tiebreak(specs: list[SortSpec], id_col: str = ID_COL) -> list[SortSpec]:
    """``_doc`` means storage order; we use ``_id`` instead, and always end with ``_id`` ascending."""
    out = [SortSpec(id_col, s.order) if s.field in ("_doc", "_shard_doc") else s for s in specs]
    if not any(s.field == id_col for s in out):
        out.append(SortSpec(id_col, "asc"))
    return out


def reduce_array(arr: Column, mode: str) -> Column:
    """O2: one value from an array by sort mode; nulls inside the array are ignored, empty → null."""
    vals = F.filter(arr, lambda x: x.isNotNull())
    n = F.size(vals)
    if mode == "min":
        return F.array_min(vals)
    if mode == "max":
        return F.array_max(vals)
    if mode == "sum":
        return F.when(n > 0, F.aggregate(vals, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double")))
    if mode == "avg":
        return F.when(n > 0, F.aggregate(vals, F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double")) / n)
    if mode == "median":
        s = F.array_sort(vals)
        lo = F.element_at(s, F.floor((n + 1) / 2).cast("int")).cast("double")
        hi = F.element_at(s, F.floor(n / 2).cast("int") + 1).cast("double")
        return F.when(n > 0, (lo + hi) / 2)
    raise ValueError(mode)


def key_column(spec: SortSpec) -> Column:
    """The per-document sort key for one clause."""
    if spec.nested_path:
        arr = F.col(spec.nested_path)
        if spec.nested_filter is not None:
            arr = F.filter(arr, spec.nested_filter)
        sub = spec.field[len(spec.nested_path) + 1:] if spec.field.startswith(spec.nested_path + ".") else spec.field
        vals = F.transform(arr, lambda x: x[sub])
        key = reduce_array(vals, spec.mode or ("max" if spec.descending else "min"))
    elif spec.multi or spec.mode:
        key = reduce_array(F.col(spec.field), spec.mode or ("max" if spec.descending else "min"))
    else:
        key = F.col(spec.field)
    if spec.missing not in (None, "_last", "_first"):
        key = F.coalesce(key, F.lit(spec.missing))
    return key


def key_name(i: int) -> str:
    return f"_k{i}"


def order_column(name: str, spec: SortSpec) -> Column:
    c = F.col(name)
    if spec.descending:
        return c.desc_nulls_first() if spec.nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if spec.nulls_first else c.asc_nulls_last()


def cursor_value(v: Any) -> Any:
    """A cursor value as a literal. Naive datetimes (what a TIMESTAMP_NTZ key collects to) are rebuilt from their
    ISO text so the wall-clock value is exact whatever the Python process's time zone."""
    import datetime as _dt
    if isinstance(v, _dt.datetime) and v.tzinfo is None:
        return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")
    return v


def _strictly_after(c: Column, v: Any, spec: SortSpec) -> Column:
    """Rows whose key comes strictly after ``v`` in this clause's order."""
    if v is None:
        # nulls last: nothing is after null. nulls first: every non-null is after null.
        return c.isNotNull() if spec.nulls_first else F.lit(False)
    lv = F.lit(cursor_value(v))
    beyond = (c < lv) if spec.descending else (c > lv)
    return beyond if spec.nulls_first else (beyond | c.isNull())


def _at_or_after(c: Column, v: Any, spec: SortSpec) -> Column:
    if v is None:
        return F.lit(True) if spec.nulls_first else c.isNull()
    lv = F.lit(cursor_value(v))
    bound = (c <= lv) if spec.descending else (c >= lv)
    return bound if spec.nulls_first else (bound | c.isNull())


def keyset_after(specs: Sequence[SortSpec], names: Sequence[str], values: Sequence[Any]) -> Column:
    """``k1 after v1 OR (k1 = v1 AND k2 after v2) OR ...``, null- and direction-aware, plus the leading bound
    ``k1 at-or-after v1`` on its own so the scan can prune row groups with it."""
    if len(values) != len(specs):
        raise ValueError(f"cursor has {len(values)} values, sort has {len(specs)} clauses")
    disjuncts = []
    for i, (spec, name, v) in enumerate(zip(specs, names, values)):
        eqs = [F.col(names[j]).eqNullSafe(F.lit(cursor_value(values[j]))) for j in range(i)]
        disjuncts.append(reduce(lambda a, b: a & b, eqs + [_strictly_after(F.col(name), v, spec)]))
    after = reduce(lambda a, b: a | b, disjuncts)
    return _at_or_after(F.col(names[0]), values[0], specs[0]) & after


def keyset_branches(specs: Sequence[SortSpec], names: Sequence[str], values: Sequence[Any]) -> list[Column]:
    """The keyset predicate as disjoint branches that each push down to the scan. With nulls last and a non-null
    first cursor value, rows after the cursor are (a) non-null first keys at or beyond the value — a plain range
    bound — and (b) every row whose first key is null. Written as one predicate, the shared ``IS NULL`` would be
    factored into a top-level OR and nothing would be pushed."""
    first, v = specs[0], values[0]
    after = keyset_after(specs, names, values)
    if v is None or first.nulls_first:
        return [after]
    c = F.col(names[0])
    lv = F.lit(cursor_value(v))
    bound = (c <= lv) if first.descending else (c >= lv)
    nonnull_after = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(names[j]).eqNullSafe(F.lit(cursor_value(values[j]))) for j in range(i)]
               + [_strictly_after(F.col(names[i]), values[i], specs[i]) if i else
                  ((c < lv) if first.descending else (c > lv))])
        for i in range(len(specs))])
    return [bound & nonnull_after, c.isNull()]
