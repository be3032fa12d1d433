"""Predicate builders.

Every predicate is a plain ``Column`` so Catalyst can push it into the Parquet scan. Multi-valued fields (declared
``multi=True``, stored as arrays) use ``array_contains`` / ``exists`` instead of a scalar comparison.
Text ``match`` (P4) needs the token table and lives in :mod:`docspark.operators.text`.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable

from pyspark.sql import Column, functions as F


def _col(field: str | Column) -> Column:
    return F.col(field) if isinstance(field, str) else field


def match_all() -> Column:
    """Every document."""
    return F.lit(True)


def term(field: str | Column, value: Any, multi: bool = False) -> Column:
    """Exact value. On a multi-valued field, any element equal to ``value``."""
    c = _col(field)
    if multi:
        return F.array_contains(c, F.lit(value))
    return c == F.lit(value)


def terms(field: str | Column, values: Iterable[Any], multi: bool = False) -> Column:
    """Any of several exact values."""
    vals = list(values)
    c = _col(field)
    if multi:
        return F.exists(c, lambda x: x.isin(vals))
    return c.isin(vals)


def range_(field: str | Column, gte: Any = None, gt: Any = None, lte: Any = None, lt: Any = None,
           multi: bool = False) -> Column:
    """Bounds on a value; on a multi-valued field, any element in range."""

    def check(x: Column) -> Column:
        parts = []
        if gte is not None:
            parts.append(x >= F.lit(gte))
        if gt is not None:
            parts.append(x > F.lit(gt))
        if lte is not None:
            parts.append(x <= F.lit(lte))
        if lt is not None:
            parts.append(x < F.lit(lt))
        if not parts:
            return x.isNotNull()
        return reduce(lambda a, b: a & b, parts)

    c = _col(field)
    return F.exists(c, check) if multi else check(c)


def exists(field: str | Column, multi: bool = False) -> Column:
    c = _col(field)
    return (F.size(F.filter(c, lambda x: x.isNotNull())) > 0) if multi else c.isNotNull()


def negate(p: Column) -> Column:
    """NOT with unknown counted as no match: ``~p OR p IS NULL`` (still pushable to the scan, unlike coalesce)."""
    return ~p | p.isNull()


def bool_(must: Iterable[Column] = (), filter: Iterable[Column] = (), should: Iterable[Column] = (),
          must_not: Iterable[Column] = (), minimum_should_match: int | None = None) -> Column:
    """P5: ``must`` and ``filter`` are AND-ed, ``should`` needs ``minimum_should_match`` hits (default 1 when
    there is no must/filter clause, else 0), ``must_not`` excludes (an unknown predicate value counts as no match).
    Plain AND/OR/NOT-or-null forms are kept so Catalyst can push the clauses into the scan."""
    must, filter, should, must_not = list(must), list(filter), list(should), list(must_not)
    parts = must + filter
    if should:
        msm = minimum_should_match if minimum_should_match is not None else (0 if parts else 1)
        if msm == 1:
            parts.append(reduce(lambda a, b: a | b, should))
        elif msm > 1:
            hits = reduce(lambda a, b: a + b, [F.when(p, 1).otherwise(0) for p in should])
            parts.append(hits >= F.lit(msm))
    parts += [negate(p) for p in must_not]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def sql(expr: str) -> Column:
    """Any other predicate, written as a Spark SQL expression."""
    return F.expr(expr)
