"""Search: filter, sort, offset and cursor paging, hit projection.

``search`` returns a :class:`SearchResult` holding the filtered frame and the page frame; nothing runs until the
caller acts. A page is ``orderBy(keys).offset(from).limit(size)`` which Spark plans as ``TakeOrderedAndProject``
(each task keeps only ``from + size`` rows, so no global sort of the collection). Cursor paging adds the keyset
predicate (:func:`docspark.functions.sorting.keyset_after`), which is pushed into the scan as a range filter.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions.sorting import (SortSpec, key_column, key_name, keyset_branches, order_column, parse_sort,
                                 with_tiebreak)
from ..schema import ID_COL, SCORE_COL

DEFAULT_SIZE = 10


@dataclass
class SearchResult:
    filtered: DataFrame          # every matching document (S16 total = filtered.count())
    page: DataFrame              # the requested page, with key columns _k0.._kn and _sort
    specs: list[SortSpec]
    size: int

    def total(self) -> int:
        return self.filtered.count()

    def hits(self) -> DataFrame:
        """The page without the internal key columns."""
        return self.page.drop(*[c for c in self.page.columns if c.startswith("_k") and c[2:].isdigit()])

    def next_cursor(self) -> list | None:
        """Sort values of the last hit of the page (collects only the page's key columns, ``size`` rows)."""
        names = [key_name(i) for i in range(len(self.specs))]
        rows = self.page.select(*names).collect()
        if not rows:
            return None
        return list(rows[-1])


def sort_keys(df: DataFrame, sort: Sequence | None, id_col: str = ID_COL) -> tuple[DataFrame, list[SortSpec]]:
    specs = with_tiebreak(parse_sort(sort), id_col)
    keyed = df.select("*", *[key_column(s).alias(key_name(i)) for i, s in enumerate(specs)])
    return keyed, specs


def search(df: DataFrame, query: Column | None = None, sort: Sequence | None = None, size: int = DEFAULT_SIZE,
           from_: int = 0, after: Sequence[Any] | None = None, id_col: str = ID_COL) -> SearchResult:
    """P1-P6 (``query`` is any boolean Column; None = match_all), O1-O9 on one collection frame."""
    if size < 0 or from_ < 0:
        raise ValueError("size and from must be >= 0")
    filtered = df if query is None else df.filter(query)
    keyed, specs = sort_keys(filtered, sort, id_col)
    names = [key_name(i) for i in range(len(specs))]
    if after is not None:
        branches = keyset_branches(specs, names, list(after))
        parts = [keyed.filter(b) for b in branches]
        keyed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    ordered = keyed.orderBy(*[order_column(n, s) for n, s in zip(names, specs)])
    if from_:
        ordered = ordered.offset(from_)
    page = ordered.limit(size)
    page = page.withColumn("_sort", F.struct(*[F.col(n).alias(s.field) for n, s in zip(names, specs)]))
    return SearchResult(filtered, page, specs, size)


def with_rank(page: DataFrame, specs: list[SortSpec], offset: int = 0) -> DataFrame:
    """Add the 1-based position of each hit on an already limited page (at most ``size`` rows, so the
    single-partition window here is bounded by the page size)."""
    names = [key_name(i) for i in range(len(specs))]
    w = Window.orderBy(*[order_column(n, s) for n, s in zip(names, specs)])
    return page.withColumn("rank", (F.row_number().over(w) + F.lit(offset)).cast("long"))


def pages(df: DataFrame, sort: Sequence | None, size: int, query: Column | None = None, max_pages: int | None = None,
          id_col: str = ID_COL):
    """Iterate cursor pages (each page is one bounded ``TakeOrderedAndProject``); stops on an empty page."""
    cursor = None
    n = 0
    while max_pages is None or n < max_pages:
        res = search(df, query, sort, size, 0, cursor, id_col)
        cursor = res.next_cursor()
        if cursor is None:
            return
        yield res
        n += 1
