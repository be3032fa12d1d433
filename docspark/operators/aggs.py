"""Named aggregations over filtered documents.

``aggregate(df, {"name": Agg, ...}, query=...)`` returns ``{"name": DataFrame}``. All metric aggregations are fused
into one ``agg`` (one pass, partial + final hash aggregation); every bucket aggregation is its own grouped plan. The
filtered input is cached only when more than one plan reads it.

Scale notes: ``terms`` / ``date_histogram`` are partial-aggregated group-bys, so a hot key costs one row per map task.
Ranges are one conditional count per range in a single pass (no range join). ``top_hits`` uses
``row_number() <= k`` which Spark plans as ``WindowGroupLimit`` before the shuffle, so at most ``k`` rows per bucket
and map task move. Exact medians (MAD) use a distributed rank selection, never a single-task percentile buffer.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window

from ..functions.dates import iso_string, to_epoch_millis
from ..functions.ip import cidr_bounds, ip_key, key_bytes, key_to_string
from ..functions.sorting import key_column, order_column, parse_sort, with_tiebreak
from ..plans.sizing import partitions_for
from ..schema import ID_COL


def _c(f: str | Column) -> Column:
    return F.col(f) if isinstance(f, str) else f


# ----------------------------------------------------------------------------------------------------------------
# Specifications
# ----------------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Metric:
    """One-value metric. ``kind`` in avg, min, max, sum, value_count, cardinality, or a
    custom aggregate Column (G18) via ``expr``."""

    kind: str
    field: str | Column | None = None
    multi: bool = False
    exact: bool = False        # cardinality: count_distinct instead of the HLL++ sketch
    rsd: float = 0.01          # cardinality sketch relative standard deviation
    expr: Column | None = None

    def column(self) -> Column:
        if self.expr is not None:
            return self.expr
        c = _c(self.field)
        if self.multi:
            raise ValueError("use explode_multi() before metric aggregation of multi-valued fields")
        k = self.kind
        if k == "avg":
            return F.avg(c)
        if k == "min":
            return F.min(c)
        if k == "max":
            return F.max(c)
        if k == "sum":
            return F.sum(c)
        if k == "value_count":
            return F.count(c)
        if k == "cardinality":
            return F.count_distinct(c) if self.exact else F.approx_count_distinct(c, self.rsd)
        raise ValueError(k)


def Avg(field, **kw):
    return Metric("avg", field, **kw)


def Min(field, **kw):
    return Metric("min", field, **kw)


def Max(field, **kw):
    return Metric("max", field, **kw)


def Sum(field, **kw):
    return Metric("sum", field, **kw)


def ValueCount(field, multi: bool = False):
    if multi:
        return Metric("value_count", expr=F.sum(F.size(F.filter(_c(field), lambda x: x.isNotNull()))).cast("long"))
    return Metric("value_count", field)


def Cardinality(field, exact: bool = False, rsd: float = 0.01):
    return Metric("cardinality", field, exact=exact, rsd=rsd)


def sketch_column(field, lg_k: int = 12) -> Column:
    """The mergeable sketch of a field's distinct values (binary, at most about 2^``lg_k`` bytes); nulls do not
    count. The relative error of its estimate is about 1.04 / sqrt(2^``lg_k``). Values count by their string form, so
    that sketches of columns of different types merge."""
    return F.hll_sketch_agg(_c(field).cast("string"), F.lit(lg_k))


def cardinality_sketches(df: DataFrame, field: str | Column, by=(), lg_k: int = 12) -> DataFrame:
    """One sketch for each slice (the ``by`` columns): (by..., sketch). Stored with its slice, a sketch stands in for
    the slice's rows; it is an aggregation with map-side combining, without a distinct shuffle."""
    return df.groupBy(*by).agg(sketch_column(field, lg_k).alias("sketch"))


def merge_cardinality(sketches: DataFrame, by=(), column: str = "sketch") -> DataFrame:
    """(by..., value): the distinct count of the union of the slices' sketches. A group without a sketch counts 0."""
    merged = F.hll_sketch_estimate(F.hll_union_agg(F.col(column)))
    return sketches.groupBy(*by).agg(F.coalesce(merged, F.lit(0)).cast("long").alias("value"))


def Custom(expr: Column):
    return Metric("custom", expr=expr)


@dataclass(frozen=True)
class Stats:
    """Count, min, max, avg, sum of one field in the same pass."""
    field: str | Column


@dataclass(frozen=True)
class MedianAbsoluteDeviation:
    """median(|x - median(x)|). ``approx=True`` uses ``percentile_approx`` (one pass)."""
    field: str
    approx: bool = False
    accuracy: int = 10000


@dataclass(frozen=True)
class Terms:
    """G1: top ``size`` keys by document count (ties by key), null keys dropped. ``metrics`` are per-bucket
    metrics computed in the same group-by."""
    field: str | Column
    size: int = 10
    multi: bool = False
    min_doc_count: int = 1
    metrics: Mapping[str, Metric] = field(default_factory=dict)


@dataclass(frozen=True)
class SignificantTerms:
    """Keys over-represented in the foreground set (``foreground`` predicate) against all documents."""
    field: str | Column
    foreground: Column
    size: int = 10
    min_doc_count: int = 3


@dataclass(frozen=True)
class DateHistogram:
    """``calendar_interval`` (minute, hour, day, week, month, quarter, year) or ``fixed_interval``
    (e.g. ``'90m'``, ``'12h'``, ``'7d'``). Empty buckets between the first and last are filled with 0 when
    ``min_doc_count == 0``."""
    field: str
    calendar_interval: str | None = None
    fixed_interval: str | None = None
    min_doc_count: int = 0


@dataclass(frozen=True)
class Range:
    """``ranges`` = [{"from": a, "to": b, "key": optional}], ``from`` inclusive, ``to`` exclusive."""
    field: str | Column
    ranges: Sequence[Mapping[str, Any]]


@dataclass(frozen=True)
class DateRange:
    """Ranges given as ISO date strings (or epoch millis)."""
    field: str
    ranges: Sequence[Mapping[str, Any]]


@dataclass(frozen=True)
class IpRange:
    """Ranges as {"from": ip, "to": ip} or {"mask": "10.0.0.0/8"} on an IP string field."""
    field: str
    ranges: Sequence[Mapping[str, Any]]


@dataclass(frozen=True)
class TopHits:
    """Per bucket of ``by`` (or over everything when None), the first ``size`` documents by ``sort``,
    with the bucket's total."""
    by: str | Column | None
    sort: Sequence
    size: int = 3
    source: Sequence[str] | None = None


# ----------------------------------------------------------------------------------------------------------------
# Metric fusion
# ----------------------------------------------------------------------------------------------------------------

def _metric_columns(name: str, spec) -> list[Column]:
    if isinstance(spec, Metric):
        return [spec.column().alias(name)]
    if isinstance(spec, Stats):
        c = _c(spec.field)
        return [F.count(c).alias(f"{name}_count"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max"),
                F.avg(c).alias(f"{name}_avg"), F.sum(c).alias(f"{name}_sum")]
    raise TypeError(spec)


def _metric_names(name: str, spec) -> list[str]:
    return [f"{name}_{p}" for p in ("count", "min", "max", "avg", "sum")] if isinstance(spec, Stats) else [name]


def _apart(specs: Mapping[str, Any]) -> list[str]:
    """The exact cardinalities that need an aggregation of their own. An aggregation with a distinct count groups its
    input by the distinct values first, and holds the state of every other aggregate once for each of them: next to
    a sketch (or a custom aggregate, whose state may have any size) that is a sketch per value, so all exact
    cardinalities run apart. Otherwise the first may stay; more would force an ``Expand`` of the input per column."""
    own = [k for k, s in specs.items() if isinstance(s, Metric)]
    exact = [k for k in own if specs[k].kind == "cardinality" and specs[k].exact]
    large = [k for k in own if specs[k].expr is not None or (specs[k].kind == "cardinality" and not specs[k].exact)]
    return exact if large else exact[1:]


def metrics(df: DataFrame, specs: Mapping[str, Any]) -> DataFrame:
    """All metrics in one aggregation → one row; exact cardinalities in aggregations of their own where
    :func:`_apart` says so."""
    exact = [k for k, s in specs.items() if isinstance(s, Metric) and s.kind == "cardinality" and s.exact]
    apart = _apart(specs)
    fused = {k: s for k, s in specs.items() if k not in apart}
    out = df.agg(*[c for k, s in fused.items() for c in _metric_columns(k, s)])
    if apart:
        # one-row frames stacked and folded back to one row (no cross join)
        stacked = out
        for k in apart:
            stacked = stacked.unionByName(df.agg(specs[k].column().alias(k)), allowMissingColumns=True)
        names = [c for k, s in specs.items() if k not in exact[1:] for c in _metric_names(k, s)] + exact[1:]
        out = stacked.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in names])
    return out


def bucket_metrics(df: DataFrame, key: str, specs: Mapping[str, Any], *counts: Column) -> DataFrame:
    """(key, counts..., metrics...) of every non-null value of column ``key``: one group-by, and one more for each exact
    cardinality that :func:`_apart` names, joined by key."""
    apart = _apart(specs)
    columns = [c for k, s in specs.items() if k not in apart for c in _metric_columns(k, s)]
    out = df.groupBy(key).agg(*counts, *columns)
    if not apart:
        return out
    for k in apart:
        out = out.join(df.groupBy(key).agg(specs[k].column().alias(k)), key)
    named = [c for k, s in specs.items() for c in _metric_names(k, s)]
    return out.select(key, *[c for c in out.columns if c != key and c not in named], *named)


# ----------------------------------------------------------------------------------------------------------------
# Bucket aggregations
# ----------------------------------------------------------------------------------------------------------------

def terms(df: DataFrame, spec: Terms) -> DataFrame:
    key = _c(spec.field)
    if spec.multi:
        base = df.select(F.explode(F.array_distinct(key)).alias("key"), "*")
    else:
        base = df.select(key.alias("key"), "*")
    base = base.filter(F.col("key").isNotNull())
    g = bucket_metrics(base, "key", spec.metrics, F.count(F.lit(1)).alias("doc_count"))
    if spec.min_doc_count > 1:
        g = g.filter(F.col("doc_count") >= spec.min_doc_count)
    out = g.orderBy(F.desc("doc_count"), F.asc("key")).limit(spec.size)
    # date keys are epoch milliseconds and boolean keys 1/0, each with its text form in key_as_string
    kt = out.schema["key"].dataType
    if isinstance(kt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        extra = [c for c in out.columns if c not in ("key", "doc_count")]
        return out.select(to_epoch_millis(F.col("key")).alias("key"), iso_string(F.col("key")).alias("key_as_string"),
                          "doc_count", *extra)
    if isinstance(kt, T.BooleanType):
        extra = [c for c in out.columns if c not in ("key", "doc_count")]
        return out.select(F.col("key").cast("int").alias("key"),
                          F.when(F.col("key"), "true").otherwise("false").alias("key_as_string"), "doc_count", *extra)
    return out


def significant_terms(df: DataFrame, spec: SignificantTerms) -> DataFrame:
    """JLH score ``(f - b) * (f / b)`` with ``f = fg_count / fg_total`` and ``b = bg_count / bg_total``, kept when
    ``f > b``. Totals are one scalar aggregation (two numbers collected), then a single group-by."""
    fg = F.coalesce(spec.foreground, F.lit(False))
    tot = df.agg(F.count_if(fg).alias("fg"), F.count(F.lit(1)).alias("bg")).first()
    fg_total, bg_total = int(tot["fg"]), int(tot["bg"])
    g = (df.select(_c(spec.field).alias("key"), fg.alias("__fg")).filter(F.col("key").isNotNull())
         .groupBy("key").agg(F.count_if(F.col("__fg")).alias("doc_count"), F.count(F.lit(1)).alias("bg_count")))
    if fg_total == 0:
        return g.limit(0).withColumn("score", F.lit(0.0))
    f = F.col("doc_count") / F.lit(float(fg_total))
    b = F.col("bg_count") / F.lit(float(bg_total))
    return (g.filter(F.col("doc_count") >= spec.min_doc_count)
            .withColumn("score", (f - b) * (f / b)).filter(f > b)
            .orderBy(F.desc("score"), F.asc("key")).limit(spec.size))


# Fixed-interval unit suffixes in milliseconds.
FIXED_UNITS_MS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
# Calendar intervals and their date_trunc unit.
CALENDAR_UNITS = {"minute": "minute", "1m": "minute", "hour": "hour", "1h": "hour", "day": "day", "1d": "day",
                  "week": "week", "1w": "week", "month": "month", "1M": "month", "quarter": "quarter",
                  "1q": "quarter", "year": "year", "1y": "year"}
# Lengths of the fixed-length calendar units in milliseconds.
CALENDAR_MS = {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 7 * 86_400_000}


def _fixed_ms(s: str) -> int:
    for suffix in sorted(FIXED_UNITS_MS, key=len, reverse=True):
        if s.endswith(suffix) and s[: -len(suffix)].isdigit():
            return int(s[: -len(suffix)]) * FIXED_UNITS_MS[suffix]
    raise ValueError(f"bad fixed_interval {s!r}")


def date_histogram(df: DataFrame, spec: DateHistogram) -> DataFrame:
    ts = F.col(spec.field).cast("timestamp")
    if spec.calendar_interval:
        unit = CALENDAR_UNITS[spec.calendar_interval]
        bucket = F.date_trunc(unit, ts)
    else:
        ms = _fixed_ms(spec.fixed_interval)
        bucket = F.timestamp_millis(F.floor(F.unix_millis(ts) / ms) * ms)
    counts = df.select(bucket.alias("b")).filter(F.col("b").isNotNull()).groupBy("b") \
        .agg(F.count(F.lit(1)).alias("doc_count"))
    if spec.min_doc_count == 0:
        # Gap filling: the first and last bucket (one row, as epoch millis) fix the bucket sequence, which is
        # generated by spark.range across partitions (never expanded inside one row) and left-joined to the counts.
        spark = df.sparkSession
        bounds = counts.agg(F.unix_millis(F.min("b")).alias("lo"), F.unix_millis(F.max("b")).alias("hi"),
                            F.year(F.min("b")).alias("ly"), F.month(F.min("b")).alias("lm"),
                            F.year(F.max("b")).alias("hy"), F.month(F.max("b")).alias("hm")).first()
        if bounds["lo"] is None:
            out = counts.select("b", F.col("doc_count").cast("long"))
        else:
            lo, hi = int(bounds["lo"]), int(bounds["hi"])
            months = {"month": 1, "quarter": 3, "year": 12}.get(unit) if spec.calendar_interval else None
            if months:
                n = ((bounds["hy"] - bounds["ly"]) * 12 + (bounds["hm"] - bounds["lm"])) // months
                seq = spark.range(0, n + 1).select(
                    F.add_months(F.timestamp_millis(F.lit(lo)), (F.col("id") * months).cast("int")).cast("timestamp").alias("b"))
            else:
                step_ms = CALENDAR_MS[unit] if spec.calendar_interval else ms
                seq = spark.range(0, (hi - lo) // step_ms + 1).select(
                    F.timestamp_millis(F.lit(lo) + F.col("id") * F.lit(step_ms)).alias("b"))
            out = seq.join(counts, "b", "left").select("b", F.coalesce("doc_count", F.lit(0)).cast("long").alias("doc_count"))
    else:
        out = counts.filter(F.col("doc_count") >= max(spec.min_doc_count, 1))
    return out.select(to_epoch_millis(F.col("b")).alias("key"), iso_string(F.col("b")).alias("key_as_string"),
                      F.col("b").cast("timestamp_ntz").alias("bucket"), "doc_count")


def _range_key(r: Mapping[str, Any], lo_s: str | None, hi_s: str | None) -> str:
    if r.get("key"):
        return str(r["key"])
    return f"{lo_s if lo_s is not None else '*'}-{hi_s if hi_s is not None else '*'}"


def _stack(df: DataFrame, rows: list[tuple], conds: list[Column]) -> DataFrame:
    """One pass: a conditional count per range, then the counts are laid out one row per range."""
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conds)])
    return counts.select(F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in row], F.col(f"c{i}").alias("doc_count"))
        for i, row in enumerate(rows)])).alias("r")).select("r.*")


def range_agg(df: DataFrame, spec: Range) -> DataFrame:
    x = _c(spec.field)
    rows, conds = [], []
    for r in spec.ranges:
        lo, hi = r.get("from"), r.get("to")
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & (x < F.lit(hi))
        rows.append([("key", _range_key(r, None if lo is None else str(float(lo)), None if hi is None else str(float(hi)))),
                     ("from", None if lo is None else float(lo)), ("to", None if hi is None else float(hi))])
        conds.append(cond & x.isNotNull())
    out = _stack(df, rows, conds)
    return out.select("key", F.col("from").cast("double"), F.col("to").cast("double"), "doc_count")


def date_range_agg(df: DataFrame, spec: DateRange) -> DataFrame:
    import datetime as _dt
    x = F.col(spec.field).cast("timestamp")
    rows, conds = [], []

    def ms_of(v):
        if v is None:
            return None
        if isinstance(v, (int, float)):
            return int(v)
        t = _dt.datetime.fromisoformat(str(v).replace("Z", "+00:00"))
        if t.tzinfo is None:
            t = t.replace(tzinfo=_dt.timezone.utc)
        return int(t.timestamp() * 1000)

    def as_str(ms):
        if ms is None:
            return None
        t = _dt.datetime.fromtimestamp(ms / 1000, _dt.timezone.utc)
        return t.strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"

    for r in spec.ranges:
        lo, hi = ms_of(r.get("from")), ms_of(r.get("to"))
        cond = x.isNotNull()
        if lo is not None:
            cond = cond & (x >= F.timestamp_millis(F.lit(lo)))
        if hi is not None:
            cond = cond & (x < F.timestamp_millis(F.lit(hi)))
        rows.append([("key", _range_key(r, as_str(lo), as_str(hi))), ("from", lo), ("from_as_string", as_str(lo)),
                     ("to", hi), ("to_as_string", as_str(hi))])
        conds.append(cond)
    out = _stack(df, rows, conds)
    return out.select("key", F.col("from").cast("long"), F.col("from_as_string").cast("string"),
                      F.col("to").cast("long"), F.col("to_as_string").cast("string"), "doc_count")


def ip_range_agg(df: DataFrame, spec: IpRange) -> DataFrame:
    # the 16-byte key is computed once per row in a projection; every range's condition reads that column
    df = df.select(ip_key(F.col(spec.field)).alias("__ipk"))
    k = F.col("__ipk")
    rows, conds = [], []
    for r in spec.ranges:
        if "mask" in r:
            lo, hi = cidr_bounds(r["mask"])
            key = r.get("key") or r["mask"]
        else:
            lo = key_bytes(r["from"]) if r.get("from") else None
            hi = key_bytes(r["to"]) if r.get("to") else None
            key = r.get("key") or f"{r.get('from') or '*'}-{r.get('to') or '*'}"
        cond = k.isNotNull()
        if lo is not None:
            cond = cond & (k >= F.lit(bytearray(lo)))
        if hi is not None:
            cond = cond & (k < F.lit(bytearray(hi)))
        rows.append([("key", key), ("from", None if lo is None else key_to_string(lo)),
                     ("to", None if hi is None else key_to_string(hi))])
        conds.append(cond)
    out = _stack(df, rows, conds)
    return out.select("key", F.col("from").cast("string"), F.col("to").cast("string"), "doc_count")


SALT_HITS_ABOVE, HIT_SALTS = 1000, 64


def top_hits(df: DataFrame, spec: TopHits, id_col: str = ID_COL) -> DataFrame:
    specs = with_tiebreak(parse_sort(spec.sort), id_col)
    bucket = F.lit("_all") if spec.by is None else _c(spec.by)
    keyed = df.select("*", bucket.alias("bucket"), *[key_column(s).alias(f"_k{i}") for i, s in enumerate(specs)])
    keyed = keyed.filter(F.col("bucket").isNotNull())
    order = [order_column(f"_k{i}", s) for i, s in enumerate(specs)]
    w = Window.partitionBy("bucket").orderBy(*order)
    best = keyed
    if spec.by is None:
        best = keyed.orderBy(*order).limit(spec.size)            # top-k in every task, then one merge of those
    elif spec.size > SALT_HITS_ABOVE:
        # Spark limits a ranking before its shuffle only for small ranks; larger ones are cut in slices of the bucket
        salted = Window.partitionBy("bucket", "_salt").orderBy(*order)
        best = (keyed.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(HIT_SALTS)))
                .withColumn("_r", F.row_number().over(salted)).filter(F.col("_r") <= spec.size).drop("_salt", "_r"))
    top = best.withColumn("hit_rank", F.row_number().over(w)).filter(F.col("hit_rank") <= spec.size)
    totals = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("total"))
    cols = list(spec.source) if spec.source else [c for c in df.columns]
    return top.join(totals, "bucket").select("bucket", "total", "hit_rank", *cols)


# ----------------------------------------------------------------------------------------------------------------
# Exact median without a single-task buffer (for G11)
# ----------------------------------------------------------------------------------------------------------------

def exact_quantile(df: DataFrame, col: str, q: float = 0.5, partitions: int | None = None) -> float | None:
    """Exact quantile (linear interpolation between the two middle ranks, like ``percentile``/DuckDB ``median``).

    Distributed rank selection: values are counted per distinct value (partial aggregation absorbs hot values),
    range-partitioned and sorted, checkpointed so both passes see the same partitions; per-partition totals
    (one number per partition) give each partition's starting rank; a per-partition running sum then finds the
    one or two values at the target ranks. No step holds more than one partition's distinct values."""
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    vals = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    vc = vals.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    n_parts = partitions or partitions_for(vals)
    ordered = vc.repartitionByRange(n_parts, "x").sortWithinPartitions("x").withColumn("pid", F.spark_partition_id())
    ordered = ordered.checkpoint(eager=True)
    totals = ordered.groupBy("pid").agg(F.sum("c").alias("n"))
    n = int(totals.agg(F.sum("n")).first()[0] or 0)
    if n == 0:
        return None
    from .scan import partition_starts
    pos = q * (n - 1)
    lo_rank, hi_rank = int(pos) + 1, min(int(pos) + 2, n)       # 1-based ranks
    frac = pos - int(pos)
    w = Window.partitionBy("pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    cum = ordered.join(F.broadcast(partition_starts(totals, "pid", "n")), "pid") \
        .withColumn("end", F.col("__start") + F.sum("c").over(w))
    hits = cum.filter(((F.col("end") - F.col("c") < lo_rank) & (F.col("end") >= lo_rank))
                      | ((F.col("end") - F.col("c") < hi_rank) & (F.col("end") >= hi_rank))).select("x", "end", "c").collect()

    def at(rank):
        for r in hits:
            if r["end"] - r["c"] < rank <= r["end"]:
                return float(r["x"])
        raise RuntimeError("rank not found")

    lo, hi = at(lo_rank), at(hi_rank)
    return lo + (hi - lo) * frac


def grouped_exact_median(df: DataFrame, key: str | Column, value: str | Column, key_name: str = "key",
                         partitions: int | None = None) -> DataFrame:
    """(key, median) for every key, exact (mean of the two middle values for even counts), whatever a key's size:
    see :func:`_distributed_group_median`."""
    vals = df.select(_c(key).alias("k"), _c(value).cast("double").alias("x")).filter(F.col("x").isNotNull() & F.col("k").isNotNull())
    return _distributed_group_median(vals, key_name, partitions)


def _distributed_group_median(vals: DataFrame, key_name: str, partitions: int | None = None) -> DataFrame:
    """Exact per-key median by rank selection: values are counted per (key, value) (partial aggregation),
    range-partitioned on (key, value) so a hot key spreads over many partitions, and checkpointed. Per
    (key, partition) counts (at most one row per partition a key spans) give each slice its starting rank; a
    running sum inside each slice then finds the rows holding the middle ranks."""
    from ..session import ensure_checkpoint_dir
    spark = vals.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = partitions or partitions_for(vals)
    vc = vals.groupBy("k", "x").agg(F.count(F.lit(1)).alias("c"))
    ranged = vc.repartitionByRange(n_parts, "k", "x").withColumn("pid", F.spark_partition_id()).checkpoint(eager=True)
    slices = ranged.groupBy("k", "pid").agg(F.sum("c").alias("n"))
    wk = Window.partitionBy("k").orderBy("pid")
    slices = slices.select("k", "pid", (F.sum("n").over(wk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"),
                           F.sum("n").over(Window.partitionBy("k")).alias("total"))
    joined = ranged.join(slices, ["k", "pid"])
    ws = Window.partitionBy("k", "pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ends = joined.withColumn("end", F.col("start") + F.sum("c").over(ws))
    lo = F.floor((F.col("total") - 1) / 2) + 1
    hi = F.floor(F.col("total") / 2) + 1

    def covers(r):
        return (F.col("end") - F.col("c") < r) & (F.col("end") >= r)

    picked = ends.filter(covers(lo) | covers(hi))
    return picked.groupBy(F.col("k").alias(key_name)).agg(
        ((F.max(F.when(covers(lo), F.col("x"))) + F.max(F.when(covers(hi), F.col("x")))) / 2).alias("median"))


def median_absolute_deviation(df: DataFrame, spec: MedianAbsoluteDeviation) -> DataFrame:
    spark = df.sparkSession
    if spec.approx:
        m = df.agg(F.percentile_approx(spec.field, 0.5, spec.accuracy).alias("m")).first()["m"]
        if m is None:
            return spark.createDataFrame([(None,)], "value double")
        return df.agg(F.percentile_approx(F.abs(F.col(spec.field) - F.lit(float(m))), 0.5, spec.accuracy)
                      .cast("double").alias("value"))
    m = exact_quantile(df, spec.field)
    if m is None:
        return spark.createDataFrame([(None,)], "value double")
    dev = df.select(F.abs(F.col(spec.field).cast("double") - F.lit(m)).alias("d"))
    return spark.createDataFrame([(exact_quantile(dev, "d"),)], "value double")


# ----------------------------------------------------------------------------------------------------------------
# Entry point
# ----------------------------------------------------------------------------------------------------------------

def aggregate(df: DataFrame, aggs: Mapping[str, Any], query: Column | None = None) -> dict[str, DataFrame]:
    """G16 + G17: named aggregations over the documents matching ``query``. All metrics share one scan; each bucket
    aggregation scans only the columns it reads."""
    base = df if query is None else df.filter(query)
    metric_specs = {k: s for k, s in aggs.items() if isinstance(s, (Metric, Stats))}
    bucket_specs = {k: s for k, s in aggs.items() if k not in metric_specs}
    out: dict[str, DataFrame] = {}
    if metric_specs:
        row = metrics(base, metric_specs)
        for k, s in metric_specs.items():
            if isinstance(s, Stats):
                out[k] = row.select(*[F.col(f"{k}_{p}").alias(p) for p in ("count", "min", "max", "avg", "sum")])
            else:
                out[k] = row.select(F.col(k).alias("value"))
    for k, s in bucket_specs.items():
        if isinstance(s, Terms):
            out[k] = terms(base, s)
        elif isinstance(s, SignificantTerms):
            out[k] = significant_terms(base, s)
        elif isinstance(s, DateHistogram):
            out[k] = date_histogram(base, s)
        elif isinstance(s, Range):
            out[k] = range_agg(base, s)
        elif isinstance(s, DateRange):
            out[k] = date_range_agg(base, s)
        elif isinstance(s, IpRange):
            out[k] = ip_range_agg(base, s)
        elif isinstance(s, TopHits):
            out[k] = top_hits(base, s)
        elif isinstance(s, MedianAbsoluteDeviation):
            out[k] = median_absolute_deviation(base, s)
        else:
            raise TypeError(f"unknown aggregation {k!r}: {s!r}")
    return out
