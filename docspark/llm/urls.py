"""URL rules by Bloom filter cascades: exact membership without a join.

A rule is a host and a path prefix; it fits its host and all subdomains. Every url has a short list of *keys* that a
rule could have: each suffix of its host (by labels) with each beginning of its path that has the length of some
rule's path. A cascade is built over all keys of the corpus: level 1 is a Bloom filter of the listed keys, level 2 one
of the corpus keys that level 1 takes in wrongly, level 3 one of the listed keys that level 2 takes in wrongly, and so
on until a level has no false positives. For every key of the corpus the first level that misses it tells whether it
is listed. A url takes the verdict of its longest listed key (of two of one length, the one with the longer host);
one cascade per verdict tells which; a url without a listed key is allowed.

Level 1 has about 1.44 * log2(corpus keys / listed keys) bits per listed key and the later levels shrink, so what is
broadcast is bounded by the rule list (``BITS_PER_KEY`` bits for each rule), never by the corpus. Building joins the
corpus keys with the rules once per level; judging reads only the urls and the cascades.

Defined results: a null url and one without ``://`` have an empty host and path, no rule and the verdict allow;
repeated rows give repeated result rows; without rules every verdict is allow; rules with an empty host are refused.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import kernel as K
from .common import cut, table

BITS_PER_KEY = 64
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str | Column) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(u, _URL, 1), upper, upper.lower()), F.lit(""))


def path(url: str | Column) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(u, _URL, 2), F.lit(""))


def keys_of(host_col: str, path_col: str, lengths: list[int]) -> Column:
    """The keys of a url, longest first."""
    labels = F.split(F.col(host_col), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path_col))
    starts = F.transform(fits, lambda n: F.substring(F.col(path_col), F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.struct(
        F.length(F.concat(s, p)).alias("n"), F.length(s).alias("h"), F.concat(s, p).alias("key")))))
    return F.transform(F.sort_array(pairs, asc=False), lambda x: x["key"])


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.concat(key, F.lit("\u0001"))).alias("h2")]


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, k: int, bits: int) -> np.ndarray:
    base = K.mix(h1.view(np.uint64), level)
    step = K.mix(h2.view(np.uint64), level + 101) | np.uint64(1)
    i = np.arange(k, dtype=np.uint64)
    return (K.mix(base[:, None] + step[:, None] * i) % np.uint64(bits)).astype(np.int64)


class Cascade:
    """Bloom filters in levels; each level is (bit array, number of bits, hashes per key)."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, int, int]] = []

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words, bits, k = self.levels[level]
        at = _positions(h1, h2, level, k, bits)
        return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool).all(1)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether each key is listed; exact for the keys of the corpus the cascade was built over."""
        answer = np.zeros(len(h1), bool)
        left = np.arange(len(h1))
        for level in range(len(self.levels)):
            left = left[self.passes(level, h1[left], h2[left])]
            answer[left] = level % 2 == 0
        return answer


def _through(keys: DataFrame, cascade: Cascade) -> DataFrame:
    """The keys (key, h1, h2) that pass every level so far."""
    shared = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches):
        for b in batches:
            c = shared.value
            ok = np.ones(b.num_rows, bool)
            h1, h2 = b.column("h1").to_numpy(), b.column("h2").to_numpy()
            for level in range(len(c.levels)):
                ok &= c.passes(level, h1, h2)
            yield b.filter(pa.array(ok))

    return keys.mapInArrow(run, keys.schema)


def _bits(keys: DataFrame, level: int, k: int, bits: int) -> np.ndarray:
    """The bytes of a Bloom filter of the keys: bit positions are merged by Spark, the driver gets the set bytes."""
    def run(batches):
        for b in batches:
            at = np.unique(_positions(b.column("h1").to_numpy(), b.column("h2").to_numpy(), level, k, bits))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array((1 << (at & 7)).astype(np.int32))],
                                             ["at", "bit"])

    out = np.zeros((bits + 7) // 8, np.uint8)
    for r in keys.select("h1", "h2").mapInArrow(run, "at long, bit int").groupBy("at").agg(
            F.bit_or("bit").alias("bit")).toLocalIterator():
        out[r["at"]] = r["bit"]
    return out


def build(listed: DataFrame, universe: DataFrame, max_levels: int = 64) -> Cascade:
    """Cascade of the ``listed`` keys over the corpus keys ``universe`` (both: distinct key, h1, h2)."""
    inside = cut(listed.join(universe.select("key"), "key", "left_semi"))
    outside = universe.join(listed.select("key"), "key", "left_anti")
    n_in, cascade = inside.count(), Cascade()
    if not n_in:
        return cascade
    n_out = max(outside.count(), 1)
    wanted, n, other = inside, n_in, outside
    rate = min(0.5, max(n_in / n_out, 2.0 ** -40)) * math.sqrt(0.5)
    while n:
        level = len(cascade.levels)
        if level >= max_levels:
            raise ValueError("the cascade does not close: two keys share both hashes")
        k = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(min(1.44 * -math.log2(rate), BITS_PER_KEY) * n))
        cascade.levels.append((_bits(wanted, level, k, bits), bits, k))
        wanted, other = cut(_through(other, cascade)), wanted      # false positives of this level come next
        n, rate = wanted.count(), 0.5
    return cascade


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row. ``rules``: (host, path, verdict) with verdicts allow or block."""
    spark = pages.sparkSession
    rules = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    if rules.where("host IS NULL OR host = ''").limit(1).count():
        raise ValueError("a rule has no host")
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())   # path lengths, not rules
    urls = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col).cast("string")).alias("host"),
                        path(F.col(url_col).cast("string")).alias("path"))
    keyed = urls.withColumn("keys", keys_of("host", "path", lengths))
    universe = cut(keyed.select(F.explode("keys").alias("key")).distinct().select("key", *_hashes(F.col("key"))))
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict").distinct()
    cascades = {v: build(listed.where(F.col("verdict") == v).select("key", *_hashes(F.col("key"))), universe)
                for v in ("block", "allow")}
    shared = spark.sparkContext.broadcast(cascades)

    def run(batches):
        for b in batches:
            h1, h2 = (b.column(c).flatten().to_numpy() for c in ("h1", "h2"))
            row = np.repeat(np.arange(b.num_rows), b.column("h1").value_lengths().to_numpy())
            first = np.searchsorted(row, np.arange(b.num_rows))
            best = np.full(b.num_rows, np.iinfo(np.int64).max)
            verdict = np.full(b.num_rows, "allow", object)
            for v, c in shared.value.items():
                hit = np.flatnonzero(c.contains(h1, h2))
                r, at = np.unique(row[hit], return_index=True)
                place = hit[at] - first[r]
                better = place < best[r]
                best[r[better]], verdict[r[better]] = place[better], v
            found = best < np.iinfo(np.int64).max
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("page_id", "host", "path", "keys")),
                 pa.array(np.where(found, best + 1, 0).astype(np.int32), mask=~found), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "keys", "at", "verdict"])

    kind = dict(urls.dtypes)["page_id"]
    hashed = keyed.withColumns({"h1": F.transform("keys", lambda k: F.xxhash64(k)), "h2": F.transform(
        "keys", lambda k: F.xxhash64(F.concat(k, F.lit("\u0001"))))})
    judged = hashed.mapInArrow(run, f"page_id {kind}, host string, path string, keys array<string>, at int, verdict string")
    return judged.select("page_id", "host", "path", F.element_at("keys", F.col("at")).alias("rule"), "verdict")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP2_SQL = r"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')),
m AS (SELECT p.*, rh || rp AS rule, v,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
best AS (SELECT DISTINCT host, path, rule, v FROM m WHERE k = 1)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.v, 'allow') AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path
"""
