"""Spelling variants by Bloom-guided neighbourhoods.

The vocabulary is counted first (occurrences are aggregated before the shuffle). Its words are put into blocked Bloom
filters, one for each word length (lengths from ``LONGEST`` on share one). A word's neighbours at one deleted or
replaced code point are not written out: their hashes follow from the word's prefix hashes, and each is probed against
the filter of its length. Only the positives become strings and are shuffled to an exact join with the vocabulary,
which removes the false ones. An insertion is the deletion seen from the longer word, and a replacement is tried from the
word with the smaller letter only, so each pair is found once and then stands for both words.

The filters take ``KEY_BITS`` bits a word. A vocabulary that needs more than ``FILTER_BYTES`` is cut by hash into slices
that stay below, and the words are probed against one slice's broadcast filter after the other; so what is broadcast
or passes through the driver has a fixed bound at any size, and no probe is left out.

Defined results: null and empty texts have no words; a null id counts as an empty one; repeated rows count every time;
words of any length take part (their probes are made in parts); ties between forms go to the smallest word; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import kernel as K
from .common import cut, table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)          # Latin-1 codes of lower-cased words
NOISE = 97
MIN_LENGTH = 5
MIN_COUNT = 3
FORM_RATIO = 2
KEY_BITS = 16
FILTER_BYTES = 32 << 20
LONGEST = 64
LANES = 8                                            # 32-bit lanes of a filter block, one bit in each
RANGE = 8192                                         # filter blocks built by one task
PROBES = 1 << 20                                     # probes made at a time

_rng = np.random.Generator(np.random.PCG64(13))
_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LANE = _rng.integers(1, 1 << 31, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``word`` per run of letters, lower-cased; runs picked by their hash lose one code point."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(ident.alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0)))
                       .alias("run")).where(F.length("run") >= MIN_LENGTH)
    low = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.col("h") % F.length("run")
    less = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    return hashed.select(F.when(F.col("h") % NOISE == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; written once."""
    return cut(words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") >= min_count))


def _by_length(column: pa.Array):
    """(row numbers, letters as a matrix) for each length of the words of a batch."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    lengths = np.array([len(w) for w in words], np.int64)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield rows, np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), n)


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _prefixes(letters: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes: column i is that of the first i letters."""
    m, n = letters.shape
    out = np.zeros((m, n + 1), np.uint64)
    np.cumsum(_CODE[letters] * _powers(n)[:n], axis=1, out=out[:, 1:])
    return out


def _shard(length: int) -> int:
    return min(length, LONGEST)


class LengthFilters:
    """Blocked Bloom filters by word length in one array; ``slice_`` of ``slices`` parts of the vocabulary."""

    def __init__(self, counts: dict[int, int], slice_: int, slices: int):
        self.slice, self.slices = slice_, slices
        self.first, self.blocks, at = {}, {}, 0
        for shard in sorted(counts):
            self.first[shard], self.blocks[shard] = at, max(1, -(-counts[shard] * KEY_BITS // (32 * LANES)))
            at += self.blocks[shard]
        self.total, self.lanes = at, np.zeros((at, LANES), np.uint32)

    def block(self, h: np.ndarray, shard: int) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)).astype(np.int64) + self.first[shard]

    def holds(self, h: np.ndarray, shard: int) -> np.ndarray:
        """Numbers of the hashes that pass."""
        if shard not in self.first:
            return np.zeros(0, np.int64)
        left = np.arange(len(h))
        if self.slices > 1:
            left = left[_slice_of(h, self.slices) == self.slice]
        block = self.block(h[left], shard)
        for lane in range(LANES):
            ok = (self.lanes[block, lane] >> bit_of(h[left], lane)) & np.uint32(1) == 1
            left, block = left[ok], block[ok]
        return left


def bit_of(h: np.ndarray, lane: int) -> np.ndarray:
    return (((h & np.uint64(0xFFFFFFFF)) * _LANE[lane] >> np.uint64(20)) & np.uint64(31)).astype(np.uint32)


def _finish(h: np.ndarray, length: int) -> np.ndarray:
    return K.mix(h, length)


def _slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return (K.mix(h, 3) % np.uint64(slices)).astype(np.int64)


def _hashes(vocab: DataFrame, slices: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for rows, letters in _by_length(b.column(0)):
                n = letters.shape[1]
                h = _finish(_prefixes(letters)[:, n], n)
                yield pa.RecordBatch.from_arrays([pa.array(_slice_of(h, slices)), pa.array(np.full(len(rows), _shard(n))),
                                                  pa.array(h.view(np.int64))], ["slice", "shard", "h"])
    return vocab.select("word").mapInArrow(run, "slice long, shard long, h long")


def build_filters(vocab: DataFrame, size: int) -> Iterator[LengthFilters]:
    """The filters of each slice, one after the other; every one is below ``FILTER_BYTES`` (plus a block per length)."""
    slices = max(1, -(-size * KEY_BITS // 8 // (FILTER_BYTES // 2)))
    hashes = _hashes(vocab, slices)
    counts: dict[int, dict[int, int]] = {}
    for r in hashes.groupBy("slice", "shard").count().collect():             # at most LONGEST rows a slice
        counts.setdefault(r["slice"], {})[r["shard"]] = r["count"]
    for s, of in sorted(counts.items()):
        f = LengthFilters(of, s, slices)

        def place(batches, f=f):
            for b in batches:
                h, shard = b.column("h").to_numpy().view(np.uint64), b.column("shard").to_numpy()
                block = np.zeros(len(h), np.int64)
                for k in np.unique(shard).tolist():
                    block[shard == k] = f.block(h[shard == k], k)
                yield pa.RecordBatch.from_arrays([pa.array(block // RANGE), pa.array(block % RANGE),
                                                  pa.array(h.view(np.int64))], ["part", "block", "h"])

        def fill(t: pa.Table) -> pa.Table:
            lanes = np.zeros((RANGE, LANES), np.uint32)
            block, h = t.column("block").to_numpy(), t.column("h").to_numpy().view(np.uint64)
            for lane in range(LANES):
                np.bitwise_or.at(lanes[:, lane], block, np.uint32(1) << bit_of(h, lane))
            return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int64()),
                             "bits": pa.array([lanes.tobytes()], pa.binary())})

        placed = hashes.where(F.col("slice") == s).mapInArrow(place, "part long, block long, h long")
        for r in placed.groupBy("part").applyInArrow(fill, "part long, bits binary").toLocalIterator():
            lanes = np.frombuffer(r["bits"], np.uint32).reshape(RANGE, LANES)
            to = r["part"] * RANGE
            f.lanes[to:to + RANGE] = lanes[:f.total - to]
        yield f


def _neighbours(letters: np.ndarray, f: LengthFilters, min_length: int):
    """(row, neighbour) of the probes that pass: one deleted letter, or one replaced by a larger letter."""
    m, n = letters.shape
    prefix, power = _prefixes(letters), _powers(n)
    whole = prefix[:, n]
    if n > min_length:
        for lo in range(0, m * n, PROBES):
            row, at = np.divmod(np.arange(lo, min(lo + PROBES, m * n)), n)
            new = (at == 0) | (letters[row, at] != letters[row, at - 1])      # equal letters in a row: the same result
            row, at = row[new], at[new]
            h = prefix[row, at] + (whole[row] - prefix[row, at + 1]) * _BACK
            for i in f.holds(_finish(h, n - 1), _shard(n - 1)).tolist():
                w = letters[row[i]].tobytes()
                yield row[i], w[:at[i]] + w[at[i] + 1:]
    step = max(1, PROBES // len(LETTERS))
    for lo in range(0, m * n, step):
        row, at = np.divmod(np.arange(lo, min(lo + step, m * n)), n)
        old = letters[row, at]
        place, letter = np.nonzero(LETTERS[None, :] > old[:, None])
        h = (whole[row] - _CODE[old] * power[at])[place] + _CODE[LETTERS[letter]] * power[at][place]
        for i in f.holds(_finish(h, n), _shard(n)).tolist():
            r, a = row[place[i]], at[place[i]]
            w = letters[r].tobytes()
            yield r, w[:a] + LETTERS[letter[i]].tobytes() + w[a + 1:]


def near_pairs(vocab: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n, near, near_n): all pairs of vocabulary words one edit apart, from both sides."""
    size = vocab.count()
    guesses = None
    for f in build_filters(vocab, size):
        shared = vocab.sparkSession.sparkContext.broadcast(f)

        def run(batches, shared=shared):
            for b in batches:
                column, n = b.column(0), b.column(1)
                for rows, letters in _by_length(column):
                    rows_at, near = [], []
                    for r, w in _neighbours(letters, shared.value, min_length):
                        rows_at.append(rows[r])
                        near.append(w.decode("latin-1"))
                        if len(near) >= 10_000:
                            take = pa.array(rows_at, pa.int64())
                            yield pa.RecordBatch.from_arrays([column.take(take), n.take(take), pa.array(near)], ["word", "n", "near"])
                            rows_at, near = [], []
                    take = pa.array(rows_at, pa.int64())
                    yield pa.RecordBatch.from_arrays([column.take(take), n.take(take), pa.array(near, pa.string())],
                                                     ["word", "n", "near"])

        found = cut(vocab.mapInArrow(run, "word string, n long, near string"))
        shared.destroy()                                          # the next slice takes its place
        guesses = found if guesses is None else guesses.unionByName(found)
    if guesses is None:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    exact = cut(guesses.join(vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
                .select("word", "n", "near", "near_n"))
    return exact.unionByName(exact.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(links: DataFrame, depth: int) -> DataFrame:
    """(word, form) links without cycles → (word, root) by pointer doubling; chains have at most ``depth`` links."""
    r = links.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(max(depth, 2))))):
        nxt = r.select(F.col("word").alias("via"), F.col("root").alias("further"))
        r = cut(r.join(nxt, F.col("root") == F.col("via"), "left")
                .select("word", F.coalesce("further", "root").alias("root")))
    return r


def variants(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the words of a one-column table ``word`` of occurrences (code points
    up to U+00FF)."""
    vocab = vocabulary(words, min_length, min_count)
    first = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("first")
    best = near_pairs(vocab, min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    has: Column = -F.col("first.minus") >= F.col("n") * ratio
    judged = cut(vocab.join(best, "word", "left")
                 .select("word", F.when(has, F.col("first.near")).alias("form"), "n",
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(has, -F.col("first.minus")).cast("long").alias("form_n")))
    most = judged.agg(F.max("n")).first()[0] or 1
    depth = math.ceil(math.log(most, ratio)) + 1                     # counts grow by the ratio with each link
    linked = roots(judged.where("form IS NOT NULL"), depth)
    return (judged.join(linked, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(noisy_words(table(spark, sf_dir, "documents")))


OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
low AS (SELECT id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS times FROM runs
        WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hx AS (SELECT run, times, hex(encode(id || ':' || run)) AS hx FROM low),
h AS (
  SELECT run, times, xor(list_reduce(list_transform(range(length(hx) // 2),
      lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) AS h
  FROM hx, crc),
w AS (SELECT CASE WHEN h % {NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
        AS word, times FROM h),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= {MIN_LENGTH} GROUP BY word
      HAVING sum(times) >= {MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM places),
near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cuts x JOIN cuts y
    ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT c.word, c.n, v.word, v.n FROM cuts c JOIN v ON v.word = c.a || c.z
  UNION SELECT v.word, v.n, c.word, c.n FROM cuts c JOIN v ON v.word = c.a || c.z),
best AS (SELECT word, count(*) AS n_near, min({{'minus': -near_n, 'near': near}}) AS first FROM near GROUP BY word),
j AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -first.minus >= {FORM_RATIO} * v.n THEN first.near END AS form,
    CASE WHEN -first.minus >= {FORM_RATIO} * v.n THEN -first.minus END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
chain AS (
  SELECT word, word AS root, 0 AS step FROM j
  UNION ALL SELECT chain.word, j.form, step + 1 FROM chain JOIN j ON j.word = chain.root WHERE j.form IS NOT NULL),
r AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT j.word, form, r.root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM j JOIN r ON r.word = j.word
"""
