"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: every word of a piece starts one window of ``max_words`` words, whose lead
columns are padded where the piece ends. An occurrence of a shorter phrase is the beginning of exactly one window, so
its count is the sum over the windows that begin with it. No n-grams of any other order are generated: window counts
are shuffled once, to the partition of their first two words, where the sums of all prefixes of two words and more
follow in place; one ``ROLLUP`` sums first words and languages (and the parts of hot pairs).

A window travels as two strings (language and first two words; the other words) with its count. Tasks combine equal
windows before the shuffle, ``CHUNK`` rows at a time, and sort them, which lets the shuffle's compression drop repeated
beginnings. First pairs that hold more than a ``HOT``-th of a sample's windows (at most ``HOT`` pairs) are dealt to
``SALTS`` parts by their other words; that changes the layout only, sums of the parts are added up.

Every part of a phrase that occurs ``min_count`` times occurs at least as often itself, so only counts from there on
are kept, written once, and joined to the candidates' parts (the session's skewed-join splitting takes frequent
words). Ranks are limited in ``SALTS`` parts of each language first.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows and null ids count like
any other row; all orders are total (score, count, phrase), so there are no ties; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import cut, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_END = r"[.,;:!?\x0A-\x0D]"
WORD = r"[^\x20\x09]+"
MAX_WORDS = 3
MIN_COUNT = 10
SCALE = 1_000_000
INSIDE = 50                  # per cent of a phrase's occurrences that lie in one longer candidate
KEEP = 2000
SALTS = 32
HOT = 500
SAMPLE = 0.01                # of the rows, to find hot pairs
CHUNK = 1 << 20


def windows(docs: DataFrame, max_words: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(head, tail) of the window that each word starts: language, tab and its first two words; the other words."""
    names = [f"w{i}" for i in range(1, max_words + 1)]
    text = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    pieces = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                         F.explode(F.split(text, PIECE_END)).alias("piece"))
    words = pieces.select("lang", F.regexp_extract_all("piece", F.lit(WORD), F.lit(0)).alias("w1"))
    leads = [F.slice("w1", i, F.size("w1")).alias(n) for i, n in enumerate(names, 1) if i > 1]
    starts = words.select("lang", "w1", *leads).select("lang", F.inline(F.arrays_zip(*names)))
    head = F.concat(F.col("lang"), F.lit("\t"), F.concat_ws(" ", *names[:2]))
    return starts.select(head.alias("head"), F.concat_ws(" ", *names[2:]).alias("tail"))


def _combined(wins: DataFrame) -> DataFrame:
    """(head, tail, f): equal windows of a task added up, a chunk of rows at a time, sorted."""
    def add(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).group_by(["head", "tail"], use_threads=False).aggregate([([], "count_all")])
        t = t.sort_by([("head", "ascending"), ("tail", "ascending")])
        yield from t.rename_columns(["head", "tail", "f"]).to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= CHUNK:
                yield from add(held)
                held, rows = [], 0
        if rows:
            yield from add(held)

    return wins.mapInArrow(run, "head string, tail string, f long")


def _hot_heads(docs: DataFrame, max_words: int, lang_col: str, text_col: str) -> list[str]:
    """First pairs with more than a ``HOT``-th of the windows of a fixed sample of rows: fewer than ``HOT``."""
    wins = windows(docs.sample(SAMPLE, seed=11), max_words, lang_col, text_col)
    total = wins.count()
    return [r["head"] for r in wins.groupBy("head").count().where(F.col("count") * HOT > total).collect()]


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, lang_col: str = "lang",
                  text_col: str = "text") -> DataFrame:
    """(lang, phrase, size, f): every phrase of up to ``max_words`` words that occurs ``min_count`` times, and per
    language a row of size 0 whose count is the number of its words. Written once."""
    hot = F.col("head").isin(_hot_heads(docs, max_words, lang_col, text_col))
    salt = F.when(hot, F.pmod(F.xxhash64(F.substring_index("tail", " ", 1)), F.lit(SALTS))).otherwise(F.lit(0))
    dealt = (_combined(windows(docs, max_words, lang_col, text_col)).withColumn("salt", salt.cast("int"))
             .repartition("head", "salt"))
    # an expression over all columns that filters can't pass and no column can be pruned from: one exchange serves all
    dealt = dealt.withColumn("f", F.when((F.spark_partition_id() >= 0) & F.col("tail").isNotNull(), F.col("f")))
    lang, words = F.substring_index("head", "\t", 1).alias("lang"), F.substring_index("head", "\t", -1)
    longer = []
    for size in range(3, max_words + 1):                       # windows of one beginning are in one partition
        rest = F.split("tail", " ")
        begin = F.col("tail") if size == max_words else F.array_join(F.slice(rest, 1, size - 2), " ")
        long_enough = (F.col("tail") != "") & (F.size(rest) >= size - 2)
        sums = (dealt.where(long_enough).groupBy("head", "salt", begin.alias("begin")).agg(F.sum("f").alias("f"))
                .where(F.col("f") >= min_count))
        longer.append(sums.select(lang, F.concat_ws(" ", words, "begin").alias("phrase"), F.lit(size).alias("size"), "f"))
    pairs = dealt.groupBy("head", "salt").agg(F.sum("f").alias("f"))
    pair = F.when(F.contains(words, F.lit(" ")) & (hot | (F.col("f") >= min_count)), words)
    shorter = F.array_compact(F.array(F.struct(F.substring_index(words, " ", 1).alias("phrase"), F.col("f").alias("words")),
                                      F.when(pair.isNotNull(), F.struct(pair.alias("phrase"), F.lit(0).cast("long").alias("words")))))
    rolled = (pairs.select(lang, "f", F.inline(shorter)).rollup("lang", "phrase")
              .agg(F.sum("f").alias("f"), F.sum("words").alias("words"), F.grouping_id().alias("level")).where("level < 2"))
    size = F.when(F.col("level") == 1, 0).otherwise(F.size(F.split("phrase", " ")))
    out = rolled.where((F.col("level") == 1) | (F.col("f") >= min_count)).select(
        "lang", F.coalesce("phrase", F.lit("")).alias("phrase"), size.alias("size"),
        F.when(F.col("level") == 1, F.col("words")).otherwise(F.col("f")).alias("f"))
    for other in longer:
        out = out.unionByName(other)
    return cut(out)


def _scored(counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of each candidate's lowest-scoring cut."""
    cuts = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - size) AS tail")
    part = counts.where("size > 0")
    left = part.select(F.col("lang").alias("hl"), F.col("phrase").alias("hp"), F.col("f").alias("l"))
    right = part.select(F.col("lang").alias("tl"), F.col("phrase").alias("tp"), F.col("f").alias("r"))
    cuts = (cuts.join(left, (F.col("lang") == F.col("hl")) & (F.col("head") == F.col("hp")))
            .join(right, (F.col("lang") == F.col("tl")) & (F.col("tail") == F.col("tp"))))
    exact = [F.col(c).cast("decimal(19,0)").alias(c) for c in ("a", "l", "r")]
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(7,0)) * x.a * x.a) div (x.l * x.r)").cast("long")
    cuts = cuts.withColumn("x", F.struct(*exact)).withColumn("score", score)
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return (cuts.groupBy("lang", "phrase", "size", "a").agg(best)
            .select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score"))


def _inside_longer(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer candidate that holds the phrase."""
    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> "
                   "array_join(slice(split(phrase, ' '), i, m), ' '))))")
    return (candidates.where(F.size(words) > 2).select("lang", "a", F.explode(spans).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))


def _top(df: DataFrame, keep: int, order: list[Column]) -> DataFrame:
    part = df.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = part.withColumn("at", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= keep)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= keep).drop("salt", "at")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, keep: int = KEEP,
                 inside: int = INSIDE, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``keep`` phrases of each language."""
    counts = phrase_counts(docs, max_words, min_count, lang_col, text_col)
    candidates = counts.where("size > 1").withColumnRenamed("f", "a")
    held = _inside_longer(candidates)
    scored = _scored(counts, candidates)
    free = (scored.join(held, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)))
    best = _top(free, keep, [F.desc("score"), F.desc("a"), F.asc("phrase")])
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return (best.join(words, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                    *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PIECE_END}')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '{WORD}') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS MATERIALIZED (SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3 FROM s),
f AS MATERIALIZED (
  SELECT lang, w1 AS phrase, 1 AS size, count(*) AS f FROM g GROUP BY lang, w1
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3),
c AS MATERIALIZED (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
parts AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail FROM k),
u AS (
  SELECT parts.lang, parts.phrase, a, k, h.f AS l, t.f AS r,
    CAST((1000000::HUGEINT * a * a) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM parts JOIN f h ON h.lang = parts.lang AND h.phrase = head JOIN f t ON t.lang = parts.lang AND t.phrase = tail),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE size = 3)
  GROUP BY lang, phrase),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang)
SELECT b.lang, CAST(row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS BIGINT) AS rank,
  b.phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN held ON held.lang = b.lang AND held.phrase = b.phrase
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""
