"""Text analysis, token tables and BM25 relevance.

1. T1 split on runs of non-letter/non-digit characters (``[^\\p{L}\\p{N}]+``), empties dropped;
2. T2/T3 user dictionary: a raw token is cut into dictionary words and what lies between them. With
   ``segmentation="prefix"`` only the longest word that starts the token is split off (``노트북을`` → ``노트북`` +
   ``을``); with ``"whole"`` the cut leaves the fewest characters outside dictionary words, then uses the fewest words,
   then, from the left, the longer word. Compound rules ``word part1 part2`` emit the word, its parts or both
   (decompound mode);
3. T5 tokens whose tag is in ``stoptags`` are removed (dictionary words and parts are ``NNG``; other tokens are
   tagged by script: ``SN`` digits, ``SL`` Latin, ``SH`` Han, ``UNKNOWN`` otherwise);
4. T4 lowercase;
5. T6 search-time synonyms expand query tokens only; the longest rule that fits the tokens wins, from the left.

Analysis is a per-row array expression and never shuffles. With a dictionary the expression is an Arrow function that
cuts each distinct raw token of a batch once, looking its substrings up among the rules by hash.

BM25 (k1=1.2, b=0.75) takes one corpus scan that keeps the query tokens' counts of each row and observes the totals.
A persisted token index (:func:`build_token_index`) serves repeated queries by reading only the query tokens' row
groups. Rows are scored each by its own text; an id that repeats gets the score of its best row, on every path.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.sizing import BROADCAST_MAX_ROWS, collect_bounded, ensure_parallelism, maybe_broadcast, partitions_for
from ..schema import ID_COL, SCORE_COL
from ..session import ensure_checkpoint_dir

# Fixed value: token separator pattern (runs of anything that is not a letter or a digit).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# Decompound modes.
DECOMPOUND_MODES = ("none", "discard", "mixed")
# Fixed value: tag of user-dictionary words and their parts.
DICT_TAG = "NNG"
# How a token is cut into dictionary words.
SEGMENTATIONS = ("prefix", "whole")
BM25_K1 = 1.2
BM25_B = 0.75

# Bytes of index read for one task that scores many queries, and of a row group of the index.
MATCH_PARTITION_BYTES = 4 << 20
SEGMENT_ROW_GROUP = 16 << 20

TOKEN_STRUCT = "struct<token:string,tag:string>"


@dataclass(frozen=True)
class Analyzer:
    lowercase: bool = True
    user_dictionary: tuple[str, ...] = ()
    decompound: str = "mixed"
    stoptags: tuple[str, ...] = ()
    synonyms: tuple[str, ...] = ()
    pattern: str = TOKEN_SPLIT
    segmentation: str = "prefix"

    def __post_init__(self):
        if self.segmentation not in SEGMENTATIONS:
            raise ValueError(f"bad segmentation {self.segmentation!r}")
        if self.decompound not in DECOMPOUND_MODES:
            raise ValueError(f"bad decompound mode {self.decompound!r}")

    def dictionary(self) -> dict[str, list[str]]:
        """``word`` or ``word part1 part2`` rules → {word: parts} (later rules replace earlier ones)."""
        out: dict[str, list[str]] = {}
        for rule in self.user_dictionary:
            words = rule.split()
            if not words:
                continue
            w = [x.lower() for x in words] if self.lowercase else words
            out[w[0]] = w[1:]
        return out

    def synonym_rules(self) -> dict[tuple[str, ...], list[tuple[str, ...]]]:
        return synonym_rules(self.synonyms, self.lowercase)


def korean_analysis(decompound: str = "mixed", stoptags=(), synonyms=(), user_dictionary_rules=()) -> dict:
    """T2-T7 preset: the index analyser, plus a search analyser with synonyms only when synonyms are given."""
    index = Analyzer(True, tuple(user_dictionary_rules), decompound, tuple(stoptags), (), segmentation="whole")
    out = {"index": index}
    if synonyms:
        out["search"] = replace(index, synonyms=tuple(synonyms))
    return out


def synonym_rules(rules, lowercase: bool = True) -> dict[tuple[str, ...], list[tuple[str, ...]]]:
    """``A,B`` makes A and B equivalent; ``A => B`` rewrites A to B; each of A and B is one or more words.
    Whitespace around commas is removed; rules that do not parse (empty side, several arrows) are skipped.
    Returns {words: [alternative, ...]}."""
    out: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for rule in rules:
        sides = (rule.lower() if lowercase else rule).split("=>")
        if len(sides) > 2:
            continue
        terms = [[t for t in (tuple(x.split()) for x in side.split(",")) if t] for side in sides]
        if not all(terms) or (len(terms) == 1 and len(terms[0]) < 2):
            continue
        for source in terms[0]:
            known = out.setdefault(source, [])
            known += [t for t in dict.fromkeys(terms[-1]) if t not in known]
    return out


def parse_synonyms(rules, lowercase: bool = True) -> dict[str, list[str]]:
    """The rules of single words only: {word: [word, ...]}."""
    single = [r for r in rules if all(len(x.split()) <= 1 for side in r.split("=>") for x in side.split(","))]
    return {k[0]: [t[0] for t in v] for k, v in synonym_rules(single, lowercase).items()}


def _tag(t: Column) -> Column:
    return (F.when(t.rlike(r"^\p{N}+$"), "SN").when(t.rlike(r"^[A-Za-z]+$"), "SL")
            .when(t.rlike(r"^\p{IsHan}+$"), "SH").otherwise("UNKNOWN"))


def _tok(t: Column, tag: Column | str) -> Column:
    return F.struct(t.alias("token"), (F.lit(tag) if isinstance(tag, str) else tag).alias("tag"))


def _raw_tokens(text: Column, analyzer: "Analyzer") -> Column:
    src = F.lower(text) if analyzer.lowercase else text
    return F.filter(F.split(F.coalesce(src, F.lit("")), analyzer.pattern), lambda x: x != "")


def cut_token(token: str, matches: list[tuple[int, str]]) -> list[tuple[str, bool]]:
    """The token as (piece, is a dictionary word) in order, given the (start, word) matches in it: the cheapest path
    over its characters, where the cost is the characters outside words, then the number of words, and a longer first
    word breaks ties. Time and memory follow the token's length and its matches."""
    at = defaultdict(list)
    for start, word in matches:
        at[start].append(len(word))
    best: list[tuple[int, int]] = [(0, 0)] * (len(token) + 1)
    step = [0] * len(token)                                  # length of the word that starts here on the best path
    for i in range(len(token) - 1, -1, -1):
        paths = [(best[i + 1][0] + 1, best[i + 1][1], 0)]
        paths += [(best[i + n][0], best[i + n][1] + 1, -n) for n in at[i]]
        outside, words, first = min(paths)
        best[i], step[i] = (outside, words), -first
    pieces, i, gap = [], 0, 0
    while i < len(token):
        if step[i]:
            if gap < i:
                pieces.append((token[gap:i], False))
            pieces.append((token[i:i + step[i]], True))
            gap = i = i + step[i]
        else:
            i += 1
    if gap < len(token):
        pieces.append((token[gap:], False))
    return pieces


def _emitted(token: str, analyzer: "Analyzer", dictionary: dict[str, list[str]], lengths: list[int]) -> list[tuple[str, str | None]]:
    """What one raw token becomes, as (token, tag); the tag of a piece outside dictionary words is left open."""
    starts = range(len(token)) if analyzer.segmentation == "whole" else range(1)
    matches = [(s, token[s:s + n]) for s in starts for n in lengths if s + n <= len(token) and token[s:s + n] in dictionary]
    if analyzer.segmentation == "prefix":
        matches = matches[-1:]                               # lengths ascend: the longest word
    out: list[tuple[str, str | None]] = []
    for piece, known in cut_token(token, matches) if matches else [(token, False)]:
        parts = dictionary[piece] if known and analyzer.decompound != "none" else []
        if not known or not parts or analyzer.decompound != "discard":
            out.append((piece, DICT_TAG if known else None))
        out += [(p, DICT_TAG) for p in parts]
    return out


def segmented(raw: Column, analyzer: "Analyzer", tagged: bool = False) -> Column:
    """An array of raw tokens → the array of emitted tokens (``tagged``: of struct<token,tag>, where a null tag
    is still to be found). Rows stay where they are; each distinct token of an Arrow batch is cut once, and the cuts are
    dealt back to the tokens by their number. The rules are looked up by hash, whatever their number."""
    dictionary = analyzer.dictionary()
    lengths = sorted({len(w) for w in dictionary})
    item = pa.struct([("token", pa.string()), ("tag", pa.string())]) if tagged else pa.string()

    def run(rows: pa.Array) -> pa.Array:
        words = rows.flatten().dictionary_encode()
        if not len(words):
            return pa.array([[]] * len(rows), pa.list_(item))
        cuts = [_emitted(t, analyzer, dictionary, lengths) for t in words.dictionary.to_pylist()]
        cuts = [[{"token": t, "tag": g} for t, g in c] if tagged else [t for t, _ in c] for c in cuts]
        found = pa.array(cuts, pa.list_(item)).take(words.indices)
        ends = pc.subtract(rows.offsets, rows.offsets[0])
        return pa.ListArray.from_arrays(found.offsets.take(ends), found.values)

    # not deterministic for the optimizer: a filter on the result would otherwise run the function a second time
    return F.arrow_udf(run, f"array<{TOKEN_STRUCT}>" if tagged else "array<string>").asNondeterministic()(raw)


def _analyzed_tokens(text: Column, analyzer: "Analyzer") -> Column:
    raw = _raw_tokens(text, analyzer)
    if not analyzer.user_dictionary:
        return analyze(text, analyzer)
    if not analyzer.stoptags:
        return segmented(raw, analyzer)
    cut = F.transform(segmented(raw, analyzer, True), lambda z: _tok(z["token"], F.coalesce(z["tag"], _tag(z["token"]))))
    return F.transform(_without(cut, analyzer), lambda z: z["token"])


def analyzed(df: DataFrame, text_col: str, analyzer: "Analyzer", columns=()) -> DataFrame:
    """``columns`` and ``__toks`` (array<string>, T1-T5) of every row. Rows are not moved."""
    return ensure_parallelism(df).select(*columns, _analyzed_tokens(F.col(text_col), analyzer).alias("__toks"))


def _without(emitted: Column, analyzer: "Analyzer") -> Column:
    """T5: array<struct<token,tag>> less the tokens whose tag is a stoptag."""
    if not analyzer.stoptags:
        return emitted
    stop = F.array(*[F.lit(s) for s in analyzer.stoptags])
    return F.filter(emitted, lambda z: ~F.array_contains(stop, z["tag"]))


def analyze(text: Column, analyzer: Analyzer = Analyzer()) -> Column:
    """T1, T4, T5 as one expression: ``array<string>`` of tokens in order (position = array index). A user dictionary
    needs joins, which an expression can't have: use :func:`analyzed` or :func:`tokens`."""
    if analyzer.user_dictionary:
        raise ValueError("an analyzer with a user dictionary works on DataFrames: use analyzed() or tokens()")
    raw = _raw_tokens(text, analyzer)
    if not analyzer.stoptags:
        return raw
    tagged = F.transform(raw, lambda t: _tok(t, _tag(t)))
    return F.transform(_without(tagged, analyzer), lambda s: s["token"])


def expand_synonyms(df: DataFrame, column: str, analyzer: Analyzer) -> DataFrame:
    """``df`` with the token array ``column`` rewritten: from the left, the longest run of tokens that a rule
    names gives way to all its alternatives, one after the other; other tokens stay."""
    rules = analyzer.synonym_rules()
    if not rules:
        return df
    longest = max(len(k) for k in rules)
    if longest == 1:
        m = F.create_map(*[x for k, v in rules.items()
                           for x in (F.lit(k[0]), F.array(*[F.lit(w) for t in v for w in t]))])
        return df.withColumn(column, F.flatten(F.transform(column, lambda t: F.coalesce(F.element_at(m, t), F.array(t)))))
    flat = {k: [w for t in v for w in t] for k, v in rules.items()}

    def rewrite(words: list[str]) -> list[str]:
        out, i = [], 0
        while i < len(words):
            n = next((n for n in range(min(longest, len(words) - i), 0, -1) if tuple(words[i:i + n]) in flat), 0)
            out += flat[tuple(words[i:i + n])] if n else words[i:i + 1]
            i += n or 1
        return out

    def run(batches):
        for b in batches:
            at = b.schema.names.index(column)
            new = pa.array([rewrite(w or []) for w in b.column(at).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], new, *b.columns[at + 1:]], b.schema.names)

    return df.mapInArrow(run, df.schema)


def tokens(df: DataFrame, text_col: str, id_col: str = ID_COL, analyzer: Analyzer = Analyzer(),
           search_time: bool = False) -> DataFrame:
    """(id, pos, token) rows; ``search_time=True`` applies the synonym expansion (query side)."""
    rows = analyzed(df, text_col, analyzer, [id_col])
    if search_time:
        rows = expand_synonyms(rows, "__toks", analyzer)
    return rows.select(F.col(id_col), F.posexplode("__toks").alias("pos", "token")) \
        .select(id_col, F.col("pos").cast("long").alias("pos"), "token")


def query_tokens(spark, query: str, analyzer: Analyzer = Analyzer()) -> list[str]:
    """Analyse one query string on Spark (same code path as the documents) and return its distinct tokens."""
    one = spark.range(1).select(F.lit(query).alias("text"))
    rows = expand_synonyms(analyzed(one, "text", analyzer), "__toks", analyzer)
    return list(dict.fromkeys(t for r in rows.collect() for t in r["__toks"]))


# ----------------------------------------------------------------------------------------------------------------
# BM25 over a text column (no index)
# ----------------------------------------------------------------------------------------------------------------

def _gain(idf: Column, tf: Column, dl: Column, avgdl: float | Column, k1: float, b: float) -> Column:
    avgdl = F.lit(avgdl) if isinstance(avgdl, float) else avgdl
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl.cast("double") / avgdl)
    return idf * tf * F.lit(k1 + 1.0) / (tf + norm)


def bm25(df: DataFrame, text_col: str, query: str | list[str], id_col: str = ID_COL,
         index_analyzer: Analyzer = Analyzer(), search_analyzer: Analyzer | None = None,
         k1: float = BM25_K1, b: float = BM25_B, keep: list[str] | None = None) -> DataFrame:
    """P4 + T8: documents with at least one query token (OR semantics) and their BM25 ``_score``.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); tf and document length count analysed tokens, N and df count rows.
    Rows that share an id are scored each by its own text; the id gets its best row's score (and ``keep`` columns).

    One scan of the corpus: a row's tokens shrink to the counts of the query tokens in it, and only rows with one are
    written to the checkpoint folder, while the corpus totals (N, total length) are observed on the same scan.
    Scoring then reads only those rows."""
    from pyspark.sql import Observation
    from ..plans.sizing import scratch_path
    spark = df.sparkSession
    q = query if isinstance(query, list) else query_tokens(spark, query, search_analyzer or index_analyzer)
    q = list(dict.fromkeys(q))
    keep = keep or []
    if not q:
        return df.limit(0).select(F.col(id_col), *keep, F.lit(0.0).alias(SCORE_COL))
    docs = analyzed(df, text_col, index_analyzer, [id_col, *[k for k in keep if k != id_col]])
    obs = Observation(f"bm25_{uuid.uuid4().hex[:12]}")
    docs = docs.observe(obs, F.count(F.lit(1)).alias("n"), F.sum(F.size("__toks")).alias("total_len"))
    docs = docs.withColumn("dl", F.size("__toks")).withColumn("__toks", F.filter("__toks", lambda t: t.isin(q)))
    counts = F.transform(F.array_sort(F.array_distinct("__toks")), lambda t: F.struct(
        t.alias("token"), F.size(F.filter("__toks", lambda x: x == t)).alias("tf")))
    path = scratch_path(spark, "bm25")
    docs.where(F.size("__toks") > 0).withColumn("hits", counts).drop("__toks").write.parquet(path)
    t = spark.read.parquet(path)
    dfs = {r["token"]: int(r["df"]) for r in collect_bounded(
        t.select(F.explode("hits.token").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df")), len(q),
        "token frequencies")}
    if not dfs:
        # nothing matched; the statistics are not needed (and an empty branch may have been pruned with them)
        return t.select(id_col, *keep, F.lit(0.0).alias(SCORE_COL))
    st = obs.get
    n, total = int(st["n"] or 0), int(st["total_len"] or 0)
    avgdl = total / n if total else 1.0
    idf = F.create_map(*[x for tok, d in dfs.items()
                         for x in (F.lit(tok), F.lit(math.log(1.0 + (n - d + 0.5) / (d + 0.5))))])
    score = F.aggregate("hits", F.lit(0.0), lambda acc, h: acc + _gain(
        F.element_at(idf, h["token"]), h["tf"], F.col("dl"), avgdl, k1, b))
    scored = t.withColumn(SCORE_COL, score)
    own = [F.max_by(F.col(k), F.col(SCORE_COL)).alias(k) for k in keep if k != id_col]
    return scored.groupBy(id_col).agg(*own, F.max(SCORE_COL).alias(SCORE_COL)).select(id_col, *[k for k in keep if k != id_col], SCORE_COL)


# ----------------------------------------------------------------------------------------------------------------
# Persisted token index (T7) and matching against it
# ----------------------------------------------------------------------------------------------------------------

def token_table(df: DataFrame, text_col: str, id_col: str = ID_COL, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """(token, id, tf) with partial aggregation per (token, id)."""
    return tokens(df, text_col, id_col, analyzer).groupBy("token", id_col).agg(F.count(F.lit(1)).alias("tf"))


def token_counts(tokens: Column) -> Column:
    """An array of tokens → array<struct<token,tf>>, each token once. Counted where the row lies, without a shuffle."""
    item = pa.struct([("token", pa.string()), ("tf", pa.int64())])

    def run(rows: pa.Array) -> pa.Array:
        words = rows.flatten().dictionary_encode()
        size, row = max(len(words.dictionary), 1), np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
        pairs, tf = np.unique(row * size + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
        found = pa.StructArray.from_arrays([words.dictionary.take(pa.array(pairs % size)).cast(pa.string()),
                                            pa.array(tf.astype("int64"))], fields=list(item))
        ends = np.searchsorted(pairs // size, np.arange(len(rows) + 1))
        return pa.ListArray.from_arrays(pa.array(ends.astype("int32")), found)

    return F.arrow_udf(run, "array<struct<token:string,tf:long>>").asNondeterministic()(tokens)


def build_token_index(df: DataFrame, text_col: str, path: str, id_col: str = ID_COL,
                      analyzer: Analyzer = Analyzer(), partitions: int | None = None) -> None:
    """Write ``{path}/terms`` (token, id, row, tf, dl) in segments: each task counts the tokens of its own rows and
    writes them as one file sorted by token and id, so building moves no row. Page and row-group statistics prune a match
    query to its tokens' part of every segment, and a frequent token is spread over all of them. ``row`` tells rows that
    share an id apart. ``{path}/stats`` holds the number of rows and their mean length. The texts are tokenised once.
    ``partitions`` deals the rows into that many segments; otherwise they stay as they come."""
    spark = df.sparkSession
    rows = df.repartition(partitions) if partitions else df
    rows = analyzed(rows, text_col, analyzer, [id_col]).withColumn("row", F.monotonically_increasing_id())
    words = rows.select(id_col, "row", F.size("__toks").cast("long").alias("dl"), F.explode(token_counts(F.col("__toks"))).alias("t"))
    words.select("t.token", id_col, "row", "t.tf", "dl").sortWithinPartitions("token", id_col) \
        .write.option("parquet.block.size", SEGMENT_ROW_GROUP).mode("overwrite").parquet(f"{path}/terms")
    totals = df.select(F.lit(1).alias("n"), F.lit(0).cast("long").alias("words")) \
        .unionByName(spark.read.parquet(f"{path}/terms").select(F.lit(0).alias("n"), F.col("tf").alias("words")))
    totals.agg(F.sum("n").alias("n"), F.sum("words").alias("words")) \
        .select("n", (F.coalesce("words", F.lit(0)) / F.greatest("n", F.lit(1))).alias("avgdl")) \
        .write.mode("overwrite").parquet(f"{path}/stats")                       # one row


def match_index(spark, path: str, query: str, id_col: str = ID_COL, analyzer: Analyzer = Analyzer(),
                k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """P4/T8 against a token index: only the query tokens' rows are read (``token IN (...)`` is pushed to the scan);
    document frequencies come from those rows, lengths stand in them, and the totals are one stored row."""
    q = query_tokens(spark, query, analyzer)
    terms = spark.read.parquet(f"{path}/terms").filter(F.col("token").isin(q))
    gain = _index_gain(spark, path, terms, k1, b, len(q))
    scored = gain.groupBy(id_col, "row").agg(F.sum("gain").alias(SCORE_COL))
    return scored.groupBy(id_col).agg(F.max(SCORE_COL).alias(SCORE_COL))


def _index_gain(spark, path: str, terms: DataFrame, k1: float, b: float, most: int | None = None) -> DataFrame:
    """``terms`` (rows of a token index, all of each token that is there) with what each adds to its row's score.
    ``most`` is a bound on the number of tokens; without one the token table is counted before it is broadcast."""
    st = spark.read.parquet(f"{path}/stats").first()
    n, avgdl = float(st["n"] or 0), float(st["avgdl"] or 1.0)
    dfs = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    dfs = F.broadcast(dfs) if most is not None and most <= BROADCAST_MAX_ROWS else maybe_broadcast(dfs)
    idf = F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return terms.join(dfs, "token").withColumn("gain", _gain(idf, F.col("tf"), F.col("dl"), avgdl, k1, b)).drop("df")


def match_many(spark, path: str, queries: DataFrame, k: int = 10, query_id: str = "query_id", query_col: str = "query",
               id_col: str = ID_COL, analyzer: Analyzer = Analyzer(), k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """P4/T8 for a table of queries in one plan: (query_id, rank, id, _score), the ``k`` best ids of each query.

    The queries' tokens are a table joined to the index by token (broadcast only under a counted bound; beyond it the
    join shuffles and AQE splits frequent tokens), so their number has no bound. Only index rows of asked tokens are
    dealt by id, once and before they meet the queries: what a task then holds of an id is all of it, so scores are
    summed and ranked there, and ``k`` rows a query and task go on. Scores are rounded to nine digits, so that equal texts
    tie; ties go to the smaller id. Rows of one query id are one query; a query without a known token returns nothing."""
    asked = tokens(queries, query_col, query_id, analyzer, search_time=True).select(query_id, "token").distinct()
    terms = spark.read.parquet(f"{path}/terms")
    terms = terms.join(maybe_broadcast(asked.select("token").distinct()), "token", "left_semi")
    gains = _index_gain(spark, path, terms, k1, b).select("token", id_col, "row", "gain")
    hits = gains.repartition(partitions_for(gains, MATCH_PARTITION_BYTES), id_col).join(maybe_broadcast(asked), "token")
    scored = hits.groupBy(query_id, id_col, "row").agg(F.sum("gain").alias(SCORE_COL))
    scored = scored.groupBy(query_id, id_col).agg(F.round(F.max(SCORE_COL), 9).alias(SCORE_COL))
    order = Window.partitionBy(query_id).orderBy(F.desc(SCORE_COL), F.asc(id_col))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select(query_id, "rank", id_col, SCORE_COL)


# ----------------------------------------------------------------------------------------------------------------
# Field-level analysers and text search (T7 + P4 + P5 + O5)
# ----------------------------------------------------------------------------------------------------------------

def field_analyzers(collection, field: str) -> tuple[Analyzer, Analyzer]:
    """(index, search) analysers of a declared text field, resolved by name from ``settings['analysis']``
    (name → :class:`Analyzer`); unnamed means the standard chain; no search analyser means the index one."""
    f = collection.field_at(field)
    if f is None or f.type != "text":
        raise ValueError(f"{field!r} is not a declared text field")
    registry = dict(collection.settings.get("analysis", {})) if collection.settings else {}

    def resolve(name):
        if name is None:
            return None
        if name not in registry:
            raise ValueError(f"analyzer {name!r} is not defined in the collection's analysis settings")
        return registry[name]

    index = resolve(f.analyzer) or Analyzer()
    return index, resolve(f.search_analyzer) or index


def match_search(df: DataFrame, collection, field: str, query: str, filter: Column | None = None,
                 sort=None, size: int = 10, from_: int = 0, id_col: str = ID_COL):
    """``bool(must=match(field, query), filter=...)``: BM25 over the whole collection (statistics are not
    affected by the filter), hits restricted by ``filter``, sorted by ``_score`` descending unless ``sort`` says
    otherwise, then paged like any search. Returns a :class:`~docspark.operators.search.SearchResult`."""
    from .search import search
    index, search_an = field_analyzers(collection, field)
    scores = bm25(df, field, query, id_col, index, search_an)
    hits = df.join(maybe_broadcast(scores, 1_000_000), id_col)
    return search(hits, filter, sort or [(SCORE_COL, "desc")], size, from_, id_col=id_col)
