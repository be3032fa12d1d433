"""Exact top-k search: BM25 over sharded inverted indexes with block bounds.

Rows are dealt to shards by the hash of their id. A shard's index holds its postings by term (64-bit word hashes),
with frequencies and lengths. Global statistics (rows, mean length, document frequencies of the query terms) come from
all shards, so every shard scores like one index and the merge of the shards' best rows is exact.

In a shard, rows that share frequent terms stand together (halves along the main direction of their most frequent terms,
again and again), by length, in blocks of at most ``BLOCK``. Queries are taken ``TOGETHER``. The postings of a term that
is frequent in a block form a row of that block's dense impacts; the others are added up first, over their whole lists.
What a block's rows have then and the largest impacts of its frequent terms bound what a query can find there; a block
that stays below the query's limit is skipped, and the others take one product of weights and dense impacts for all
queries that they are not skipped by. Blocks of long rows come first. A query's limit is its floor or the k-th score so far.
Dense impacts, weights and sums have single precision; limits leave a slack above the rounding of such sums, and the scores
returned are correctly rounded sums in double precision, taken from the few rows that are left by their own terms, so equal
texts have equal scores in any shard; ties go to the smaller id.

Queries are broadcast in blocks of at most ``QUERY_BLOCK`` rows. The index is built once; a shard is prepared once and
asked by all blocks, and the distinct terms of a block are looked up in it once. The shards are asked in rounds, each of as
many as all before (the first: one for every core). The k-th best score of the rounds before is a query's floor in the next:
no row below it can be among the k best, so blocks are skipped by it and, with rows dealt by hash, a round after the first
returns about k rows a query however many shards it has.

Defined results: null and empty texts are indexed with no terms and never found; a query without a known term returns
nothing; rows with a null id can be found, after others of the same score; repeated rows are found each; words are
compared with A-Z lower-cased; a repeated query word counts each time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from . import kernel as K
from .common import cut, parts_for, table

K1, B = 1.2, 0.75
BLOCK = 1024
SHARD_MB = 20
QUERY_BLOCK = 4096
FREQUENT = 10                # a term in more than a tenth of a block's rows (mean of its share there and in rows like them)
LISTED = 8                   # or in no more rows of a block than this is not frequent
TOGETHER = 256               # queries scored at a time, or fewer,
HELD = 1 << 22               # so that they hold at most this many sums
FIRST = 1                    # shards a core in the first round
TERM_PARTS = 256             # parts that terms are counted in
GUIDES, HALVINGS = 128, 4    # rows are put together by this many terms, halved this often at most
COUNT = np.arange(1 << 16)
LAST = np.iinfo(np.int64).max
_ARRAYS = {"ids": np.int64, "lengths": np.int64, "terms": np.uint64, "starts": np.int64, "docs": None, "tf": None,
           "edges": np.int64, "parents": np.int64}
_NARROW = {1: np.uint8, 2: np.uint16, 4: np.int32}                # of the arrays that have no kind above, by their bytes


def _order(hashes: np.ndarray) -> np.ndarray:
    """A stable order by hash: a sort of the first bits with the places after them, if those bits tell the hashes apart."""
    last = np.uint64((1 << len(hashes).bit_length()) - 1)
    packed = hashes & ~last
    packed |= np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    packed &= last
    order = packed.view(np.int64)
    found = hashes[order]
    return order if (found[:-1] <= found[1:]).all() else np.argsort(hashes, kind="stable")


def _counted(column: pa.Array):
    """(row, term, frequency) of distinct words per row, and the words per row."""
    rows, terms, tfs, lengths = [], [], [], np.zeros(len(column), np.int64)
    for lo, hi, w in K.chunks(column, table=K.LOWER):
        lengths[lo:hi] = w.counts
        h, row = w.hashes(), w.rows().astype(np.uint16 if hi - lo <= 1 << 16 else np.int32)
        order = _order(h)
        order = order[np.argsort(row[order], kind="stable")]                  # by row, then by term
        h, row = h[order], row[order]
        at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))) if len(h) else []
        rows.append(row[at].astype(np.int32) + np.int32(lo))
        terms.append(h[at])
        tfs.append(np.diff(np.append(at, len(h))).astype(np.int32))
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)      # noqa: E731
    return cat(rows, np.int32), cat(terms, np.uint64), cat(tfs, np.int32), lengths


def _arranged(row: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """(order of the rows, first row of each block, cluster of each block) from postings by term."""
    n, df = len(lengths), np.diff(starts)
    guides = np.argsort(df, kind="stable")[-GUIDES:].tolist()
    x = np.zeros((n, len(guides)), np.float32)
    for j, t in enumerate(guides):
        x[row[starts[t]:starts[t + 1]], j] = 1
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    clusters = [np.arange(n)]
    for _ in range(HALVINGS):
        halves = []
        for rows in clusters:
            side = np.zeros(len(rows), bool)
            if len(rows) >= 2 * BLOCK and guides:
                y = x[rows]
                y -= y.mean(axis=0)
                side = y @ np.linalg.eigh(y.T @ y)[1][:, -1] > 0
            halves += [half for half in (rows[~side], rows[side]) if len(half)]
        clusters = halves
    edges, parents, at = [], [], 0
    for c, rows in enumerate(clusters):
        clusters[c] = rows[np.argsort(lengths[rows], kind="stable")]
        blocks = -(-len(rows) // BLOCK)
        edges += [at + len(rows) * b // blocks for b in range(blocks)]
        parents += [c] * blocks
        at += len(rows)
    return np.concatenate(clusters), np.array(edges), np.array(parents)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts in one array; the list is emptied."""
    whole = np.concatenate(parts)
    parts.clear()
    return whole


def _narrow(array: np.ndarray):
    """The smallest kind that holds an array's numbers."""
    most = int(array.max()) if len(array) else 0
    return next(kind for kind in _NARROW.values() if most <= np.iinfo(kind).max)


def _packed(array: np.ndarray) -> pa.Array:
    """One binary value with an array's bytes (not copied)."""
    ends = pa.py_buffer(np.array([0, array.nbytes], np.int32))
    return pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(np.ascontiguousarray(array))])


def build_index(rows: DataFrame, shards: int) -> DataFrame:
    """``rows``: (id, text). One row per shard, in a partition of its own, with the index as packed arrays."""
    def run(batches):
        shard, ids, lengths, rows, terms, tfs, n, b = None, [], [], [], [], [], 0, None
        for b in batches:                                                     # a batch's texts go when they are counted
            if not b.num_rows:
                continue
            row, term, tf, length = _counted(b.column("text"))
            for all_, some in ((rows, row + np.int32(n)), (terms, term), (tfs, tf), (lengths, length)):
                all_.append(some)
            ids.append(b.column("id").fill_null(LAST).to_numpy(zero_copy_only=False))
            shard, n = b.column("shard").slice(0, 1), n + b.num_rows
        del b
        if not n:
            return
        term = _joined(terms)
        order = _order(term)
        term = term[order]
        at = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
        term, starts = term[at], np.append(at, len(term))
        row, tf, length = _joined(rows)[order], _joined(tfs)[order], _joined(lengths)
        del order
        arranged, edges, parents = _arranged(row, starts, length)
        place = np.empty(n, np.int32)
        place[arranged] = np.arange(n)
        data = {"ids": _joined(ids)[arranged], "lengths": length[arranged], "terms": term, "starts": starts,
                "docs": place[row], "tf": tf, "edges": edges, "parents": parents}
        yield pa.RecordBatch.from_pydict({
            "shard": shard, "n": pa.array([n], pa.int64()), "words": pa.array([int(length.sum())], pa.int64()),
            **{k: _packed(data[k].astype(d or _narrow(data[k]), copy=False)) for k, d in _ARRAYS.items()}})
        del data, row, tf, term
        K.release()

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    kinds = ", ".join(f"{k} binary" for k in _ARRAYS)
    return cut(dealt.repartitionById(shards, F.col("shard").cast("int"))
               .mapInArrow(run, f"shard long, n long, words long, {kinds}"))


def _document_frequencies(index: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """(term, df) of the terms of ``words``: the distinct terms of shards and queries meet in parts by their first bits, as
    packed arrays."""
    firsts = np.array([(i << 64) // parts for i in range(parts)], np.uint64)
    kinds = "part int, terms binary, df binary"

    def cut_up(terms: np.ndarray, df: np.ndarray | None) -> pa.RecordBatch:
        cuts = np.append(np.searchsorted(terms, firsts), len(terms)).tolist()
        some = [i for i in range(parts) if cuts[i] < cuts[i + 1]]
        packed = [pa.array([None if x is None else x[cuts[i]:cuts[i + 1]].tobytes() for i in some], pa.binary()) for x in (terms, df)]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *packed], ["part", "terms", "df"])

    def of_shards(batches):
        for b in batches:
            for terms, starts in zip(b.column("terms"), b.column("starts"), strict=True):
                yield cut_up(np.frombuffer(terms.as_buffer(), np.uint64),
                             np.diff(np.frombuffer(starts.as_buffer(), np.int64)).astype(np.int32))

    def of_queries(batches):
        for b in batches:
            yield cut_up(np.unique(b.column("term").to_numpy().view(np.uint64)), None)

    def count(batches):
        asked, found = [], []
        for b in batches:
            for terms, df in zip(b.column("terms"), b.column("df"), strict=True):
                terms = np.frombuffer(terms.as_buffer(), np.uint64)
                if df.is_valid:
                    found.append((terms, np.frombuffer(df.as_buffer(), np.int32)))
                else:
                    asked.append(terms)
        if not asked:
            return
        asked = np.unique(np.concatenate(asked))
        total = np.zeros(len(asked), np.int64)
        for terms, df in found:                                               # distinct in a shard
            at = np.minimum(np.searchsorted(terms, asked), len(terms) - 1)
            met = terms[at] == asked
            total[met] += df[at[met]]
        met = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(asked[met].view(np.int64)), pa.array(total[met])], ["term", "df"])

    return (index.select("terms", "starts").mapInArrow(of_shards, kinds)
            .unionByName(words.select("term").mapInArrow(of_queries, kinds))
            .repartitionById(parts, "part").mapInArrow(count, "term long, df long"))


def query_vectors(queries: DataFrame, index: DataFrame, n_rows: int, parts: int = 1) -> DataFrame:
    """``queries``: (id, text) → (id, terms, weights): sorted term hashes with frequency in the query times idf."""
    def run(batches):
        for b in batches:
            row, term, tf, _ = _counted(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(term.view(np.int64)),
                                              pa.array(tf)], ["id", "term", "tf"])

    words = queries.mapInArrow(run, "id long, term long, tf int")
    idf = F.log(1 + (F.lit(n_rows) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return (words.join(_document_frequencies(index, words, parts), "term")
            .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", (F.col("tf") * idf).alias("w")))).alias("v"))
            .select("id", F.col("v.term").alias("terms"), F.col("v.w").alias("weights")))


class Queries:
    """A block of query vectors: ids, the distinct terms of all, and each query's places among them with its weights."""

    def __init__(self, rows: pa.Table):
        t = rows.combine_chunks()
        terms, weights = (t.column(c).combine_chunks() for c in ("terms", "weights"))
        lengths = terms.value_lengths().to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        self.terms, places = np.unique(terms.flatten().to_numpy().view(np.uint64), return_inverse=True)
        # queries with the same commonest term stand together
        common = np.bincount(places)[places] * len(self.terms) + places
        order = (np.argsort(np.maximum.reduceat(common, starts[:-1]), kind="stable") if len(lengths)
                 else np.zeros(0, np.int64))
        lengths = lengths[order]
        self.starts = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(starts[order] - self.starts[:-1], lengths) + np.arange(len(places))
        self.ids = t.column("id").take(pa.array(order)).to_pylist()
        self.places, self.weights = places[at].astype(np.int32), weights.flatten().to_numpy()[at]


class Shard:
    def __init__(self, row: dict, mean: float):
        for k, kind in _ARRAYS.items():
            size = memoryview(row[k]).nbytes
            setattr(self, k, np.frombuffer(row[k], kind or _NARROW[size // max(int(self.starts[-1]), 1) or 1]))
        self.n = len(self.ids)
        self.norm = K1 * (1 - B + B * self.lengths / mean)
        self.df = np.diff(self.starts)
        # the postings by row (a sort of short numbers is one of digits)
        order = np.argsort(self.docs, kind="stable")
        self.row_terms = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.df)[order]
        self.row_tf = self.tf[order]
        del order
        self.row_starts = np.concatenate(([0], np.cumsum(np.bincount(self.docs, minlength=self.n))))
        self._split()
        self.known, self.asked = np.zeros(len(self.terms), bool), np.zeros(len(self.terms))    # terms of one query, weights

    def _impact(self, posts) -> np.ndarray:
        tf, below = self.tf[posts], self.norm[self.docs[posts]]
        below += tf
        return np.divide(tf * (K1 + 1), below, out=below)

    @property
    def impact(self) -> np.ndarray:
        return self._impact(slice(None))

    def _split(self) -> None:
        """Postings of terms that are frequent in their block become its dense impacts; the others stay in lists."""
        blocks = len(self.edges)
        sizes = np.diff(np.append(self.edges, self.n))
        block = np.repeat(np.arange(blocks, dtype=np.int32), sizes)
        some = np.flatnonzero(self.df > LISTED)
        post = np.flatnonzero(np.repeat(self.df > LISTED, self.df)).astype(np.int32)
        term = np.repeat(np.arange(len(some), dtype=np.int32), self.df[some])
        own = block[self.docs[post]]
        counts = np.bincount(term * np.int64(blocks) + own, minlength=len(some) * blocks).reshape(-1, blocks)
        first = np.flatnonzero(np.diff(self.parents, prepend=-1))             # of each cluster
        alike = np.add.reduceat(counts, first, axis=1)[:, self.parents]
        share = counts / sizes * (alike / np.add.reduceat(sizes, first)[self.parents])
        dense = (counts > LISTED) & (share > 1 / FREQUENT ** 2)
        rank, widths = np.cumsum(dense, axis=0) - 1, dense.sum(axis=0)
        base = np.concatenate(([0], np.cumsum(widths * sizes)))
        taken = dense[term, own]
        post, term, own = post[taken], term[taken], own[taken]
        flat = np.zeros(base[-1], np.float32)
        flat[base[own] + rank[term, own] * sizes[own] + self.docs[post] - self.edges[own]] = self._impact(post)
        self.dense = [flat[base[b]:base[b + 1]].reshape(widths[b], sizes[b]) for b in range(blocks)]
        wide = dense.any(axis=1)
        self.slots = int(wide.sum())
        self.slot = np.full(len(self.terms), -1)
        self.slot[some[wide]] = np.arange(self.slots)
        self.columns = [np.flatnonzero(c) for c in dense[wide].T]
        self.tops = np.zeros((self.slots, blocks), np.float32)                # the largest impacts
        for b, c in enumerate(self.columns):
            self.tops[c, b] = self.dense[b].max(axis=1)
        listed = np.ones(len(self.docs), bool)
        listed[post] = False
        # impacts with the row in their last bits
        bits = self.n.bit_length()
        self.row_bits = np.int64((1 << bits) - 1)
        self.lists = self._impact(listed).view(np.int64)
        self.lists &= ~self.row_bits
        self.lists |= self.docs[listed]
        self.list_df = self.df.copy()
        self.list_df[some] -= np.bincount(term, minlength=len(some))
        self.list_starts = np.cumsum(self.list_df) - self.list_df
        longest = np.add.reduceat(self.lengths, self.edges) / sizes if self.n else sizes
        self.order = np.argsort(-longest, kind="stable").tolist()
        # above twice the error of a sum of as many terms in single precision, and of its limit
        self.slack = (max([self.slots, *widths.tolist()]) + 64) * 2.0 ** -22 + 2.0 ** (bits - 50)

    def _listed(self, starts: np.ndarray, df: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums of some posting lists for every row."""
        where = np.repeat(starts - np.cumsum(df) + df, df)
        where += COUNT[:len(where)] if len(where) <= len(COUNT) else np.arange(len(where))
        posts = self.lists.take(where, mode="clip")
        parts = np.repeat(weights, df)
        parts *= posts.view(np.float64)
        posts &= self.row_bits
        return np.bincount(posts, parts, self.n)

    def _left(self, partial: np.ndarray, weights: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Queries with the rows that may be among their k best, from the sums of listed postings, the weights of frequent
        terms and a score that the k best have at least."""
        limits = np.maximum(floors * (1 - self.slack), np.finfo(np.float32).tiny).astype(np.float32)
        most = weights @ self.tops                                            # of their frequent terms
        found = []
        for b in self.order:
            lo, size = int(self.edges[b]), self.dense[b].shape[1]
            part = partial[:, lo:lo + size]
            alive = np.flatnonzero(part.max(axis=1) + most[:, b] >= limits * np.float32(1 - self.slack))
            if not len(alive):                                                # the block is skipped whole
                continue
            score = weights[alive[:, None], self.columns[b]] @ self.dense[b]
            score += part[alive]
            hit = np.flatnonzero(score >= limits[alive][:, None])
            if not len(hit):
                continue
            q, score = hit // size, score.ravel()[hit]
            ends = np.cumsum(np.bincount(q, minlength=len(alive)))
            for i in np.flatnonzero(np.diff(ends, prepend=0) >= k).tolist():
                own = score[ends[i - 1] if i else 0:ends[i]]
                limits[alive[i]] = max(limits[alive[i]], np.partition(own, -k)[-k] * (1 - self.slack))
            keep = score >= limits[alive][q]
            found.append((alive[q[keep]], lo + hit[keep] % size, score[keep]))
        if not found:
            return []
        q, rows, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(q, kind="stable")
        q, rows, score = q[order], rows[order], score[order]
        out, at = [], np.flatnonzero(np.diff(q, prepend=-1)).tolist()
        for lo, hi in zip(at, [*at[1:], len(q)], strict=True):
            own, limit = score[lo:hi], limits[q[lo]]
            if len(own) > k:
                limit = max(limit, np.partition(own, -k)[-k] * (1 - self.slack))
            out.append((int(q[lo]), rows[lo:hi][own >= limit]))
        return out

    def _exact(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> list[tuple[float, int]]:
        """(score, id) of some rows: correctly rounded sums."""
        lengths = self.row_starts[rows + 1] - self.row_starts[rows]
        ends = np.cumsum(lengths)
        where = np.repeat(self.row_starts[rows] - ends + lengths, lengths) + np.arange(ends[-1])
        terms = self.row_terms[where]
        self.known[at], self.asked[at] = True, weights
        met = self.known[terms]
        self.known[at] = False
        ends = np.cumsum(met)[ends - 1].tolist()
        met = np.flatnonzero(met)
        tf, norm = self.row_tf[where[met]], np.repeat(self.norm[rows], lengths)[met]
        parts = (self.asked[terms[met]] * (tf * (K1 + 1) / (tf + norm))).tolist()
        return [(math.fsum(parts[lo:hi]), d) for lo, hi, d in zip([0, *ends], ends, self.ids[rows].tolist(), strict=False)]

    def search(self, queries: Queries, k: int, floors: np.ndarray | None = None) -> list[tuple[int, float, int]]:
        """(query id, score, id) of the k best rows for each query, best first; none below the query's floor."""
        if not len(self.terms):
            return []
        if floors is None:
            floors = np.zeros(len(queries.ids))
        found = np.minimum(np.searchsorted(self.terms, queries.terms), len(self.terms) - 1)
        found[self.terms[found] != queries.terms] = -1
        step = max(1, min(TOGETHER, HELD // self.n))
        hits = []
        for lo in range(0, len(queries.ids), step):
            ids = queries.ids[lo:lo + step]
            starts = queries.starts[lo:lo + len(ids) + 1]
            at, weights = found[queries.places[starts[0]:starts[-1]]], queries.weights[starts[0]:starts[-1]]
            met = at >= 0
            starts = np.concatenate(([0], np.cumsum(met)))[starts - starts[0]]
            at, weights = at[met], weights[met]
            often, slot = np.zeros((len(ids), self.slots), np.float32), self.slot[at]
            wide = np.flatnonzero(slot >= 0)
            often[np.repeat(np.arange(len(ids)), np.diff(starts))[wide], slot[wide]] = weights[wide]
            list_starts, list_df = self.list_starts[at], self.list_df[at]
            partial = np.empty((len(ids), self.n), np.float32)
            own = [slice(a, z) for a, z in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            for i, terms in enumerate(own):
                partial[i] = self._listed(list_starts[terms], list_df[terms], weights[terms])
            for i, rows in self._left(partial, often, k, floors[lo:lo + step]):
                best = sorted((x for x in self._exact(rows, at[own[i]], weights[own[i]]) if x[0] >= floors[lo + i]), key=lambda x: (-x[0], x[1]))
                hits.extend((ids[i], s, d) for s, d in best[:k])
        return hits


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(query_id, rank, id, score): the k best of all ``rows`` for every row that ``is_query`` marks."""
    marked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                         F.coalesce(is_query, F.lit(False)).alias("asks"))
    # shards follow the bytes of the table, not the number of shuffle partitions
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    shards = parts_for(rows, SHARD_MB, cores)
    ends = _round_ends(shards, FIRST * cores)
    index = build_index(marked.select("id", "text"), shards)
    rounds = [index.where(F.col("shard").between(a, z - 1)) for a, z in zip([0, *ends], ends, strict=False)]
    total = index.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if not total["words"]:
        return empty
    mean = total["words"] / total["n"]
    vectors = cut(query_vectors(marked.where("asks AND id IS NOT NULL").select("id", "text").dropDuplicates(["id"]),
                                index, total["n"], min(shards, TERM_PARTS)))
    blocks = -(-vectors.count() // QUERY_BLOCK)
    asked = [spark.sparkContext.broadcast(Queries(
        vectors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow())) for block in range(blocks)]
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    best = None
    for i, part in enumerate(rounds if asked else []):
        # the ids of the queries that have k rows by now, and the scores of their last
        last = best.where(F.col("rank") == k).select("query_id", "score").orderBy("query_id").toArrow() if i else None
        known = spark.sparkContext.broadcast(tuple(last.column(c).to_numpy() for c in last.column_names) if i else None)
        hits = part.mapInArrow(_asking(asked, known, mean, k), "query_id long, id long, score double")
        if i:
            hits = hits.unionByName(best.drop("rank"))
        best = (hits.withColumn("rank", F.row_number().over(order))
                .where(F.col("rank") <= k))
        if i < len(rounds) - 1:
            best = cut(best)
    if best is None:
        return empty
    return best.select("query_id", "rank", F.when(F.col("id") != LAST, F.col("id")).alias("id"), "score")


def _round_ends(shards: int, first: int) -> list[int]:
    """Each round asks as many shards as all before it."""
    ends = [min(first, shards)]
    while ends[-1] < shards:
        ends.append(min(2 * ends[-1], shards))
    return ends


def _asking(asked: list[Broadcast], known: Broadcast, mean: float, k: int):
    """The hits of blocks of queries in shards, given the scores that some queries' hits have at least."""
    def floors(queries: Queries) -> np.ndarray:
        if known.value is None or not len(known.value[0]):
            return np.zeros(len(queries.ids))
        ids, scores = known.value
        at = np.minimum(np.searchsorted(ids, queries.ids), len(ids) - 1)
        return np.where(ids[at] == queries.ids, scores[at], 0.0)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard({c: b.column(c)[i].as_buffer() for c in _ARRAYS}, mean)
                K.release()
                for block in asked:
                    queries = block.value
                    hits = shard.search(queries, k, floors(queries))
                    q, s, d = (list(c) for c in zip(*hits, strict=True)) if hits else ([], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(d, pa.int64()),
                                                      pa.array(s, pa.float64())], ["query_id", "id", "score"])
                    if len(asked) > 1 and getattr(block, "_path", None):      # one block in memory; the next shard reads it again
                        block.__dict__.pop("_value", None)
                del shard
                K.release()

    return run


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of all documents for the whole text of every document whose id is divisible by 50."""
    hits = top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0, id_col="doc_id")
    return hits.select(F.col("query_id").alias("query_doc_id"), "rank", F.col("id").alias("doc_id"), "score")
