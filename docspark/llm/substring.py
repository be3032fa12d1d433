"""Repeated passages: suffix automata of reference shards, streamed for matching statistics.

A window is ``SPAN`` consecutive words. A word goes if a window that covers it also starts in a document with a smaller
id. Comparing every document with an automaton of the whole corpus would grow with its square, so the corpus is cut
into shards by content first:

1. Each window has a *minimiser*, the least hash of its 6-word grams; equal windows have equal minimisers. Minimisers
   that occur in one document only are ruled out by one shuffle of packed hash arrays (a task sorts a bucket of the
   hash space and answers each block of documents with the minimisers that repeat).
2. The runs of windows that share a repeated minimiser are cut out as segments and sent to the shard of that
   minimiser. Copies of a segment collapse inside a block of documents. Minimisers with more than ``HOT`` occurrences
   would make one shard large; their windows are sent one by one to shards by the window's own hash.
3. A shard's distinct segments are its reference. They are added to one suffix automaton whose states know the
   smallest document id of their occurrences; the segments are streamed through it, and at each position the
   matching statistic (held at ``SPAN`` words) leads to the state of the window that ends there.
4. Removed windows go back to the blocks, where the words they cover are dropped.

An automaton goes only to the task that streams its shard, instead of to every executor: all shards together grow with
the corpus and have no size bound that would allow a broadcast. Words are compared as bytes, so hashes only choose
shards. Documents are shuffled once (by block) and that exchange is read three times.

Defined results: null and empty texts have no words; texts shorter than a window keep all words; rows with a null id
count as larger than any id; rows that repeat an id are one document (neither removes from the other); repeated
passages inside one document stay unless a smaller document has them too.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import kernel as K
from .common import ids_texts, parts_for, table

SPAN = 13
GRAM = 6
HOT = 5000                  # occurrences from which a minimiser's windows are dealt by their own hash
BLOCK_MB = 8                # input megabytes in a block of documents
SHARDS_PER_BLOCK = 16
LAST = np.iinfo(np.int64).max


class SuffixAutomaton:
    """Suffix automaton of several sequences; a state knows the least id of the sequences that hold its strings."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [LAST]

    def add(self, sequence, ident: int) -> None:
        step, link, length, least = self.step, self.link, self.length, self.least
        last = 0
        for c in sequence:
            q = step[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
            else:
                new = last
                if q is None:
                    new = len(length)
                    step.append({})
                    link.append(0)
                    length.append(length[last] + 1)
                    least.append(LAST)
                    p = last
                    while p >= 0 and c not in step[p]:
                        step[p][c] = new
                        p = link[p]
                    if p < 0:
                        last = new
                        if ident < least[last]:
                            least[last] = ident
                        continue
                    q = step[p][c]
                    if length[q] == length[p] + 1:
                        link[new] = q
                        last = new
                        if ident < least[last]:
                            least[last] = ident
                        continue
                else:
                    p = last
                clone = len(length)
                step.append(step[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                least.append(LAST)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = clone
                if new != last:
                    link[new] = clone
                    last = new
                else:
                    last = clone
            if ident < least[last]:
                least[last] = ident

    def close(self) -> None:
        """Carry the least ids from longer strings to their suffixes; call once, after the last sequence."""
        link, least = self.link, self.least
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if least[s] < least[link[s]]:
                least[link[s]] = least[s]

    def stream(self, sequence, span: int):
        """For each position: the matching statistic, held at ``span``, and the least id of the sequences that hold
        the ``span`` symbols ending there (LAST where the statistic is shorter)."""
        step, link, length, least = self.step, self.link, self.length, self.least
        s, n = 0, 0
        for c in sequence:
            while s and c not in step[s]:
                s = link[s]
                n = length[s]
            if c in step[s]:
                s = step[s][c]
                n += 1
            if n >= span:
                n = span
                while length[link[s]] >= span:
                    s = link[s]
                yield n, least[s]
            else:
                yield n, LAST


def _canonical(column: pa.Array, rows: range) -> tuple[np.ndarray, np.ndarray]:
    """The texts of some rows with one space between words, as one buffer with offsets."""
    texts = [b" ".join((column[i].as_py() or "").encode().split()) for i in rows]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _chunks(column: pa.Array, span: int):
    """(first row, end row, words, window minimisers, whether each position starts a window)."""
    _, offsets = K.text_buffer(column)
    for lo, hi in K.row_chunks(offsets):
        buf, off = _canonical(column, range(lo, hi))
        w = K.Words(buf, off)
        h, row = w.hashes(), w.rows()
        starts = (w.first[1:][row] - np.arange(len(h))) >= span
        m = K.ngram_hashes(h, GRAM)
        width, have = span - GRAM + 1, 1
        while have < width:                            # sliding minimum by doubling
            by = min(have, width - have)
            m = np.minimum(m[:-by], m[by:]) if len(m) > by else m[:0]
            have += by
        least = np.zeros(len(h), np.uint64)
        least[:len(m)] = m
        yield lo, hi, w, row, least, starts


def _runs(row, least, starts):
    """(first, end) window positions of maximal runs of windows with one minimiser."""
    at = np.flatnonzero(starts)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] + 1


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False)


def _bytes(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _joined(column, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column] or [np.zeros(0, kind)])


def repeated_minimisers(blocks: DataFrame, buckets: int, span: int) -> DataFrame:
    """(block, minimisers, hot): the minimisers of each block that occur under two or more ids, in packed arrays."""
    def pack(batches):
        for b in batches:
            ids, block = _ids(b.column("doc_id")), b.column("block").to_numpy()
            found = []
            for lo, _, _, row, least, starts in _chunks(b.column("text"), span):
                first, _ = _runs(row, least, starts)
                found.append((block[lo + row[first]], least[first], ids[lo + row[first]]))
            if not found:
                continue
            blk, m, doc = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((m, blk))
            blk, m, doc = blk[order], m[order], doc[order]
            if not len(m):
                continue
            at = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (blk[1:] != blk[:-1]))))
            n = np.diff(np.append(at, len(m)))
            low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
            blk, m = blk[at], m[at]
            bucket = ((m >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (blk[1:] != blk[:-1]))))
            ends = np.append(cut[1:], len(m))
            pack64 = lambda x: [x[i:j] for i, j in zip(cut, ends, strict=True)]           # noqa: E731
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut]), pa.array(blk[cut]), _bytes(pack64(m)), _bytes(pack64(low)),
                 _bytes(pack64(high - low)), _bytes(pack64(n.astype(np.int32)))],
                ["bucket", "block", "m", "low", "more", "n"])

    @K.tidy
    def repeated(t: pa.Table) -> pa.Table:
        size = np.array([len(x.as_buffer()) // 8 for x in t.column("m")])
        m, low = _joined(t.column("m"), np.uint64), _joined(t.column("low"), np.int64)
        high, n = low + _joined(t.column("more"), np.int64), _joined(t.column("n"), np.int32)
        order = np.argsort(m, kind="stable")
        s = m[order]
        at = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        count = np.add.reduceat(n[order].astype(np.int64), at)
        again = np.minimum.reduceat(low[order], at) < np.maximum.reduceat(high[order], at)
        length = np.diff(np.append(at, len(s)))
        yes, hot = np.zeros(len(m), bool), np.zeros(len(m), bool)
        yes[order] = np.repeat(again, length)
        hot[order] = np.repeat(count > HOT, length)
        ends = np.cumsum(size)
        parts = [slice(e - k, e) for e, k in zip(ends, size, strict=True)]
        return pa.table({"block": t.column("block"), "m": _bytes([m[p][yes[p]] for p in parts]),
                         "hot": _bytes([hot[p][yes[p]] for p in parts])})

    packed = blocks.mapInArrow(pack, "bucket long, block long, m binary, low binary, more binary, n binary")
    return packed.groupBy("bucket").applyInArrow(repeated, "block long, m binary, hot binary")


def segments(blocks: DataFrame, repeated: DataFrame, shards: int, span: int) -> DataFrame:
    """(shard, block, text, ids, rows, places): the distinct segments of each block with their occurrences in it."""
    @K.tidy
    def cut_out(docs: pa.Table, again: pa.Table) -> pa.Table:
        m, hot = _joined(again.column("m"), np.uint64), _joined(again.column("hot"), bool)
        m, first = np.unique(m, return_index=True)
        hot = hot[first]
        seen: dict[tuple[int, bytes], tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
        text, ids = docs.column("text").combine_chunks(), _ids(docs.column("doc_id").combine_chunks())
        names = docs.column("row").to_numpy()
        for lo, _, w, row, least, starts in _chunks(text, span) if len(m) else ():
            place = np.minimum(np.searchsorted(m, least), len(m) - 1)
            a, z = _runs(row, least, starts & (m[place] == least))
            dealt = hot[place[a]]
            key = least[a]
            if dealt.any():                             # one segment a window, keyed by the window's own hash
                many = z[dealt] - a[dealt]
                one = np.repeat(a[dealt], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                own = K.ngram_hashes(w.hashes(), span)
                a, z, key = (np.concatenate(p) for p in ((a[~dealt], one), (z[~dealt], one + 1), (key[~dealt], own[one])))
            raw = w.buf.tobytes()
            where = (key % np.uint64(shards)).tolist()
            doc, name, base = ids[lo + row[a]].tolist(), names[lo + row[a]].tolist(), (a - w.first[row[a]]).tolist()
            for s, i, j, *found in zip(where, w.starts[a].tolist(), w.ends[z + span - 2].tolist(), doc, name, base,
                                       strict=True):
                for kept, value in zip(seen[s, raw[i:j]], found, strict=True):
                    kept.append(value)
        block = docs.column("block")[0].as_py() if len(docs) else 0
        return pa.table({"shard": pa.array([k[0] for k in seen], pa.int64()),
                         "block": pa.array([block] * len(seen), pa.int64()),
                         "text": pa.array([k[1] for k in seen], pa.binary()),
                         **{name: pa.array([np.array(v[k], np.int64).tobytes() for v in seen.values()], pa.binary())
                            for k, name in enumerate(("ids", "rows", "places"))}})

    return blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        cut_out, "shard long, block long, text binary, ids binary, rows binary, places binary")


def removed_windows(found: DataFrame, span: int) -> DataFrame:
    """(block, rows, places, n): runs of ``n`` removed windows that start at word ``places`` of the rows."""
    @K.tidy
    def shard(t: pa.Table) -> pa.Table:
        texts = t.column("text").to_pylist()
        ids = [np.frombuffer(x.as_buffer(), np.int64) for x in t.column("ids")]
        rows, places = ([np.frombuffer(x.as_buffer(), np.int64) for x in t.column(c)] for c in ("rows", "places"))
        least: dict[bytes, int] = {}
        for s, d in zip(texts, ids, strict=True):
            lo = int(d.min())
            if lo < least.get(s, LAST + 1):
                least[s] = lo
        words = {s: s.split(b" ") for s in least}
        automaton = SuffixAutomaton()
        for s, lo in least.items():
            automaton.add(words[s], lo)
        automaton.close()
        low = {s: np.array([d for n, d in automaton.stream(words[s], span)][span - 1:]) for s in least}
        out: dict[int, list] = defaultdict(list)
        for s, block, doc, row, place in zip(texts, t.column("block").to_pylist(), ids, rows, places, strict=True):
            gone = doc[:, None] > low[s]
            if not gone.any():
                continue
            pad = np.zeros((len(doc), gone.shape[1] + 2), np.int8)
            pad[:, 1:-1] = gone
            edge = np.diff(pad, axis=1)
            i, a = np.nonzero(edge == 1)
            z = np.nonzero(edge == -1)[1]
            out[block].append((row[i], place[i] + a, z - a))
        cat = [(b, *(np.concatenate(x) for x in zip(*v, strict=True))) for b, v in out.items()]
        return pa.table({"block": pa.array([c[0] for c in cat], pa.int64()), **{
            name: pa.array([c[k].astype(np.int64).tobytes() for c in cat], pa.binary())
            for k, name in enumerate(("rows", "places", "n"), start=1)}})

    return found.groupBy("shard").applyInArrow(shard, "block long, rows binary, places binary, n binary")


def _kept_words(docs: pa.Table, gone: pa.Table, span: int):
    """(row, words, mask of kept words) of a block's documents."""
    d, p, n = (_joined(gone.column(c), np.int64) for c in ("rows", "places", "n"))
    order = np.argsort(d, kind="stable")
    d, p, n = d[order], p[order], n[order]
    names = docs.column("row").to_numpy()
    a, z = np.searchsorted(d, names, "left"), np.searchsorted(d, names, "right")
    for i, text in enumerate(docs.column("text")):
        words = (text.as_py() or "").encode().split()
        mask = None
        if z[i] > a[i]:
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, p[a[i]:z[i]], 1)
            np.add.at(cover, p[a[i]:z[i]] + n[a[i]:z[i]] + span - 1, -1)
            mask = np.cumsum(cover[:-1]) == 0
        yield i, words, mask


def _blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents dealt to blocks by id; ``row`` tells rows that share an id but not the text apart."""
    n = parts_for(docs, BLOCK_MB)
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    # rows with a null id never share one, so their texts deal them
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(n))
    return docs.withColumn("block", block).repartition(n, "block"), n


def _removal(blocks: DataFrame, n: int, span: int) -> DataFrame:
    return removed_windows(segments(blocks, repeated_minimisers(blocks, n, span), n * SHARDS_PER_BLOCK, span), span)


def digests(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    blocks, n = _blocks(ids_texts(docs, id_col, text_col))

    @K.tidy
    def run(docs: pa.Table, gone: pa.Table) -> pa.Table:
        out = []
        for _, words, mask in _kept_words(docs, gone, span):
            kept = words if mask is None else [w for w, m in zip(words, mask.tolist(), strict=True) if m]
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        total, removed, sha = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [])
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(total, pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    return blocks.groupBy("block").cogroup(_removal(blocks, n, span).groupBy("block")).applyInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns and rows, with the texts that lose words replaced by their kept words joined by one
    space; other texts stay as they are."""
    row = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest"))
    blocks, n = _blocks(row)
    kind = dict(docs.dtypes)[text_col]

    @K.tidy
    def run(docs: pa.Table, gone: pa.Table) -> pa.Table:
        texts = docs.column("text").to_pylist()
        for i, words, mask in _kept_words(docs, gone, span):
            if mask is not None:
                texts[i] = b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if m]).decode()
        return pa.table({"rest": docs.column("rest"), "text": pa.array(texts, pa.string())})

    schema = T.StructType([row.schema["rest"], T.StructField("text", T.StringType())])
    out = blocks.groupBy("block").cogroup(_removal(blocks.select("doc_id", "text", "row", "block"), n, span)
                                          .groupBy("block")).applyInArrow(run, schema)
    return out.select(*[F.col("text").cast(kind).alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
                        for c in docs.columns])


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
