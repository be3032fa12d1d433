"""Repeated byte passages by column-wise construction of a collection's Burrows-Wheeler order with common prefixes.

Every byte goes that a ``SPAN``-byte string covers which also starts anywhere else. The order of all suffixes and the
common prefixes of neighbours tell which strings those are; the construction inserts one symbol of every sequence each
round (:func:`repeated_windows`). Its rounds are as many as the longest sequence has symbols, so whole documents can't
go in (a long one would take a round for every byte, each over the whole collection). They are cut by content first:

1. Equal texts become one, inside tasks and then inside blocks of the text hash; a text that occurs twice and holds a
   window is removed whole, and stays the reference for other texts.
2. The windows of a text are cut into runs with one *minimiser* (the 64-byte gram of least hash). Equal windows have equal
   minimisers, so runs whose minimiser occurs once in the collection are ruled out, by packed hashes that each block
   sends once. Of minimisers with more than ``HOT`` occurrences every window is asked for by its own hash in the same
   way, and those that stay are dealt one by one, by that hash.
3. The runs that are left, at most 736 bytes each, are dealt to shards by their minimiser, each distinct one once a block.
   A shard is the collection of its distinct runs: symbols are 16-byte words, each run is read in 16 phases, and 25 equal
   symbols are 400 equal bytes, whatever the phases. Hashes only choose shards and rule out; words are compared.
4. The windows found repeated go back to the places of their run, and the texts lose the bytes they cover.

The files that the construction rewrites in sequence each round are arrays of a shard here: a shard is small (its size
does not grow with the corpus), so nothing is written outside Spark's own shuffles and the checkpoint folder.

Defined results: null and empty texts have no bytes; texts below a window lose nothing; ids are not looked at, so null
and repeated ids are rows like any other, and repeated rows remove each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.sizing import scratch_path
from . import kernel as K
from .common import ids_texts, parts_for, table

SPAN = 400
GRAM = 64
HOT = 2000                  # occurrences from which a minimiser's windows are dealt by their own hash
BLOCK_MB = 8
SHARDS_PER_BLOCK = 16
PIECE = 1 << 17             # bytes hashed at a time; longer texts are taken in pieces

_rng = np.random.Generator(np.random.PCG64(1200))
_ODD = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)
_LOW = np.int64((1 << 32) - 1)


# ----------------------------------------------------------------------------------------------------------------
# The construction
# ----------------------------------------------------------------------------------------------------------------

class _Minimum:
    """Least value of any range of an array of common prefixes: the table of all ranges of 2^k values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.levels = np.empty((max(1, n.bit_length()), n), np.uint8)
        self.levels[0] = values
        for k in range(1, len(self.levels)):
            by, kept = 1 << (k - 1), n - (1 << k) + 1
            np.minimum(self.levels[k - 1, :kept], self.levels[k - 1, by:by + kept], out=self.levels[k, :kept])

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        k = np.frexp(hi - lo)[1] - 1
        return np.minimum(self.levels[k, lo], self.levels[k, hi - (1 << k)])


def repeated_windows(texts: list[bytes], span: int = SPAN) -> list[np.ndarray]:
    """For each text, which of its ``span``-byte windows start more than once in the collection.

    A text is read as ``width`` sequences of ``width``-byte symbols, one for each phase. The order of the suffixes
    inserted so far is kept as (first symbol, place of the rest), which is the inverse of the Burrows-Wheeler
    transform, beside the common prefix of each suffix with the one before it, held at the window's length. A round
    puts one more symbol before the last suffix of every sequence: its place follows by a search for (symbol, place of
    that suffix), its common prefixes are one more than the least between the places of the rests, and all arrays are
    rewritten once in sequence."""
    width = next(w for w in (16, 8, 4, 2, 1) if span % w == 0)
    need = span // width
    if need > 250:
        raise ValueError(f"windows of {span} bytes are over 250 symbols of {width} bytes")
    size = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(size)))
    raw = np.frombuffer(b"".join(texts) + b"\0" * 16, np.uint8)
    symbols = np.ndarray((len(raw) - 7,), np.uint64, raw, 0, (1,)) & np.uint64((1 << (8 * min(width, 8))) - 1)
    ids = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    if width == 16:                                            # the number of a pair of 8-byte words
        ids = np.unique((ids[:-8] << 32) | ids[8:], return_inverse=True)[1].astype(np.int64) + 1
    windows = size - span + 1
    phases = np.clip(windows, 0, width)
    text = np.repeat(np.arange(len(texts)), phases)
    phase = np.arange(len(text)) - np.repeat(np.cumsum(phases) - phases, phases)
    length = (size[text] - phase) // width
    order = np.argsort(-length, kind="stable")
    text, phase, length = text[order], phase[order], length[order]
    begin, limit = starts[text] + phase, starts[text] + windows[text]
    place = np.arange(len(text))                              # of the last suffix of each sequence: the empty ones
    keys, common, owner = place.astype(np.int64), np.zeros(len(text), np.uint8), np.full(len(text), -1, np.int32)
    for j in range(1, int(length.max(initial=0)) + 1):
        active = int(np.searchsorted(-length, -j, "right"))
        at = begin[:active] + width * (length[:active] - j)
        new = (ids[at] << 32) | place[:active]
        order = np.argsort(new)
        new = new[order]
        before = np.searchsorted(keys, new)
        mine = before + np.arange(active)
        left = keys[before - 1]
        right = np.append(keys, -1)[before]
        chained = np.flatnonzero(before[1:] == before[:-1])
        left[chained + 1], right[chained] = new[chained], new[chained + 1]
        same_l, same_r = np.flatnonzero(left >> 32 == new >> 32), np.flatnonzero(right >> 32 == new >> 32)
        prefix_l, prefix_r = np.zeros(active, np.uint8), np.zeros(active, np.uint8)
        if len(same_l) or len(same_r):
            least = _Minimum(common)
            for found, same, a, b in ((prefix_l, same_l, left, new), (prefix_r, same_r, new, right)):
                held = least.over((a[same] & _LOW) + 1, (b[same] & _LOW) + 1)
                found[same] = np.minimum(held, need - 1) + 1
        moved = np.cumsum(np.bincount(before, minlength=len(keys) + 1))
        total = len(keys) + active
        to = np.ones(total, bool)                                    # the places of the suffixes there were
        to[mine] = False
        next_keys, next_common, next_owner = np.empty(total, np.int64), np.zeros(total + 1, np.uint8), np.empty(total, np.int32)
        next_keys[to] = keys + moved[keys & _LOW]
        next_keys[mine] = new + moved[new & _LOW]
        next_common[:-1][to] = common
        next_common[mine + 1] = prefix_r
        next_common[mine] = prefix_l
        next_owner[to] = owner
        next_owner[mine] = np.where(at < limit[:active], at, -1)[order]
        keys, common, owner = next_keys, next_common[:-1], next_owner
        place[order] = mine
    equal = common >= need
    again = equal | np.append(equal[1:], False)
    marked = np.zeros(len(raw), bool)
    marked[owner[again & (owner >= 0)]] = True
    return [marked[s:s + max(w, 0)] for s, w in zip(starts[:-1], windows.tolist(), strict=True)]


# ----------------------------------------------------------------------------------------------------------------
# Runs of windows with one minimiser
# ----------------------------------------------------------------------------------------------------------------

class _Runs:
    """The runs of a piece: text number, first window, number of windows, minimiser; ``own`` hashes single windows."""

    def __init__(self, part: np.ndarray, ends: np.ndarray, number: np.ndarray, base: np.ndarray, span: int):
        w = np.ndarray((len(part) - 7,), np.uint64, part, 0, (1,)) * _ODD[0]
        w ^= w >> np.uint64(32)
        for k, by in enumerate((8, 16, 32), start=1):                # 8-byte words to 64-byte grams
            w = w[:-by] * _ODD[k] + w[by:]
            w ^= w >> np.uint64(29)
        self.grams, self.span = w, span
        low = (w * _ODD[4] & ~_PLACE) | (_PLACE - np.arange(len(w), dtype=np.uint64))
        width, have = span - GRAM + 1, 1
        while have < width:                                          # sliding minimum by doubling
            by = min(have, width - have)
            low = np.minimum(low[:-by], low[by:])
            have += by
        sizes = np.diff(np.concatenate(([0], ends)))
        fits = np.repeat(ends - span + 1, sizes)[:len(low)] > np.arange(len(low))
        at = np.flatnonzero(fits)
        where = (_PLACE - (low[at] & _PLACE)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (where[1:] != where[:-1]))))[:len(at)]
        self.at, self.n = at[new], np.diff(np.append(new, len(at)))
        self.minimiser = K.mix(w[where[new]])
        piece = np.searchsorted(ends, self.at, "right")
        self.text, self.first = number[piece], base[piece] + self.at - (ends - sizes)[piece]

    def own(self, at: np.ndarray) -> np.ndarray:
        h = self.grams[at + self.span - GRAM] * _ODD[5]
        for k in range(0, self.span - GRAM, GRAM):
            h = h * _ODD[6 + k // GRAM % 8] + self.grams[at + k]
            h ^= h >> np.uint64(31)
        return K.mix(h)


def _runs(column: pa.ChunkedArray, span: int) -> Iterator[_Runs]:
    """Runs of the texts of a binary column, piece after piece; a long text is cut into pieces that share no window."""
    buf, offsets = K.text_buffer(column)
    held: list[tuple[int, int, int]] = []
    size = 0

    def ready() -> _Runs:
        parts = [buf[offsets[i] + a:offsets[i] + z] for i, a, z in held]
        return _Runs(np.concatenate(parts), np.cumsum([len(p) for p in parts]), np.array([h[0] for h in held]),
                     np.array([h[1] for h in held]), span)

    for i, n in enumerate(np.diff(offsets).tolist()):
        for a in range(0, n - span + 1, PIECE):
            held.append((i, a, min(n, a + PIECE + span - 1)))
            size += held[-1][2] - a
            if size >= PIECE:
                yield ready()
                held, size = [], 0
    if held:
        yield ready()


# ----------------------------------------------------------------------------------------------------------------
# Stages
# ----------------------------------------------------------------------------------------------------------------

def _distinct_texts(docs: DataFrame, n: int) -> DataFrame:
    """(block, row, key, text, n): each text once with the number of its rows; a task sends a text once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        names = ["block", "row", "key", "text", "n"]

        def rows(keys, texts, counts):
            head = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 4)
            return pa.RecordBatch.from_arrays([pa.array(head[:, 0] % n), pa.array(head[:, 1]), pa.array(keys, pa.binary()), texts,
                                               pa.array(counts, pa.int64())], names)

        for b in batches:
            buf, offsets = K.text_buffer(b.column(0))
            keys, at = [], []
            for i in range(b.num_rows):
                key = hashlib.sha256(buf[offsets[i]:offsets[i + 1]]).digest()
                if key in seen:
                    seen[key] += 1
                else:
                    seen[key] = 0
                    keys.append(key)
                    at.append(i)
            if keys:
                texts = b.column(0).take(pa.array(at)).fill_null("").cast(pa.binary())
                yield rows(keys, texts, [1] * len(keys))
        more = [(k, c) for k, c in seen.items() if c]
        if more:
            yield rows([k for k, _ in more], pa.nulls(len(more), pa.binary()), [c for _, c in more])

    sent = docs.select("text").mapInArrow(run, "block long, row long, key binary, text binary, n long")
    return (sent.repartition(n, "block").groupBy("block", "row")
            .agg(F.first("key").alias("key"), F.first("text", ignorenulls=True).alias("text"), F.sum("n").alias("n")))


def _packed(block: int, h: np.ndarray, n: np.ndarray, buckets: int) -> pa.Table:
    """One row for each bucket of the sorted hashes ``h`` with their counts."""
    if not len(h):
        return pa.table({"bucket": pa.array([], pa.int64()), "block": pa.array([], pa.int64()),
                         "h": pa.array([], pa.binary()), "n": pa.array([], pa.binary())})
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends = np.append(cut[1:], len(h))
    pack = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(cut, ends, strict=True)], pa.binary())      # noqa: E731
    return pa.table({"bucket": pa.array(bucket[cut]), "block": pa.array(np.full(len(cut), block)), "h": pack(h),
                     "n": pack(n.astype(np.int32))})


PACKED = "bucket long, block long, h binary, n binary"


def _joined(column, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column] or [np.zeros(0, kind)])


def _repeated(packed: DataFrame, kind: int) -> DataFrame:
    """(block, kind, h, hot): back to each block the hashes that occur twice or more in all blocks together."""
    def run(t: pa.Table) -> pa.Table:
        size = [len(x.as_buffer()) // 8 for x in t.column("h")]
        h, n = _joined(t.column("h"), np.uint64), _joined(t.column("n"), np.int32)
        _, inverse = np.unique(h, return_inverse=True)
        total = np.bincount(inverse, n)[inverse]
        ends = np.cumsum(size)
        parts = [slice(e - k, e) for e, k in zip(ends, size, strict=True)]
        return pa.table({"block": t.column("block"), "kind": pa.array(np.full(len(parts), kind)),
                         "h": pa.array([h[p][total[p] > 1].tobytes() for p in parts], pa.binary()),
                         "hot": pa.array([(total[p][total[p] > 1] > HOT).tobytes() for p in parts], pa.binary())})

    return packed.groupBy("bucket").applyInArrow(run, "block long, kind long, h binary, hot binary")


def _among(h: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each hash is in the sorted list, its place there)."""
    if not len(sorted_):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(sorted_, h), len(sorted_) - 1)
    return sorted_[at] == h, at


def _answers(t: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    t = t.filter(pa.compute.equal(t.column("kind"), kind))
    h, hot = _joined(t.column("h"), np.uint64), _joined(t.column("hot"), bool)
    order = np.argsort(h)
    return h[order], hot[order]


def _windows_of(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, run number) of all windows of some runs."""
    run = np.repeat(np.arange(len(at)), n)
    return at[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n), run


CANDIDATES = "block long, shard long, seg binary, text binary, c long, row long, first long, at binary, n binary"


def _settled(number: np.ndarray, first: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, firsts, counts) with ranges of windows that follow each other made one."""
    order = np.lexsort((first, number))
    number, first, count = number[order], first[order], count[order]
    new = np.ones(len(number), bool)
    new[1:] = (number[1:] != number[:-1]) | (first[1:] != first[:-1] + count[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(count, at) if len(at) else count
    number, first = number[at], first[at]
    cut = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))[:len(number)]
    for i, j in zip(cut, np.append(cut[1:], len(number)), strict=False):
        yield int(number[i]), first[i:j], total[i:j]


def _candidates(blocks: DataFrame, buckets: int, shards: int, span: int) -> DataFrame:
    """The runs that may repeat. One row for each distinct run of a block (shard, seg, text, c: its places there); with
    its place (row, first) if there is but one, which waits for what other blocks have. Runs with more places in the
    block repeat: their places are rows without a seg, packed (at, n) ranges of windows for each text."""
    def minimisers(t: pa.Table) -> pa.Table:
        found = [r.minimiser for r in _runs(t.column("text"), span)]
        h, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
        return _packed(t.column("block")[0].as_py(), h, n, buckets)

    first = _repeated(blocks.groupBy("block").applyInArrow(minimisers, PACKED), 0)

    def hot_windows(t: pa.Table, answer: pa.Table) -> pa.Table:
        m, hot = _answers(answer, 0)
        found = [np.zeros(0, np.uint64)]
        for r in _runs(t.column("text"), span) if hot.any() else ():
            yes, _ = _among(r.minimiser, m[hot])
            found.append(r.own(_windows_of(r.at[yes], r.n[yes])[0]))
        h, n = np.unique(np.concatenate(found), return_counts=True)
        return _packed(t.column("block")[0].as_py() if len(t) else 0, h, n, buckets)

    second = _repeated(blocks.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(hot_windows, PACKED), 1)

    def cut_out(t: pa.Table, answer: pa.Table) -> pa.Table:
        m, hot = _answers(answer, 0)
        own, _ = _answers(answer, 1)
        text, row = t.column("text"), t.column("row").to_numpy()
        buf, offsets = K.text_buffer(text)
        seen: dict[bytes, int] = {}
        segs: list[tuple[int, bytes, bytes]] = []
        which, number, first, count = [], [], [], []
        for r in _runs(text, span) if len(m) else ():
            yes, place = _among(r.minimiser, m)
            heavy = yes & hot[place]
            light = yes & ~heavy
            windows, of = _windows_of(r.at[heavy], r.n[heavy])
            name = r.own(windows)
            stay = _among(name, own)[0]
            windows, of = windows[stay], of[stay]
            numbers = np.concatenate((r.text[light], r.text[heavy][of]))
            begins = np.concatenate((r.first[light], r.first[heavy][of] + windows - r.at[heavy][of]))
            counts = np.concatenate((r.n[light], np.ones(len(of), np.int64)))
            dealt = np.concatenate((r.minimiser[light], name[stay])) % np.uint64(shards)
            for i, a, n, s in zip(numbers.tolist(), begins.tolist(), counts.tolist(), dealt.tolist(), strict=True):
                body = buf[offsets[i] + a:offsets[i] + a + n + span - 1].tobytes()
                seg = hashlib.blake2b(body, digest_size=16).digest()
                if seg not in seen:
                    seen[seg] = len(segs)
                    segs.append((s, seg, body))
                which.append(seen[seg])
            number.append(numbers)
            first.append(begins)
            count.append(counts)
        which = np.array(which, np.int64)
        number, first, count = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (number, first, count))
        times = np.bincount(which, minlength=len(segs))
        once = np.flatnonzero(times[which] == 1)
        asked = dict(zip(which[once].tolist(), once.tolist(), strict=True))
        at = [asked.get(k) for k in range(len(segs))]
        lines = [(s, seg, body, int(times[k]), None if j is None else int(row[number[j]]), None if j is None else int(first[j]),
                  None, None) for k, ((s, seg, body), j) in enumerate(zip(segs, at, strict=True))]
        lines += [(None, None, None, None, int(row[i]), 0, a.tobytes(), n.tobytes())
                  for i, a, n in _settled(*(x[times[which] > 1] for x in (number, first, count)))]
        cols = list(zip(*lines, strict=True)) if lines else [()] * 8
        block = t.column("block")[0].as_py() if len(t) else 0
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = ["shard", "seg", "text", "c", "row", "first", "at", "n"]
        return pa.table({"block": pa.array(np.full(len(lines), block, np.int64)),
                         **{x: pa.array(c, k) for x, c, k in zip(names, cols, kinds, strict=True)}})

    return blocks.groupBy("block").cogroup(first.unionByName(second).groupBy("block")).applyInArrow(cut_out, CANDIDATES)


def _repeated_runs(candidates: DataFrame, span: int) -> DataFrame:
    """(seg, at, n): the repeated windows of each distinct run, as packed (first, number) ranges."""
    def construct(t: pa.Table) -> pa.Table:
        texts, segs = t.column("text").to_pylist(), t.column("seg").to_pylist()
        many = t.column("c").to_numpy() > 1
        alone = len(texts) == 1 and many[0]
        masks = [np.ones(len(texts[0]) - span + 1, bool)] if alone else repeated_windows(texts, span)
        out: dict[str, list] = defaultdict(list)
        for seg, mask, all_ in zip(segs, masks, many.tolist(), strict=True):
            edge = np.diff(np.concatenate(([0], (mask | all_).astype(np.int8), [0])))
            a, z = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            if len(a):
                out["seg"].append(seg)
                out["at"].append(a.astype(np.int64).tobytes())
                out["n"].append((z - a).astype(np.int64).tobytes())
        return pa.table({c: pa.array(out[c], pa.binary()) for c in ("seg", "at", "n")})

    given = candidates.where("text IS NOT NULL").select("shard", "seg", "text", "c").repartition("shard")
    distinct = given.groupBy("shard", "seg").agg(F.first("text").alias("text"), F.sum("c").alias("c"))
    return distinct.groupBy("shard").applyInArrow(construct, "seg binary, at binary, n binary")


def _covered(t: pa.Table, gone: pa.Table, span: int):
    """(text number, bytes, mask of removed bytes or None) of a block's texts."""
    count = [len(x.as_buffer()) // 8 for x in gone.column("at")]
    row = np.repeat(gone.column("row").to_numpy(), count)
    a = np.repeat(gone.column("first").to_numpy(), count) + _joined(gone.column("at"), np.int64)
    n = _joined(gone.column("n"), np.int64)
    order = np.argsort(row, kind="stable")
    row, a, n = row[order], a[order], n[order]
    rows, copies = t.column("row").to_numpy(), t.column("n").to_numpy()
    lo, hi = np.searchsorted(row, rows, "left"), np.searchsorted(row, rows, "right")
    buf, offsets = K.text_buffer(t.column("text"))
    for i in range(len(rows)):
        body = buf[offsets[i]:offsets[i + 1]]
        mask = None
        if copies[i] > 1 and len(body) >= span:
            mask = np.ones(len(body), bool)
        elif hi[i] > lo[i]:
            cover = np.zeros(len(body) + 1, np.int32)
            np.add.at(cover, a[lo[i]:hi[i]], 1)
            np.add.at(cover, a[lo[i]:hi[i]] + n[lo[i]:hi[i]] + span - 1, -1)
            mask = np.cumsum(cover[:-1]) > 0
        yield i, body, mask


def judged_texts(docs: DataFrame, span: int = SPAN, keep_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, starts, ends) for each distinct text of a table (text string);
    ``key`` is its SHA-256 and ``starts``/``ends`` are its removed runs. With ``keep_text`` also ``kept`` (binary)."""
    if span < 2 * GRAM:
        raise ValueError(f"windows are {2 * GRAM} bytes at least")
    n = parts_for(docs, BLOCK_MB)
    blocks = _distinct_texts(docs, n)
    path = scratch_path(docs.sparkSession, "passages")
    _candidates(blocks, n, n * SHARDS_PER_BLOCK, span).write.parquet(path)          # read twice
    found = docs.sparkSession.read.schema(CANDIDATES).parquet(path)
    asked = found.where("seg IS NOT NULL AND row IS NOT NULL").select("seg", "block", "row", "first")
    gone = (asked.join(_repeated_runs(found, span), "seg").drop("seg")
            .unionByName(found.where("seg IS NULL").select("block", "row", "first", "at", "n")))

    def run(t: pa.Table, gone: pa.Table) -> pa.Table:
        out = []
        for _, body, mask in _covered(t, gone, span):
            a = z = np.zeros(0, np.int64)
            kept = body
            if mask is not None:
                edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
                a, z, kept = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), body[~mask]
            out.append((len(body), len(body) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), a, z,
                        kept.tobytes() if keep_text else None))
        c = list(zip(*out, strict=True)) if out else [()] * 7
        spans = [pa.array([x.tolist() for x in v], pa.list_(pa.int64())) for v in c[4:6]]
        cols = {"key": t.column("key"), "n_bytes": pa.array(c[0], pa.int64()), "n_removed": pa.array(c[1], pa.int64()),
                "n_spans": pa.array(c[2], pa.int64()), "kept_sha256": pa.array(c[3], pa.string()), "starts": spans[0], "ends": spans[1]}
        return pa.table(cols | ({"kept": pa.array(c[6], pa.binary())} if keep_text else {}))

    schema = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"
    return blocks.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        run, schema + (", kept binary" if keep_text else ""))


def remove_passages(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
                    keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends) for each row, and ``kept`` when asked for."""
    rows = ids_texts(docs, id_col, text_col)
    judged = judged_texts(rows.select("text"), span, keep_text)
    keys = rows.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("key"))
    return keys.join(judged, "key").drop("key")


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(table(spark, sf_dir, "documents")).drop("starts", "ends")
