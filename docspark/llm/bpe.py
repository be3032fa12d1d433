"""Byte-level BPE encoding and decoding as bounded-lookahead streaming transducers.

``MergeTables`` reads a published tokenizer file and computes the *sufficient lookahead* of its merge list: the
number of bytes K such that every token ending K or more bytes before the end of what has been read can no longer
change, whatever follows. Merges run in rank order, so a difference at the right end can only travel left along rules
of rising rank: a rule (u, v) moves it by len(u), and the next rule (u', v') must find, at the same place, a v' whose
left spine holds u. K is the heaviest such chain, found by one pass over the rules in rank order.

``Encoder`` keeps at most ``WINDOW`` + K bytes of a pre-token: it merges what it holds, emits the tokens that are
stable and drops their bytes. A boundary that no merge crosses splits the encoding in two, so the rest is encoded as
if it stood alone. Pre-tokens up to 64 bytes go through a bounded memo. ``Decoder`` is the inverse state machine:
ids in, text out, holding back only the bytes of an unfinished character.

Defined results: null text encodes like the empty text (no ids); repeated rows and repeated ids give repeated result
rows; the text of a special token is encoded as that token; ids outside the vocabulary are a ValueError on decoding.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import ids_texts, table

WINDOW = 512                 # bytes of a long pre-token merged at a time, besides the lookahead
MEMO = 100_000               # pre-tokens remembered per worker and generation (two generations are kept)
SLICE = 1 << 16              # characters given to the splitting pattern at a time


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies → the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTables:
    """Vocabulary, merges, special tokens and the lookahead bound of a byte-level BPE tokenizer file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        to_bytes = lambda t: bytes(alphabet[c] for c in t)                      # noqa: E731
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes | None] = [None] * size
        for t, i in vocab.items():
            self.token_bytes[i] = to_bytes(t)
        for t, i in self.special.items():
            self.token_bytes[i] = t.encode()
        self.byte_id = [vocab.get(c, -1) for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.rank = {p: r for p, (r, _) in self.merges.items()}
        self.made = [vocab[a + b] for a, b in pairs]
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int | None:
        """K as in the module text; None when a rule uses a token that only a later rule makes (then no finite
        bound is claimed and pre-tokens are merged whole)."""
        left: dict[int, int] = {}                       # token → left part in the rule that makes it first
        made = set(i for i in self.byte_id if i >= 0)
        heaviest: dict[int, int] = {}                   # token u → heaviest chain that ends in a rule with left part u
        bound = 0
        for (u, v), (_, uv) in sorted(self.merges.items(), key=lambda x: x[1][0]):
            if u not in made or v not in made:
                return None
            best, s = 0, v
            while s is not None:
                best = max(best, heaviest.get(s, 0))
                s = left.get(s)
            d = len(self.token_bytes[u]) + best
            heaviest[u] = max(heaviest.get(u, 0), d)
            bound = max(bound, d)
            if uv not in made:
                made.add(uv)
                left[uv] = u
        return bound

    def merge(self, ids: list[int]) -> list[int]:
        """Merge a sequence of byte ids completely (lowest rank first, leftmost first)."""
        merges = self.merges
        if len(ids) <= 128:
            rank, made, none = self.rank.get, self.made, len(self.made)
            ranks = [*map(rank, zip(ids, ids[1:]), repeat(none))]  # noqa: B905
            while ranks and (m := min(ranks)) < none:
                i = ranks.index(m)
                ids[i] = made[m]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
                if i < len(ranks):
                    ranks[i] = rank((ids[i], ids[i + 1]), none)
            return ids
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merges[(a, b)][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[k]))
            if (p := before[i]) >= 0 and (m := merges.get((ids[p], ids[i]))):
                heapq.heappush(heap, (m[0], p, ids[p], ids[i]))
        return [x for x in ids if x >= 0]


def _packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


class Memo(dict):
    """Bounded memo of a function, in two generations: when the young one is full it becomes the old one."""

    def __init__(self, compute: Callable, size: int = MEMO):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            self[key] = value
        return value

    def trim(self) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Text → packed little-endian unsigned 32-bit ids."""

    PATTERN = regex.compile(r"'(?:[stmd]|re|ve|ll)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s++")
    LOOSE = regex.compile(r"\s ")

    def __init__(self, tables: MergeTables, window: int = WINDOW):
        self.t, self.window = tables, window
        self.tokens, self.words = Memo(self._pretoken), Memo(self._word)
        self.special = (regex.compile("(" + "|".join(regex.escape(s) for s in sorted(tables.special, key=len,
                        reverse=True)) + ")") if tables.special else None)

    def stream(self, data: Iterable[bytes]) -> Iterator[int]:
        """Ids of one pre-token whose bytes arrive in pieces; holds at most ``window`` + K bytes plus one piece."""
        t, keep, window = self.t, self.t.lookahead, self.window
        held = b""
        for piece in data:
            held += piece
            while keep is not None and len(held) >= window + keep:
                part = held[:window + keep]
                done, stable = 0, len(part) - keep
                for i in t.merge([t.byte_id[b] for b in part]):
                    n = len(t.token_bytes[i])
                    if done + n > stable:
                        break
                    done += n
                    yield i
                if not done:                            # a token longer than the window: widen it
                    window *= 2
                held = held[done:]
        yield from t.merge([t.byte_id[b] for b in held])

    def _pretoken(self, s: str) -> bytes:
        raw = s.encode()
        if len(raw) <= self.window:
            ids = self.t.merge([*map(self.t.byte_id.__getitem__, raw)])
        else:
            step = self.window
            ids = list(self.stream(raw[i:i + step] for i in range(0, len(raw), step)))
        return _packed(ids)

    def _word(self, s: str) -> bytes:
        """Ids of a space and ``s``."""
        return b"".join(map(self.tokens.__getitem__, self.PATTERN.findall(" " + s)))

    def _plain(self, text: str) -> Iterator[bytes]:
        """A space after a non-space always starts a pre-token, so a text whose spaces are all such splits at its
        spaces into parts that encode alone; other texts go through the pattern."""
        for piece in slices(text):
            self.words.trim()
            self.tokens.trim()
            if self.LOOSE.search(piece):
                yield b"".join(map(self.tokens.__getitem__, self.PATTERN.findall(piece)))
                continue
            first, *rest = piece.split(" ")
            yield b"".join(map(self.tokens.__getitem__, self.PATTERN.findall(first)))
            yield b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special is None or not any(s in text for s in self.t.special):
            return b"".join(self._plain(text))
        out = []
        for part in self.special.split(text):
            if part in self.t.special:
                out.append(_packed([self.t.special[part]]))
            elif part:
                out.extend(self._plain(part))
        return b"".join(out)


_CUT = regex.compile(r"(?<=\S) ")


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Pieces of at least ``size`` characters, cut before a space that follows a non-space: a pre-token always
    starts there, so the pieces split like the whole text."""
    lo, n = 0, len(text)
    while n - lo > size:
        m = _CUT.search(text, lo + size)
        if m is None:
            break
        yield text[lo:m.start()]
        lo = m.start()
    yield text[lo:] if lo else text


class Decoder:
    """Ids → text, incrementally; only the bytes of an unfinished character are held between calls."""

    def __init__(self, tables: MergeTables):
        self.token_bytes = tables.token_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        try:
            return self.state.decode(b"".join(map(self.token_bytes.__getitem__, ids)), last)
        except (IndexError, TypeError):
            raise ValueError("an id is not in the vocabulary") from None

    def decode(self, packed: bytes, block: int = 1 << 16) -> Iterator[str]:
        """The text of packed ids, ``block`` ids at a time."""
        ids = np.frombuffer(packed, "<u4")
        for i in range(0, len(ids), block):
            yield self.feed(ids[i:i + block].tolist())
        yield self.feed((), True)
        self.state.reset()


_loaded: dict[int, tuple[Encoder, Decoder]] = {}


def coders(content: str) -> tuple[Encoder, Decoder]:
    """The worker's encoder and decoder for a tokenizer file's content (built once per process)."""
    key = hash(content)
    if key not in _loaded:
        t = MergeTables(content)
        _loaded[key] = Encoder(t), Decoder(t)
    return _loaded[key]


def read_tokenizer(path: str) -> str:
    """Content of a tokenizer file on the driver (a vocabulary: a few MB, whatever the corpus)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary: packed little-endian unsigned 32-bit) per row. One pass, no shuffle."""
    content = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches):
        enc, _ = coders(content.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array((enc.encode(x.as_py()) for x in b.column(1)), pa.binary())], ["doc_id", "ids"])

    return ids_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) rows."""
    content = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def run(batches):
        _, dec = coders(content.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(("".join(dec.decode(x.as_py() or b"")) for x in b.column(1)), pa.string())],
                ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again, in one pass: (doc_id, n_tokens, ids_sha256, decoded_sha256).
    The ids of a text are held only while its digests are made."""
    content = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def digests(enc: Encoder, dec: Decoder, text: str | None):
        packed, h = enc.encode(text), hashlib.sha256()
        for s in dec.decode(packed):
            h.update(s.encode())
        return len(packed) // 4, hashlib.sha256(packed).hexdigest(), h.hexdigest()

    def run(batches):
        enc, dec = coders(content.value)
        for b in batches:
            rows = [digests(enc, dec, x.as_py()) for x in b.column(1)]
            n, ids, text = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                              pa.array(text, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return ids_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))
