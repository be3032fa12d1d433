"""Token ids in Arrow files of equal-length sequences with masks.

Documents are range-partitioned and sorted by id; each partition streams its ids into one Arrow IPC file whose
batches hold fixed-size lists: ``ids`` (unsigned 16-bit where the vocabulary allows, else 32-bit) and ``mask``
(false only in the padding of the file's last sequence). Sequence i of a file is a fixed slice of its batch, so
readers map the file and take any sequence or any document's ids without copying or decoding what lies before. A small
index file beside it gives each document's place. Documents' global starts are the running sum of the files' lengths.

A task writes to a name of its own attempt and moves the finished files to their final names, so a task that is run
again replaces its files by equal ones. The folder is under spark.checkpoint.dir (any file system pyarrow knows);
inputs are read by Spark alone. Words are encoded by the tokenizers library once per distinct word and remembered in
a bounded memo: the tokenizer drops white space, so a text's ids are those of its words in turn. Where it also lower-cases
and splits letters from punctuation, a word of letters and trailing punctuation is the ids of its lower-cased letters and
those of the punctuation, and the letters that a text brings for the first time go to the library in one call.

Defined results: null and empty texts have only the end id; rows with a null id stand first; rows that repeat an id
stand together and each is returned; an empty table gives files without sequences and an empty result.
"""

from __future__ import annotations

import json
import os
import re
import string
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..session import ensure_checkpoint_dir
from .bpe import Memo, public_tokenizer, read_tokenizer
from .common import cut, ids_texts, parts_for, table

SEQUENCE = 1024
BATCH_ROWS = 256
END_ID = 2
WORDS_REMEMBERED = 500_000
PART_MB = 12
# letters that stay one piece in any case (in UTF-8: A-Z, a-z, U+00C0 to U+00FF but the two signs)
LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PUNCTUATION = string.punctuation.encode()
# the normaliser and the splitting pattern under which such letters and the punctuation after them encode alone
LOWERED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def _letters_of(word: bytes) -> bytes | None:
    """The letters of a word of letters and trailing punctuation; None for other words."""
    letters = word.rstrip(PUNCTUATION)
    return letters if letters.isalpha() or LETTERS.fullmatch(letters) else None


def _word_ends(spec: dict) -> list[int]:
    """Ids of the tokens that end a piece, if a tokenizer encodes letters and the punctuation after them alone; else none."""
    model, suffix = spec["model"], spec["model"].get("end_of_word_suffix")
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    if (not suffix or model.get("dropout") or (spec.get("normalizer") or {}).get("normalizers") != LOWERED
            or split[0].get("pattern") != {"Regex": PIECES} or [x.get("type") for x in split[1:]] != ["ByteLevel"]
            or any(_letters_of(t["content"].encode()) for t in spec.get("added_tokens", []))):
        return []
    return [i for t, i in model["vocab"].items() if t.endswith(suffix)]


class WordEncoder:
    """Packed ids of whole texts by a tokenizer that drops white space; distinct words are encoded once."""

    def __init__(self, content: str, width: str):
        from tokenizers import Tokenizer
        self.tokenizer, self.width = Tokenizer.from_str(content), width
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.memo = Memo(lambda w: self._many([w])[0], WORDS_REMEMBERED)
        ends = _word_ends(json.loads(content))
        self.last = np.zeros(1 << 16 if width == "<u2" else max(ends, default=0) + 1, bool)     # tokens that end a piece
        self.last[ends] = True
        self.split = bool(ends)

    def _many(self, words: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes()
                for e in self.batch([w.decode() for w in words], add_special_tokens=False)]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Words of letters alone, in one text: each is one piece, so it ends with the first token that ends one."""
        ids = np.array(self.batch([b" ".join(words).decode()], add_special_tokens=False)[0].ids, self.width)
        packed = ids.tobytes()
        ends = ((np.flatnonzero(self.last[ids]) + 1) * ids.itemsize).tolist()
        return [packed[a:z] for a, z in zip([0, *ends], ends, strict=False)]

    def _learn(self, new: list[bytes]) -> None:
        memo, old = self.memo, self.memo.old
        if self.split:
            parts, others = [], []
            for w in new:
                c = _letters_of(w)
                if c:
                    parts.append((w, c.lower(), w[len(c):]))
                else:
                    others.append(w)
            letters = [c for c in {c for _, c, _ in parts} if c not in memo and c not in old]
            if letters:
                memo.update(zip(letters, self._letters(letters), strict=True))
            for w, c, tail in parts:
                memo[w] = memo[c] + memo[tail] if tail else memo[c]
            new = others
        if new:
            memo.update(zip(new, self._many(new), strict=True))

    def encode(self, text: str | None) -> bytes:
        words = (text or "").encode().split()
        memo = self.memo
        memo.trim()
        distinct = list(set(words))
        ids = dict(zip(distinct, map(memo.get, distinct), strict=True))          # small, so asked for every word
        missing = [w for w, x in ids.items() if x is None]
        if missing:
            new = [w for w in missing if w not in memo.old and len(w) <= 64]
            if new:
                self._learn(new)
            ids.update((w, memo[w]) for w in missing)
        return b"".join(map(ids.__getitem__, words))


_encoders: dict[int, WordEncoder] = {}


def _encoder(content: str, width: str) -> WordEncoder:
    key = hash(content)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[key] = WordEncoder(content, width)
    return _encoders[key]


class SequenceWriter:
    """Streams ids into an Arrow file of fixed-size lists; at most one batch is held."""

    def __init__(self, sink, width: str, length: int = SEQUENCE):
        self.kind, self.width, self.length = pa.from_numpy_dtype(np.dtype(width)), width, length
        self.schema = pa.schema([("ids", pa.list_(self.kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.file, self.held, self.count, self.total = pa.ipc.new_file(sink, self.schema), [], 0, 0

    def add(self, packed: bytes) -> int:
        ids = np.frombuffer(packed, self.width)
        self.held.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        if self.count >= self.length * BATCH_ROWS:
            self._flush(False)
        return len(ids)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, self.width)
        step = self.length * BATCH_ROWS
        full = len(ids) // step * step
        for i in range(0, full, step):
            self._write(ids[i:i + step], step)
        rest = ids[full:]
        if last and len(rest):
            rows = -(-len(rest) // self.length) * self.length
            self._write(np.concatenate([rest, np.zeros(rows - len(rest), self.width)]), len(rest))
            rest = rest[:0]
        self.held, self.count = [rest], len(rest)

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        self.file.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                                               pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
                                              schema=self.schema))

    def close(self) -> None:
        self._flush(True)
        self.file.close()


class SequenceReader:
    """Random access to a file's sequences, masks and id ranges; local files are mapped, not read."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self._last = (-1, None)

    def _batch(self, i: int) -> pa.RecordBatch:
        if self._last[0] != i:
            self._last = (i, self.file.get_batch(i))
        return self._last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; the ids are a view of the file."""
        b, r = self._batch(i // BATCH_ROWS), i % BATCH_ROWS
        at = slice(r * self.length, (r + 1) * self.length)
        return b.column(0).values.to_numpy()[at], b.column(1).values[at].to_numpy(zero_copy_only=False)

    def ids(self, start: int, n: int):
        """Views of the ids at positions ``start`` to ``start + n`` of the file, batch by batch."""
        step = self.length * BATCH_ROWS
        while n > 0:
            b, at = divmod(start, step)
            part = self._batch(b).column(0).values.to_numpy()[at:at + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_sequences(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int | None = END_ID,
                    length: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files; returns their manifest (part, data, places, n_docs, n_ids), one row per file."""
    content = read_tokenizer(tokenizer_path)
    spec = json.loads(content)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", [])), end_id or 0])
    width = "<u2" if top < 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast(content)
    tail = b"" if end_id is None else np.array([end_id], width).tobytes()
    fs, _ = open_fs(folder)
    fs.create_dir(open_fs(folder)[1])

    def run(batches):
        ctx = TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        encoder = _encoder(shared.value, width)
        fs, base = open_fs(folder)
        names = [f"{base}/part-{part:06d}.arrow", f"{base}/part-{part:06d}.places.arrow"]
        own = [f"{n}.{attempt}" for n in names]
        places = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        n_docs = 0
        with fs.open_output_stream(own[0]) as data, fs.open_output_stream(own[1]) as index:
            writer, table_file = SequenceWriter(data, width, length), pa.ipc.new_file(index, places)
            for b in batches:
                starts, counts = [], []
                for x in b.column(1):
                    starts.append(writer.total)
                    counts.append(writer.add(encoder.encode(x.as_py()) + tail))
                table_file.write_batch(pa.record_batch([b.column(0), pa.array(starts, pa.int64()),
                                                        pa.array(counts, pa.int64())], schema=places))
                n_docs += b.num_rows
            writer.close()
            table_file.close()
        for a, b in zip(own, names, strict=True):
            fs.move(a, b)
        tail_of = [f"{folder.rstrip('/')}/{os.path.basename(n)}" for n in names]
        yield pa.RecordBatch.from_pydict({"part": [part], "data": [tail_of[0]], "places": [tail_of[1]],
                                          "n_docs": [n_docs], "n_ids": [writer.total]})

    parts = parts_for(docs, PART_MB)
    ordered = ids_texts(docs, id_col, text_col).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    return cut(ordered.mapInArrow(run, "part long, data string, places string, n_docs long, n_ids long"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)          # one row per file
    files = manifest.withColumn("ahead", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for b in batches:
            for f in b.to_pylist():
                if not f["n_docs"]:
                    continue
                reader = SequenceReader(f["data"])
                fs, path = open_fs(f["places"])
                with pa.ipc.open_file(fs.open_input_file(path)) as places:
                    for i in range(places.num_record_batches):
                        p = places.get_batch(i)
                        crc = []
                        for start, k in zip(p.column(1).to_pylist(), p.column(2).to_pylist(), strict=True):
                            c = 0
                            for part in reader.ids(start, k):
                                c = zlib.crc32(part.astype("<u4").tobytes(), c)
                            crc.append(c)
                        yield pa.RecordBatch.from_arrays(
                            [p.column(0), pa.array(np.asarray(p.column(1)) + f["ahead"], pa.int64()), p.column(2),
                             pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sequences-{uuid.uuid4().hex}"
    return read_documents(write_sequences(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"), folder))
