"""Document quality by a regularised quadratic discriminant over transformed document statistics.

``statistics`` turns each whole text into a fixed vector (lengths, repetition, shares of byte classes; logarithms and
square roots make them roughly normal). ``fit`` reads a bounded sample of labelled rows (``max_rows`` smallest id
hashes; the bound keeps the driver's part fixed, see ``SAMPLE_ROWS``), shrinks each class covariance towards the pooled one
and towards a multiple of the identity, and caches the inverse Cholesky factors; a score is the logistic of the
difference of the two Gaussian log densities (discounted for texts of few words) plus the log prior odds. Scoring is one scan without a shuffle.

Defined results: null and empty texts have the statistics of an empty text and are scored; without labelled rows of
both classes every score is the share of label 1 (0.5 without any); repeated rows give repeated result rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import kernel as K
from .common import held_out, ids_texts, table

SAMPLE_ROWS = 20_000          # labelled rows that a fit reads at most
KEEP_FROM = 0.3               # scores from here on count as label 1
FULL_WEIGHT_WORDS = 50        # shorter texts' statistics are noisy: their evidence counts by (words / 50) squared
SHRINK_POOLED, SHRINK_RIDGE = 0.2, 0.01

_CLASS = np.zeros(256, np.uint8)
for _i, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
                             b"\n\r", b".,;:'\"()-", b"!?", b"#$%&*@|~^<>=+/\\_{}[]`"], start=1):
    _CLASS[list(_chars)] = _i
_CLASS[0x80:] = 9
N_CLASSES = 10
N_STATS = 8 + N_CLASSES - 1


def statistics(column: pa.Array) -> np.ndarray:
    """(rows, N_STATS) statistics of whole texts."""
    out = np.zeros((len(column), N_STATS))
    for lo, hi, w in K.chunks(column):
        out[lo:hi] = _chunk_stats(w)
    return out


def _chunk_stats(w: K.Words) -> np.ndarray:
    rows = len(w.counts)
    n_bytes = np.diff(w.offsets)
    row_of_byte = np.repeat(np.arange(rows, dtype=np.int64) * N_CLASSES, n_bytes)
    classes = np.bincount(row_of_byte + _CLASS[w.buf], minlength=rows * N_CLASSES).reshape(rows, N_CLASSES)
    row, n = w.rows(), w.counts.astype(float)
    length = (w.ends - w.starts).astype(float)
    one = np.maximum(n, 1)
    mean = np.bincount(row, length, rows) / one
    var = np.maximum(np.bincount(row, length ** 2, rows) / one - mean ** 2, 0)
    h = w.hashes()
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    repeats = np.bincount(row[again], minlength=rows)
    key = np.sort((row.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    run = np.diff(np.append(first, len(key)))
    run_row = (key[first] >> np.uint64(40)).astype(np.int64)
    distinct = np.bincount(run_row, minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, run_row, run)
    share = classes[:, 1:] / np.maximum(n_bytes, 1)[:, None]
    return np.column_stack([np.log1p(n), np.log1p(mean), np.sqrt(np.sqrt(var)), np.log((distinct + 1) / (n + 1)),
                            np.log((top + 1) / (n + 1)), np.sqrt(repeats / one),
                            np.log1p(np.bincount(row, length > 20, rows) / one * 100),
                            np.log((classes[:, 5] + 1) / (n + 1)), np.sqrt(share)])


class Discriminant:
    """Two Gaussian classes with shrunk covariances and cached inverse Cholesky factors."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.classes = []
        n1 = int(y.sum())
        if min(n1, len(y) - n1) < 2:
            return
        self.center, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.center) / self.scale
        d = z.shape[1]
        covs = [np.cov(z[y == c].T) for c in (0, 1)]
        pooled = (covs[0] * (len(y) - n1) + covs[1] * n1) / len(y)
        for c, cov in enumerate(covs):
            cov = (1 - SHRINK_POOLED) * cov + SHRINK_POOLED * pooled
            cov = (1 - SHRINK_RIDGE) * cov + SHRINK_RIDGE * max(np.trace(cov) / d, 1e-3) * np.eye(d)
            chol = np.linalg.cholesky(cov)
            self.classes.append((z[y == c].mean(0), np.linalg.inv(chol).T, -np.log(np.diag(chol)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.share)
        z = (x - self.center) / self.scale
        zero, one = (const - 0.5 * (((z - mu) @ inv) ** 2).sum(1) for mu, inv, const in self.classes)
        weight = np.minimum(np.expm1(x[:, 0]) / FULL_WEIGHT_WORDS, 1) ** 2
        return 1 / (1 + np.exp(-np.clip((one - zero) * weight + np.log(self.share / (1 - self.share)), -50, 50)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``max_rows`` labelled rows that are not held out: those with the smallest id
    hashes. Only the chosen ids (bounded by ``max_rows``) are broadcast to the scan of the documents."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))
    return ids_texts(docs).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Discriminant:
    def run(batches):
        for b in batches:
            x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"),
                                              pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])

    rows = (labelled_sample(docs, labels, "quality", max_rows)
            .mapInArrow(run, "doc_id long, label int, x binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))               # the same sums whatever the task order
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), N_STATS)
    return Discriminant(x, np.array([r["label"] for r in rows], int))


def score(docs: DataFrame, model: Discriminant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = shared.value.score(statistics(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array((s >= KEEP_FROM).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return (ids_texts(docs, id_col, text_col).withColumn("held_out", held_out("doc_id"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``KEEP_FROM``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(shared.value.score(statistics(b.column(at))) >= KEEP_FROM))

    return docs.mapInArrow(run, docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
