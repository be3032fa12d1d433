"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

1. *Lexicon.* Words and word beginnings (4 to 7 bytes, case-folded) of labelled training rows are counted by class in
   one distributed aggregation; the ``ENTRIES`` that mark label 1 best are kept (a bounded list).
2. *Voters.* The entries are dealt over ``LEXICON_VOTERS`` voters, each firing when a text holds one of its entries;
   further voters look at patterns (capitals, exclamation marks, symbols, one word over and over).
3. *Label model.* An expectation-maximisation over the votes (the given labels count as one noisy voter) estimates each voter's firing rate in either
   class (its accuracy), the class prior, and the voters' correlations within a class (their shared residual
   covariance); correlated voters share their weight through its inverse.
4. *Classifier.* A ridge logistic regression on entry indicators and votes is trained on the label model's posterior
   labels, and scores every whole text in one scan.

The training rows are a bounded sample (``SAMPLE_ROWS`` smallest id hashes among labelled rows that are not held out).
Defined results: null and empty texts hold no entry and get the score of a text without any; without labelled rows
every score is 0; repeated rows give repeated result rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import kernel as K
from .common import held_out, ids_texts, table
from .quality import labelled_sample

SAMPLE_ROWS = 20_000
ENTRIES = 320
LEXICON_VOTERS = 16
PREFIXES = (4, 5, 6, 7)
MIN_ROWS = 4                   # label-1 rows that an entry must occur in
PATTERNS = 4


def _folded(column: pa.Array):
    """Runs of letters, digits and non-ASCII bytes, lower-cased (ASCII and the Latin-1 letters)."""
    for lo, hi, w in K.chunks(column, K.LETTER):
        raw = w.buf
        buf = K.LOWER[raw]
        upper = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1 if len(raw) else []
        buf[upper] += 32
        w.buf = buf
        yield lo, hi, w, raw


def _feature_hashes(w: K.Words):
    """Hashes of the whole words and of their beginnings: (hash array, word index array) pairs."""
    prefix, length = w.prefix(), w.ends - w.starts
    yield w.hashes(prefix), np.arange(len(length))
    for k in PREFIXES:
        long = np.flatnonzero(length > k)
        ends = np.where(length > k, w.starts + k, w.ends)
        yield K.mix(w.hashes(prefix, ends)[long], k), long


def _patterns(w: K.Words, raw: np.ndarray) -> np.ndarray:
    rows = len(w.counts)
    at = np.repeat(np.arange(rows), np.diff(w.offsets))
    share = lambda mask: np.bincount(at[mask], minlength=rows) / np.maximum(np.diff(w.offsets), 1)
    row, h = w.rows(), w.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    return np.column_stack([share((raw >= 65) & (raw <= 90)) > 0.3, share((raw == 33) | (raw == 63)) > 0.02,
                            share(np.isin(raw, np.frombuffer(b"#$%&*@|~^", np.uint8))) > 0.02,
                            np.bincount(row[same], minlength=rows) > 0.2 * np.maximum(w.counts, 1)])


def learn_lexicon(sample: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """Hashes of the words and word beginnings that mark label 1, best first. Counts are summed by Spark; only the
    ``entries`` best reach the driver."""
    def run(batches):
        for b in batches:
            toxic = b.column("label").to_numpy(zero_copy_only=False) == 1
            for lo, hi, w, _ in _folded(b.column("text")):
                row = w.rows()
                for h, at in _feature_hashes(w):
                    pair = np.unique(K.mix(h ^ K.mix(row[at].astype(np.uint64), 1)), return_index=True)[1]
                    one = toxic[lo + row[at[pair]]]
                    keys, where = np.unique(h[pair], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.bincount(where, one, len(keys)).astype(np.int64)),
                         pa.array(np.bincount(where, ~one, len(keys)).astype(np.int64))], ["h", "n1", "n0"])

    n = sample.groupBy("label").count().collect()
    n1, n0 = (sum(r["count"] for r in n if r["label"] == c) for c in (1, 0))
    if not n1:
        return np.zeros(0, np.uint64)
    counts = sample.mapInArrow(run, "h long, n1 long, n0 long").groupBy("h").agg(F.sum("n1").alias("n1"),
                                                                                   F.sum("n0").alias("n0"))
    ratio = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    best = (counts.where(F.col("n1") >= MIN_ROWS).withColumn("ratio", ratio).where("ratio > 2.5")
            .orderBy((F.col("ratio") * F.col("n1")).desc(), "h").limit(entries).collect())
    return np.array([r["h"] for r in best], np.int64).view(np.uint64)


class Voters:
    def __init__(self, lexicon: np.ndarray):
        order = np.argsort(lexicon)
        self.table, self.entry = lexicon[order], order
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(lexicon >> np.uint64(48)).astype(np.int64)] = True
        self.voter_of = np.arange(len(lexicon)) % LEXICON_VOTERS

    def features(self, column: pa.Array) -> np.ndarray:
        """(rows, entries + patterns) indicators as booleans."""
        n = len(self.table)
        out = np.zeros((len(column), n + PATTERNS), bool)
        for lo, hi, w, raw in _folded(column):
            row = w.rows()
            for h, at in _feature_hashes(w) if n else ():
                some = np.flatnonzero(self.maybe[(h >> np.uint64(48)).astype(np.int64)])
                place = np.minimum(np.searchsorted(self.table, h[some]), n - 1)
                hit = self.table[place] == h[some]
                out[lo + row[at[some[hit]]], self.entry[place[hit]]] = True
            out[lo:hi, n:] = _patterns(w, raw)
        return out

    def votes(self, features: np.ndarray) -> np.ndarray:
        n = len(self.table)
        lex = np.column_stack([features[:, :n][:, self.voter_of == v].any(1) for v in range(LEXICON_VOTERS)])
        return np.column_stack([lex, features[:, n:]]).astype(float)


def label_model(votes: np.ndarray, marked: np.ndarray, trust: float = 0.98, rounds: int = 50) -> np.ndarray:
    """Posterior probability of label 1 for each row of votes. The given labels (``marked``: 0 or 1) are one more
    voter, of a known accuracy ``trust``. Each round estimates the class-conditional firing rates, the prior and the
    correlations of the votes within a class, then the posteriors under them."""
    p = np.where(marked == 1, trust, 1 - trust)
    said = np.log(p / (1 - p))
    fired = votes.sum(1)
    many = np.maximum(fired - 1, 1)
    for _ in range(rounds):
        prior = np.clip(p.mean(), 1e-4, 1 - 1e-4)
        one = (p @ votes + 0.5) / (p.sum() + 1)
        zero = ((1 - p) @ votes + 0.5) / ((1 - p).sum() + 1)
        r1, r0 = votes - one, votes - zero
        cov = (r1.T @ (r1 * p[:, None]) + r0.T @ (r0 * (1 - p)[:, None])) / len(votes)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        corr = np.clip(cov / np.outer(sd, sd), 0, 1)
        np.fill_diagonal(corr, 0)
        shared = ((votes @ corr) * votes).sum(1) / np.maximum(fired, 1)       # mean over fired voters of Σ others
        evidence = (votes @ np.log(one / zero)) / (1 + np.minimum(shared, many))
        silent = fired == 0
        evidence[silent] = np.log(((p[silent].sum() + 0.5) / (p.sum() + 1))
                                  / (((1 - p[silent]).sum() + 0.5) / ((1 - p).sum() + 1)))
        z = evidence + np.log(prior / (1 - prior)) + said
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    return p


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the intercept) of a ridge logistic regression on soft labels, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, voters: Voters, weights: np.ndarray | None):
        self.voters, self.weights = voters, weights

    def score(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(column))
        f = self.voters.features(column)
        x = np.column_stack([f, self.voters.votes(f)])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Model:
    sample = labelled_sample(docs, labels, "toxic", max_rows)
    voters = Voters(learn_lexicon(sample))
    if not len(voters.table):
        return Model(voters, None)
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches):
        for b in batches:
            packed = np.packbits(shared.value.features(b.column("text")), axis=1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"),
                                              pa.array([r.tobytes() for r in packed], pa.binary())],
                                             ["doc_id", "label", "bits"])

    rows = sample.mapInArrow(run, "doc_id long, label int, bits binary").collect()   # max_rows short bit strings
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["bits"]))
    width = len(voters.table) + PATTERNS
    f = np.unpackbits(np.array([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1)[:, :width].astype(bool)
    votes = voters.votes(f)
    posterior = label_model(votes, np.array([r["label"] for r in rows]))
    return Model(voters, logistic(np.column_stack([f, votes]), posterior))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = shared.value.score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return (ids_texts(docs, id_col, text_col).withColumn("held_out", held_out("doc_id"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
