"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact reranking.

``fit`` learns a rotation on a bounded sample (``SAMPLE_ROWS`` smallest id hashes): principal directions, then
alternating sign codes and orthogonal Procrustes steps until the codes are balanced and close to the rotated vectors.
Directions and codes are taken without subtracting the mean, which would widen the angles of vectors that share a
common direction: codes keep the angle between two vectors however strong their mean is, at the price of more code
pairs to compare then. Every vector gets a code of up to 64 bits. Codes are cut into ``CHUNKS`` chunks; two codes within ``MAX_BITS`` have a
chunk with at most two differing bits, so if each code is entered under every chunk value with at most one bit
flipped, such a pair meets. Pairs of codes (not of vectors) are found that way; vectors under close codes are compared
by cosine in double precision, block against block, so a code shared by many vectors is spread over many tasks.

Equal vectors are one *class* first and are never expanded into pairs. A block pair returns, per class, the number of
vectors it links, and links enough to connect what is connected (each class to the smallest it reaches inside the block pair),
not every link. Recall is below one only for links whose codes differ in more than ``MAX_BITS`` bits; the
tests measure it against brute force.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id link
with nothing (component: their id); vectors link with vectors of their own length, each length by a model of its own;
repeated rows link with each other; rows that repeat an id with different vectors are judged each by its own vector;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import kernel as K
from .common import cut, parts_for, table
from .components import components

COSINE = 0.95
SAMPLE_ROWS = 20_000
ROUNDS = 50
CHUNKS = 4
MAX_BITS = 3 * CHUNKS - 1
BLOCK = 1024                  # classes of one code compared at a time


class Quantiser:
    def __init__(self, sample: np.ndarray):
        self.dim = sample.shape[1] if sample.ndim == 2 else 0
        self.bits = min(64, self.dim)
        if not len(sample) or not self.dim:
            return
        unit = sample / np.linalg.norm(sample, axis=1)[:, None]
        _, axes = np.linalg.eigh(unit.T @ unit)
        axes = axes[:, ::-1][:, :self.bits]
        v = unit @ axes
        rotation = np.linalg.qr(np.random.Generator(np.random.PCG64(1)).normal(size=(self.bits, self.bits)))[0]
        for _ in range(ROUNDS):
            u, _, wt = np.linalg.svd(np.where(v @ rotation >= 0, 1.0, -1.0).T @ v)
            rotation = (u @ wt).T
        self.map = axes @ rotation

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = (x / np.linalg.norm(x, axis=1)[:, None]) @ self.map >= 0
        return (bits.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(1, dtype=np.uint64)


def _vectors(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the usable vectors of length ``dim`` (the batch's most common length by default)."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if dim is None:
        dim = Counter(lengths[lengths > 0].tolist()).most_common(1)[0][0] if (lengths > 0).any() else 0
    rows = np.flatnonzero((lengths == dim) & (dim > 0))
    if not len(rows):
        return rows, np.zeros((0, dim))
    x = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy().reshape(len(rows), dim)
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    x = x[ok]
    return rows[ok], np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])     # by a power of two: norms are finite


def fit(vectors: DataFrame, max_rows: int = SAMPLE_ROWS) -> Quantiser:
    """``vectors``: (vec_id, embedding). Only the sample reaches the driver."""
    rows = (vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_rows).select("embedding").toArrow())
    column = rows.column(0).combine_chunks()
    return Quantiser(_vectors(column)[1] if len(column) else np.zeros((0, 0)))


def encode(vectors: DataFrame, model: Quantiser) -> DataFrame:
    """(vec_id, code, h1, h2, vector) per row, null but for the id where the vector is not usable; equal vectors have
    equal (h1, h2)."""
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            m = shared.value
            rows, x = _vectors(b.column(1), m.dim)
            x = x + 0.0                                              # -0.0 is 0.0
            at = np.full(b.num_rows, -1)
            at[rows] = np.arange(len(rows))
            take = pa.array(at, mask=at < 0)
            w = x.view(np.uint64)
            place = np.arange(1, m.dim + 1, dtype=np.uint64)
            h = [np.add.reduce(K.mix(K.mix(w, s) + K.mix(place, s)), axis=1).view(np.int64) for s in (1, 2)]
            code = m.codes(x).view(np.int64) if len(rows) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()).take(take) for c in (code, *h)),
                 pa.array([r.tobytes() for r in x], pa.binary()).take(take)], ["vec_id", "code", "h1", "h2", "vector"])

    return vectors.mapInArrow(run, "vec_id long, code long, h1 long, h2 long, vector binary")


def close_codes(codes: DataFrame, bits: int, tasks: int) -> DataFrame:
    """Distinct (x, y) with x < y of the distinct ``code`` values within MAX_BITS."""
    edges = [round(i * bits / CHUNKS) for i in range(CHUNKS + 1)]

    def keys(batches):
        for b in batches:
            code = b.column(0).to_numpy().view(np.uint64)
            for c, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                part = code >> np.uint64(lo) & np.uint64((1 << (hi - lo)) - 1)
                for flip in (0, *(1 << i for i in range(hi - lo))):
                    key = (part ^ np.uint64(flip)) * np.uint64(CHUNKS) + np.uint64(c)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((K.mix(key, 9) % np.uint64(tasks)).astype(np.int64)), pa.array(key.view(np.int64)),
                         b.column(0)], ["task", "key", "code"])

    def meet(t: pa.Table) -> pa.Table:
        key, code = t.column("key").to_numpy(), t.column("code").to_numpy()
        order = np.argsort(key, kind="stable")
        key, code = key[order], code[order].view(np.uint64)
        out, at, step = [np.zeros((0, 2), np.uint64)], np.arange(len(key)), 1
        while True:
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]
            if not len(at):
                break
            for lo in range(0, len(at), 1 << 20):
                i = at[lo:lo + (1 << 20)]
                x, y = code[i], code[i + step]
                near = (np.bitwise_count(x ^ y) <= MAX_BITS) & (x != y)
                pair = np.column_stack([x[near], y[near]])
                signed = pair.view(np.int64)
                pair = np.where((signed[:, :1] < signed[:, 1:]), pair, pair[:, ::-1])
                out.append(np.unique(pair, axis=0))
            step += 1
        pairs = np.unique(np.concatenate(out), axis=0).view(np.int64)
        return pa.table({"x": pa.array(pairs[:, 0]), "y": pa.array(pairs[:, 1])})

    return (codes.select("code").mapInArrow(keys, "task long, key long, code long")
            .groupBy("task").applyInArrow(meet, "x long, y long").distinct())


def _compare(a_id, a_n, a, b_id, b_n, b, same: bool):
    """Links between two blocks (or inside one): vectors linked per class, and links to the least class reached."""
    norm = lambda x: np.sqrt((x * x).sum(1))                                        # noqa: E731
    linked = (a @ b.T) / (norm(a)[:, None] * norm(b)[None, :]) >= COSINE
    if same:
        np.fill_diagonal(linked, False)
        ids, adjacent = a_id, linked
        n = linked @ a_n
    else:
        ids = np.concatenate([a_id, b_id])
        adjacent = np.zeros((len(ids), len(ids)), bool)
        adjacent[:len(a_id), len(a_id):] = linked
        adjacent |= adjacent.T
        n = np.concatenate([linked @ b_n, linked.T @ a_n])
    has = np.flatnonzero(adjacent.any(1))
    ids, n, adjacent = ids[has], n[has], adjacent[np.ix_(has, has)]
    label = ids.copy()
    while len(ids):
        low = np.minimum(label, np.where(adjacent, label[None, :], np.iinfo(np.int64).max).min(1))
        if (low == label).all():
            break
        label = low
    return ids, n, label


def link(encoded: DataFrame, model: Quantiser, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(classes: (h1, h2, least, rep, size), links: (rep, n, reaches)) of the encoded vectors. ``least`` is the smallest
    id of a class; it names the class (``rep``) unless another class has the same one, as ids may repeat with different
    vectors: then the first by hash has it, and the others are named by their hash."""
    classes = encoded.groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"),
                                              F.min("code").alias("code"))
    leads = classes.groupBy("least").agg(F.min(F.struct("h1", "h2")).alias("lead"))
    name = F.when(F.struct("h1", "h2") == F.col("lead"), F.col("least")).otherwise(F.xxhash64("h1", "h2", "least"))
    classes = cut(classes.join(leads, "least").select("h1", "h2", "least", name.alias("rep"), "size", "code"))
    reps = cut(encoded.join(classes.select("h1", "h2", "least", "rep", "size"), ["h1", "h2"]).where("vec_id = least")
               .dropDuplicates(["h1", "h2"]).select("rep", "size", "code", "vector"))
    codes = cut(reps.groupBy("code").agg(F.count("*").alias("n"))
                .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    reps = (reps.join(codes.select("code", "blocks"), "code")
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks"))
    pairs = close_codes(codes, model.bits, tasks)
    left = codes.select(F.col("code").alias("x"), F.col("blocks").alias("bx"))
    right = codes.select(F.col("code").alias("y"), F.col("blocks").alias("by"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)                              # noqa: E731
    work = (pairs.join(left, "x").join(right, "y")
            .withColumn("i", F.explode(every("bx"))).withColumn("j", F.explode(every("by"))).select("x", "i", "y", "j"))
    inside = (codes.where("n > 1").withColumn("i", F.explode(every("blocks")))
              .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)))
              .select(F.col("code").alias("x"), "i", F.col("code").alias("y"), "j"))
    work = cut(work.unionByName(inside).withColumn("job", F.xxhash64("x", "i", "y", "j")))
    first = work.select("job", F.lit(0).alias("side"), F.col("x").alias("code"), F.col("i").alias("block"))
    second = (work.where("x != y OR i != j")
              .select("job", F.lit(1).alias("side"), F.col("y").alias("code"), F.col("j").alias("block")))
    # a group is a few block pairs: their number follows the number of vectors shipped
    groups = max(tasks, -(-work.count() // 32))
    shipped = (first.unionByName(second).join(reps, ["code", "block"])
               .withColumn("task", F.pmod("job", F.lit(groups))))

    def run(t: pa.Table) -> pa.Table:
        job, side = t.column("job").to_numpy(), t.column("side").to_numpy()
        rep, size = t.column("rep").to_numpy(), t.column("size").to_numpy()
        x = np.frombuffer(K.text_buffer(t.column("vector"))[0].tobytes()).reshape(len(job), -1)
        order = np.lexsort((side, job))
        cuts = np.flatnonzero(np.concatenate(([True], job[order][1:] != job[order][:-1], [True])))
        out = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[lo:hi]
            a, b = at[side[at] == 0], at[side[at] == 1]
            if len(b) or len(a) > 1:
                other = b if len(b) else a
                out.append(_compare(rep[a], size[a], x[a], rep[other], size[other], x[other], not len(b)))
        ids, n, label = (np.concatenate(c) if out else np.zeros(0, np.int64)
                         for c in (zip(*out, strict=True) if out else ((), (), ())))
        return pa.table({"rep": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()),
                         "reaches": pa.array(label, pa.int64())})

    links = cut(shipped.select("task", "job", "side", "rep", "size", "vector").groupBy("task")
                .applyInArrow(run, "rep long, n long, reaches long"))
    return classes, links


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    tasks = parts_for(vectors, 4)
    length = F.when(F.col("vec_id").isNotNull(), F.greatest(F.size("embedding"), F.lit(0)))
    shared = [r["n"] for r in vectors.groupBy(length.alias("n")).count().where("n > 0 AND count > 1").orderBy("n").collect()]
    alone = vectors.where(~F.coalesce(length.isin(shared), F.lit(False))) if shared else vectors
    out = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                       F.col("vec_id").isNotNull().alias("kept"))
    for n in shared:
        out = out.unionByName(_of_one_length(vectors.where(length == n), tasks))
    return out


def _of_one_length(vectors: DataFrame, tasks: int) -> DataFrame:
    model = fit(vectors)
    encoded = cut(encode(vectors, model))
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    classes, links = link(encoded.where(usable), model, tasks)
    found = components(links.select(F.col("rep").alias("a"), F.col("reaches").alias("b")).where("a != b"))
    members = found.join(classes.select(F.col("rep").alias("node"), "least"), "node")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    found = members.join(smallest, "component").select("node", "component_id")
    counted = links.groupBy("rep").agg(F.sum("n").alias("n"))
    judged = (classes.join(counted, "rep", "left").join(found, classes["rep"] == found["node"], "left")
              .select("h1", "h2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                      F.coalesce("component_id", "least").alias("component_id")))
    linked = (encoded.where(usable).select("vec_id", "h1", "h2").join(judged, ["h1", "h2"])
              .select("vec_id", "n_links", "component_id"))
    alone = encoded.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
