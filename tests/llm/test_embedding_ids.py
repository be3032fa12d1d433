"""Links and components of vectors whose ids repeat, against plain numpy."""

import numpy as np

from docspark.llm import embeddings


def expected(rows, threshold=0.95):
    ok = [i for i, (k, v) in enumerate(rows) if k is not None and v is not None and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i][1] for i in ok], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array([rows[i][0] for i in ok])
    while True:
        low = np.minimum(label, np.where(near, label[None, :], 1 << 60).min(1))
        if (low == label).all():
            break
        label = low
    found = {i: (int(n), int(c)) for i, n, c in zip(ok, near.sum(1), label)}
    return sorted(((k, *found.get(i, (0, k))) for i, (k, _) in enumerate(rows)), key=str)


def test_repeated_ids_with_different_vectors(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 48))
    rows = [(1, a), (1, b), (2, b + 0.01 * rng.normal(size=48)), (3, a + 0.01 * rng.normal(size=48))]
    centres = rng.normal(size=(12, 48))
    rows += [(10 + int(rng.integers(60)), centres[i % 12] + 0.02 * rng.normal(size=48)) for i in range(150)]
    rows += [(200 + i, rng.normal(size=48)) for i in range(40)] + [(5, a), (5, a), (7, None), (None, a)]
    data = [(k, None if v is None else [float(f) for f in np.float32(v)]) for k, v in rows]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4)
    got = embeddings.near_duplicates(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == expected(data)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
