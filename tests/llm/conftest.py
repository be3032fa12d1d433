import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars) rows: near and exact copies, shared passages, nulls, empty and long
    texts, repeated rows, null ids and null sources."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(120):
        text = prose(rng, rng.randint(1, 150))
        if i % 7 == 0:
            text += "\n" + passage + " " + prose(rng, 20)
        rows.append([i, text, "en", f"s{i % 4}", len(text)])
    for i in range(120, 150):
        base = rows[i % 10][1].split(" ")
        if i % 2 and len(base) > 40:
            base[20] = f"changed{i}"
        text = " ".join(base)
        rows.append([i, text, "en", "s0", len(text)])
    long = prose(rng, 20_000, 100_000)
    rows += [[150, None, None, None, None], [151, "", "en", "s1", 0], [152, " \t\n ", "en", None, 4],
             [153, long, "de", "s2", len(long)], [154, "Ünïcode\u00a0wörds ça\x0bva", "fr", "s3", 20],
             [155, "x" * 70_000, "en", "s3", 70_000], [156, "same same same " * 200, "en", "s1", 3000],
             [None, rows[0][1], "en", "s1", 1], [None, None, None, None, None]]
    rows += [list(rows[3]), list(rows[3])]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, docs):
    """The corpus with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = "size key before part block node sig component score rank held_out n h1 h2 _mix_size task".split()
    return docs.select("*", *[F.lit(7).alias(n) for n in names])
