import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text) as a table in several partitions, with clashing extra columns."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            for c in ("id", "sig", "n", "c", "digest", "keep_id", "component_id", "pos", "score", "near", "bucket", "rank"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df.repartition(3) if rows else df
    return make


@pytest.fixture(scope="session")
def corpus():
    """Small texts with copies, near copies, shared passages, nulls, empty and long texts and repeated rows."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Äpfel", "naïve", "日本", "don't", "x-y", "A", "a"]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    rows, i = [], 0

    def add(t):
        nonlocal i
        rows.append((i, t))
        i += rnd.choice([1, 1, 3])

    shared = text(70)
    for _ in range(25):
        add(text(rnd.randrange(1, 180)))
    for _ in range(6):
        add(text(30) + "\n" + shared + "  " + text(rnd.randrange(0, 40)))
    base = text(120).split(" ")
    for _ in range(14):  # near copies, one to four words changed
        t = list(base)
        for _ in range(rnd.randrange(1, 5)):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        add(" ".join(t))
    for _ in range(8):
        add(rows[3][1])
    add(rows[4][1].replace(" ", "\t \n"))
    add(rows[5][1].upper())
    for t in (None, None, "", " ", "\n\t", "one", "one two three", "one two three four", shared, text(3000)):
        add(t)
    rows += [rows[2], rows[2], (None, rows[0][1]), (None, None), (None, shared)]
    rnd.shuffle(rows)
    return rows
