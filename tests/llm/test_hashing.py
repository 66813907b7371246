"""Word hashes on mirrored patterns, and packages read by several tasks."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.llm.jaccard_join import jaccard_components
from quayside.llm.substring_dedup import substring_dedup
from quayside.llm.warc_zip import read_packages, write_packages


def mirrored(steps):
    """A Thue-Morse word and its mirror: polynomials modulo powers of two agree on them."""
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


def test_hashes_of_mirrored_words_and_of_long_words_differ():
    a, b = (x.encode() for x in mirrored(12))
    words = [a, b, a[:-1] + b"c", a + b"a", a[::-1] + b"x", b"q" * 64, b"q" * 65, b"q" * 63 + b"r"]
    for base in (U.BASE_A, U.BASE_B):
        text = b" ".join(words + words)
        h, rows = U.word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]), base=base)
        assert rows.tolist() == [0, 16] and len(set(h.tolist())) == 8 and h[:8].tolist() == h[8:].tolist()


def test_window_hashes_of_mirrored_sequences_differ():
    a, b = (np.frombuffer(x.encode(), np.uint8).astype(np.uint64) for x in mirrored(11))
    for size in (2, 5, 50, 2048):
        x, y = (U.window_hashes(v, size) for v in (a, b))
        by = {}
        for v, h in ((a, x), (b, y)):
            for p, k in enumerate(h.tolist()):
                by.setdefault(k, set()).add(v[p:p + size].tobytes())
        assert all(len(v) == 1 for v in by.values()) and len(x) == len(a) - size + 1


def test_texts_that_differ_in_one_mirrored_word(spark, frame):
    a, b = mirrored(10)
    rest = [f"w{i}" for i in range(59)]
    rows = [(i, " ".join([*rest[:30], word, *rest[30:]])) for i, word in ((1, a), (2, b), (3, a))]
    got = {r.doc_id: r.n_removed for r in substring_dedup(spark, frame(rows), window=50).collect()}
    assert got == {1: 0, 2: 0, 3: 60}
    linked = {r.doc_id: r.component_id for r in jaccard_components(spark, frame(rows), k=4, num=100, den=100).collect()}
    assert linked == {1: 1, 2: 2, 3: 1}


def test_packages_are_read_by_several_tasks(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.concat(F.repeat(F.lit("x"), 500), F.col("id").cast("string")).alias("html"))
    manifest = write_packages(spark, pages, U.Scratch(spark, "t"), package_bytes=4000)
    assert manifest.count() > 16

    def task(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()] * b.num_rows})

    tasks = read_packages(manifest, payloads=False).mapInArrow(task, "task bigint")
    assert tasks.count() == 400 and tasks.distinct().count() > 8
