"""Shared helpers: written tables in the shared folder, vectorised word scans.

``Scratch`` writes intermediate tables under the folder the cluster names in
``spark.checkpoint.dir``: a written table cuts the lineage, so a lost executor
repeats one step at most, and every executor sees the same rows.

The word functions work on the Arrow buffers of a whole batch of texts: words
are found with one table look-up per byte, and a word's hash is the sum of one random
number per (byte, place in the word), taken from prefix sums, so there is no Python
loop per word. Hashes of consecutive words are mixes of pairs of hashes at doubled
lengths. Neither is a polynomial, whose values agree on mirrored patterns.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

U64 = np.uint64
# Word separators: U+0020 and U+0009 to U+000D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd bases (5 modulo 8, so differences of their powers keep few factors of two).
BASE_A = 0x9E3779B97F4A7C15
BASE_B = 0xD1342543DE82EF95
CHUNK_BYTES = 1 << 18
#: Rows of small columns that a file of a written table holds at least, and the least number of files.
FILE_ROWS, FILES = 1 << 15, 16
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (in a local
    session or on shared storage; a cluster that installs it needs nothing)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


class Scratch:
    """A private folder under the shared checkpoint folder for one operator call.
    ``conf``: session settings that hold while its tables are written."""

    def __init__(self, spark: SparkSession, name: str, conf: dict[str, str] | None = None):
        reach_workers(spark)
        self.spark = spark
        self.conf = {SHUFFLE_CLEANUP: "true", **(conf or {})}
        self.root = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, by: Sequence[str] = (), rows: int | None = None, **options: str) -> DataFrame:
        """Write ``df`` once, in folders by the columns ``by``, and return the table read
        back. Spark drops the shuffle files of the write as soon as the table is complete:
        nothing reads them again. ``rows``: about as many small rows are written, so as many
        files do (an executor starts processes for every file)."""
        if rows is not None:
            df = df.coalesce(max(FILES, -(-rows // FILE_ROWS)))
        conf = self.spark.conf
        before = {k: conf.get(k, None) for k in self.conf}
        try:
            for k, v in self.conf.items():
                conf.set(k, v)
            df.write.mode("overwrite").options(**options).partitionBy(*by).parquet(self.path(name))
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete written tables that nothing will read again."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def text_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column, without copying."""
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offs, data = arr.buffers()
    n = len(arr)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d, o


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes (a longer text is a range of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i below ``n`` (cached)."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, U64(b))
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        got = (out[0], out[1])
        if size <= 4 * CHUNK_BYTES:
            _POWERS[base] = got
    return got


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (in place)."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray,
               sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's first word index (n+1 values).
    ``sep`` marks the separator bytes.

    ``offsets`` index ``data``; only the bytes from offsets[0] to offsets[-1] are read.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    word = ~sep[part]
    edge = np.zeros(len(part) + 1, dtype=bool)
    edge[offsets - lo] = True
    first, last = word.copy(), word.copy()
    if len(part):
        first[1:] &= ~word[:-1] | edge[1:-1]
        last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first) + lo
    ends = np.flatnonzero(last) + lo + 1
    return starts, ends, np.searchsorted(starts, offsets)


PLACES = 64
_RANDOM: dict[int, np.ndarray] = {}


def _random(code: np.ndarray, base: int) -> np.ndarray:
    """The random number of each (place << 8 | byte)."""
    return mix(code.astype(U64) * U64(0xD6E8FEB86659FD93) + U64(base))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False, base: int = BASE_A,
                sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the rows, and each row's first word index."""
    starts, ends, rows = word_spans(data, offsets, sep)
    lo, hi = int(offsets[0]), int(offsets[-1])
    if base not in _RANDOM:
        _RANDOM[base] = _random(np.arange(PLACES << 8), base)
    place = np.zeros(hi - lo, np.int64)
    place[starts - lo] = starts - lo
    place = np.arange(hi - lo) - np.maximum.accumulate(place)
    code = place << 8
    code |= LOWER[data[lo:hi]] if lower else data[lo:hi]
    acc = np.zeros(hi - lo + 1, U64)
    vals = acc[1:]
    np.take(_RANDOM[base], code, mode="clip", out=vals)
    far = np.flatnonzero(place >= PLACES)
    vals[far] = _random(code[far], base)
    np.cumsum(vals, out=vals)
    return mix(acc[ends - lo] - acc[starts - lo]), rows


def window_hashes(h: np.ndarray, size: int, base: int = BASE_B) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (len(h) - size + 1 of them)."""
    if len(h) < size:
        return np.zeros(0, U64)
    f, n = h, 1
    while n < size:
        step = min(n, size - n)
        z = f[step:] * U64(base)
        z ^= z >> U64(32)
        z += f[:-step]
        f, n = mix(z), n + step
    return f


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def id_filter(ids: DataFrame, column: str, bits: int = 1 << 25, parts: int = 8) -> np.ndarray:
    """A Bloom filter (4 MB at the default size, whatever the number of ids) of a
    long column. It only thins a scan ahead of an exact join; a full filter lets
    more rows through and changes no result."""
    def build(batches):
        got = np.zeros(bits // 8, np.uint8)
        for b in batches:
            mark(got, b.column(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({"bits": pa.array([got.tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    for r in ids.select(F.col(column).cast("long").alias("id")).coalesce(parts).mapInArrow(build, "bits binary").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
    return out


def _slots(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(ids.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15))
    return [(h & U64(bits - 1)).astype(np.int64), ((h >> U64(32)) & U64(bits - 1)).astype(np.int64)]


def mark(filt: np.ndarray, ids: np.ndarray) -> None:
    for s in _slots(ids, len(filt) * 8):
        np.bitwise_or.at(filt, s >> 3, (1 << (s & 7)).astype(np.uint8))


def might_hold(filt: np.ndarray, ids: np.ndarray) -> np.ndarray:
    ok = np.ones(len(ids), bool)
    for s in _slots(ids, len(filt) * 8):
        ok &= (filt[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
    return ok


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """An Arrow list column from flat values and the length of each row."""
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


def blob_column(parts: list[bytes | None]) -> pa.Array:
    return pa.array(parts, pa.binary())


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
