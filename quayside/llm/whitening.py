"""Embedding whitening from an exact, bit-sliced scatter matrix.

Every entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``.

1. Scatter: each task takes blocks of rows, shifts every dimension by its least value
   in the block and cuts the rest into bit planes; a plane is packed across the rows,
   64 rows a word. The cross-product of two dimensions is the sum over their planes of
   ``2**(a + b)`` times the popcount of the AND of plane ``a`` and plane ``b``. The shift
   is added back in integers. Sums and cross-products leave the task as exact
   integers and Spark adds them up as decimals; they number dimensions squared,
   whatever the number of rows.
2. Model: ``n * sum(x_i x_j) - S_i S_j`` is formed in integers, so centring loses
   nothing, and divided by ``n * n`` once; ``eigh`` gives the components.
3. Whitening: ``n x - S`` is exact too; its projections over the root of the eigenvalue
   are written once, their covariance is measured on the written values, and every
   component becomes a row.

Defined results: vectors that are null, empty or hold null or non-finite entries take
no part; vectors of each length are fitted and whitened on their own; entries beyond
``2**62`` in steps of 1/64 count as that; a component whose eigenvalue is below
``RANK`` of the largest is zero to double precision (constant or dependent
dimensions, a single row) and has no rows; repeated rows count as often as they occur;
a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U

SCALE, SHIFT, LIMIT = 64, 1_000_000, float(1 << 62)
#: Rows of a block: its planes stay in the processor's cache.
BLOCK_ROWS = 1 << 14
#: Numbers of a slice of whitened rows.
SLICE = 1 << 20
RANK = 1e-11
WIDE = pa.decimal128(38, 0)


def by_length(column: pa.ListArray):
    """(length, rows, matrix of integers) of the vectors that take part, by length."""
    if not len(column):
        return
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64())
    value = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    ends = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(value))])
    ok = (size > 0) & (bad[ends] == bad[ends - size])
    for d in np.unique(size[ok]):
        rows = np.flatnonzero(ok & (size == d))
        for at in range(0, len(rows), max(1, SLICE // int(d))):
            part = rows[at:at + max(1, SLICE // int(d))]
            v = np.floor(value[(ends - size)[part][:, None] + np.arange(d)] * SCALE)
            yield int(d), part, np.clip(v, -LIMIT, LIMIT).astype(np.int64) + SHIFT


def cross_products(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Exact column sums and cross-products (Python integers) of a block of integers."""
    n, d = x.shape
    low = x.min(axis=0)
    rest = x - low
    bits = [int(m).bit_length() for m in rest.max(axis=0)]
    of = np.repeat(np.arange(d), bits)
    place = np.concatenate([np.arange(b) for b in bits]).astype(np.int64) if len(of) else np.zeros(0, np.int64)
    planes = np.zeros((len(of), -(-n // 64)), np.uint64)
    for p, (i, b) in enumerate(zip(of, place, strict=True)):
        packed = np.packbits((rest[:, i] >> b) & 1 == 1, bitorder="little")
        planes[p].view(np.uint8)[:len(packed)] = packed
    wide = 2 * max(bits, default=0) + 2 * max(bits, default=1).bit_length() + n.bit_length() > 62
    weight = np.array([1 << int(b) for b in place], object if wide else np.int64)
    got = np.zeros((d, d), object)
    ones = np.zeros(d, object)
    for p in range(len(of)):
        both = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
        ones[of[p]] += int(weight[p]) * int(both[0])
        # the planes before p have met p already, from their side
        row = np.zeros(d, object if wide else np.int64)
        np.add.at(row, of[p:], both * weight[p:])
        i = of[p]
        row = row.astype(object) * int(weight[p])
        own = int(weight[p]) ** 2 * int(both[0])
        got[i, :] += row
        got[:, i] += row
        got[i, i] -= own
    base = low.astype(object)
    got += np.outer(base, ones) + np.outer(ones, base) + n * np.outer(base, base)
    return [int(o) + n * int(b) for o, b in zip(ones, base, strict=True)], got


def _scatter(batches):
    """Arrow task: vectors to (length, i, j, value): n (i = j = -1), sums (j = -1) and cross-products."""
    held: dict[int, list[np.ndarray]] = {}
    total: dict[int, list] = {}

    def flush(d: int, least: int) -> None:
        x = np.concatenate(held[d])
        at = 0
        while len(x) - at >= max(least, 1):
            block = x[at:at + BLOCK_ROWS]
            s, q = cross_products(block)
            t = total.setdefault(d, [0, np.zeros(d, object), np.zeros((d, d), object)])
            t[0] += len(block)
            t[1] += np.array(s, object)
            t[2] += q
            at += len(block)
        held[d] = [x[at:]]

    for b in batches:
        for d, _, x in by_length(b.column(0)):
            held.setdefault(d, []).append(x)
            if sum(map(len, held[d])) >= BLOCK_ROWS:
                flush(d, BLOCK_ROWS)
    for d in held:
        flush(d, 1)
        n, s, q = total[d]
        i, j = np.triu_indices(d)
        where = (np.concatenate([[-1], np.arange(d), i]), np.concatenate([[-1], np.full(d, -1), j]))
        value = [n, *s.tolist(), *q[i, j].tolist()]
        for at in range(0, len(value), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(value[cut]), d), pa.int32()), pa.array(where[0][cut], pa.int32()),
                 pa.array(where[1][cut], pa.int32()), pa.array([Decimal(v) for v in value[cut]], WIDE)],
                names=["d", "i", "j", "v"])


class Model:
    """Whitening of the vectors of one length."""

    def __init__(self, d: int, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int):
        self.n, self.sums = n, sums
        v = np.zeros((d, d))
        for (i, j), q in products.items():
            v[i, j] = v[j, i] = (n * q - sums[i] * sums[j]) / (n * n)  # integers up to the one division
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        keep = int((e[:most] > max(e[0], 0) * RANK).sum())
        trace = float(np.trace(v))
        self.explained = [float(x) / trace for x in e[:keep]]
        self.project = u[:, :keep] / np.sqrt(e[:keep])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: 64-bit integers where they fit, else Python's."""
        most = max(abs(int(x.max())), abs(int(x.min())))
        if self.n * most + max(map(abs, self.sums)) < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> tuple[list[int] | np.ndarray, np.ndarray]:
        """Deviation and whitened values of every row."""
        c = self.centred(x)
        most = max(abs(int(c.max())), abs(int(c.min())))
        if c.dtype == object or most * most * c.shape[1] >= 1 << 62:
            c = c.astype(object)
        return (c * c).sum(axis=1), (c.astype(np.float64) / self.n) @ self.project


def _whiten(models: dict[int, Model]):
    """Arrow task: (vec_id, embedding) to (vec_id, d, deviation, values)."""
    def run(batches):
        for b in batches:
            for d, rows, x in by_length(b.column(1)):
                dev, values = models[d].rows(x)
                dev = pa.array([Decimal(int(v)) for v in dev], WIDE) if dev.dtype == object else pa.array(dev).cast(WIDE)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), d), pa.int32()), dev,
                     U.list_column(values.ravel(), np.full(len(rows), values.shape[1]), pa.float64())],
                    names=["vec_id", "d", "deviation", "whitened"])
    return run


def _products(batches):
    """Arrow task: (d, whitened) to (d, i, j, value): sums (j = -1) and cross-products."""
    got: dict[int, list[np.ndarray]] = {}
    for b in batches:
        kinds = b.column(0).to_numpy()
        for d in np.unique(kinds):
            w = b.column(1).filter(pa.array(kinds == d))
            x = w.flatten().to_numpy()
            x = x.reshape(len(w), len(x) // len(w))
            t = got.setdefault(int(d), [np.zeros(x.shape[1]), np.zeros((x.shape[1], x.shape[1]))])
            t[0] += x.sum(axis=0)
            t[1] += x.T @ x
    for d, (s, q) in got.items():
        k = len(s)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k + len(i), d), pa.int32()), pa.array(np.concatenate([np.arange(k), i]), pa.int32()),
             pa.array(np.concatenate([np.full(k, -1), j]), pa.int32()), pa.array(np.concatenate([s, q[i, j]]))],
            names=["d", "i", "j", "v"])


def _by_length_sums(df: DataFrame) -> dict[int, dict[tuple[int, int], object]]:
    """Sums of (d, i, j, v): at most dimensions squared numbers per vector length."""
    out: dict[int, dict[tuple[int, int], object]] = {}
    for r in df.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        out.setdefault(r.d, {})[r.i, r.j] = r.v
    return out


def fit_whitening(vectors: DataFrame, most: int = 32) -> dict[int, Model]:
    """The model of every vector length in column ``embedding``."""
    out = {}
    got = _by_length_sums(vectors.select("embedding").mapInArrow(_scatter, "d int, i int, j int, v decimal(38,0)"))
    for d, v in got.items():
        v = {k: int(x) for k, x in v.items()}
        n = v.pop((-1, -1))
        out[d] = Model(d, n, [v.pop((i, -1)) for i in range(d)], v, most)
    return out


def whiten(spark: SparkSession, vectors: DataFrame, most: int = 32, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation decimal(38,0),
    whitened, explained, identity_error``."""
    s = U.Scratch(spark, "whitening")
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    models = fit_whitening(src, most)
    rows = s.save(src.mapInArrow(_whiten(models), "vec_id bigint, d int, deviation decimal(38,0), whitened array<double>"), "rows")
    errors = {}
    for d, v in _by_length_sums(rows.select("d", "whitened").mapInArrow(_products, "d int, i int, j int, v double")).items():
        n = models[d].n
        errors[d] = max((abs(q / n - v[i, -1] / n * v[j, -1] / n - (i == j)) for (i, j), q in v.items() if j >= 0), default=0.0)
    facts = [(d, m.n, m.explained, float(errors.get(d, 0.0))) for d, m in models.items()]
    known = spark.createDataFrame(facts, "d int, n bigint, parts array<double>, identity_error double")
    # one row per vector length
    out = rows.select("vec_id", "d", "deviation", F.posexplode("whitened").alias("k", "whitened")).join(F.broadcast(known), "d")
    return out.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened",
                      F.element_at("parts", F.col("k") + 1).alias("explained"), "identity_error")
