"""Global ranks (row_number, rank, dense_rank, percent_rank, ntile) without a
single-partition window.

A window with an ``orderBy`` and no ``partitionBy`` moves every row into one
task. ``global_ranks`` instead

1. takes the rows with the smallest key hashes as a sample (a fixed number of rows,
   and the same rows however the input is laid out or retried) and cuts the
   sorted sample into buckets;
2. finds each row's bucket by binary search in the cut points and ranks inside the
   bucket with a window partitioned by bucket;
3. aggregates per-bucket counts and boundary rows (one row per bucket), turns
   them into offsets with a window over that small table and broadcasts them
   back (``buckets`` rows).

There is one path for every input size and every orderable type: rows are compared
by Spark's own ordering (NULL placement, NaN, dates, text). Nothing runs before
the caller's action. ``buckets`` sets the parallelism, by default four times
``spark.sql.shuffle.partitions``; the window spills like any other.

The sort key always ends with a unique tie-break, so a hot key value (on a third of the
rows) is split over many buckets like any other rows; rank and dense_rank of a
tie group that crosses bucket borders are repaired from the boundary rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_BUCKET = 16

@dataclass(frozen=True)
class SortKey:
    column: str
    ascending: bool = True
    nulls_last: bool = False  # Spark default for ascending order

    @staticmethod
    def asc(c: str, nulls_last: bool = False) -> "SortKey":
        return SortKey(c, True, nulls_last)

    @staticmethod
    def desc(c: str, nulls_last: bool = True) -> "SortKey":
        return SortKey(c, False, nulls_last)


KINDS = ("row_number", "rank", "dense_rank", "percent_rank", "ntile")


def _window_order(keys: Sequence[SortKey], tie: Sequence[str]) -> list[Column]:
    out = []
    for k in keys:
        c = F.col(k.column)
        if k.ascending:
            out.append(c.asc_nulls_last() if k.nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if k.nulls_last else c.desc_nulls_first())
    return out + [F.col(t).asc() for t in tie]


def _side(col: Column, key: SortKey) -> Column:
    """A struct that compares ascending like the column with its NULL placement
    (for descending keys the comparison is turned round)."""
    nulls_high = key.nulls_last == key.ascending
    return F.struct(col.isNull() if nulls_high else col.isNotNull(), col)


def _cuts(df: DataFrame, keys: Sequence[SortKey], order: list[Column], buckets: int) -> DataFrame:
    """One row: the sorted cut points, at most ``buckets``, as an array of structs."""
    cols = [_side(F.col(k.column), k).alias(f"k{i}") for i, k in enumerate(keys)]
    sample = (df.select(*[k.column for k in keys], F.xxhash64(*[k.column for k in keys]).alias("_rank_hash"))
              .orderBy("_rank_hash", *order).limit(buckets * SAMPLE_PER_BUCKET))
    picked = (sample.withColumn("_n", F.row_number().over(Window.orderBy(*order)))
              .where(F.col("_n") % SAMPLE_PER_BUCKET == 0))
    return picked.agg(F.array_sort(F.collect_list(F.struct("_n", *cols))).alias("cuts"))


def _with_bucket(df: DataFrame, cuts: DataFrame, keys: Sequence[SortKey], buckets: int) -> DataFrame:
    """``df`` with ``_b``, the number of cut points at or before the row, by binary search.
    What is compared is made once a row and once a cut point, not in every step."""
    steps = [1 << i for i in reversed(range(buckets.bit_length()))] or [1]
    mine = {f"_me{i}": _side(F.col(k.column), k) for i, k in enumerate(keys)}
    out = df.withColumn("_cuts", cuts.scalar()).withColumns(mine)

    def step(acc: Column, width: Column) -> Column:
        cut = F.get("_cuts", acc + width - 1)
        before = F.lit(False)
        for i, k in reversed(list(enumerate(keys))):
            me, at = F.col(f"_me{i}"), cut.getField(f"k{i}")
            before = ((me < at) if k.ascending else (at < me)) | ((me == at) & before)
        return F.when((acc + width <= F.size("_cuts")) & ~before, acc + width).otherwise(acc)

    # never NULL: no filter tries the search a second time
    found = F.coalesce(F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), step), F.lit(0))
    return out.withColumn("_b", found).drop("_cuts", *mine)


def global_ranks(
    df: DataFrame,
    keys: Sequence[SortKey],
    tie: Sequence[str],
    outputs: dict[str, tuple],
    *,
    buckets: int | None = None,
) -> DataFrame:
    """Add rank columns over the whole of ``df`` ordered by ``keys`` then ``tie``.

    ``outputs`` maps a column name to ``("row_number",)``, ``("rank",)``,
    ``("dense_rank",)``, ``("percent_rank",)`` or ``("ntile", n)``. ``tie`` must
    make the order total; rank, dense_rank and percent_rank look at ``keys`` only.
    The input is read three times (sample, boundaries, rows): pass a narrow frame.
    """
    for kind, *_ in outputs.values():
        if kind not in KINDS:
            raise ValueError(kind)
    if buckets is None:
        buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    all_keys = [*keys, *[SortKey.asc(t) for t in tie]]
    order, peers = _window_order(keys, tie), _window_order(keys, [])
    cuts = _cuts(df, all_keys, order, buckets)
    work = _with_bucket(df, cuts, all_keys, buckets)

    in_bucket = Window.partitionBy("_b").orderBy(*order)
    peers_in_bucket = Window.partitionBy("_b").orderBy(*peers)
    work = work.withColumns({
        "_lrn": F.row_number().over(in_bucket),
        "_lrk": F.rank().over(peers_in_bucket),
        "_ldr": F.dense_rank().over(peers_in_bucket),
        "_peer": F.struct(*[k.column for k in keys]),
    })

    stats = work.groupBy("_b").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by("_peer", "_lrn").alias("_pmin"),
        F.max_by("_peer", "_lrn").alias("_pmax"),
        F.max("_ldr").alias("_nd"),
        (F.count(F.lit(1)) - F.max("_lrk") + 1).alias("_nlast"),
    )
    # One row per bucket: a window over this table is small by construction.
    ob = Window.orderBy("_b")
    before = ob.rowsBetween(Window.unboundedPreceding, -1)
    same_prev = F.coalesce(F.lag("_pmax").over(ob) == F.col("_pmin"), F.lit(False))
    stats = stats.withColumns({
        "_row_off": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_total": F.sum("_n").over(Window.partitionBy()),
        "_same_prev": same_prev,
        "_cum_last": F.sum("_nlast").over(
            Window.partitionBy("_pmax").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)),
    })
    stats = stats.withColumns({
        "_carry": F.when(F.col("_same_prev"), F.lag("_cum_last").over(ob)).otherwise(F.lit(0)),
        "_new_d": F.col("_nd") - F.col("_same_prev").cast("int"),
    })
    stats = stats.withColumn("_dense_off", F.coalesce(F.sum("_new_d").over(before), F.lit(0)))
    stats = stats.select("_b", "_row_off", "_total", "_same_prev", "_carry", "_dense_off")

    out = work.join(F.broadcast(stats), "_b")
    rn = F.col("_row_off") + F.col("_lrn")
    rk = F.col("_row_off") + F.col("_lrk") - F.when(F.col("_ldr") == 1, F.col("_carry")).otherwise(F.lit(0))
    dr = F.col("_dense_off") + F.col("_ldr") - F.col("_same_prev").cast("int")
    total = F.col("_total")
    cols = {}
    for name, (kind, *arg) in outputs.items():
        if kind == "row_number":
            cols[name] = rn
        elif kind == "rank":
            cols[name] = rk
        elif kind == "dense_rank":
            cols[name] = dr
        elif kind == "percent_rank":
            cols[name] = F.when(total > 1, (rk - 1).cast("double") / (total - 1)).otherwise(F.lit(0.0))
        else:
            cols[name] = ntile_from_row_number(rn, total, arg[0])
    cols = {n: c.cast("double" if outputs[n][0] == "percent_rank" else "bigint") for n, c in cols.items()}
    return out.withColumns(cols).drop("_b", "_lrn", "_lrk", "_ldr", "_peer", "_row_off", "_total",
                                      "_same_prev", "_carry", "_dense_off")


def ntile_from_row_number(rn: Column, total: Column, n: int) -> Column:
    """Spark's ``ntile(n)`` from a 1-based global row number and the row count:
    the first ``total mod n`` tiles get one extra row."""
    q = F.floor(total / n)
    m = total - q * n
    big = m * (q + 1)
    return F.when(rn <= big, F.ceil(rn / (q + 1))).otherwise(m + F.ceil((rn - big) / q)).cast("bigint")


def histogram_ranks(
    df: DataFrame,
    key: str,
    within: str,
    *,
    low: float,
    high: float,
    decimals: int,
    city_rank: str,
    overall_rank: str,
    overall_pct: str,
) -> DataFrame:
    """Dense rank of ``key`` (largest first) within ``within``, and its dense and percent
    rank over everything, for a key rounded to ``decimals`` within ``low``..``high``.

    One histogram (one row per group and distinct value) carries all windows; the
    overall histogram is its sum. The domain bounds the overall window's rows to
    ``(high - low) * 10**decimals + 2``; a value outside it raises. The ranks join
    back once, null-safe, so a hot group is never sorted whole. NULL keys sort last.
    """
    value = F.col(key)
    inside = value.isNull() | (value.between(low, high) & (F.round(value, decimals) == value))
    checked = F.when(inside, value).otherwise(F.raise_error(F.concat(F.lit(f"{key} outside its domain: "), value.cast("string"))))
    hist = df.groupBy(F.col(within).alias("_g"), checked.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    best = F.col("_v").desc_nulls_last()
    total = hist.groupBy("_v").agg(F.sum("_n").alias("_n"))
    everything = Window.orderBy(best)
    before = F.coalesce(F.sum("_n").over(everything.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = F.sum("_n").over(Window.partitionBy())
    overall = total.select(
        F.col("_v").alias("_ov"), F.dense_rank().over(everything).cast("bigint").alias(overall_rank),
        F.when(rows > 1, before.cast("double") / (rows - 1)).otherwise(F.lit(0.0)).alias(overall_pct))
    ranks = (hist.withColumn(city_rank, F.dense_rank().over(Window.partitionBy("_g").orderBy(best)).cast("bigint"))
             .join(overall, F.col("_v").eqNullSafe(F.col("_ov"))).drop("_n", "_ov"))
    return (df.join(ranks, df[within].eqNullSafe(ranks["_g"]) & df[key].cast("double").eqNullSafe(ranks["_v"]), "left")
            .drop("_g", "_v"))
