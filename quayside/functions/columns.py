"""Column-expression helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` only, so it stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Money is summed as decimal(18,2): exact, so the result does not depend on
# partitioning or task order (a double sum does).
MONEY = "decimal(18,2)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(c: ColumnOrName, rules: Sequence[tuple], otherwise: str) -> Column:
    """CASE bucketing, first matching rule wins, NULL falls through to ``otherwise``.

    ``rules`` is a list of ``(op, bound, label)`` with op in ``>=``, ``<=``,
    ``>``, ``<``, ``==`` or ``between`` (bound is then ``(lo, hi)``, inclusive).
    """
    c = _c(c)
    expr = None
    for op, bound, label in rules:
        if op == ">=":
            cond = c >= bound
        elif op == "<=":
            cond = c <= bound
        elif op == ">":
            cond = c > bound
        elif op == "<":
            cond = c < bound
        elif op == "==":
            cond = c == bound
        elif op == "between":
            cond = c.between(bound[0], bound[1])
        else:
            raise ValueError(f"unknown bucket operator {op!r}")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def flag(cond: Column) -> Column:
    """Boolean flag from a condition; NULL counts as False."""
    return F.coalesce(cond, F.lit(False))


def safe_pct(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """``round(num / den * 100, scale)`` where a zero or NULL denominator becomes 1."""
    den = _c(den)
    return F.round(_c(num) / F.when(den > 0, den).otherwise(F.lit(1)) * 100, scale)


def pct(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """Unguarded ``round(num / den * 100, scale)``; division by zero gives NULL."""
    return F.round(F.try_divide(_c(num), _c(den)) * 100, scale)


def clamp_negative(c: ColumnOrName) -> Column:
    """Negative values become 0.0; NULL stays NULL (``greatest`` would differ)."""
    c = _c(c)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def nullify_outside(c: ColumnOrName, lo, hi) -> Column:
    """Keep values in ``[lo, hi]``, NULL otherwise (type is kept)."""
    c = _c(c)
    return F.when(c.between(lo, hi), c)


def standardize(c: ColumnOrName) -> Column:
    """Trim spaces and title-case each word."""
    return F.initcap(F.trim(_c(c)))


def standardize_text_columns(df, columns: Iterable[str]):
    """Apply :func:`standardize` to several columns in one projection."""
    return df.withColumns({c: standardize(c) for c in columns})


def surrogate_key(prefix: str, index: ColumnOrName) -> Column:
    """``PREFIX_`` + the first 8 hex digits of MD5 of ``prefix_index``.

    A display id only, never a join or dedup key: 32 bits collide from about
    10**5 ids on (2 pairs in 150,000)."""
    raw = F.concat(F.lit(prefix + "_"), _c(index).cast("string"))
    return F.concat(F.lit(prefix.upper() + "_"), F.substring(F.md5(raw), 1, 8))


def row_hash(cols: Sequence[ColumnOrName], sep: str = "||") -> Column:
    """SHA-256 of the columns joined by ``sep`` (``concat_ws`` skips NULLs)."""
    return F.sha2(F.concat_ws(sep, *[_c(c) for c in cols]), 256)


def null_safe_row_hash(cols: Sequence[ColumnOrName]) -> Column:
    """Row hash over length-prefixed fields (``-`` for NULL), so no two different rows
    share their hashed text: (a,NULL,b) != (a,b,NULL) and ('x||y','z') != ('x','y||z')."""
    def field(c: ColumnOrName) -> Column:
        t = _c(c).cast("string")
        return F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
    return F.sha2(F.concat_ws(",", *[field(c) for c in cols]), 256)


def money(c: ColumnOrName) -> Column:
    return _c(c).cast(MONEY)


def money_sum(c: ColumnOrName) -> Column:
    """Exact sum of a 2-decimal money column, returned as double."""
    return F.sum(money(c)).cast("double")


def exact_avg(c: ColumnOrName, in_scale: int, out_scale: int) -> Column:
    """Average of values that carry ``in_scale`` decimals, summed exactly as
    decimals, rounded half-up to ``out_scale``, returned as double."""
    total = F.sum(_c(c).cast(f"decimal(20,{in_scale})"))
    return F.round(F.try_divide(total, F.count(_c(c))), out_scale).cast("double")


def money_avg(c: ColumnOrName, scale: int = 2) -> Column:
    """Average of a money column computed exactly, rounded half-up, as double."""
    return exact_avg(c, 2, scale)


def avg_rounded(c: ColumnOrName, scale: int) -> Column:
    """Average of integers or already-rounded values, rounded half-up."""
    return F.round(F.avg(_c(c)), scale)


def count_where(cond: Column) -> Column:
    """Conditional count; 0 (not NULL) for groups that have rows."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def measured(df, keys: Sequence[str], measures: Sequence[Column], distinct: dict[str, str] | None = None):
    """``df`` grouped by ``keys`` with ``measures`` and exact distinct counts
    (output name -> column; NULLs don't count).

    Each distinct count is its own two-step aggregate (distinct pairs, then a count)
    joined back on the keys, so the rows are never expanded once per distinct column.
    """
    out = df.groupBy(*keys).agg(*measures)
    for name, column in (distinct or {}).items():
        marks = {k: f"_k{i}" for i, k in enumerate(keys)}
        per = (df.where(F.col(column).isNotNull()).select(*[F.col(k).alias(v) for k, v in marks.items()], column).distinct()
               .groupBy(*marks.values()).agg(F.count(F.lit(1)).alias(name)))
        same = F.lit(True)
        for k, v in marks.items():
            same = same & F.col(k).eqNullSafe(F.col(v))
        out = out.join(per, same, "left").drop(*marks.values()).withColumn(name, F.coalesce(name, F.lit(0)))
    return out
