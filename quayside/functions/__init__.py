"""Column helpers built from ``pyspark.sql.functions``."""

from quayside.functions.columns import (  # noqa: F401
    avg_rounded,
    bucket,
    clamp_negative,
    count_where,
    exact_avg,
    flag,
    money,
    money_avg,
    money_sum,
    null_safe_row_hash,
    nullify_outside,
    pct,
    row_hash,
    safe_pct,
    standardize,
    standardize_text_columns,
    surrogate_key,
)
