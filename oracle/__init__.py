"""Independent SQL statement of every registered query, for DuckDB.

Used only to check the Spark results: the driver tables are pre-registered as
views; each query is one ``WITH ... SELECT`` over them.
"""

from oracle.sql import ORACLE_SQL as _CORE
from oracle.sql_ops import OPS_SQL

from quayside.plans.present import NULLABLE_OUTPUT


def _typed(name: str, sql: str) -> str:
    spec = NULLABLE_OUTPUT.get(name, {})
    rep = ([f"CAST({c} AS DOUBLE) AS {c}" for c in spec.get("double", [])]
           + [f"CAST({c} AS VARCHAR) AS {c}" for c in spec.get("text", [])])
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM ({sql}) t" if rep else sql


# the same rows from another layout
_SAME = {"fact_bucketed": _CORE["fact_orders"]}

ORACLE_SQL = {name: _typed(name, sql) for name, sql in {**_CORE, **OPS_SQL, **_SAME}.items()}
