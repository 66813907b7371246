"""Run the four layers over a directory of driver tables.

    python -m quayside --sf-dir /root/testdata/sf0.01 [--as-of 2002-01-01] [--root PATH]

Tables are written under ``--root`` (default: a folder under the session's
``spark.checkpoint.dir``); the quality report, the layer counts and the
headline KPIs are printed. Tables are registered in the environment's layer databases.
"""

from __future__ import annotations

import argparse
import uuid

from quayside.plans import pipeline as P
from quayside.config import get_settings
from quayside.session import current_session, scratch_path


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="quayside")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--as-of", default=None, help="report date used for recency and load times")
    ap.add_argument("--root", default=None)
    ap.add_argument("--env", default="dev", help="environment whose layer databases hold the tables")
    args = ap.parse_args(argv)
    spark = current_session()
    root = args.root or scratch_path(spark, "run", uuid.uuid4().hex)
    run = P.Run(spark, root, args.as_of, settings=get_settings(spark, args.env, root=root))
    silver = P.run_silver(run, P.tpch_bronze(run, args.sf_dir))
    gold = P.run_gold(run, silver)
    P.silver_quality_report(run).show(truncate=False)
    P.layer_counts(spark, run.tables).show(50, truncate=False)
    P.dashboard_queries(gold)["headline_kpis"].show(truncate=False)
    print(f"tables written under {run.root}; registered as {run.settings.namespace}_<layer>.<table>")


if __name__ == "__main__":
    main()
