"""Run settings per environment: layer databases and storage roots.

Spark's session catalog has two levels (database.table), so each layer of an
environment is one database, ``<namespace>_<layer>``. Storage roots default to
folders under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from quayside.session import scratch_path

# Environments and their namespace suffix and log level.
ENVIRONMENTS = {"dev": ("", "DEBUG"), "staging": ("_staging", "INFO"), "prod": ("_prod", "WARNING")}
LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Settings:
    env: str
    namespace: str
    landing_path: str
    tables_path: str
    checkpoint_path: str
    log_level: str

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; use one of {LAYERS}")
        return f"{self.namespace}_{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"


def get_settings(spark: SparkSession, env: str = "dev", base_namespace: str = "marketplace",
                 root: str | None = None) -> Settings:
    """Settings of ``env``; an unknown environment raises ``ValueError``."""
    if env not in ENVIRONMENTS:
        raise ValueError(f"unknown environment {env!r}; valid: {sorted(ENVIRONMENTS)}")
    suffix, level = ENVIRONMENTS[env]
    ns = f"{base_namespace}{suffix}"
    base = (root.rstrip("/") if root else scratch_path(spark, ns))
    return Settings(env, ns, f"{base}/landing", f"{base}/tables", f"{base}/checkpoints", level)
