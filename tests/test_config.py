import pytest

from quayside.config import get_settings


def test_settings_per_environment(spark):
    dev = get_settings(spark, "dev", root="/data/x")
    prod = get_settings(spark, "prod", root="/data/x")
    assert dev.table("silver", "orders") == "marketplace_silver.orders"
    assert prod.database("gold") == "marketplace_prod_gold" and prod.log_level == "WARNING"
    assert dev.landing_path == "/data/x/landing"
    assert get_settings(spark, "staging").tables_path.endswith("/tables")
    with pytest.raises(ValueError):
        get_settings(spark, "qa")
    with pytest.raises(ValueError):
        dev.database("platinum")
