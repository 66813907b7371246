"""What moves and what is worked out once, so that cost grows no faster than the input."""

from pyspark.sql import functions as F

from quayside.operators.ranks import SortKey, global_ranks
from quayside.plans import silver as S
from quayside.registry import Chain
from quayside.registry_ops import _checked
from quayside.sources import landing as L


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bucket_search_is_not_tried_twice(spark):
    df = spark.range(50).select("id", (F.col("id") % 7).alias("v"))
    out = global_ranks(df, [SortKey.asc("v")], ["id"], {"rn": ("row_number",)})
    assert not any("Filter" in line and "aggregate(" in line for line in _plan(out).splitlines())
    assert sorted(r["rn"] for r in out.collect()) == list(range(1, 51))


def test_technical_columns_leave_before_the_dedup(spark):
    rows = [(1, "1", "2020-01-01T00:00:00", "h1"), (1, "1", "2020-01-01T00:00:00", "h2")]
    df = spark.createDataFrame(rows, "review_id bigint, review_text string, review_timestamp string, _row_hash string")
    df = df.withColumns({"rating": F.lit(3), "sentiment_label": F.lit("x")}).select(
        "review_id", "review_text", "review_timestamp", "rating", "sentiment_label", "_row_hash")
    assert S._newest(df, "reviews").columns == df.columns[:-1] and S._newest(df, "reviews").count() == 1


def test_row_hash_can_follow_the_deal(spark):
    df = spark.createDataFrame([(1, "a", "f"), (2, None, "f")], "id bigint, t string, _source_file string")
    out = L.bronze_audit(df, ["id", "t"], F.lit("2020-01-01").cast("timestamp"))
    assert out.columns == ["id", "t", "_bronze_loaded_at", "_source_file", "_row_hash"]
    assert [r[0] for r in out.select(F.col("_row_hash") == F.sha2(F.concat_ws("||", "id", "t"), 256)).collect()] == [True, True]


def test_checked_frames_are_written_once(spark):
    c = Chain(spark, "/root/testdata/sf0.001")
    _checked(c)
    assert {"checked_customers", "checked_restaurants", "checked_orders", "lines"} <= set(c._stored) and "silver_orders" not in c._stored


def test_times_with_and_without_offset(spark):
    texts = ["2020-01-01T10:00:00", "2020-01-01T10:00:00Z", "2020-01-01T10:00:00+05:30", "2020-01-01", "x:-1", None, "2020-01-01 10:00:00-08"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(S.parse_ts("t").cast("string")).collect()] == [
        "2020-01-01 10:00:00", "2020-01-01 10:00:00", "2020-01-01 04:30:00", "2020-01-01 00:00:00", None, None, "2020-01-01 18:00:00"]
