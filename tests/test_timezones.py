import datetime as dt

from helpers import frame
from quayside.plans import silver as S
from quayside.sources.tpch import iso_text


def test_wall_clock_times_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        gap = spark.createDataFrame([(dt.datetime(2000, 4, 2, 2, 13, 29),)], "ts timestamp_ntz")  # DST gap in NY
        assert gap.select(iso_text("ts")).first()[0] == "2000-04-02T02:13:29"
        orders = frame(spark, "orders", [{"order_id": "1", "order_placed_at": "2000-04-02T02:13:29"}])
        r = S.conform_orders(orders).first()
        assert r["order_placed_at"] == dt.datetime(2000, 4, 2, 2, 13, 29)
        assert (r["order_hour"], r["order_day_name"], r["order_day_of_week"]) == (2, "Sunday", 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_offsets_in_text_name_an_instant(spark):
    from quayside.plans.silver import parse_ts
    cases = {"2024-01-01T10:00:00+05:30": "2024-01-01 04:30:00", "2024-01-01 10:00:00Z": "2024-01-01 10:00:00",
             "2024-01-01T23:30:00.25-0800": "2024-01-02 07:30:00.25", "2024-01-01T10:00:00": "2024-01-01 10:00:00",
             "2024-01-01": "2024-01-01 00:00:00", "2024-03-31T02:30:00": "2024-03-31 02:30:00", "bad": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = {r[0]: r[1] for r in df.select("t", parse_ts("t").cast("string")).collect()}
            assert got == cases
            there = df.where("t like '%+05:30'").select(parse_ts("t", "Asia/Kolkata").cast("string")).first()[0]
            assert there == "2024-01-01 10:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
