import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001, collect_sorted, quote, ts
from skyfare.operators import layers
from skyfare.sources import fixtures as fx


def core_of(raw, **kw):
    return layers.core_daily_quotes(layers.stg_quotes(raw), **kw)


def test_null_price_never_wins(raw_df):
    raw = raw_df([quote(price=None, qts="2024-01-01 23:00:00"),
                  quote(price="300.00", qts="2024-01-01 01:00:00"),
                  quote(price="200.00", qts="2024-01-01 02:00:00")])
    rows = core_of(raw).collect()
    assert len(rows) == 1
    assert rows[0].daily_min_price_aud == Decimal("200.00")


def test_equal_price_latest_observation_wins(raw_df):
    raw = raw_df([quote(price="150.00", qts="2024-01-01 01:00:00", airline="JQ"),
                  quote(price="150.00", qts="2024-01-01 05:00:00", airline="TR")])
    r = core_of(raw).collect()[0]
    assert r.observed_at == ts("2024-01-01 05:00:00") and r.airline_code == "TR"


def test_all_null_prices_still_one_row(raw_df):
    raw = raw_df([quote(price=None, qts="2024-01-01 01:00:00"),
                  quote(price=None, qts="2024-01-01 03:00:00")])
    rows = core_of(raw).collect()
    assert len(rows) == 1 and rows[0].daily_min_price_aud is None
    assert rows[0].observed_at == ts("2024-01-01 03:00:00")


def test_route_code_null_when_either_side_null(raw_df):
    raw = raw_df([quote(origin=None), quote(dest=None), quote()])
    codes = sorted([r.route_code for r in layers.stg_quotes(raw).collect()], key=str)
    assert codes == ["MEL-BKK", None, None]


def test_stops_default_only_in_stg(raw_df):
    raw = raw_df([quote(stops=None)])
    assert raw.collect()[0].stops is None
    assert layers.stg_quotes(raw).collect()[0].stops == 0


def test_quote_day_is_midnight_timestamp(raw_df):
    raw = raw_df([quote(qts="2024-01-01 23:59:59")])
    r = core_of(raw).collect()[0]
    assert isinstance(r.quote_day, dt.datetime)
    assert r.quote_day == ts("2024-01-01 00:00:00")


def test_explicit_zone_moves_the_day_boundary(raw_df):
    # 2024-01-01 14:00 UTC is already 2024-01-02 in Melbourne (UTC+11).
    raw = raw_df([quote(qts="2024-01-01 14:00:00", price="10.00"),
                  quote(qts="2024-01-01 10:00:00", price="20.00")])
    utc = core_of(raw).collect()
    mel = core_of(raw, zone="Australia/Melbourne", with_partition=True).collect()
    assert len(utc) == 1
    assert len(mel) == 2
    by_price = {r.daily_min_price_aud: r for r in mel}
    assert by_price[Decimal("10.00")].quote_date == dt.date(2024, 1, 2)
    assert by_price[Decimal("20.00")].quote_date == dt.date(2024, 1, 1)
    # midnight Melbourne of 2024-01-02 is 13:00 UTC on 2024-01-01
    assert by_price[Decimal("10.00")].quote_day == ts("2024-01-01 13:00:00")


def test_grain_unique_and_mart_equals_core(spark):
    stg = layers.stg_quotes(fx.quotes_from_events(spark, SF001))
    core = layers.core_daily_quotes(stg)
    mart = layers.mart_lowest_price(core)
    grain = ["route_code", "departure_date", "quote_day"]
    assert core.groupBy(*grain).count().filter("count > 1").count() == 0
    assert collect_sorted(core) == collect_sorted(mart)


def test_daily_min_not_above_any_price_in_group(spark):
    stg = layers.stg_quotes(fx.quotes_from_events(spark, SF001))
    core = layers.core_daily_quotes(stg)
    grain = ["route_code", "departure_date", "quote_day"]
    mins = stg.withColumn("quote_day", F.date_trunc("day", "quote_ts")).groupBy(*grain) \
        .agg(F.min("price_aud").alias("m"))
    bad = core.join(mins, grain).filter(F.col("daily_min_price_aud") != F.col("m"))
    assert bad.count() == 0


def test_core_plan_limits_before_shuffle(spark):
    core = layers.core_daily_quotes(layers.stg_quotes(fx.quotes_from_events(spark, SF001)))
    plan = core._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# Melbourne leaves summer time on 2024-04-07 at 16:00 UTC the day before, New York on 2024-11-03 at 06:00 UTC.
INSTANTS = ["2024-04-06T12:59:59.999999Z", "2024-04-06T13:00:00Z", "2024-04-06T15:30:00Z", "2024-04-06T16:30:00Z",
            "2024-04-07T13:59:59Z", "2024-04-07T14:00:00Z", "2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z",
            "2024-03-10T07:30:00Z", "1969-12-31T23:59:59.5Z", "1960-02-29T12:59:00Z", None]


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Australia/Melbourne"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Australia/Melbourne", "Asia/Kolkata"])
def test_days_of_a_zone_are_the_same_in_any_session(spark, session, zone):
    from zoneinfo import ZoneInfo
    from skyfare.functions import day_start, local_date
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        df = spark.createDataFrame([(x,) for x in INSTANTS], "x string").withColumn("ts", F.col("x").cast("timestamp"))
        got = df.select("x", local_date(F.col("ts"), zone).alias("d"),
                        F.unix_micros(day_start(F.col("ts"), zone)).alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r in got:
        if r["x"] is None:
            assert r["d"] is None and r["s"] is None
            continue
        at = dt.datetime.fromisoformat(r["x"].replace("Z", "+00:00")).astimezone(ZoneInfo(zone))
        start = dt.datetime(at.year, at.month, at.day, tzinfo=ZoneInfo(zone))
        assert (r["d"], r["s"]) == (at.date(), int(start.timestamp()) * 1_000_000), r["x"]


@pytest.mark.parametrize("session", ["America/New_York", "Australia/Melbourne"])
def test_the_zone_key_does_not_depend_on_the_session(spark, session):
    from conftest import SF001
    from skyfare.plans.catalog import QUERIES
    keys = ("core_daily_quotes_zone", "refresh_layers_zone")
    cols = sorted(QUERIES[keys[0]](spark, SF001).columns)
    want = collect_sorted(QUERIES[keys[0]](spark, SF001), cols)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        for key in keys:
            assert collect_sorted(QUERIES[key](spark, SF001), cols) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
