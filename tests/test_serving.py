import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001, quote
from skyfare.operators import layers, monitoring, serving
from skyfare.sources import fixtures as fx


def mart_of(raw):
    return layers.mart_lowest_price(layers.core_daily_quotes(layers.stg_quotes(raw)))


def test_float_cast_is_double(raw_df):
    m = mart_of(raw_df([quote(price="1234.57")]))
    r = serving.price_trend(m, "MEL-BKK", "2024-06-01").collect()[0]
    assert r.price_aud == 1234.57


def test_latest_ignores_null_keys(raw_df):
    rows = [quote(dep=None, qts="2024-01-02 00:00:00"), quote(qts="2024-01-01 00:00:00")]
    snap = monitoring.latest_snapshot(mart_of(raw_df(rows))).collect()
    assert len(snap) == 1 and snap[0].departure_date == dt.date(2024, 6, 1)


def test_cheapest_latest_uses_latest_day_per_departure(raw_df):
    rows = [quote(dep="2024-06-01", qts="2024-01-01 00:00:00", price="10.00"),
            quote(dep="2024-06-01", qts="2024-01-02 00:00:00", price="99.00"),
            quote(dep="2024-06-02", qts="2024-01-01 00:00:00", price="50.00"),
            quote(dest="PNH", dep="2024-06-01", qts="2024-01-03 00:00:00", price="1.00")]
    out = serving.cheapest_latest(mart_of(raw_df(rows)), "MEL-BKK", "2024-06-01", "2024-06-05").collect()
    assert [(r.departure_date.isoformat(), r.price_aud) for r in out] == \
        [("2024-06-02", 50.0), ("2024-06-01", 99.0)]


def test_window_must_be_ordered(raw_df):
    with pytest.raises(ValueError):
        serving.cheapest_latest(mart_of(raw_df([quote()])), "MEL-BKK", "2024-06-05", "2024-06-01")


def test_guard_bounds_inclusive_and_drop_null_nan(spark):
    t = spark.createDataFrame([(49.99,), (50.0,), (3000.0,), (3000.01,), (None,), (math.nan,)],
                              "price_aud double")
    kept = sorted(r.price_aud for r in serving.trend_guarded(t).collect())
    assert kept == [50.0, 3000.0]


def test_unknown_airline_shows_code_null_stays_null(spark):
    rows = spark.createDataFrame([("JQ",), ("ZZ",), (None,)], "airline_code string")
    out = {r.airline_code: r.airline for r in
           serving.with_airline(rows, serving.airline_table(spark)).collect()}
    assert out == {"JQ": "Jetstar", "ZZ": "ZZ", None: None}


def test_display_formats(spark, raw_df):
    fares = spark.createDataFrame([("MEL-BKK", dt.date(2024, 6, 1), 1234.5, "QF", 1,
                                    dt.datetime(2024, 1, 1))],
                                  "route_code string, departure_date date, price_aud double, "
                                  "airline_code string, stops int, quote_day timestamp")
    r = serving.fare_display(fares, serving.airline_table(spark)).collect()[0]
    assert r["Price (AUD)"] == "AUD 1,234" and r["Airline"] == "Qantas"
    k = serving.kpi_summary(fares).collect()[0]
    assert (k.min_price, k.rows, k.min_price_label) == (1234.5, 1, "AUD 1,234")
    tr = serving.trend_display(fares, serving.airline_table(spark)).collect()[0]
    assert tr["quote_day_label"] == "01/01/24" and tr["price_label"] == "$1235"
    assert tr["Quote day"] == dt.date(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_top_k_and_semi_join(spark):
    mart = mart_of(fx.quotes_from_events(spark, SF001))
    fares = serving.cheapest_latest(mart, "MEL-CLICK", "2024-06-01", "2024-06-05")
    assert "TakeOrderedAndProject" in _plan(fares)
    routes = serving.routes_in_window(fx.supported_routes_from_events(spark, SF001), mart,
                                      "2024-06-01", "2024-06-05")
    routes.collect()
    assert "LeftSemi" in _plan(routes)


def _written_mart(spark, tmp_path):
    from skyfare.plans import pipeline
    from skyfare.sources import tables as T
    from skyfare.sources.tables import Warehouse
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, wh)
    return pipeline.read_mart(spark, wh)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_reads_the_mart_once_with_its_filters(spark, tmp_path):
    mart = _written_mart(spark, tmp_path)
    plan = _plan(serving.cheapest_latest(mart, "MEL-CLICK", "2024-06-01", "2024-06-05"))
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan and "Partial" in plan
    assert "EqualTo(route_code,MEL-CLICK)" in plan


def test_recent_sql_prunes_partitions(spark, tmp_path):
    from skyfare.operators import serving_sql
    _written_mart(spark, tmp_path).createOrReplaceTempView("written_mart")
    plan = _plan(serving_sql.cheapest_recent(spark, "written_mart", "2024-01-30"))
    assert "PartitionFilters: [isnotnull(quote_date" in plan
    spark.catalog.dropTempView("written_mart")


def test_recency_is_eight_calendar_days(raw_df):
    rows = [quote(qts=f"2024-01-{day:02d} 12:00:00", dep=f"2024-06-{day:02d}") for day in range(20, 31)]
    rec = monitoring.recent(mart_of(raw_df(rows)), "2024-01-30").select("quote_day").distinct()
    assert rec.count() == 8


def test_recency_prunes_partitions(spark, tmp_path):
    from skyfare.plans import pipeline
    from skyfare.sources import tables as T
    from skyfare.sources.tables import Warehouse
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, wh)
    q = monitoring.cheapest_recent(pipeline.read_mart(spark, wh), "2024-01-30")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quote_date" in plan and "quote_date" in plan
    assert len(q.collect()) == 20


def test_usage_rollup_trailing_window(spark):
    u = spark.createDataFrame([(dt.datetime(2024, 1, 23, 23, 59, 58), "click", 1.10),
                               (dt.datetime(2024, 1, 23, 23, 59, 59), "click", 2.20),
                               (dt.datetime(2024, 1, 30, 1, 0, 0), "click", 0.10),
                               (dt.datetime(2024, 1, 30, 2, 0, 0), "click", 0.20),
                               (dt.datetime(2024, 1, 30, 3, 0, 0), "view", 5.0)],
                              "start_time timestamp, resource string, amount double")
    out = monitoring.usage_daily_rollup(u, "click", "2024-01-30 23:59:59").collect()
    assert [(r.usage_day.date().isoformat(), str(r.credits_used)) for r in out] == \
        [("2024-01-30", "0.300000000"), ("2024-01-23", "2.200000000")]


def test_no_python_udfs_in_read_plans(spark):
    mart = mart_of(fx.quotes_from_events(spark, SF001))
    plans = [serving.cheapest_latest(mart, "MEL-CLICK", "2024-06-01", "2024-06-05"),
             serving.trend_display(serving.trend_guarded(serving.price_trend(mart, "MEL-CLICK", "2024-06-03")),
                                   serving.airline_table(spark)),
             monitoring.latest_snapshot(mart), monitoring.volume_by_quote_day(mart)]
    for p in plans:
        s = _plan(p)
        assert "BatchEvalPython" not in s and "ArrowEvalPython" not in s
    assert F  # keep import


def test_latest_rows_equal_the_semi_join(spark):
    mart = mart_of(fx.quotes_from_events(spark, SF001))
    key = ["route_code", "departure_date"]
    newest = mart.groupBy(*key).agg(F.max("quote_day").alias("quote_day"))
    want = mart.join(newest, [*key, "quote_day"], "left_semi").select(*mart.columns)
    got = sorted(map(tuple, serving.latest_rows(mart).collect()), key=str)
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) == 35


def test_window_helpers():
    serving.check_window("2024-06-01", "2024-06-01")            # a one-day window is valid
    with pytest.raises(ValueError):
        serving.check_window(dt.date(2024, 6, 2), dt.date(2024, 6, 1))
    assert serving.default_window("2024-01-30") == (dt.date(2024, 1, 30), dt.date(2024, 2, 29))


def test_sql_text_refuses_a_window_that_runs_backwards(spark, tmp_path):
    """The statement itself checks, also where no row would be read."""
    import datetime as dt
    from skyfare.operators import serving_sql
    from skyfare.schemas import CORE
    spark.createDataFrame([], CORE).write.parquet(str(tmp_path / "mart"))
    spark.read.parquet(str(tmp_path / "mart")).createOrReplaceTempView("guard_mart")
    spark.createDataFrame([("MEL-BKK",)], "route_code string").createOrReplaceTempView("guard_routes")
    ends = {"start": dt.date(2024, 6, 2), "end": dt.date(2024, 6, 1)}
    for text, more in ((serving_sql.ROUTES_WITH_FARES_SQL, {"routes": "guard_routes"}),
                       (serving_sql.FARES_AT_LATEST_SQL, {"route": "MEL-BKK"})):
        with pytest.raises(Exception, match="start date is after end date"):
            serving_sql.run(spark, text, mart="guard_mart", **ends, **more).collect()
        good = {"start": ends["end"], "end": ends["start"]}
        assert serving_sql.run(spark, text, mart="guard_mart", **good, **more).collect() == []
