import datetime as dt

from pyspark.sql import functions as F

from skyfare.functions import (aud_label, day_start, dollar_label, local_date, route_code,
                               split_first, strip_ws, tolerant_double)


def one(spark, expr, ddl="x double", rows=None):
    df = spark.createDataFrame(rows, ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_labels_rounding(spark):
    rows = [(12.5,), (13.5,), (1234567.49,), (0.5,)]
    # AUD label: grouped, ties to even; dollar label: ungrouped, ties away from zero
    assert one(spark, aud_label(F.col("x")), rows=rows) == ["AUD 12", "AUD 14", "AUD 1,234,567", "AUD 0"]
    assert one(spark, dollar_label(F.col("x")), rows=rows) == ["$13", "$14", "$1234567", "$1"]


def test_strip_split_route(spark):
    rows = [("\t a-b-c \n",), (" x ",), ("nodash",)]
    assert one(spark, strip_ws(F.col("s")), "s string", rows) == ["a-b-c", "x", "nodash"]
    o, d = split_first(strip_ws(F.col("s")))
    got = spark.createDataFrame(rows, "s string").select(o, d).collect()
    assert [tuple(r) for r in got] == [("a", "b-c"), ("x", None), ("nodash", None)]
    rc = spark.createDataFrame([("A", "B"), (None, "B")], "o string, d string") \
        .select(route_code(F.col("o"), F.col("d"))).collect()
    assert [r[0] for r in rc] == ["A-B", None]


def test_tolerant_double(spark):
    assert one(spark, tolerant_double(F.col("s")), "s string", [("1.5",), ("x",), (None,)]) == [1.5, None, None]


def test_day_start_and_local_date_agree(spark):
    ts = [(dt.datetime(2024, 1, 1, 12, 59, 59),), (dt.datetime(2024, 1, 1, 13, 0, 0),)]
    mel = "Australia/Melbourne"   # UTC+11 in January
    days = one(spark, day_start(F.col("t"), mel), "t timestamp", ts)
    dates = one(spark, local_date(F.col("t"), mel), "t timestamp", ts)
    assert dates == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert days == [dt.datetime(2023, 12, 31, 13, 0), dt.datetime(2024, 1, 1, 13, 0)]
    assert one(spark, day_start(F.col("t")), "t timestamp", ts) == [dt.datetime(2024, 1, 1)] * 2
