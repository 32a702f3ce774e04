import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import collect_sorted, quote, ts
from skyfare.operators import mutation
from skyfare.schemas import RAW_QUOTE_COLUMNS
from skyfare.sources import tables as T


def batch(spark, rows):
    cols = RAW_QUOTE_COLUMNS[:-1] + ["seq"]
    return spark.createDataFrame(
        [r[:8] + (i,) for i, r in enumerate(rows)],
        "origin string, destination string, departure_date date, quote_ts timestamp, "
        "price_aud decimal(10,2), stops int, airline_code string, source string, seq long").select(*cols)


def table_rows(spark, path):
    return collect_sorted(T.read_quotes(spark, path).select(*RAW_QUOTE_COLUMNS))


def setup(spark, raw_df, tmp_path, rows):
    path = str(tmp_path / "raw")
    T.write_quotes(raw_df(rows), path, mode="overwrite", static=True)
    return path


def test_upsert_semantics(spark, raw_df, tmp_path):
    target = [quote(qts="2024-01-01 10:00:00", price="100.00", cabin="Y"),
              quote(qts="2024-01-01 10:00:00", price="101.00", cabin="J"),   # duplicate target key
              quote(dest="PNH", qts="2024-01-02 10:00:00", price="50.00")]  # other day, untouched
    path = setup(spark, raw_df, tmp_path, target)
    src = [quote(qts="2024-01-01 10:00:00", price="90.00", airline="TR"),
           quote(qts="2024-01-01 10:00:00", price="80.00", stops=None, airline=None),  # last wins, NULLs
           quote(dest="SGN", qts="2024-01-01 11:00:00", price="70.00"),              # insert
           quote(dest=None, qts="2024-01-01 10:00:00", price="60.00"),               # NULL key: insert
           quote(dest=None, qts="2024-01-01 10:00:00", price="60.00")]               # ... every time
    res = mutation.upsert_quotes(spark, path, batch(spark, src))
    assert (res.input_rows, res.inserted, res.updated) == (5, 3, 2)
    got = table_rows(spark, path)
    d, t = dt.date(2024, 6, 1), ts("2024-01-01 10:00:00")
    assert ("MEL", "BKK", d, t, Decimal("80.00"), None, None, "feed", "Y") in got
    assert ("MEL", "BKK", d, t, Decimal("80.00"), None, None, "feed", "J") in got
    assert ("MEL", "PNH", d, ts("2024-01-02 10:00:00"), Decimal("50.00"), 0, "JQ", "feed", None) in got
    assert ("MEL", "SGN", d, ts("2024-01-01 11:00:00"), Decimal("70.00"), 0, "JQ", "feed", None) in got
    assert sum(1 for r in got if r[1] is None) == 2
    assert len(got) == 6


def test_upsert_twice_equals_once(spark, raw_df, tmp_path):
    path = setup(spark, raw_df, tmp_path, [quote()])
    src = batch(spark, [quote(price="1.00"), quote(dest="HND", price="2.00")])
    mutation.upsert_quotes(spark, path, src)
    once = table_rows(spark, path)
    mutation.upsert_quotes(spark, path, src)
    assert table_rows(spark, path) == once


def test_upsert_into_missing_table_and_null_timestamp(spark, tmp_path):
    path = str(tmp_path / "fresh")
    src = batch(spark, [quote(), quote(qts=None)])
    res = mutation.upsert_quotes(spark, path, src)
    assert res.inserted == 2
    assert len(table_rows(spark, path)) == 2


def test_delete_keeps_null_predicate_rows_and_drops_empty_partitions(spark, raw_df, tmp_path):
    rows = [quote(qts="2024-01-01 10:00:00", source="ingestion_test"),
            quote(qts="2024-01-02 10:00:00", source="feed"),
            quote(qts="2024-01-02 11:00:00", source=None)]
    path = setup(spark, raw_df, tmp_path, rows)
    n = mutation.delete_by_source(spark, path, "ingestion_test")
    assert n == 1
    got = table_rows(spark, path)
    assert len(got) == 2 and all(r[7] != "ingestion_test" for r in got)
    assert not os.path.exists(os.path.join(path, "quote_date=2024-01-01"))
    assert mutation.delete_by_source(spark, path, "nothing") == 0


def test_delete_by_json_path(spark, tmp_path):
    path = str(tmp_path / "json")
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "MEL-HKG", '{"curr":"AUD"}', '{"min_price":555,"airline":"XX"}'),
         (dt.datetime(2024, 1, 1), "MEL-HKG", '{"curr":"AUD"}', '{"min_price":1,"airline":"YY"}'),
         (dt.datetime(2024, 1, 2), "MEL-BKK", '{"curr":"AUD"}', '{"min_price":2,"airline":"XX"}')],
        "ingested_at timestamp, route_code string, p string, r string").select(
        "ingested_at", "route_code", F.parse_json("p").alias("params"), F.parse_json("r").alias("response"))
    mutation.append_rows(df, path, kind="json")
    assert mutation.delete_by_json_path(spark, path, "MEL-HKG", "$.airline", "XX") == 1
    left = T.read_json_rows(spark, path).select(F.to_json("response").alias("r")).collect()
    assert sorted(r.r for r in left) == ['{"airline":"XX","min_price":2}', '{"airline":"YY","min_price":1}']


def test_driver_crash_between_stage_and_swap_is_recovered(spark, raw_df, tmp_path):
    rows = [quote(qts="2024-01-01 10:00:00", price="100.00"),
            quote(dest="PNH", qts="2024-01-02 10:00:00", price="50.00")]
    crashed = setup(spark, raw_df, tmp_path / "a", rows)
    clean = setup(spark, raw_df, tmp_path / "b", rows)
    src = batch(spark, [quote(qts="2024-01-01 10:00:00", price="90.00"),
                        quote(dest="SGN", qts="2024-01-03 10:00:00", price="70.00"),
                        quote(qts=None, price="1.00")])
    mutation.upsert_quotes(spark, clean, src)
    # the driver staged the result and left its marker, then died
    res = mutation.stage_upsert(spark, crashed, src)
    assert sorted(res.touched, key=str) == sorted([dt.date(2024, 1, 1), dt.date(2024, 1, 3), None], key=str)
    mutation.mark_pending(spark, crashed, "quotes", res.staging_path, res.append_path)
    assert table_rows(spark, crashed) != table_rows(spark, clean)
    assert mutation.recover_pending(spark, crashed) == 1
    assert table_rows(spark, crashed) == table_rows(spark, clean)
    assert mutation.recover_pending(spark, crashed) == 0
    # re-applying the same staged result again changes nothing
    again = mutation.stage_upsert(spark, crashed, src)
    for _ in range(2):
        mutation._apply(spark, crashed, "quotes", again.staging_path)
    changed = [r for r in table_rows(spark, crashed) if r[3] is not None]
    assert changed == [r for r in table_rows(spark, clean) if r[3] is not None]


def scans(df):
    """Columns read by each Parquet scan of a plan."""
    import re
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [set(re.findall(r"(\w+):", m)) for m in re.findall(r"ReadSchema: struct<([^>]*)", plan)]


def test_the_target_is_scanned_once_and_probed_by_key_only(spark, raw_df, tmp_path):
    path = setup(spark, raw_df, tmp_path, [quote(), quote(qts="2024-01-02 10:00:00")])
    rows = batch(spark, [quote(price="1.00")]).drop("seq").withColumn("quote_date", F.to_date("quote_ts"))
    rows.write.parquet(str(tmp_path / "batch"))
    rows = spark.read.schema(rows.schema).parquet(str(tmp_path / "batch"))
    target = T.read_quotes(spark, path).filter(T.in_partitions([dt.date(2024, 1, 1)]))
    key = {"origin", "destination", "departure_date", "quote_ts"}
    probe = scans(mutation.probe_matches(target, rows))
    assert len(probe) == 2 and all(s <= key | {"quote_date"} for s in probe)
    matched = mutation.probe_matches(target, rows)
    matched.write.parquet(str(tmp_path / "matched"))
    matched = spark.read.schema(matched.schema).parquet(str(tmp_path / "matched"))
    plan = scans(mutation.rewritten_rows(target, rows, matched))
    assert sum("cabin" in s for s in plan) == 1     # only the target has it
    assert len(plan) == 4                           # target, batch twice, matched keys


def test_an_insert_rewrites_no_file(spark, raw_df, tmp_path):
    path = setup(spark, raw_df, tmp_path, [quote(), quote(qts="2024-01-02 10:00:00")])
    files = {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    res = mutation.upsert_quotes(spark, path, batch(spark, [quote(dest="SGN"), quote(qts=None),
                                                            quote(qts="2024-01-02 10:00:00", price="7.00")]))
    after = {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    gone = files - after
    assert all("quote_date=2024-01-02" in f for f in gone) and len(gone) == 1
    assert res.rewritten == [dt.date(2024, 1, 2)] and (res.inserted, res.updated) == (2, 1)
    assert len(table_rows(spark, path)) == 4
