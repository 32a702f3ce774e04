"""Refresh and mutation survive text dates, crashes and failed gates."""

import datetime as dt

import pytest

from conftest import quote
from skyfare.operators import mutation, quality
from skyfare.plans import pipeline
from skyfare.sources import tables as T
from skyfare.sources.tables import Warehouse


def seq(df):
    from pyspark.sql import functions as F
    return df.withColumn("seq", F.monotonically_increasing_id())


def warehouse(tmp_path, raw_df, rows):
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(raw_df(rows), wh.raw_quotes, mode="overwrite", static=True)
    return wh


def test_text_dates_refresh_the_same_partitions(spark, tmp_path, raw_df):
    rows = [quote(qts=f"2024-01-0{d} 10:00:00") for d in (1, 2, 3)]
    wh = warehouse(tmp_path, raw_df, rows)
    pipeline.refresh_layers(spark, wh)
    for dates in (["2024-01-02"], [dt.datetime(2024, 1, 2, 5)], [dt.date(2024, 1, 2)]):
        pipeline.refresh_layers(spark, wh, dates=dates)
        assert pipeline.read_core(spark, wh).count() == 3
        assert pipeline.read_mart(spark, wh).count() == 3
    with pytest.raises(ValueError):
        pipeline.refresh_layers(spark, wh, dates=["soon"])


def test_append_after_a_crash_keeps_the_row(spark, tmp_path, raw_df):
    wh = warehouse(tmp_path, raw_df, [quote()])
    batch = seq(raw_df([quote(price="90.00")])).drop("cabin")
    res = mutation.stage_upsert(spark, wh.raw_quotes, batch)
    mutation.mark_pending(spark, wh.raw_quotes, "quotes", res.staging_path, res.append_path)
    mutation.append_rows(raw_df([quote(dest="HKG")]), wh.raw_quotes)
    mutation.recover_pending(spark, wh.raw_quotes)
    got = {(r["destination"], str(r["price_aud"])) for r in T.read_quotes(spark, wh.raw_quotes).collect()}
    assert got == {("BKK", "90.00"), ("HKG", "100.00")}


def test_staging_goes_after_the_swap(spark, tmp_path, raw_df):
    wh = warehouse(tmp_path, raw_df, [quote()])
    res = mutation.upsert_quotes(spark, wh.raw_quotes, seq(raw_df([quote(price="1.00")])).drop("cabin"))
    assert res.staging_path and not T.fs_exists(spark, res.staging_path)


def test_run_after_a_crash_or_failed_gate_rebuilds_all(spark, tmp_path, raw_df):
    (tmp_path / "landing").mkdir()
    args = (str(tmp_path / "landing"), str(tmp_path / "ckpt"))
    wh = warehouse(tmp_path, raw_df, [quote()])
    T.fs_touch(spark, f"{args[1]}/_unfinished_run")  # died after the load
    _, refreshed = pipeline.daily_run(spark, wh, *args)
    assert refreshed is not None and pipeline.read_mart(spark, wh).count() == 1
    assert not T.fs_exists(spark, f"{args[1]}/_unfinished_run")
    mutation.append_rows(raw_df([quote(dep=None)]), wh.raw_quotes)
    T.fs_touch(spark, f"{args[1]}/_unfinished_run")
    for _ in range(2):  # the gate stays shut until the row is gone
        with pytest.raises(quality.QualityGateError):
            pipeline.daily_run(spark, wh, *args)


def parsed(spark, wh):
    return sorted(map(str, T.read_quotes(spark, wh.raw_quotes).collect()))


def responses(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "ingested_at timestamp, route_code string, p string, r string")
    return df.select("ingested_at", "route_code", F.parse_json("p").alias("params"), F.parse_json("r").alias("response"))


ASK = '{"fly_from":"MEL","fly_to":"BKK","date_from":"01/06/2024"}'
NOWHERE = '{"fly_from":"MEL","date_from":"01/06/2024"}'
FARE = '{"data":[{"price":100,"route":[{}],"airlines":["JQ"]}]}'


@pytest.mark.parametrize("dies", ["nowhere", "before the archive moves", "half-way through the move",
                                  "after the archive", "before the quotes", "after the quotes"])
def test_a_replayed_epoch_equals_a_single_run(spark, tmp_path, monkeypatch, dies):
    """Two identical responses, one without a time and one that yields a NULL
    key, each kept as often as it landed, wherever the first attempt died."""
    from skyfare.streaming import ingest as stream
    t = dt.datetime(2024, 1, 1, 10)
    rows = [(t, "MEL-BKK", ASK, FARE), (t, "MEL-BKK", ASK, FARE), (None, "MEL-BKK", ASK, FARE),
            (t, "MEL-?", NOWHERE, FARE), (t, "MEL-?", NOWHERE, FARE), (dt.datetime(2024, 1, 2), "MEL-BKK", ASK, FARE)]
    batch, wh = responses(spark, rows), Warehouse(str(tmp_path / "wh"))
    calls, move, finish = [], T.fs_move_partitions, mutation._finish

    def dying_move(s, source, target):
        calls.append(source)
        if dies == "before the archive moves":
            raise RuntimeError("died")
        if dies == "half-way through the move":
            only = f"{source}/quote_date=2024-01-01"
            T._fs(s, target)[1].mkdirs(T._fs(s, f"{target}/quote_date=2024-01-01")[0])
            for f in [n for n in T.fs_list(s, only) if n.endswith(".parquet")]:
                assert T._fs(s, only)[1].rename(T._fs(s, f"{only}/{f}")[0], T._fs(s, f"{target}/quote_date=2024-01-01/{f}")[0])
            raise RuntimeError("died")
        return move(s, source, target)

    def dying_finish(s, target, marker):
        if dies == "before the quotes" and target == wh.raw_quotes:
            raise RuntimeError("died")
        finish(s, target, marker)
        if (dies == "after the archive" and target == wh.raw_json) or (dies == "after the quotes" and target == wh.raw_quotes):
            raise RuntimeError("died")

    monkeypatch.setattr(T, "fs_move_partitions", dying_move)
    monkeypatch.setattr(mutation, "_finish", dying_finish)
    stats = stream.IngestStats()
    if dies == "nowhere":
        stream.load_batch(spark, wh, batch, 0, "s", stats)
    else:
        with pytest.raises(RuntimeError):
            stream.load_batch(spark, wh, batch, 0, "s", stats)
    monkeypatch.undo()
    for _ in range(2):
        stream.load_batch(spark, wh, batch, 0, "s", stats)
    assert T.read_json_rows(spark, wh.raw_json).count() == 6
    quotes = T.read_quotes(spark, wh.raw_quotes)
    # One keyed row of two, one of the next day; NULL keys are inserted each.
    assert quotes.count() == 5 and quotes.filter("destination IS NULL").count() == 2
    assert quotes.filter("quote_ts IS NULL").count() == 1
    assert T.fs_list(spark, f"{wh.raw_quotes}/_applied/s") == ["0"]
    stream.load_batch(spark, wh, batch, 1, "s", stats)
    assert T.read_json_rows(spark, wh.raw_json).count() == 12 and T.read_quotes(spark, wh.raw_quotes).count() == 8
    assert T.fs_list(spark, f"{wh.raw_quotes}/_applied/s") == ["1"]
    assert not T.fs_exists(spark, f"{wh.raw_quotes}/_pending") or T.fs_list(spark, f"{wh.raw_quotes}/_pending") == []


def test_a_new_checkpoint_counts_anew(spark, tmp_path):
    from skyfare.streaming import ingest as stream
    wh, landing = Warehouse(str(tmp_path / "wh")), str(tmp_path / "landing")
    stream.land_responses(responses(spark, [(dt.datetime(2024, 1, 1, 10), "MEL-?", NOWHERE, FARE)]), landing)
    for ckpt in ("a", "a", "b"):
        stream.ingest_landed(spark, wh, landing, str(tmp_path / ckpt))
    assert T.read_quotes(spark, wh.raw_quotes).count() == 2     # once for each checkpoint


def test_the_last_landed_file_wins(spark, tmp_path):
    """A later file of smaller size (so read later or earlier by the scheduler)
    still overrides the earlier one, and within a file the last line wins."""
    import os
    from skyfare.streaming import ingest as stream
    wh, landing = Warehouse(str(tmp_path / "wh")), str(tmp_path / "landing")
    t = "2024-01-01T10:00:00.000000Z"

    def line(price, pad=""):
        return (f'{{"ingested_at":"{t}","route_code":"MEL-BKK{pad}","params":{ASK},'
                f'"response":{{"data":[{{"price":{price}}}]}}}}')
    (tmp_path / "landing").mkdir()
    for name, at, prices in (("b.json", 1_700_000_000, [1] * 500 + [2]), ("c.json", 1_700_000_100, [3, 4]),
                             ("a.json", 1_700_000_200, [5, 6])):
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.write("\n".join(line(p) for p in prices) + "\n")
        os.utime(path, (at, at))
    stream.ingest_landed(spark, wh, landing, str(tmp_path / "ckpt"))
    assert [float(r["price_aud"]) for r in T.read_quotes(spark, wh.raw_quotes).collect()] == [6.0]


def test_unmarked_staging_is_dropped_and_long_paths_fit(spark, tmp_path, raw_df):
    wh = Warehouse(str(tmp_path / ("x" * 120) / ("y" * 120)))
    T.write_quotes(raw_df([quote()]), wh.raw_quotes, mode="overwrite", static=True)
    mutation.stage_upsert(spark, wh.raw_quotes, seq(raw_df([quote(qts="2024-02-01 10:00:00")])).drop("cabin"))
    assert mutation.recover_pending(spark, wh.raw_quotes) == 0      # died before its marker: never happened
    assert T.read_quotes(spark, wh.raw_quotes).count() == 1
    mutation.upsert_quotes(spark, wh.raw_quotes, seq(raw_df([quote(qts="2024-02-01 10:00:00")])).drop("cabin"))
    assert T.read_quotes(spark, wh.raw_quotes).count() == 2
