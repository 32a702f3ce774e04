import datetime as dt

from skyfare.operators import ingest, routes


def pairs(df):
    return [(r.origin, r.destination) for r in df.collect()]


def test_dim_parsing_strips_uppercases_splits_first(spark):
    dim = spark.createDataFrame([("mel-bkk",), ("\t MEL-PNH \n",), ("MEL-A-B",), ("MELBKK",),
                                 ("",), (None,), (" MEL - SGN ",)], "route_code string")
    assert sorted(pairs(routes.routes_from_dim(dim))) == sorted(
        [("MEL", "BKK"), ("MEL", "PNH"), ("MEL", "A-B"), ("MEL ", " SGN")])


def test_csv_parsing_strips_parts(spark):
    lists = spark.createDataFrame([("mel-bkk; MEL - PNH ;;MELBKK;MEL-A-B",)], "routes_csv string")
    out = routes.routes_from_csv(lists).orderBy("pos")
    assert pairs(out) == [("MEL", "BKK"), ("MEL", "PNH"), ("MEL", "A-B")]


def test_default_routes(spark):
    assert pairs(routes.default_routes(spark)) == [
        ("MEL", d) for d in ["BKK", "PNH", "SGN", "MNL", "HND", "ICN"]]
    lists = spark.createDataFrame([(" bkk ,, pnh",)], "destinations string")
    assert pairs(routes.routes_default(lists, " mel").orderBy("pos")) == [(" MEL", "BKK"), (" MEL", "PNH")]


def test_first_non_empty_source_wins(spark):
    csv = spark.createDataFrame([("A", "B"), ("A", "B")], "origin string, destination string")
    dim = spark.createDataFrame([("C", "D")], "origin string, destination string")
    empty = dim.limit(0)
    dflt = routes.default_routes(spark)
    assert pairs(routes.resolve_routes([csv, dim, dflt])) == [("A", "B"), ("A", "B")]
    assert pairs(routes.resolve_routes([empty, dim, dflt])) == [("C", "D")]
    assert len(pairs(routes.resolve_routes([None, empty, dflt]))) == 6
    assert routes.try_table(spark, "no_such_table_anywhere") is None


def test_request_grid(spark):
    r = spark.createDataFrame([("MEL", "BKK")], "origin string, destination string")
    g = ingest.request_grid(r, "2024-05-31", 3).orderBy("departure_date").collect()
    assert [x.departure_date for x in g] == [dt.date(2024, 6, d) for d in (1, 2, 3)]
    p = g[0].params
    assert (p.fly_from, p.fly_to, p.date_from, p.date_to, p.curr, p.limit, p.sort) == \
        ("MEL", "BKK", "01/06/2024", "01/06/2024", "AUD", 1, "price")


def test_no_source_behind_the_winner_is_read(spark):
    one = spark.createDataFrame([("A", "B")], "origin string, destination string")
    read = []
    assert pairs(routes.resolve_routes([one.limit(0), lambda: one, lambda: read.append("lower")])) == [("A", "B")]
    assert read == []


def test_an_unreadable_source_falls_back_and_the_last_error_is_raised(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException
    one = spark.createDataFrame([("A", "B")], "origin string, destination string")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")

    def bad():
        return spark.read.schema("origin string, destination string").parquet(str(tmp_path / "bad"))
    bad().schema                                                # planning it is no problem
    assert pairs(routes.resolve_routes([bad, one])) == [("A", "B")]
    assert pairs(routes.resolve_routes([bad, one.limit(0)])) == []
    for last in (bad, lambda: spark.table("no_such_table_anywhere")):
        with pytest.raises((PySparkException, Exception)) as e:
            routes.resolve_routes([None, last])
        assert not isinstance(e.value, (TypeError, AttributeError, ValueError))
    with pytest.raises(ValueError):
        routes.resolve_routes([None])
