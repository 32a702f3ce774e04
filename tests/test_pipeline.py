import os

from pyspark.sql import functions as F

from conftest import SF001, collect_sorted
from skyfare.operators import mutation
from skyfare.plans import pipeline
from skyfare.schemas import CORE_COLUMNS, RAW_QUOTE_COLUMNS
from skyfare.sources import fixtures as fx
from skyfare.sources import tables as T
from skyfare.sources.tables import Warehouse
from skyfare.streaming import ingest as stream


def test_incremental_refresh_equals_full(spark, tmp_path):
    target, source = fx.upsert_fixture(spark, SF001)
    inc = Warehouse(str(tmp_path / "inc"))
    full = Warehouse(str(tmp_path / "full"))
    for wh in (inc, full):
        T.write_quotes(target, wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, inc, fail_on_checks=False)
    # only a few days change
    part = source.filter(F.dayofmonth(F.col("quote_ts")).isin(3, 4, 17))
    res = mutation.upsert_quotes(spark, inc.raw_quotes, part)
    mutation.upsert_quotes(spark, full.raw_quotes, part)
    days = res.touched
    assert len(days) == 3
    # the fixture inserts NULL-destination rows on purpose: the gate must fail
    import pytest
    from skyfare.operators.quality import QualityGateError
    with pytest.raises(QualityGateError):
        pipeline.refresh_layers(spark, inc, dates=days)
    pipeline.refresh_layers(spark, full, fail_on_checks=False)
    a = collect_sorted(pipeline.read_mart(spark, inc).select(*CORE_COLUMNS))
    b = collect_sorted(pipeline.read_mart(spark, full).select(*CORE_COLUMNS))
    assert a == b


def test_namespaces_and_empty_tables(spark, tmp_path):
    from skyfare.sources.tables import namespace
    assert namespace("stg") == "STG" and namespace(None) == "PUBLIC"
    wh = Warehouse(str(tmp_path / "w"))
    pipeline.setup_tables(spark, wh)
    assert T.read_quotes(spark, wh.raw_quotes).count() == 0
    assert set(RAW_QUOTE_COLUMNS) <= set(T.read_quotes(spark, wh.raw_quotes).columns)
    assert os.path.isdir(wh.raw_json)


def test_landed_files_load_once(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    resp = fx.responses_from_events(spark, SF001)
    first = resp.filter("hour(ingested_at) < 12")
    second = resp.filter("hour(ingested_at) >= 12")
    stream.land_responses(first, landing)
    s1 = stream.ingest_landed(spark, wh, landing, ckpt)
    n1 = T.read_quotes(spark, wh.raw_quotes).count()
    assert s1.responses == first.count() and n1 == s1.inserted
    s2 = stream.ingest_landed(spark, wh, landing, ckpt)
    assert s2.batches == 0 and T.read_quotes(spark, wh.raw_quotes).count() == n1
    stream.land_responses(second, landing)
    s3 = stream.ingest_landed(spark, wh, landing, ckpt)
    assert s3.responses == second.count()
    total = T.read_quotes(spark, wh.raw_quotes).count()
    priced = resp.filter("try_variant_get(response, '$.data[0].price', 'double') IS NOT NULL").count()
    assert total == priced
    archived = T.read_json_rows(spark, wh.raw_json).count()
    assert archived == priced


def test_catalog_names_follow_the_latest_warehouse(spark, tmp_path):
    from skyfare.sources.catalog import register_catalog
    counts = []
    for i, n in enumerate((3, 5)):
        wh = Warehouse(str(tmp_path / f"w{i}"))
        T.write_quotes(fx.quotes_from_events(spark, SF001).limit(n), wh.raw_quotes,
                       mode="overwrite", static=True)
        names = register_catalog(spark, wh)
        counts.append(spark.table(names[T.RAW_QUOTES_TABLE]).count())
    assert counts == [3, 5]
    assert spark.sql("SELECT count(*) FROM RAW.price_quotes_parsed").collect()[0][0] == 5


def test_replayed_epoch_archives_once(spark, tmp_path):
    """An attempt that died after moving part of the epoch's files is finished,
    not repeated; an epoch the archive has is skipped."""
    from skyfare.operators import ingest as ing
    wh = Warehouse(str(tmp_path / "wh"))
    rows = ing.archive_rows(fx.responses_from_events(spark, SF001))
    staged = f"{wh.raw_json}/_pending/attempt"
    T.write_json_rows(rows, staged)
    mutation.mark_pending(spark, wh.raw_json, "json", append=staged, op=("s", 7))
    day = [n for n in T.fs_list(spark, staged) if n.startswith("quote_date=")][1]
    half = str(tmp_path / "half" / day)
    os.makedirs(half)
    for f in os.listdir(f"{staged}/{day}"):
        os.rename(f"{staged}/{day}/{f}", f"{half}/{f}")
    T.fs_move_partitions(spark, str(tmp_path / "half"), wh.raw_json)
    assert 0 < T.read_json_rows(spark, wh.raw_json).count() < rows.count()
    assert not mutation.append_rows(rows, wh.raw_json, kind="json", op=("s", 7))
    assert T.read_json_rows(spark, wh.raw_json).count() == rows.count()
    assert not mutation.append_rows(rows, wh.raw_json, kind="json", op=("s", 7))
    assert T.read_json_rows(spark, wh.raw_json).count() == rows.count()


def test_stream_with_grid_keeps_grid_cells_only(spark, tmp_path):
    from skyfare.operators import ingest as ing
    from skyfare.operators import routes as rt
    wh = Warehouse(str(tmp_path / "wh"))
    landing = str(tmp_path / "landing")
    stream.land_responses(fx.responses_from_events(spark, SF001), landing)
    pairs = spark.createDataFrame([("MEL", "CLICK")], "origin string, destination string")
    grid = ing.request_grid(pairs, "2024-05-31", 2)
    st = stream.ingest_landed(spark, wh, landing, str(tmp_path / "ckpt"), grid=grid)
    raw = T.read_quotes(spark, wh.raw_quotes)
    assert raw.count() == st.inserted > 0
    assert raw.filter("destination <> 'CLICK' OR departure_date > DATE'2024-06-02'").count() == 0
    assert rt  # imported for symmetry with the grid builder


def test_incremental_refresh_drops_emptied_dates(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, wh)
    day = "2024-01-05"
    gone = mutation.delete_where(spark, wh.raw_quotes, F.to_date("quote_ts") == F.lit(day).cast("date"))
    assert gone > 0
    import datetime as dt
    pipeline.refresh_layers(spark, wh, dates=[dt.date(2024, 1, 5)])
    mart = pipeline.read_mart(spark, wh)
    assert mart.filter(F.to_date("quote_day") == F.lit(day).cast("date")).count() == 0
    full = Warehouse(str(tmp_path / "full"))
    T.write_quotes(T.read_quotes(spark, wh.raw_quotes), full.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, full)
    assert collect_sorted(mart.select(*CORE_COLUMNS)) == \
        collect_sorted(pipeline.read_mart(spark, full).select(*CORE_COLUMNS))


def test_catalog_refuses_to_replace_managed_table(spark, tmp_path):
    import pytest
    from skyfare.sources.catalog import register_catalog
    # a CORE namespace of its own (earlier tests may have registered external
    # tables in it; dropping those removes catalog entries only)
    spark.sql("DROP DATABASE IF EXISTS CORE CASCADE")
    spark.sql(f"CREATE DATABASE CORE LOCATION '{tmp_path / 'core_db'}'")
    spark.sql("CREATE TABLE CORE.core_daily_quotes (x int) USING parquet")
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, wh)
    try:
        with pytest.raises(ValueError):
            register_catalog(spark, wh)
    finally:
        spark.sql("DROP TABLE IF EXISTS CORE.core_daily_quotes")


def test_stream_archives_processed_landed_files(spark, tmp_path):
    import glob
    wh = Warehouse(str(tmp_path / "wh"))
    landing, ckpt, arch = str(tmp_path / "landing"), str(tmp_path / "ckpt"), str(tmp_path / "arch")
    resp = fx.responses_from_events(spark, SF001)
    stream.land_responses(resp.filter("hour(ingested_at) < 12"), landing)
    s1 = stream.ingest_landed(spark, wh, landing, ckpt, archive_dir=arch)
    stream.land_responses(resp.filter("hour(ingested_at) >= 12"), landing)
    s2 = stream.ingest_landed(spark, wh, landing, ckpt, archive_dir=arch)
    # files of committed batches move out of the landing folder (one run behind)
    assert len(glob.glob(arch + "/**/*.txt", recursive=True)) >= 1
    assert s1.responses + s2.responses == resp.count()


def test_mart_is_written_without_an_exchange(spark, tmp_path):
    """CORE is laid out once; MART takes its files as they lie."""
    from skyfare.operators import layers
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    pipeline.refresh_layers(spark, wh)
    mart = layers.mart_lowest_price(pipeline.read_core(spark, wh))
    plan = T.layout(mart, ["route_code"], laid_out=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" in plan
    for day in T.fs_list(spark, wh.mart):
        if day.startswith("quote_date="):
            files = [f for f in T.fs_list(spark, f"{wh.mart}/{day}") if f.endswith(".parquet")]
            assert len(files) == 1
    assert collect_sorted(pipeline.read_mart(spark, wh)) == collect_sorted(pipeline.read_core(spark, wh))


def test_a_table_keeps_its_zone(spark, tmp_path):
    import pytest
    wh = Warehouse(str(tmp_path / "wh"))
    quotes = fx.quotes_from_events_utc(spark, SF001)
    T.write_quotes(quotes, wh.raw_quotes, mode="overwrite", static=True, zone="Australia/Melbourne")
    pipeline.refresh_layers(spark, wh)
    assert {T.table_zone(spark, t) for t in (wh.raw_quotes, wh.core, wh.mart)} == {"Australia/Melbourne"}
    for call in (lambda: pipeline.refresh_layers(spark, wh, zone="UTC"),
                 lambda: mutation.append_rows(quotes.limit(1), wh.raw_quotes, zone="UTC"),
                 lambda: mutation.upsert_quotes(spark, wh.raw_quotes, quotes.limit(1), order_col=None, zone="UTC")):
        with pytest.raises(ValueError, match="cuts days in Australia/Melbourne"):
            call()
    n = T.read_quotes(spark, wh.raw_quotes).count()
    res = mutation.upsert_quotes(spark, wh.raw_quotes, quotes, order_col=None)   # the table's zone is taken
    assert res.updated == T.read_quotes(spark, wh.raw_quotes).count() == n
    # Another zone needs a new table, and then a refresh of all.
    T.write_quotes(quotes, wh.raw_quotes, mode="overwrite", static=True, zone="UTC")
    import datetime as dt
    with pytest.raises(ValueError, match="cuts days in Australia/Melbourne, not in UTC"):
        pipeline.refresh_layers(spark, wh, dates=[dt.date(2024, 1, 5)])
    pipeline.refresh_layers(spark, wh)
    assert {T.table_zone(spark, t) for t in (wh.core, wh.mart)} == {"UTC"}


def test_staging_view_is_stored_and_follows_its_table(spark, tmp_path):
    from skyfare.operators import layers
    from skyfare.sources.catalog import register_catalog
    spark.sql("DROP DATABASE IF EXISTS RAW CASCADE")
    spark.sql("DROP DATABASE IF EXISTS STG CASCADE")
    wh = Warehouse(str(tmp_path / "wh"))
    quotes = fx.quotes_from_events(spark, SF001)
    T.write_quotes(quotes.limit(50), wh.raw_quotes, mode="overwrite", static=True)
    names = register_catalog(spark, wh)
    view = names[T.STG_VIEW]
    assert view == "STG.stg_price_quotes_parsed" and spark.catalog.getTable(view).tableType == "VIEW"
    raw = T.read_quotes(spark, wh.raw_quotes)
    assert collect_sorted(spark.newSession().table(view)) == collect_sorted(layers.stg_quotes(raw))
    assert spark.table(view).schema.names == layers.stg_quotes(raw).schema.names
    mutation.append_rows(quotes.limit(5), wh.raw_quotes)
    register_catalog(spark, wh)
    assert spark.newSession().table(view).count() == 55


def test_only_registered_tables_are_replaced(spark, tmp_path):
    """An external table that somebody else made, or pointed elsewhere since, stays."""
    import pytest
    from skyfare.sources.catalog import create_or_replace, register_catalog
    spark.sql("DROP DATABASE IF EXISTS RAW CASCADE")
    spark.sql(f"CREATE DATABASE RAW LOCATION '{tmp_path / 'raw_db'}'")
    wh = Warehouse(str(tmp_path / "wh"))
    T.write_quotes(fx.quotes_from_events(spark, SF001), wh.raw_quotes, mode="overwrite", static=True)
    name = f"RAW.{T.RAW_QUOTES_TABLE}"
    spark.range(3).write.parquet(str(tmp_path / "theirs"))
    spark.sql(f"CREATE TABLE {name} (id long) USING parquet LOCATION '{tmp_path / 'theirs'}'")
    for call in (lambda: register_catalog(spark, wh),
                 lambda: create_or_replace(spark, wh, "raw", T.RAW_QUOTES_TABLE, T.RAW_QUOTES_STORED)):
        with pytest.raises(ValueError, match="did not register"):
            call()
    assert spark.table(name).count() == 3 and T.read_quotes(spark, wh.raw_quotes).count() > 0
    spark.sql(f"DROP TABLE {name}")
    register_catalog(spark, wh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{tmp_path / 'theirs'}'")
    with pytest.raises(ValueError, match="did not register"):
        register_catalog(spark, wh)
    spark.sql(f"DROP TABLE {name}")
    register_catalog(spark, wh)
    assert create_or_replace(spark, wh, "raw", T.RAW_QUOTES_TABLE, T.RAW_QUOTES_STORED) == name
    assert spark.table(name).count() == 0 and spark.table(name).schema == T.RAW_QUOTES_STORED
    spark.sql("DROP DATABASE RAW CASCADE")
