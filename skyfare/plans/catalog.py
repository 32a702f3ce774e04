"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Each builds the layers lazily from the fixture projection and applies one
operator; nothing is collected here. Timestamps are handed over without a
zone (``present``) so the result compares against a zone-less engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skyfare import constants as C
from skyfare.functions import literal_rows, present
from skyfare.operators import (ingest, layers, monitoring, mutation, quality, routes, serving,
                               serving_sql)
from skyfare.plans import params as P
from skyfare.plans import pipeline
from skyfare.schemas import PARTITION_COLUMN, REJECTED_JSON
from skyfare.session import scratch_path
from skyfare.sources import fixtures as fx
from skyfare.sources import tables as T
from skyfare.sources.catalog import create_or_replace, register_catalog
from skyfare.sources.tables import Warehouse
from skyfare.streaming import ingest as stream_ingest


def _events_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = fx.quotes_from_events(spark, sf_dir)
    stg = layers.stg_quotes(raw)
    core = layers.core_daily_quotes(stg)
    mart = layers.mart_lowest_price(core)
    return {"raw": raw, "stg": stg, "core": core, "mart": mart}


def _mart(spark, sf_dir):
    return _events_layers(spark, sf_dir)["mart"]


def _fares(spark, sf_dir):
    return serving.cheapest_latest(_mart(spark, sf_dir), P.ROUTE, P.WINDOW_START, P.WINDOW_END)


def _trend(spark, sf_dir):
    return serving.price_trend(_mart(spark, sf_dir), P.ROUTE, P.TREND_DEPARTURE)


def _guarded(spark, sf_dir):
    return serving.trend_guarded(_trend(spark, sf_dir), P.GUARD_LO, P.GUARD_HI)


# ---- step 1: layers and the flagship read --------------------------------

def q_stg_quotes(spark, sf_dir):
    return present(_events_layers(spark, sf_dir)["stg"])


def q_core_daily_quotes(spark, sf_dir):
    return present(_events_layers(spark, sf_dir)["core"])


def q_mart_lowest_price(spark, sf_dir):
    return present(_mart(spark, sf_dir))


def q_cheapest_latest(spark, sf_dir):
    return present(_fares(spark, sf_dir))


def q_core_daily_quotes_volume(spark, sf_dir):
    raw = fx.quotes_from_lineitem(spark, sf_dir)
    return present(layers.core_daily_quotes(layers.stg_quotes(raw)))


# ---- step 2: serving -----------------------------------------------------

def q_routes_in_window(spark, sf_dir):
    return serving.routes_in_window(fx.supported_routes_from_events(spark, sf_dir),
                                    _mart(spark, sf_dir), P.WINDOW_START, P.WINDOW_END)


def q_price_trend(spark, sf_dir):
    return present(_trend(spark, sf_dir))


def q_trend_guarded(spark, sf_dir):
    return present(_guarded(spark, sf_dir))


def q_trend_display(spark, sf_dir):
    return present(serving.trend_display(_guarded(spark, sf_dir), serving.airline_table(spark)))


def q_kpi_summary(spark, sf_dir):
    return present(serving.kpi_summary(_fares(spark, sf_dir)))


def q_departure_dates(spark, sf_dir):
    return serving.departure_dates(_fares(spark, sf_dir))


def q_airline_labels(spark, sf_dir):
    rows = _mart(spark, sf_dir).select("route_code", "departure_date", "quote_day", "airline_code")
    return present(serving.with_airline(rows, serving.airline_table(spark)))


def q_fare_display(spark, sf_dir):
    return serving.fare_display(_fares(spark, sf_dir), serving.airline_table(spark))


# ---- step 3: monitoring --------------------------------------------------

def q_volume_by_quote_day(spark, sf_dir):
    return present(monitoring.volume_by_quote_day(_mart(spark, sf_dir)))


def q_cheapest_recent(spark, sf_dir):
    return monitoring.cheapest_recent(_mart(spark, sf_dir), P.AS_OF)


def q_latest_snapshot(spark, sf_dir):
    return present(monitoring.latest_snapshot(_mart(spark, sf_dir)))


def q_usage_daily_rollup(spark, sf_dir):
    return present(monitoring.usage_daily_rollup(fx.usage_from_events(spark, sf_dir),
                                                 P.USAGE_RESOURCE, P.USAGE_AS_OF_TS))


def q_parsed_row_count(spark, sf_dir):
    return monitoring.parsed_row_count(fx.quotes_from_events(spark, sf_dir))


# ---- step 4: quality -----------------------------------------------------

def _seeded_layers(spark, sf_dir):
    bad = fx.seeded_bad_quotes(spark, sf_dir)
    raw = bad.drop("event_id")
    stg = layers.stg_quotes(raw)
    core = layers.core_daily_quotes(stg)
    marked = (layers.stg_quotes(bad.filter(F.col("event_id") % 89 == 0).drop("event_id"))
              .select("route_code", "departure_date", F.col("quote_ts").alias("observed_at")))
    dup = core.join(marked, ["route_code", "departure_date", "observed_at"], "left_semi")
    core_bad = core.unionByName(dup)
    return {"raw": raw, "stg": stg, "core": core_bad,
            "mart": layers.mart_lowest_price(core_bad)}


def q_dq_checks(spark, sf_dir):
    return quality.run_checks(_events_layers(spark, sf_dir), raw_from_stg=True, mart_from_core=True)


def q_dq_checks_seeded(spark, sf_dir):
    return quality.run_checks(_seeded_layers(spark, sf_dir), raw_from_stg=True)


def q_dq_unique_seeded(spark, sf_dir):
    core = _seeded_layers(spark, sf_dir)["core"]
    return present(quality.duplicate_keys(core, ["route_code", "departure_date", "quote_day"]))


# ---- step 5: routes and request grid -----------------------------------

def _dim_routes(spark, sf_dir):
    return routes.routes_from_dim(fx.supported_routes_from_events(spark, sf_dir))


def _resolved(spark, sf_dir):
    # No route list configured; the dimension is readable; defaults last.
    return routes.resolve_routes([None, _dim_routes(spark, sf_dir),
                                  routes.default_routes(spark)])


def q_routes_from_dim(spark, sf_dir):
    return _dim_routes(spark, sf_dir)


def q_routes_from_csv(spark, sf_dir):
    return routes.routes_from_csv(fx.route_lists_from_events(spark, sf_dir), keep=["list_id"])


def q_routes_default(spark, sf_dir):
    return routes.routes_default(fx.route_lists_from_events(spark, sf_dir), "mel",
                                 keep=["list_id"])


def q_routes_resolved(spark, sf_dir):
    return _resolved(spark, sf_dir)


def q_request_grid(spark, sf_dir):
    return routes_grid(spark, sf_dir).select("origin", "destination", "departure_date", "params.*")


def routes_grid(spark, sf_dir, horizon=None):
    h = horizon or C.DEFAULT_HORIZON_DAYS
    return ingest.request_grid(_resolved(spark, sf_dir), P.GRID_AS_OF, h)


# ---- step 6: responses and JSON archive ----------------------------------

def _archive_view(df):
    """Comparable projection of stored JSON rows."""
    return present(df.select(
        "ingested_at", "route_code",
        F.try_variant_get("params", "$.curr", "string").alias("params_curr"),
        F.try_variant_get("params", "$.date_from", "string").alias("date_from"),
        F.coalesce(F.try_variant_get("response", "$.data[0].price", "double"),
                   F.try_variant_get("response", "$.min_price", "double")).alias("price"),
        F.coalesce(F.try_variant_get("response", "$.data[0].airlines[0]", "string"),
                   F.try_variant_get("response", "$.airline", "string")).alias("airline")))


def q_parse_responses(spark, sf_dir):
    return present(ingest.parse_responses(fx.responses_from_events(spark, sf_dir)))


def q_build_quote_batch(spark, sf_dir):
    grid = routes_grid(spark, sf_dir, C.DEFAULT_HORIZON_DAYS)
    quotes = ingest.parse_responses(fx.responses_from_events(spark, sf_dir))
    return present(ingest.build_quote_batch(grid, quotes))


def _archive_with_smoke(spark, sf_dir):
    path = scratch_path(spark, "raw-json")
    mutation.append_rows(ingest.archive_rows(fx.responses_from_events(spark, sf_dir)), path,
                         kind="json")
    mutation.append_rows(fx.smoke_json(spark, P.SMOKE_AS_OF_TS), path, kind="json")
    return path


def q_raw_json_append(spark, sf_dir):
    path = _archive_with_smoke(spark, sf_dir)
    return _archive_view(T.read_json_rows(spark, path))


def q_last_json_row(spark, sf_dir):
    path = _archive_with_smoke(spark, sf_dir)
    newest = (T.read_json_rows(spark, path)
              .orderBy(F.col("ingested_at").desc_nulls_first(), F.col("route_code").asc_nulls_last())
              .limit(1))
    return _archive_view(newest)


def q_delete_by_json_path(spark, sf_dir):
    path = _archive_with_smoke(spark, sf_dir)
    mutation.delete_by_json_path(spark, path, f"{C.SMOKE_ORIGIN}-{C.SMOKE_DESTINATION}",
                                 P.SMOKE_JSON_PATH, C.SMOKE_AIRLINE)
    mutation.delete_by_json_path(spark, path, P.JSON_DELETE_ROUTE, P.JSON_DELETE_PATH,
                                 P.JSON_DELETE_VALUE)
    return _archive_view(T.read_json_rows(spark, path))


# ---- step 7: mutations ---------------------------------------------------

def _raw_with_smoke(spark, sf_dir):
    path = scratch_path(spark, "raw-quotes")
    # Every 53rd quote stands for an earlier test load.
    quotes = fx.events_quotes_with_id(spark, sf_dir).withColumn("source", F.when(
        F.col("event_id") % 53 == 0, F.lit(C.SMOKE_SOURCE)).otherwise(F.col("source")))
    T.write_quotes(quotes, path, mode="overwrite", static=True)
    mutation.append_rows(fx.smoke_quote(spark, P.AS_OF, P.SMOKE_AS_OF_TS), path)
    return path


def _raw_table(spark, path):
    return present(T.read_quotes(spark, path).drop(PARTITION_COLUMN))


def q_append_smoke_row(spark, sf_dir):
    return _raw_table(spark, _raw_with_smoke(spark, sf_dir))


def q_last_test_row(spark, sf_dir):
    raw = T.read_quotes(spark, _raw_with_smoke(spark, sf_dir)).drop(PARTITION_COLUMN)
    return present(raw.filter(F.col("source") == F.lit(C.SMOKE_SOURCE))
                   .orderBy(F.col("quote_ts").desc_nulls_first(),
                            F.col("departure_date").asc_nulls_last(),
                            F.col("price_aud").asc_nulls_last())
                   .limit(1))


def q_delete_by_source(spark, sf_dir):
    path = _raw_with_smoke(spark, sf_dir)
    mutation.delete_by_source(spark, path, C.SMOKE_SOURCE)
    return _raw_table(spark, path)


def q_upsert_quotes(spark, sf_dir):
    target, source = fx.upsert_fixture(spark, sf_dir)
    path = scratch_path(spark, "raw-quotes")
    T.write_quotes(target, path, mode="overwrite", static=True)
    mutation.upsert_quotes(spark, path, source, order_col="seq")
    return _raw_table(spark, path)


# ---- step 8: pipeline ----------------------------------------------------

def q_refresh_layers(spark, sf_dir):
    wh = Warehouse(scratch_path(spark, "warehouse"))
    T.write_quotes(fx.quotes_from_events(spark, sf_dir), wh.raw_quotes, mode="overwrite",
                   static=True)
    pipeline.refresh_layers(spark, wh)
    return present(pipeline.read_mart(spark, wh).drop(PARTITION_COLUMN))


def q_ingest_landed(spark, sf_dir):
    wh = Warehouse(scratch_path(spark, "warehouse"))
    landing = scratch_path(spark, "landing")
    stream_ingest.land_responses(fx.responses_from_events(spark, sf_dir), landing)
    stream_ingest.ingest_landed(spark, wh, landing, scratch_path(spark, "ingest-checkpoint"))
    return _raw_table(spark, wh.raw_quotes)


# ---- SQL text with named parameters over named tables ---------------------

def _view(df, stem):
    name = f"skyfare_{stem}_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return name


def _mart_view(spark, sf_dir):
    return _view(_mart(spark, sf_dir), "mart")


def q_cheapest_latest_sql(spark, sf_dir):
    return present(serving_sql.cheapest_latest(spark, _mart_view(spark, sf_dir), P.ROUTE,
                                               P.WINDOW_START, P.WINDOW_END))


def q_routes_in_window_sql(spark, sf_dir):
    routes_v = _view(fx.supported_routes_from_events(spark, sf_dir), "routes")
    return serving_sql.routes_in_window(spark, routes_v, _mart_view(spark, sf_dir),
                                        P.WINDOW_START, P.WINDOW_END)


def q_price_trend_sql(spark, sf_dir):
    return present(serving_sql.price_trend(spark, _mart_view(spark, sf_dir), P.ROUTE,
                                           P.TREND_DEPARTURE))


def q_volume_by_quote_day_sql(spark, sf_dir):
    return present(serving_sql.volume_by_quote_day(spark, _mart_view(spark, sf_dir)))


def q_cheapest_recent_sql(spark, sf_dir):
    return serving_sql.cheapest_recent(spark, _mart_view(spark, sf_dir), P.AS_OF)


def q_latest_snapshot_sql(spark, sf_dir):
    return present(serving_sql.latest_snapshot(spark, _mart_view(spark, sf_dir)))


def q_usage_daily_rollup_sql(spark, sf_dir):
    usage = _view(fx.usage_from_events(spark, sf_dir), "usage")
    return present(serving_sql.usage_daily_rollup(spark, usage, P.USAGE_RESOURCE,
                                                  P.USAGE_AS_OF_TS))


def q_mart_by_name(spark, sf_dir):
    """The full path: RAW written, layers refreshed, tables registered per
    layer namespace, MART read back by its qualified name."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    T.write_quotes(fx.quotes_from_events(spark, sf_dir), wh.raw_quotes, mode="overwrite",
                   static=True)
    pipeline.refresh_layers(spark, wh)
    names = register_catalog(spark, wh)
    return present(spark.table(names[T.MART_TABLE]).drop(PARTITION_COLUMN))


def q_daily_run(spark, sf_dir):
    """Two scheduled runs over landed responses (first the morning, then the
    rest of each day): the second refreshes only the dates it changed."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "daily-checkpoint")
    resp = fx.responses_from_events(spark, sf_dir)
    stream_ingest.land_responses(resp.filter(F.hour("ingested_at") < 12), landing)
    pipeline.daily_run(spark, wh, landing, ckpt)
    stream_ingest.land_responses(resp.filter(F.hour("ingested_at") >= 12), landing)
    pipeline.daily_run(spark, wh, landing, ckpt)
    return present(pipeline.read_mart(spark, wh).drop(PARTITION_COLUMN))


# ---- write paths seen from outside -----------------------------------------

def q_upsert_counts(spark, sf_dir):
    """What an upsert reports: rows handed in, inserted, updated, and the days
    it added to and rewrote. Read off the writes as they happen."""
    target, source = fx.upsert_fixture(spark, sf_dir)
    path = scratch_path(spark, "raw-quotes")
    T.write_quotes(target, path, mode="overwrite", static=True)
    res = mutation.upsert_quotes(spark, path, source, order_col="seq")
    return literal_rows(spark, [(res.input_rows, res.inserted, res.updated, len(res.touched), len(res.rewritten))],
                        StructType([StructField(c, LongType()) for c in (
                            "input_rows", "inserted", "updated", "days_touched", "days_rewritten")]))


def q_upsert_inserts(spark, sf_dir):
    """A batch without a match: files are added, none is rewritten."""
    target, source = fx.upsert_fixture(spark, sf_dir)
    path = scratch_path(spark, "raw-quotes")
    T.write_quotes(target, path, mode="overwrite", static=True)
    later = source.withColumn("quote_ts", F.col("quote_ts") + F.expr("INTERVAL 1 HOUR 1 MICROSECOND"))
    res = mutation.upsert_quotes(spark, path, later, order_col="seq")
    return _raw_table(spark, path).withColumn("days_rewritten", F.lit(len(res.rewritten)))


def q_ingest_landed_replayed(spark, sf_dir):
    """Every micro-batch of a load comes a second time, as after a crash, with
    rows whose key has a NULL; both raw tables, as one table of rows."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    resp = fx.responses_from_events(spark, sf_dir)
    nowhere = F.parse_json(F.regexp_replace(F.to_json("params"), '"fly_to":"VIEW",?', ""))
    batch = resp.withColumn("params", F.when(F.col("route_code") == "MEL-VIEW", nowhere).otherwise(F.col("params")))
    morning = F.hour("ingested_at") < 12
    for epoch, part in ((0, batch.filter(morning)), (0, batch.filter(morning)), (1, batch.filter(~morning)),
                        (1, batch.filter(~morning))):
        stream_ingest.load_batch(spark, wh, part, epoch, "replayed", stream_ingest.IngestStats())
    quotes = (T.read_quotes(spark, wh.raw_quotes)
              .select(F.lit("quotes").alias("raw_table"), "destination", "departure_date", "quote_ts", "price_aud"))
    stored = (T.read_json_rows(spark, wh.raw_json)
              .select(F.lit("json").alias("raw_table"),
                      F.try_variant_get("params", "$.fly_to", "string").alias("destination"),
                      F.to_date(F.try_variant_get("params", "$.date_from", "string"), C.REQUEST_DATE_FORMAT)
                       .alias("departure_date"), F.col("ingested_at").alias("quote_ts"),
                      F.try_variant_get("response", "$.data[0].price", "double").cast("decimal(10,2)")
                       .alias("price_aud")))
    return present(quotes.unionByName(stored))


def q_offers_exploded(spark, sf_dir):
    return present(ingest.explode_offers(fx.responses_with_offers(spark, sf_dir)))


def q_offers_cheapest(spark, sf_dir):
    return present(ingest.offers_by_date(ingest.explode_offers(fx.responses_with_offers(spark, sf_dir)), "cheapest"))


def q_offers_first(spark, sf_dir):
    return present(ingest.offers_by_date(ingest.explode_offers(fx.responses_with_offers(spark, sf_dir)), "first"))


def q_core_daily_quotes_zone(spark, sf_dir):
    """Days cut in a zone of their own: the same rows in any session zone."""
    raw = fx.quotes_from_events_utc(spark, sf_dir)
    core = layers.core_daily_quotes(layers.stg_quotes(raw), zone=P.ZONE, with_partition=True)
    return present(core, P.ZONE)


def q_refresh_layers_zone(spark, sf_dir):
    """The same through the tables: RAW is made in a zone, and the refresh,
    which names none, takes it from there."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    T.write_quotes(fx.quotes_from_events_utc(spark, sf_dir), wh.raw_quotes, mode="overwrite", static=True, zone=P.ZONE)
    pipeline.refresh_layers(spark, wh)
    return present(pipeline.read_mart(spark, wh), P.ZONE)


def _configured(spark, sf_dir):
    return routes.routes_from_csv(fx.route_lists_from_events(spark, sf_dir))


def _unreadable(spark):
    """A table whose folder and schema are there and whose file is not Parquet."""
    path = scratch_path(spark, "unreadable")
    spark.range(1).select(F.lit("not a table").alias("value")).write.text(path)
    return spark.read.schema("route_code string").parquet(path)


def q_routes_resolved_configured(spark, sf_dir):
    return routes.resolve_routes([_configured(spark, sf_dir), _dim_routes(spark, sf_dir),
                                  routes.default_routes(spark)])


def q_routes_resolved_default(spark, sf_dir):
    """No list, and a dimension in which no value is a route."""
    dim = fx.supported_routes_from_events(spark, sf_dir).withColumn("route_code", F.translate("route_code", "-", ""))
    return routes.resolve_routes([None, routes.routes_from_dim(dim), routes.default_routes(spark)])


def q_routes_resolved_unreadable(spark, sf_dir):
    """The first source fails in its scan; the dimension steps in."""
    return routes.resolve_routes([lambda: routes.routes_from_dim(_unreadable(spark)),
                                  lambda: spark.table("no_such_table_anywhere"), _dim_routes(spark, sf_dir),
                                  routes.default_routes(spark)])


def _registered(spark, sf_dir):
    wh = Warehouse(scratch_path(spark, "warehouse"))
    T.write_quotes(fx.quotes_from_events(spark, sf_dir), wh.raw_quotes, mode="overwrite", static=True)
    return wh, register_catalog(spark, wh)


def q_stg_by_name(spark, sf_dir):
    """The staging view read by its name, in a session that did not make it."""
    _, names = _registered(spark, sf_dir)
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        other.conf.set(key, spark.conf.get(key))
    return present(other.table(names[T.STG_VIEW]))


def q_table_replaced(spark, sf_dir):
    """A table with rows, replaced by name: its declared columns, and its row
    counts before and after."""
    wh, names = _registered(spark, sf_dir)
    before = spark.table(names[T.RAW_QUOTES_TABLE]).count()
    full = create_or_replace(spark, wh, "raw", T.RAW_QUOTES_TABLE, T.RAW_QUOTES_STORED)
    after = spark.table(full)
    counts = after.agg(F.count("*").alias("rows_after")).withColumn("rows_before", F.lit(before).cast("long"))
    columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                 F.lit(f.dataType.simpleString()).alias("column_type"))
                        for i, f in enumerate(after.schema.fields)])
    return counts.select("rows_before", "rows_after", F.inline(columns))


def _texts_loaded(spark, sf_dir):
    path, rejected = scratch_path(spark, "raw-json"), scratch_path(spark, "raw-json-rejected")
    good, bad = ingest.split_json(fx.json_texts_from_events(spark, sf_dir))
    mutation.append_rows(good, path, kind="json")
    bad.write.parquet(rejected)
    return T.read_json_rows(spark, path), spark.read.schema(REJECTED_JSON).parquet(rejected)


def q_raw_json_from_text(spark, sf_dir):
    good, _ = _texts_loaded(spark, sf_dir)
    return present(good.select("ingested_at", "route_code",
                               F.try_variant_get("params", "$.k", "int").alias("k"),
                               F.try_variant_get("response", "$.price", "long").alias("price")))


def q_raw_json_rejected(spark, sf_dir):
    return present(_texts_loaded(spark, sf_dir)[1])


def q_archive_switch(spark, sf_dir):
    """Rows archived and quotes loaded by route, with the archive on and off and
    with unpriced responses kept; an empty object is never archived."""
    resp = fx.responses_from_events(spark, sf_dir, empty_objects=True)
    out = None
    for state, store, keep in (("on", True, False), ("off", False, False), ("all", True, True)):
        wh = Warehouse(scratch_path(spark, "warehouse"))
        stream_ingest.load_batch(spark, wh, resp, 0, state, stream_ingest.IngestStats(), store_json=store,
                                 keep_unpriced=keep)
        route = F.concat_ws("-", "origin", "destination").alias("route_code")
        rows = T.read_quotes(spark, wh.raw_quotes).select(route, F.lit("quotes").alias("raw_table"))
        if T.fs_exists(spark, wh.raw_json):
            rows = rows.unionByName(T.read_json_rows(spark, wh.raw_json).select("route_code", F.lit("json").alias("raw_table")))
        rows = rows.groupBy("route_code", "raw_table").agg(F.count("*").alias("n")).withColumn("archive", F.lit(state))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_build_quote_batch_run(spark, sf_dir):
    """One run time, and one row for each grid cell with a priced response."""
    quotes = ingest.parse_responses(fx.responses_from_events(spark, sf_dir))
    return present(ingest.build_quote_batch(routes_grid(spark, sf_dir), quotes, run_ts=P.RUN_TS))


QUERIES = {
    "stg_quotes": q_stg_quotes,
    "core_daily_quotes": q_core_daily_quotes,
    "mart_lowest_price": q_mart_lowest_price,
    "cheapest_latest": q_cheapest_latest,
    "core_daily_quotes_volume": q_core_daily_quotes_volume,
    "routes_in_window": q_routes_in_window,
    "price_trend": q_price_trend,
    "trend_guarded": q_trend_guarded,
    "trend_display": q_trend_display,
    "kpi_summary": q_kpi_summary,
    "departure_dates": q_departure_dates,
    "airline_labels": q_airline_labels,
    "fare_display": q_fare_display,
    "volume_by_quote_day": q_volume_by_quote_day,
    "cheapest_recent": q_cheapest_recent,
    "latest_snapshot": q_latest_snapshot,
    "usage_daily_rollup": q_usage_daily_rollup,
    "parsed_row_count": q_parsed_row_count,
    "dq_checks": q_dq_checks,
    "dq_checks_seeded": q_dq_checks_seeded,
    "dq_unique_seeded": q_dq_unique_seeded,
    "routes_from_dim": q_routes_from_dim,
    "routes_from_csv": q_routes_from_csv,
    "routes_default": q_routes_default,
    "routes_resolved": q_routes_resolved,
    "request_grid": q_request_grid,
    "parse_responses": q_parse_responses,
    "build_quote_batch": q_build_quote_batch,
    "raw_json_append": q_raw_json_append,
    "last_json_row": q_last_json_row,
    "delete_by_json_path": q_delete_by_json_path,
    "append_smoke_row": q_append_smoke_row,
    "last_test_row": q_last_test_row,
    "delete_by_source": q_delete_by_source,
    "upsert_quotes": q_upsert_quotes,
    "refresh_layers": q_refresh_layers,
    "ingest_landed": q_ingest_landed,
    "cheapest_latest_sql": q_cheapest_latest_sql,
    "routes_in_window_sql": q_routes_in_window_sql,
    "price_trend_sql": q_price_trend_sql,
    "volume_by_quote_day_sql": q_volume_by_quote_day_sql,
    "cheapest_recent_sql": q_cheapest_recent_sql,
    "latest_snapshot_sql": q_latest_snapshot_sql,
    "usage_daily_rollup_sql": q_usage_daily_rollup_sql,
    "mart_by_name": q_mart_by_name,
    "daily_run": q_daily_run,
    "upsert_counts": q_upsert_counts,
    "upsert_inserts": q_upsert_inserts,
    "ingest_landed_replayed": q_ingest_landed_replayed,
    "offers_exploded": q_offers_exploded,
    "offers_cheapest": q_offers_cheapest,
    "offers_first": q_offers_first,
    "core_daily_quotes_zone": q_core_daily_quotes_zone,
    "refresh_layers_zone": q_refresh_layers_zone,
    "routes_resolved_configured": q_routes_resolved_configured,
    "routes_resolved_default": q_routes_resolved_default,
    "routes_resolved_unreadable": q_routes_resolved_unreadable,
    "stg_by_name": q_stg_by_name,
    "table_replaced": q_table_replaced,
    "raw_json_from_text": q_raw_json_from_text,
    "raw_json_rejected": q_raw_json_rejected,
    "archive_switch": q_archive_switch,
    "build_quote_batch_run": q_build_quote_batch_run,
}
