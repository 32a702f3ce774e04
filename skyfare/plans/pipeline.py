"""The layered refresh: RAW -> STG (view) -> CORE (table) -> MART (table) -> checks.

CORE and MART are partitioned by ``quote_date``, the local date of the
quote in the truncation zone. Because CORE's window partition contains
``quote_day``, recomputing only the touched dates gives exactly the full
refresh result, provided truncation and partitioning use the same zone.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.operators import layers, mutation, quality
from skyfare.schemas import CORE_STORED, PARTITION_COLUMN
from skyfare.sources import tables as T
from skyfare.sources.tables import Warehouse


@dataclass
class RefreshResult:
    core_path: str
    mart_path: str
    checks: DataFrame


def _days(dates: list) -> list:
    """Quote dates as ``datetime.date`` (None stays: the NULL partition). Text
    and timestamps are read by their date part; anything else is refused."""
    out = []
    for d in dates:
        if isinstance(d, _dt.datetime):
            d = d.date()
        if d is not None and not isinstance(d, _dt.date):
            d = _dt.date.fromisoformat(str(d).strip()[:10])
        out.append(d)
    return list(dict.fromkeys(out))


def refresh_layers(spark: SparkSession, wh: Warehouse, zone: str | None = None,
                   dates: list | None = None, run_checks: bool = True,
                   fail_on_checks: bool = True, check_scope: str | None = None) -> RefreshResult:
    """Rebuild CORE and MART; all of them, or only the given quote dates.

    Days are cut in RAW's zone; CORE and MART are given the same, and one that
    was built in another zone can only be rebuilt as a whole.

    MART is derived from the CORE just written (a read of the written
    table), never from the in-memory plan, so each step restarts from
    durable files.

    ``check_scope``: ``"all"`` checks whole tables; ``"touched"`` (the
    default for an incremental refresh) checks the rebuilt partitions plus
    RAW's NULL-date partition. That is exact for anything the run could
    have changed: untouched partitions are byte-for-byte what an earlier run
    checked, and a CORE/MART duplicate cannot span partitions because the
    grain contains ``quote_day``.
    """
    scope = check_scope or ("all" if dates is None else "touched")
    dates = None if dates is None else _days(dates)
    mutation.recover_pending(spark, wh.raw_quotes)
    zone = T.settle_zone(spark, wh.raw_quotes, zone)
    if dates is not None:
        for table in (wh.core, wh.mart):
            T.settle_zone(spark, table, zone)
    raw = T.read_quotes(spark, wh.raw_quotes)
    if dates is not None:
        # The partition column is derived from quote_ts in the same zone
        # as quote_day, so this filter prunes RAW partitions and is exact.
        raw = raw.filter(T.in_partitions(list(dates)))
    stg = layers.stg_quotes(raw)
    core = layers.core_daily_quotes(stg, zone=zone, with_partition=True)
    mode_static = dates is None
    T.write_partitioned(core, wh.core, mode="overwrite", static=mode_static)
    if dates is not None:
        _drop_vanished(spark, wh, raw, list(dates))
    core_t = T.read_stored(spark, wh.core, CORE_STORED)
    core_new = core_t if dates is None else core_t.filter(T.in_partitions(list(dates)))
    # CORE's files hold one day each: MART is written from them as they lie.
    T.write_partitioned(layers.mart_lowest_price(core_new), wh.mart, mode="overwrite",
                        static=mode_static, laid_out=True)
    for table in (wh.core, wh.mart):
        T.store_zone(spark, table, zone)
    mart_t = T.read_stored(spark, wh.mart, CORE_STORED)
    checks = None
    if run_checks:
        raw_t = T.read_quotes(spark, wh.raw_quotes)
        if scope == "touched" and dates is not None:
            raw_t = raw_t.filter(T.in_partitions(list(dates) + [None]))
            core_t = core_t.filter(T.in_partitions(list(dates)))
            mart_t = mart_t.filter(T.in_partitions(list(dates)))
        checks = quality.run_checks({"stg": layers.stg_quotes(raw_t), "core": core_t,
                                     "mart": mart_t}, raw_from_stg=True)
        if fail_on_checks:
            quality.gate(checks)
    return RefreshResult(wh.core, wh.mart, checks)


def _drop_vanished(spark: SparkSession, wh: Warehouse, raw_touched: DataFrame,
                   dates: list) -> None:
    """Touched dates with no RAW rows left produce no CORE rows, and a dynamic
    overwrite would leave their old CORE/MART partitions in place: remove
    them. A CORE partition exists exactly when RAW has rows for that date,
    so only the partition column of the touched RAW partitions is read."""
    present = {r[0] for r in raw_touched.select(PARTITION_COLUMN).distinct().collect()}
    for d in dates:
        if d in present:
            continue
        name = "__HIVE_DEFAULT_PARTITION__" if d is None else str(d)[:10]
        for table in (wh.core, wh.mart):
            T.fs_delete(spark, f"{table.rstrip('/')}/{PARTITION_COLUMN}={name}")


def read_mart(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return T.read_stored(spark, wh.mart, CORE_STORED)


def read_core(spark: SparkSession, wh: Warehouse) -> DataFrame:
    return T.read_stored(spark, wh.core, CORE_STORED)


def setup_tables(spark: SparkSession, wh: Warehouse, replace: bool = False) -> None:
    """Create the raw tables empty, with their declared schemas.
    ``sources.catalog.create_or_replace`` does the same by name."""
    T.create_table(spark, wh.raw_quotes, T.RAW_QUOTES_STORED, replace=replace)
    T.create_table(spark, wh.raw_json, T.RAW_JSON_STORED, replace=replace)


def daily_run(spark: SparkSession, wh: Warehouse, landing: str, checkpoint: str,
              zone: str | None = None, fail_on_checks: bool = True):
    """The scheduled job: load newly landed responses (archive + upsert),
    then rebuild CORE and MART for exactly the quote dates that changed and
    run the checks on them (the gate fails the run)."""
    from skyfare.streaming.ingest import ingest_landed

    # The marker stands from before the first write until refresh and gate have
    # passed. A run that finds one follows a crash or a failed gate: what is
    # out of date, or bad, is then unknown, so all is rebuilt and checked.
    unfinished = f"{checkpoint.rstrip('/')}/_unfinished_run"
    heal = T.fs_exists(spark, unfinished)
    if not heal:
        T.fs_touch(spark, unfinished)
    stats = ingest_landed(spark, wh, landing, checkpoint, zone=zone)
    refreshed = None
    if stats.touched or (heal and T.fs_exists(spark, wh.raw_quotes)):
        full = heal or not T.fs_exists(spark, wh.core)
        refreshed = refresh_layers(spark, wh, zone=zone,
                                   dates=None if full else sorted(stats.touched, key=str),
                                   fail_on_checks=fail_on_checks)
    T.fs_delete(spark, unfinished)
    return stats, refreshed
