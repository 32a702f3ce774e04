"""Keyed upsert, appends and deletes on partitioned Parquet tables.

There is no table format with MERGE/DELETE here. A mutation touches
``quote_date`` partitions in one of two ways:

- *rewrite*: the new content of a whole partition is staged in the shared
  checkpoint folder and replaces it by a dynamic overwrite;
- *append*: new files, staged in partition layout under the table's hidden
  ``_pending`` folder, are renamed into place. Partitions that only gain rows
  are never read or rewritten.

Staging cuts lineage: a lost executor recomputes from staging, never from files
that are being replaced. A pending marker (a small JSON file) then names what
is staged; both ways can be repeated, so a driver that dies part-way through is
made good by ``recover_pending``, which every mutation runs first.

A mutation may carry an operation (stream, epoch). It is recorded in the
table's ``_applied`` folder before its marker goes, and is skipped when it
comes again: a replayed micro-batch changes nothing, whatever its rows.
Single writer per table is assumed.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyfare.functions import empty_frame
from skyfare.schemas import PARTITION_COLUMN, PRICE, QUOTE_KEY, UPDATABLE
from skyfare.session import scratch_path
from skyfare.sources import tables as T

PENDING_DIR, APPLIED_DIR = "_pending", "_applied"
OP = "_op"          # staged row flag: kept / updated / inserted / deleted
Operation = tuple[str, int]     # (stream, epoch)


@dataclass
class UpsertResult:
    input_rows: int      # rows handed in (what the caller reports as loaded)
    inserted: int
    updated: int         # target rows overwritten by a matching source row
    staging_path: str = ""
    touched: list = field(default_factory=list)     # quote_date values that got a row (None: the NULL partition)
    rewritten: list = field(default_factory=list)   # those of them whose old rows were replaced
    append_path: str = ""
    skipped: bool = False


def _touched(dates: DataFrame) -> list:
    """Distinct touched partition values, NULL included. One value per calendar
    day at most, whatever the size of the batch, so the list is bounded by the
    calendar; it prunes the target's partitions when the scan is planned."""
    return [r[0] for r in dates.select(PARTITION_COLUMN).distinct().collect()]


def _any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _staged_schema(kind: str) -> StructType:
    """``kind`` is ``<table>`` or ``<table>-delete``, table ``quotes``/``json``."""
    base = T.RAW_QUOTES_STORED if kind.split("-")[0] == "quotes" else T.RAW_JSON_STORED
    return StructType(list(base.fields)).add(OP, "string")


def write_staged(df: DataFrame, path: str) -> None:
    """Stage rows as plain Parquet (``quote_date`` an ordinary column).

    Staging's layout does not matter, because the swap re-lays the rows
    out, so staging skips the partitioned writer's rebalance shuffle:
    each task writes its rows once, and the touched data is shuffled once
    (at the swap), not twice.
    """
    df.write.mode("overwrite").parquet(path)


def read_staged(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(_staged_schema(kind)).parquet(path)


def _folder(target: str, name: str) -> str:
    return f"{target.rstrip('/')}/{name}"


def mark_pending(spark: SparkSession, target: str, kind: str, staged: str = "", append: str = "",
                 op: Operation | None = None) -> str:
    """Leave the marker of a staged mutation: from here on it will be applied."""
    marker = f"{_folder(target, PENDING_DIR)}/{uuid.uuid4().hex}.json"
    T.fs_write_text(spark, marker, json.dumps({"kind": kind, "staged": staged, "append": append, "op": op}))
    return marker


def applied(spark: SparkSession, target: str, op: Operation | None) -> bool:
    """Whether the table has this epoch of the stream, or a later one."""
    if op is None:
        return False
    folder = f"{_folder(target, APPLIED_DIR)}/{op[0]}"
    return T.fs_exists(spark, folder) and any(int(n) >= op[1] for n in T.fs_list(spark, folder))


def _record(spark: SparkSession, target: str, op: Operation | None) -> None:
    if op is None:
        return
    folder = f"{_folder(target, APPLIED_DIR)}/{op[0]}"
    T.fs_touch(spark, f"{folder}/{op[1]}")
    # A stream replays its last epoch only, so earlier records can go.
    for name in T.fs_list(spark, folder):
        if int(name) < op[1]:
            T.fs_delete(spark, f"{folder}/{name}")


def _apply(spark: SparkSession, target: str, kind: str, staged_path: str, append_path: str = "") -> None:
    """Swap rewritten partitions, then move appended files in (repeatable: the
    two never share a partition, and a moved file is not there to move again)."""
    if staged_path:
        staged = read_staged(spark, staged_path, kind)
        T.write_partitioned(staged.filter(F.col(OP) != "deleted").drop(OP), target, mode="overwrite")
        if kind.endswith("-delete"):
            # A partition whose every row was deleted is not touched by a dynamic
            # overwrite, so it is removed explicitly; only those names reach the driver.
            emptied = (staged.groupBy(PARTITION_COLUMN)
                       .agg(F.bool_or(F.col(OP) != "deleted").alias("_kept"))
                       .filter(~F.col("_kept")).collect())
            for r in emptied:
                name = "__HIVE_DEFAULT_PARTITION__" if r[0] is None else r[0].isoformat()
                T.fs_delete(spark, f"{target.rstrip('/')}/{PARTITION_COLUMN}={name}")
    if append_path:
        T.fs_move_partitions(spark, append_path, target)


def _finish(spark: SparkSession, target: str, marker: str) -> None:
    """Apply what a marker names, record its operation, and clean up."""
    todo = json.loads(T.fs_read_text(spark, marker))
    _apply(spark, target, todo["kind"], todo["staged"], todo["append"])
    _record(spark, target, todo["op"] and tuple(todo["op"]))
    T.fs_delete(spark, marker)
    for path in (todo["staged"], todo["append"]):
        if path:
            T.fs_delete(spark, path)


def recover_pending(spark: SparkSession, target: str) -> int:
    """Finish mutations whose driver died between staging and the end of the
    swap; drop what one had staged without getting as far as its marker."""
    folder = _folder(target, PENDING_DIR)
    if not T.fs_exists(spark, folder):
        return 0
    markers = [n for n in T.fs_list(spark, folder) if n.endswith(".json")]
    for name in markers:
        _finish(spark, target, f"{folder}/{name}")
    T.fs_delete(spark, folder)
    return len(markers)


def stage_batch(batch: DataFrame, path: str, order_col: str | None, zone: str | None) -> tuple[int, list]:
    """Write the batch once, the last row of each key only (a key with a NULL
    part is no key: all its rows stay); (rows handed in, quote dates). Both are
    observed on the way to the file, not counted by jobs of their own."""
    seen = Observation()
    rows = batch.select(*QUOTE_KEY, *UPDATABLE, *([order_col] if order_col else [])).withColumns({
        "price_aud": F.col("price_aud").cast(PRICE), PARTITION_COLUMN: T.partition_of(F.col("quote_ts"), zone),
        "_id": F.monotonically_increasing_id()})
    dates = F.collect_set(F.col(PARTITION_COLUMN).cast("string"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), dates.alias("dates"),
                        F.count_if(F.col(PARTITION_COLUMN).isNull()).alias("undated"))
    alone = F.when(_any_null(QUOTE_KEY), F.col("_id"))
    newest = F.col(order_col or "_id").desc_nulls_last()
    last = Window.partitionBy(*QUOTE_KEY, alone).orderBy(newest)
    (rows.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1")
     .select(*QUOTE_KEY, *UPDATABLE, PARTITION_COLUMN).write.parquet(path))
    found = seen.get
    days = [_dt.date.fromisoformat(d) for d in sorted(found["dates"])] + [None] * bool(found["undated"])
    return found["n"], days


def probe_matches(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Key and partition of the target rows that a batch row matches. Reads the
    key columns of the target only; the result is no larger than the batch
    (times the copies of a key that the target holds), and all later steps
    join it instead of the target."""
    key = [*QUOTE_KEY, PARTITION_COLUMN]
    return target.select(*key).join(batch.select(*key), key, "left_semi").distinct()


def rewritten_rows(target: DataFrame, batch: DataFrame, matched: DataFrame) -> DataFrame:
    """The new content of the partitions that hold a match, from one scan of
    them: rows flagged kept / updated / inserted."""
    news = batch.select(*QUOTE_KEY, *[F.col(c).alias(f"_s_{c}") for c in UPDATABLE], F.lit(True).alias("_hit"))
    joined = target.join(news, QUOTE_KEY, "left")
    hit = F.col("_hit").isNotNull()
    kept = joined.select(
        *QUOTE_KEY, *[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in UPDATABLE],
        "cabin", PARTITION_COLUMN, F.when(hit, F.lit("updated")).otherwise(F.lit("kept")).alias(OP))
    return kept.unionByName(new_rows(batch, matched))


def new_rows(batch: DataFrame, matched: DataFrame) -> DataFrame:
    """Batch rows whose key the target does not hold. A key with a NULL part
    equals nothing, so the anti-join keeps its rows."""
    new = batch.join(matched.select(*QUOTE_KEY), QUOTE_KEY, "left_anti")
    return new.select(*QUOTE_KEY, *UPDATABLE, F.lit(None).cast("string").alias("cabin"), PARTITION_COLUMN,
                      F.lit("inserted").alias(OP))


def stage_upsert(spark: SparkSession, target_path: str, batch: DataFrame,
                 order_col: str | None = "seq", zone: str | None = None) -> UpsertResult:
    """Compute and stage an upsert: the content of the partitions that hold a
    match, and the files to add to the others. Counts are observed on the
    writes themselves."""
    zone = T.settle_zone(spark, target_path, zone)
    work = scratch_path(spark, "upsert")
    n, days = stage_batch(batch, f"{work}/batch", order_col, zone)
    stored = StructType([f for f in T.RAW_QUOTES_STORED.fields if f.name != "cabin"])
    rows = spark.read.schema(stored).parquet(f"{work}/batch")
    target = (T.read_quotes(spark, target_path).filter(T.in_partitions(days))
              if T.fs_exists(spark, target_path) else empty_frame(spark, T.RAW_QUOTES_STORED))
    seen = Observation()
    (probe_matches(target, rows).observe(seen, F.collect_set(PARTITION_COLUMN).alias("days"))
     .write.parquet(f"{work}/matched"))
    matched = spark.read.schema(StructType([f for f in stored.fields if f.name in (*QUOTE_KEY, PARTITION_COLUMN)])
                                ).parquet(f"{work}/matched")
    hit_days = sorted(seen.get["days"])
    res = UpsertResult(n, 0, 0, touched=days, rewritten=hit_days)
    inserted, updated = F.count_if(F.col(OP) == "inserted"), F.count_if(F.col(OP) == "updated")
    if hit_days:
        counts, here = Observation(), T.in_partitions(hit_days)
        res.staging_path = f"{scratch_path(spark, 'upsert-staging')}"
        write_staged(rewritten_rows(target.filter(here), rows.filter(here), matched).observe(
            counts, inserted.alias("inserted"), updated.alias("updated")), res.staging_path)
        res.inserted, res.updated = counts.get["inserted"], counts.get["updated"]
    if set(days) - set(hit_days):
        counts, res.append_path = Observation(), f"{_folder(target_path, PENDING_DIR)}/{uuid.uuid4().hex}"
        rest = rows.filter(~F.coalesce(T.in_partitions(hit_days), F.lit(False))) if hit_days else rows
        T.write_partitioned(new_rows(rest, matched).observe(counts, inserted.alias("inserted")).drop(OP),
                            res.append_path, mode="overwrite", static=True)
        res.inserted += counts.get["inserted"]
    T.fs_delete(spark, work)
    return res


def upsert_quotes(spark: SparkSession, target_path: str, batch: DataFrame,
                  order_col: str | None = "seq", zone: str | None = None,
                  op: Operation | None = None) -> UpsertResult:
    """MERGE the batch into the raw quotes table on (origin, destination,
    departure_date, quote_ts).

    - duplicate keys in the batch: the last one (highest ``order_col``) wins;
    - a matched row takes price, stops, airline and source from the batch,
      NULLs included; ``cabin`` is never written by the upsert;
    - every target row with the key is updated;
    - a key with a NULL part never matches and is always inserted;
    - an operation the table has already is skipped as a whole.
    """
    recover_pending(spark, target_path)
    zone = T.settle_zone(spark, target_path, zone)
    if applied(spark, target_path, op):
        dates = batch.select(T.partition_of(F.col("quote_ts"), zone).alias(PARTITION_COLUMN))
        return UpsertResult(0, 0, 0, touched=_touched(dates), skipped=True)
    res = stage_upsert(spark, target_path, batch, order_col, zone)
    _finish(spark, target_path, mark_pending(spark, target_path, "quotes", res.staging_path, res.append_path, op))
    return res


def append_rows(df: DataFrame, path: str, kind: str = "quotes", zone: str | None = None,
                op: Operation | None = None) -> bool:
    """Append rows (e.g. a literal smoke row) to a raw table; False if the table
    has the operation already. A mutation left half-way is finished first: its
    swap would otherwise drop what is appended."""
    spark = df.sparkSession
    recover_pending(spark, path)
    if applied(spark, path, op):
        return False
    zone = T.settle_zone(spark, path, zone)
    staged = f"{_folder(path, PENDING_DIR)}/{uuid.uuid4().hex}"
    write = T.write_quotes if kind == "quotes" else T.write_json_rows
    write(df, staged, mode="append", zone=zone)
    _finish(spark, path, mark_pending(spark, path, kind, append=staged, op=op))
    return True


def delete_where(spark: SparkSession, path: str, predicate: Column, kind: str = "quotes") -> int:
    """Delete the rows for which ``predicate`` is true (NULL keeps the row).

    Only partitions holding a matching row are rewritten; a partition left
    empty is removed. Returns the number of deleted rows.
    """
    recover_pending(spark, path)
    read = T.read_quotes if kind == "quotes" else T.read_json_rows
    table = read(spark, path)
    hit = F.coalesce(predicate, F.lit(False))
    values = _touched(table.filter(hit))
    if not values:
        return 0
    touched = table.filter(T.in_partitions(values))
    staged_path = scratch_path(spark, "delete-staging")
    flagged = touched.withColumn(OP, F.when(hit, F.lit("deleted")).otherwise(F.lit("kept")))
    write_staged(flagged, staged_path)
    deleted = (read_staged(spark, staged_path, kind)
               .filter(F.col(OP) == "deleted").count())
    _finish(spark, path, mark_pending(spark, path, f"{kind}-delete", staged_path))
    return deleted


def delete_by_source(spark: SparkSession, path: str, source: str) -> int:
    return delete_where(spark, path, F.col("source") == F.lit(source))


def delete_by_json_path(spark: SparkSession, path: str, route: str, json_path: str,
                        value: str) -> int:
    pred = (F.col("route_code") == F.lit(route)) & \
        (F.try_variant_get("response", json_path, "string") == F.lit(value))
    return delete_where(spark, path, pred, kind="json")
