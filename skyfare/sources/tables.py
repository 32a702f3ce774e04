"""Layered Parquet tables: locations, declared-schema reads, partitioned writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from skyfare.functions import empty_frame, local_date
from skyfare.schemas import PARTITION_COLUMN, RAW_JSON, RAW_QUOTES

DEFAULT_NAMESPACE = "PUBLIC"

# Table name per layer.
RAW_QUOTES_TABLE = "price_quotes_parsed"
RAW_JSON_TABLE = "price_quotes_json"
STG_VIEW = "stg_price_quotes_parsed"
CORE_TABLE = "core_daily_quotes"
MART_TABLE = "mart_lowest_price_by_route_date"
ROUTES_TABLE = "dim_supported_routes"


def namespace(layer: str | None, default: str = DEFAULT_NAMESPACE) -> str:
    """A configured layer name maps to its upper-cased namespace; no layer
    falls back to the default namespace."""
    return layer.upper() if layer else default


@dataclass(frozen=True)
class Warehouse:
    """Root folder holding one sub-folder per layer namespace."""
    root: str

    def path(self, layer: str | None, table: str) -> str:
        return f"{self.root.rstrip('/')}/{namespace(layer)}/{table}"

    @property
    def raw_quotes(self) -> str:
        return self.path("raw", RAW_QUOTES_TABLE)

    @property
    def raw_json(self) -> str:
        return self.path("raw", RAW_JSON_TABLE)

    @property
    def core(self) -> str:
        return self.path("core", CORE_TABLE)

    @property
    def mart(self) -> str:
        return self.path("mart", MART_TABLE)


def with_partition(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(PARTITION_COLUMN, DateType())])


RAW_QUOTES_STORED = with_partition(RAW_QUOTES)
RAW_JSON_STORED = with_partition(RAW_JSON)


def fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def fs_delete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fs_list(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def fs_touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwriting one that exists)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(p, True).close()


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    tmp, fs = _fs(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(tmp, _fs(spark, path)[0]):
        raise OSError(f"cannot write {path}")


def fs_read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    source = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(fs.open(p))
    return bytes(source).decode()


def fs_move_partitions(spark: SparkSession, source: str, target: str) -> int:
    """Rename the files of each ``quote_date=...`` folder of ``source`` into the
    folder of that name in ``target``: no data passes the driver. A file keeps
    its (unique) name, so a second call moves only what the first one left."""
    root, fs = _fs(spark, source)
    moved = 0
    if not fs.exists(root):
        return 0
    for part in fs.listStatus(root):
        name = part.getPath().getName()
        if not name.startswith(f"{PARTITION_COLUMN}="):
            continue
        folder, _ = _fs(spark, f"{target.rstrip('/')}/{name}")
        fs.mkdirs(folder)
        for f in fs.listStatus(part.getPath()):
            if f.isFile() and not f.getPath().getName().startswith(("_", ".")):
                to, _ = _fs(spark, f"{folder}/{f.getPath().getName()}")
                if not fs.rename(f.getPath(), to):
                    raise OSError(f"cannot move {f.getPath()} to {to}")
                moved += 1
    return moved


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a partitioned table with its declared schema (never inferred)."""
    return (spark.read.schema(schema).option("basePath", path)
            .option("mergeSchema", "false").parquet(path))


def create_table(spark: SparkSession, path: str, schema: StructType,
                 replace: bool = True) -> None:
    """Create (or replace) an empty table with the declared schema."""
    if not replace and fs_exists(spark, path):
        return
    empty = empty_frame(spark, schema)
    write_partitioned(empty, path, mode="overwrite", static=True)


def in_partitions(values: list) -> Column:
    """Predicate for ``quote_date`` in ``values``; a None entry selects the
    NULL (default) partition."""
    part = F.col(PARTITION_COLUMN)
    dated = [v for v in values if v is not None]
    cond = part.isin(dated) if dated else F.lit(False)
    if len(dated) < len(values):
        cond = cond | part.isNull()
    return cond


ZONE_FILE = "_zone"


def table_zone(spark: SparkSession, path: str) -> str | None:
    """The zone a table's days are cut in, as stored with it."""
    stored = f"{path.rstrip('/')}/{ZONE_FILE}"
    return fs_read_text(spark, stored) if fs_exists(spark, stored) else None


def store_zone(spark: SparkSession, path: str, zone: str) -> None:
    own = table_zone(spark, path)
    if own == zone:
        return
    if own is not None:
        fs_delete(spark, f"{path.rstrip('/')}/{ZONE_FILE}")
    fs_write_text(spark, f"{path.rstrip('/')}/{ZONE_FILE}", zone)


def settle_zone(spark: SparkSession, path: str, zone: str | None, store: bool = True) -> str:
    """The zone to cut days in: the table's own. A table without one takes
    ``zone``, else the session's, and keeps it from then on, whatever zone a
    later session has; asking for another zone than the table's is an error."""
    own = table_zone(spark, path)
    if own is None:
        own = zone or spark.conf.get("spark.sql.session.timeZone")
        if store:
            store_zone(spark, path, own)
    elif zone is not None and zone != own:
        raise ValueError(f"{path} cuts days in {own}, not in {zone}")
    return own


def partition_of(ts: Column, zone: str | None = None) -> Column:
    return local_date(ts, zone)


def layout(df: DataFrame, sort_cols: list[str], laid_out: bool = False) -> DataFrame:
    """Physical layout for a partitioned write.

    ``laid_out``: the rows come from a table of the same partitions, so a task
    that reads a file holds rows of its day already and nothing is exchanged.

    ``rebalance`` on the partition column lets AQE split a heavy day over
    several tasks and merge light ones, so each day gets a few large files
    rather than one file per task; the in-file sort clusters row groups for
    min/max skipping on the usual filter columns.
    """
    present = [c for c in sort_cols if c in df.columns]
    placed = df if laid_out else df.hint("rebalance", PARTITION_COLUMN)
    return placed.sortWithinPartitions(PARTITION_COLUMN, *present)


def write_partitioned(df: DataFrame, path: str, mode: str = "append",
                      static: bool = False,
                      sort_cols: tuple[str, ...] = ("route_code", "origin", "destination",
                                                    "departure_date"),
                      laid_out: bool = False) -> None:
    w = layout(df, list(sort_cols), laid_out).write.mode(mode).partitionBy(PARTITION_COLUMN)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "static" if static else "dynamic")
    w.parquet(path)


def write_quotes(df: DataFrame, path: str, mode: str = "append", zone: str | None = None,
                 static: bool = False) -> None:
    """Write raw quotes partitioned by the local date of ``quote_ts`` in the
    table's zone. A static overwrite makes a new table, with a zone of its own."""
    spark = df.sparkSession
    zone = (zone or spark.conf.get("spark.sql.session.timeZone")) if static else settle_zone(spark, path, zone)
    out = df.select(*[f.name for f in RAW_QUOTES.fields])
    out = out.withColumn(PARTITION_COLUMN, partition_of(F.col("quote_ts"), zone))
    write_partitioned(out, path, mode=mode, static=static)
    if static:
        store_zone(spark, path, zone)       # the overwrite took the old one away


def write_json_rows(df: DataFrame, path: str, mode: str = "append",
                    zone: str | None = None) -> None:
    """Write raw JSON responses partitioned by the local date of ingestion in
    the table's zone."""
    zone = settle_zone(df.sparkSession, path, zone)
    out = df.select(*[f.name for f in RAW_JSON.fields])
    out = out.withColumn(PARTITION_COLUMN, partition_of(F.col("ingested_at"), zone))
    write_partitioned(out, path, mode=mode, sort_cols=("route_code",))


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, RAW_QUOTES_STORED)


def read_json_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, RAW_JSON_STORED)
