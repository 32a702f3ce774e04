"""Register the layered tables in the session catalog, one namespace per layer.

After registration the layers are addressable by full name in SQL
(``MART.mart_lowest_price_by_route_date``) and through ``spark.table``.
Registration is idempotent; call it again after writes that add
partitions so the catalog lists them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from skyfare.schemas import CORE_STORED, PARTITION_COLUMN, SUPPORTED_ROUTES
from skyfare.sources import tables as T
from skyfare.sources.tables import Warehouse, namespace


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


LOCATION_PROPERTY, ZONE_PROPERTY = "skyfare.location", "skyfare.zone"

# STG as a view of RAW: ``operators.layers.stg_quotes`` in SQL.
STG_SELECT = """SELECT CAST(origin AS STRING) AS origin, CAST(destination AS STRING) AS destination,
       CAST(origin AS STRING) || '-' || CAST(destination AS STRING) AS route_code,
       CAST(departure_date AS DATE) AS departure_date, CAST(quote_ts AS TIMESTAMP) AS quote_ts,
       CAST(price_aud AS DECIMAL(10,2)) AS price_aud, coalesce(CAST(stops AS INT), 0) AS stops,
       CAST(airline_code AS STRING) AS airline_code, CAST(source AS STRING) AS source,
       CAST(cabin AS STRING) AS cabin
FROM {raw}"""


def _properties(spark: SparkSession, full_name: str) -> tuple[str, str, dict]:
    """(table type, location, properties) of a catalog table."""
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").collect()}
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {full_name}").collect()}
    return rows.get("Type", ""), rows.get("Location", ""), props


def _release(spark: SparkSession, full_name: str) -> None:
    """Drop the entry of a table that this library registered, so that its name
    can be pointed elsewhere. Its data stay: the table is external. It is ours
    if it records the place it points to, and still points there; any other
    table of the name is someone else's and is not touched."""
    if not spark.catalog.tableExists(full_name):
        return
    kind, location, props = _properties(spark, full_name)
    ours = props.get(LOCATION_PROPERTY)
    if kind != "EXTERNAL" or ours is None or _plain(ours) != _plain(location):
        raise ValueError(f"{full_name} exists as a {kind} table at {location or 'no location'} that this "
                         "library did not register; not replacing it")
    spark.sql(f"DROP TABLE {full_name}")


def _plain(location: str) -> str:
    """A location without the ``file:`` scheme and slashes that Spark adds."""
    path = location.removeprefix("file:")
    return ("/" + path.lstrip("/") if location.startswith(("file:", "/")) else path).rstrip("/")


def _table(spark: SparkSession, full_name: str, schema: StructType, path: str,
           partitioned: bool = True) -> None:
    part = f" PARTITIONED BY ({PARTITION_COLUMN})" if partitioned else ""
    _release(spark, full_name)
    zone = T.table_zone(spark, path)
    props = {LOCATION_PROPERTY: path} | ({ZONE_PROPERTY: zone} if zone else {})
    text = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    spark.sql(f"CREATE TABLE {full_name} ({_ddl(schema)}) USING parquet{part} "
              f"LOCATION '{path}' TBLPROPERTIES ({text})")
    if partitioned:
        spark.sql(f"ALTER TABLE {full_name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(full_name)


def create_or_replace(spark: SparkSession, wh: Warehouse, layer: str, table: str, schema: StructType,
                      zone: str | None = None) -> str:
    """CREATE OR REPLACE a layer's table, empty and with the declared schema;
    its full name. The old rows go. A table of that name which is not ours is
    refused before anything is deleted."""
    full, path = f"{namespace(layer)}.{table}", wh.path(layer, table)
    _namespace(spark, wh, layer)
    _release(spark, full)
    T.create_table(spark, path, schema, replace=True)
    T.store_zone(spark, path, zone or spark.conf.get("spark.sql.session.timeZone"))
    _table(spark, full, schema, path, partitioned=PARTITION_COLUMN in schema.names)
    return full


def _namespace(spark: SparkSession, wh: Warehouse, layer: str) -> None:
    ns = namespace(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{wh.root.rstrip('/')}/{ns}'")


def register_catalog(spark: SparkSession, wh: Warehouse, routes_path: str | None = None) -> dict:
    """Create the layer namespaces and register every table that exists."""
    names = {}
    for layer in ("raw", "stg", "core", "mart"):
        _namespace(spark, wh, layer)
    specs = [("raw", T.RAW_QUOTES_TABLE, T.RAW_QUOTES_STORED, wh.raw_quotes),
             ("raw", T.RAW_JSON_TABLE, T.RAW_JSON_STORED, wh.raw_json),
             ("core", T.CORE_TABLE, CORE_STORED, wh.core),
             ("mart", T.MART_TABLE, CORE_STORED, wh.mart)]
    for layer, table, schema, path in specs:
        if T.fs_exists(spark, path):
            full = f"{namespace(layer)}.{table}"
            _table(spark, full, schema, path)
            names[table] = full
    if T.fs_exists(spark, wh.raw_quotes):
        # STG stays a view: stored in its namespace for every session, and
        # inlined into every reader.
        full = f"{namespace('stg')}.{T.STG_VIEW}"
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS " + STG_SELECT.format(raw=names[T.RAW_QUOTES_TABLE]))
        names[T.STG_VIEW] = full
    if routes_path:
        full = f"{namespace('core')}.{T.ROUTES_TABLE}"
        _table(spark, full, SUPPORTED_ROUTES, routes_path, partitioned=False)
        names[T.ROUTES_TABLE] = full
    return names
