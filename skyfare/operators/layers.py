"""RAW -> STG -> CORE -> MART."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfare.functions import day_start, local_date, route_code
from skyfare.schemas import CORE_COLUMNS, CORE_GRAIN, PARTITION_COLUMN, PRICE, STG_COLUMNS


def stg_quotes(raw: DataFrame) -> DataFrame:
    """Typed staging view: casts, ``route_code``, stops defaulted to 0."""
    typed = raw.select(
        F.col("origin").cast("string").alias("origin"),
        F.col("destination").cast("string").alias("destination"),
        F.col("departure_date").cast("date").alias("departure_date"),
        F.col("quote_ts").cast("timestamp").alias("quote_ts"),
        F.col("price_aud").cast(PRICE).alias("price_aud"),
        F.col("stops").cast("int").alias("stops"),
        F.col("airline_code").cast("string").alias("airline_code"),
        F.col("source").cast("string").alias("source"),
        F.col("cabin").cast("string").alias("cabin"),
    )
    return typed.select(
        "origin", "destination",
        route_code(F.col("origin"), F.col("destination")).alias("route_code"),
        "departure_date", "quote_ts", "price_aud",
        F.coalesce(F.col("stops"), F.lit(0)).alias("stops"),
        "airline_code", "source", "cabin",
    ).select(*STG_COLUMNS)


def cheapest_first() -> list:
    """Order within a (route, departure, day) group: lowest price first, then
    the latest observation; the rest only makes equal rows repeatable.
    A NULL price never wins while a priced row exists."""
    return [F.col("price_aud").asc_nulls_last(),
            F.col("quote_ts").desc_nulls_first(),
            F.col("airline_code").asc_nulls_last(),
            F.col("stops").asc_nulls_last(),
            F.col("source").asc_nulls_last(),
            F.col("cabin").asc_nulls_last()]


def core_daily_quotes(stg: DataFrame, zone: str | None = None,
                      with_partition: bool = False) -> DataFrame:
    """One row per (route_code, departure_date, quote_day): the cheapest.

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so each map task forwards at most one row per
    group; a hot group costs at most one row per task in the exchange.
    """
    base = stg.withColumn("quote_day", day_start(F.col("quote_ts"), zone))
    w = Window.partitionBy(*CORE_GRAIN).orderBy(*cheapest_first())
    ranked = base.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
    out = ranked.select(
        "route_code", "origin", "destination", "departure_date", "quote_day",
        F.col("price_aud").alias("daily_min_price_aud"),
        "stops", "airline_code", "source", "cabin",
        F.col("quote_ts").alias("observed_at"),
    )
    if with_partition:
        out = out.withColumn(PARTITION_COLUMN, local_date(F.col("observed_at"), zone))
    return out


def mart_lowest_price(core: DataFrame) -> DataFrame:
    """Business-facing copy of CORE (same 11 columns, same grain)."""
    cols = list(CORE_COLUMNS)
    if PARTITION_COLUMN in core.columns:
        cols.append(PARTITION_COLUMN)
    return core.select(*cols)
