"""Ingestion monitoring and usage rollups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.functions import as_date, day_start
from skyfare.operators.serving import latest_rows
from skyfare.schemas import CORE_COLUMNS, PARTITION_COLUMN


def volume_by_quote_day(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("quote_day").agg(F.count(F.lit(1)).alias("quotes"))
            .orderBy(F.col("quote_day").desc_nulls_first()))


def recent(mart: DataFrame, as_of, days: int = C.RECENT_DAYS) -> DataFrame:
    """Rows with ``quote_day >= as_of - days`` (up to days + 1 calendar days).

    When the mart carries its ``quote_date`` partition column the same bound
    is repeated on it, which prunes whole partitions at planning time.
    """
    since = F.date_sub(as_date(as_of), days)
    out = mart.filter(F.col("quote_day") >= since.cast("timestamp"))
    if PARTITION_COLUMN in mart.columns:
        out = out.filter(F.col(PARTITION_COLUMN) >= since)
    return out


def cheapest_recent(mart: DataFrame, as_of, days: int = C.RECENT_DAYS,
                    limit: int = C.RECENT_LIMIT) -> DataFrame:
    return (recent(mart, as_of, days)
            .groupBy("route_code", "departure_date")
            .agg(F.min("daily_min_price_aud").alias("min_price_aud"))
            .orderBy(F.col("min_price_aud").asc_nulls_last(),
                     F.col("route_code").asc_nulls_last(),
                     F.col("departure_date").asc_nulls_last())
            .limit(limit))


def latest_snapshot(mart: DataFrame, limit: int = C.SNAPSHOT_LIMIT) -> DataFrame:
    return (latest_rows(mart).select(*CORE_COLUMNS)
            .orderBy(F.col("daily_min_price_aud").asc_nulls_last(),
                     F.col("route_code").asc_nulls_last(),
                     F.col("departure_date").asc_nulls_last())
            .limit(limit))


def usage_daily_rollup(usage: DataFrame, resource: str, as_of_ts,
                       days: int = C.RECENT_DAYS, zone: str | None = None) -> DataFrame:
    """Daily usage of one resource over the trailing ``days`` days.

    Amounts are summed as decimal(38,9), the metering column's own type,
    so the total does not depend on summation order.
    """
    if isinstance(as_of_ts, _dt.datetime):
        as_of_ts = as_of_ts.isoformat(sep=" ")
    since = F.lit(str(as_of_ts)).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    return (usage.filter((F.col("resource") == F.lit(resource)) & (F.col("start_time") >= since))
            .groupBy(day_start(F.col("start_time"), zone).alias("usage_day"))
            .agg(F.sum(F.col("amount").cast("decimal(38,9)")).alias("credits_used"))
            .orderBy(F.col("usage_day").desc_nulls_first()))


def parsed_row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("parsed_rows"))
