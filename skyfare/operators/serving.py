"""Reads behind the fare explorer: routes, cheapest latest fares, trends."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.functions import (airline_name, as_date, aud_label, dollar_label, literal_rows,
                               tolerant_double)
from skyfare.schemas import AIRLINE_LABELS

LATEST_KEY = ["route_code", "departure_date"]


def check_window(start, end) -> None:
    """The date window must be ordered: start <= end."""
    s = _dt.date.fromisoformat(str(start)[:10])
    e = _dt.date.fromisoformat(str(end)[:10])
    if s > e:
        raise ValueError(f"start date {s} is after end date {e}")


def default_window(as_of, days: int = 30) -> tuple[_dt.date, _dt.date]:
    d = _dt.date.fromisoformat(str(as_of)[:10])
    return d, d + _dt.timedelta(days=days)


def routes_in_window(routes: DataFrame, mart: DataFrame, start, end) -> DataFrame:
    """Supported routes that have any mart row departing in [start, end].

    Written as a semi-join against the distinct quoted routes: the mart side
    is reduced map-side to one row per route before anything is exchanged.
    """
    check_window(start, end)
    quoted = (mart.filter(F.col("departure_date").between(as_date(start), as_date(end)))
              .select("route_code").distinct())
    return (routes.select("route_code").distinct()
            .join(quoted, "route_code", "left_semi")
            .orderBy(F.col("route_code").asc_nulls_last()))


def latest_rows(mart: DataFrame) -> DataFrame:
    """Mart rows at the latest quote_day of their (route, departure).

    ``rank() = 1`` by descending day: one scan, and the limit of rank 1 is
    applied to each task's rows before the exchange, so a hot key sends its
    best rows of each task and no more. Rows with a NULL key part or day drop out.
    """
    keyed = mart.filter(F.col("route_code").isNotNull() & F.col("departure_date").isNotNull()
                        & F.col("quote_day").isNotNull())
    newest_first = Window.partitionBy(*LATEST_KEY).orderBy(F.col("quote_day").desc())
    return keyed.withColumn("_age", F.rank().over(newest_first)).filter("_age = 1").drop("_age")


def cheapest_latest(mart: DataFrame, route: str, start, end,
                    limit: int = C.FARE_LIMIT) -> DataFrame:
    """Cheapest fares at the latest quote for one route and departure window."""
    check_window(start, end)
    in_scope = (F.col("route_code") == F.lit(route)) & \
        F.col("departure_date").between(as_date(start), as_date(end))
    # Filters are on the latest-key columns, so applying them before the
    # aggregate gives the same rows as filtering after the join.
    m = mart.filter(in_scope)
    fares = latest_rows(m).select(
        "route_code", "departure_date",
        F.col("daily_min_price_aud").cast("double").alias("price_aud"),
        "airline_code", "stops", "quote_day")
    return (fares.orderBy(F.col("price_aud").asc_nulls_last(),
                          F.col("departure_date").asc_nulls_last(),
                          F.col("airline_code").asc_nulls_last())
            .limit(limit))


def price_trend(mart: DataFrame, route: str, departure) -> DataFrame:
    return (mart.filter((F.col("route_code") == F.lit(route))
                        & (F.col("departure_date") == as_date(departure)))
            .select("route_code", "departure_date", "quote_day",
                    F.col("daily_min_price_aud").cast("double").alias("price_aud"),
                    "airline_code", "stops")
            .orderBy(F.col("quote_day").asc_nulls_last()))


def trend_guarded(trend: DataFrame, lo: float = C.MIN_PRICE,
                  hi: float = C.MAX_PRICE) -> DataFrame:
    """Outlier guard: keep lo <= price <= hi (NULL and NaN drop out)."""
    price = tolerant_double(F.col("price_aud"))
    return trend.withColumn("price_aud", price).filter(price.between(lo, hi))


def airline_table(spark: SparkSession) -> DataFrame:
    """The 11-entry label table: fixed size, always safe to broadcast."""
    return literal_rows(spark, C.AIRLINE_NAMES, AIRLINE_LABELS)


def with_airline(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Left lookup of airline names; unknown codes show the code itself."""
    joined = rows.join(labels.withColumnRenamed("airline", "_airline_name"),
                       "airline_code", "left")
    return joined.withColumn("airline", airline_name(F.col("airline_code"),
                                                     F.col("_airline_name"))).drop("_airline_name")


def trend_display(guarded: DataFrame, labels: DataFrame) -> DataFrame:
    """Chart rows: renamed columns, airline label, date-only quote day."""
    t = with_airline(guarded, labels)
    return t.select(
        F.col("route_code"), F.col("departure_date"),
        F.to_date("quote_day").alias("Quote day"),
        F.col("price_aud").alias("Price_AUD"),
        F.col("airline_code").alias("Airline_Code"),
        F.col("stops").alias("Stops"),
        F.col("airline").alias("Airline"),
        F.date_format(F.to_date("quote_day"), C.AXIS_DATE_FORMAT).alias("quote_day_label"),
        dollar_label(F.col("price_aud")).alias("price_label"),
    )


def fare_display(fares: DataFrame, labels: DataFrame) -> DataFrame:
    """User-facing fare table with formatted prices."""
    f = with_airline(fares.withColumn("price_aud", tolerant_double(F.col("price_aud"))), labels)
    return f.select(
        F.col("route_code").alias("Route"),
        F.col("departure_date").alias("Departure date"),
        aud_label(F.col("price_aud")).alias("Price (AUD)"),
        F.col("airline").alias("Airline"),
        F.col("stops").alias("Stops"),
    )


def kpi_summary(fares: DataFrame) -> DataFrame:
    """Headline numbers over the served fares (after its row cap)."""
    price = tolerant_double(F.col("price_aud"))
    return fares.agg(
        F.min(price).alias("min_price"),
        F.count(F.lit(1)).alias("rows"),
        F.max("quote_day").alias("last_quote_day"),
    ).withColumn("min_price_label", aud_label(F.col("min_price")))


def departure_dates(fares: DataFrame) -> DataFrame:
    return (fares.select("departure_date").distinct()
            .orderBy(F.col("departure_date").asc_nulls_last()))
