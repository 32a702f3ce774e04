"""Declared schemas, one per layer. Nothing in the package infers a schema."""

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType,
                               StringType, StructField, StructType,
                               TimestampType, VariantType)

PRICE = DecimalType(10, 2)

# RAW.PRICE_QUOTES_PARSED (logical columns; ``quote_date`` is the physical
# partition column added on write).
RAW_QUOTES = StructType([
    StructField("origin", StringType()),
    StructField("destination", StringType()),
    StructField("departure_date", DateType()),
    StructField("quote_ts", TimestampType()),
    StructField("price_aud", PRICE),
    StructField("stops", IntegerType()),
    StructField("airline_code", StringType()),
    StructField("source", StringType()),
    StructField("cabin", StringType()),
])
RAW_QUOTE_COLUMNS = [f.name for f in RAW_QUOTES.fields]
QUOTE_KEY = ["origin", "destination", "departure_date", "quote_ts"]
UPDATABLE = ["price_aud", "stops", "airline_code", "source"]

# RAW.PRICE_QUOTES_JSON
RAW_JSON = StructType([
    StructField("ingested_at", TimestampType()),
    StructField("route_code", StringType()),
    StructField("params", VariantType()),
    StructField("response", VariantType()),
])
RAW_JSON_COLUMNS = [f.name for f in RAW_JSON.fields]

# Texts that do not parse as JSON, kept as they came.
REJECTED_JSON = StructType([
    StructField("ingested_at", TimestampType()),
    StructField("route_code", StringType()),
    StructField("params_json", StringType()),
    StructField("response_json", StringType()),
    StructField("reason", StringType()),
])

STG_COLUMNS = ["origin", "destination", "route_code", "departure_date", "quote_ts",
               "price_aud", "stops", "airline_code", "source", "cabin"]

# CORE.core_daily_quotes and MART.mart_lowest_price_by_route_date share one
# column list; grain (route_code, departure_date, quote_day).
CORE_COLUMNS = ["route_code", "origin", "destination", "departure_date", "quote_day",
                "daily_min_price_aud", "stops", "airline_code", "source", "cabin",
                "observed_at"]
CORE_GRAIN = ["route_code", "departure_date", "quote_day"]
PARTITION_COLUMN = "quote_date"

SUPPORTED_ROUTES = StructType([StructField("route_code", StringType())])

USAGE_LOG = StructType([
    StructField("start_time", TimestampType()),
    StructField("resource", StringType()),
    StructField("amount", DoubleType()),
])

AIRLINE_LABELS = StructType([
    StructField("airline_code", StringType()),
    StructField("airline", StringType()),
])

CORE = StructType([
    StructField("route_code", StringType()),
    StructField("origin", StringType()),
    StructField("destination", StringType()),
    StructField("departure_date", DateType()),
    StructField("quote_day", TimestampType()),
    StructField("daily_min_price_aud", PRICE),
    StructField("stops", IntegerType()),
    StructField("airline_code", StringType()),
    StructField("source", StringType()),
    StructField("cabin", StringType()),
    StructField("observed_at", TimestampType()),
])
CORE_STORED = StructType(list(CORE.fields) + [StructField(PARTITION_COLUMN, DateType())])
