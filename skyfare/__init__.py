"""skyfare: a Spark-native engine for price-quote time series.

Quotes observed over time for a route and departure date are landed as
typed Parquet (plus the raw JSON responses), upserted by key, and refined
through RAW -> STG -> CORE -> MART layers that keep the cheapest quote per
route, departure date and quote day. Serving, monitoring and data-quality
operators are lazy DataFrame plans over those layers.
"""

__version__ = "0.1.0"
