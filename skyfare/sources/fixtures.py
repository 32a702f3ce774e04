"""Projections of the driver's tables onto the pipeline's schemas.

Every projection is a lazy, per-row ``select`` over a Parquet scan (plus,
for the routes dimension, one distinct), so each grows with the input and
keeps column pruning and filter pushdown intact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.operators.ingest import request_params
from skyfare.schemas import PRICE, RAW_QUOTE_COLUMNS

EVENTS_DEPARTURE_BASE = "2024-06-01"
LINEITEM_QUOTE_BASE = "2024-01-01 00:00:00"
LINEITEM_DESTINATIONS = ["BKK", "PNH", "SGN", "MNL", "HND", "ICN"]
EVENT_AIRLINES = ["JQ", "TR", "ZZ"]
UNQUOTED_ROUTE = "MEL-SYD"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def _event_columns(ev: DataFrame) -> dict[str, Column]:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return {
        "origin": F.lit("MEL"),
        "destination": F.upper("event_type"),
        "departure_date": F.date_add(F.lit(EVENTS_DEPARTURE_BASE).cast("date"),
                                     (F.col("user_id") % 7).cast("int")),
        "quote_ts": F.col("ts").cast("timestamp"),
        "price_aud": F.col("value").cast(PRICE),
        "stops": F.nullif(k % 4, F.lit(3)),
        "airline_code": _pick(F.col("event_id") % 3, EVENT_AIRLINES),
        "source": F.lit(C.DEFAULT_SOURCE_NAME),
        "cabin": F.lit(None).cast("string"),
        "k": k,
    }


def events_quotes_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> raw quotes, keeping ``event_id`` and ``k`` for fixtures."""
    ev = table(spark, sf_dir, "events")
    cols = _event_columns(ev)
    return ev.select(F.col("event_id"), *[cols[c].alias(c) for c in RAW_QUOTE_COLUMNS],
                     cols["k"].alias("k"))


def quotes_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_quotes_with_id(spark, sf_dir).select(*RAW_QUOTE_COLUMNS)


def quotes_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` -> raw quotes: the volume projection used by the benchmark."""
    li = table(spark, sf_dir, "lineitem")
    quote_ts = (F.lit(LINEITEM_QUOTE_BASE).cast("timestamp")
                + F.make_dt_interval(days=(F.col("l_orderkey") % 30).cast("int"),
                                     mins=(F.col("l_suppkey") % 1440).cast("int")))
    return li.select(
        F.lit("MEL").alias("origin"),
        _pick(F.col("l_suppkey") % 6, LINEITEM_DESTINATIONS).alias("destination"),
        F.date_add(F.lit(EVENTS_DEPARTURE_BASE).cast("date"),
                   (F.col("l_partkey") % 30).cast("int")).alias("departure_date"),
        quote_ts.alias("quote_ts"),
        F.col("l_extendedprice").cast(PRICE).alias("price_aud"),
        F.nullif(F.col("l_linenumber") - 1, F.lit(6)).alias("stops"),
        F.col("l_returnflag").alias("airline_code"),
        F.lit(C.DEFAULT_SOURCE_NAME).alias("source"),
        F.lit(None).cast("string").alias("cabin"),
    )


def supported_routes_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DIM_SUPPORTED_ROUTES stand-in: every distinct quoted route, plus one
    supported route that has no quotes."""
    ev = table(spark, sf_dir, "events")
    quoted = (ev.filter(F.col("event_type").isNotNull())
              .select(F.concat(F.lit("MEL-"), F.upper("event_type")).alias("route_code"))
              .distinct())
    extra = spark.range(1).select(F.lit(UNQUOTED_ROUTE).alias("route_code"))
    return quoted.unionByName(extra)


def usage_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("ts").cast("timestamp").alias("start_time"),
                     F.col("event_type").alias("resource"),
                     F.col("value").cast("double").alias("amount"))


def seeded_bad_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with planted defects: NULL price where ``event_id % 97 = 0``,
    NULL origin where ``event_id % 101 = 0``. Keeps ``event_id``."""
    q = events_quotes_with_id(spark, sf_dir)
    return q.select(
        "event_id",
        F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("origin")).alias("origin"),
        "destination", "departure_date", "quote_ts",
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast(PRICE))
         .otherwise(F.col("price_aud")).alias("price_aud"),
        "stops", "airline_code", "source", "cabin")


def upsert_fixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, source) pair for the keyed upsert.

    target: events with ``event_id % 10 < 6``.
    source: events with ``event_id % 10 >= 5``, price + 1, ordinal = event_id
    (digit 5 updates, 6-9 insert); plus copies of ``event_id % 50 = 5`` with a
    higher ordinal and price + 2 (last one wins); plus NULL-destination
    copies of ``event_id % 70 = 5`` (a NULL key never matches: insert).
    """
    q = events_quotes_with_id(spark, sf_dir)
    target = q.filter(F.col("event_id") % 10 < 6).select(*RAW_QUOTE_COLUMNS)
    base = q.filter(F.col("event_id") % 10 >= 5)
    bump = lambda d: (F.col("price_aud") + d).cast(PRICE).alias("price_aud")
    cols = lambda price, dest=F.col("destination"): [
        "origin", dest.alias("destination"), "departure_date", "quote_ts", price,
        "stops", "airline_code", "source", "cabin"]
    plain = base.select(*cols(bump(1)), F.col("event_id").alias("seq"))
    later = (q.filter(F.col("event_id") % 50 == 5)
             .select(*cols(bump(2)), (F.col("event_id") + F.lit(10**12)).alias("seq")))
    nullkey = (q.filter(F.col("event_id") % 70 == 5)
               .select(*cols(bump(1), F.lit(None).cast("string")),
                       (F.col("event_id") + F.lit(2 * 10**12)).alias("seq")))
    source = plain.unionByName(later).unionByName(nullkey)
    return target, source


def quotes_from_events_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``quotes_from_events`` with event times read as UTC in any session zone."""
    ev = table(spark, sf_dir, "events")
    c = _event_columns(ev)
    c["quote_ts"] = F.concat(F.col("ts").cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")
    return ev.select(*[c[n].alias(n) for n in RAW_QUOTE_COLUMNS])


def responses_with_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored response per event with ``event_id % 5`` offers in no order
    of price: offer j costs ``value + (7 j + event_id) % 5`` (no price where
    ``(event_id + j) % 11 = 0``), departs on the requested date or, for odd j,
    the day after, has ``(k + j) % 4`` legs and its own airline."""
    ev = table(spark, sf_dir, "events")
    c = _event_columns(ev)
    legs = F.struct(c["origin"].alias("flyFrom"), c["destination"].alias("flyTo"))

    def offer(j):
        at = F.col("event_id") + j
        return F.struct(
            F.when(at % 11 != 0, F.col("value") + (7 * j + F.col("event_id")) % 5).alias("price"),
            F.array_repeat(legs, ((F.coalesce(c["k"], F.lit(0)) + j) % 4).cast("int")).alias("route"),
            F.array(_pick(at % 3, EVENT_AIRLINES)).alias("airlines"),
            F.date_format(F.date_add(c["departure_date"], (j % 2).cast("int")), "yyyy-MM-dd'T'08:30:00").alias(
                "local_departure"))
    n = (F.col("event_id") % 5).cast("int")
    offers = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), offer)
    response = F.to_variant_object(F.struct(offers.alias("data")))
    params = F.to_variant_object(request_params(c["origin"], c["destination"], c["departure_date"]))
    return ev.select(c["quote_ts"].alias("ingested_at"),
                     F.concat(c["origin"], F.lit("-"), c["destination"]).alias("route_code"),
                     params.alias("params"), response.alias("response"))


def json_texts_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON texts that nobody has checked: ``props`` is the request,
    cut short where ``event_id % 11 = 0``; the response has an open brace too
    many where ``event_id % 7 = 0`` and is not there where ``event_id % 13 = 0``."""
    ev = table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"price":'), F.col("event_id").cast("string"), F.lit("}"))
    return ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("ingested_at"),
        F.concat(F.lit("MEL-"), F.upper("event_type")).alias("route_code"),
        F.when(F.col("event_id") % 11 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
         .alias("params_json"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
         .when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), body)).otherwise(body).alias("response_json"))


def responses_from_events(spark: SparkSession, sf_dir: str, empty_objects: bool = False) -> DataFrame:
    """Stored search responses, one per event (RAW JSON table shape).

    The request is the one for (MEL, upper(event_type), departure date);
    the response holds one offer with ``price = value``, ``k % 4`` legs and
    the event's airline. Events with ``event_id % 10 = 0`` got no offers; with
    ``empty_objects``, every second one of them not even a list (``{}``).
    """
    ev = table(spark, sf_dir, "events")
    c = _event_columns(ev)
    legs = F.array_repeat(F.struct(c["origin"].alias("flyFrom"),
                                   c["destination"].alias("flyTo")), c["k"] % 4)
    offer = F.struct(F.col("value").alias("price"), legs.alias("route"),
                     F.array(c["airline_code"]).alias("airlines"))
    nothing = F.when((F.col("event_id") % 20 == 0) & F.lit(empty_objects), F.lit("{}")).otherwise(F.lit('{"data":[]}'))
    response = (F.when(F.col("event_id") % 10 == 0, F.parse_json(nothing))
                .otherwise(F.to_variant_object(F.struct(F.array(offer).alias("data")))))
    params = F.to_variant_object(request_params(c["origin"], c["destination"],
                                                c["departure_date"]))
    return ev.select(c["quote_ts"].alias("ingested_at"),
                     F.concat(c["origin"], F.lit("-"), c["destination"]).alias("route_code"),
                     params.alias("params"), response.alias("response"))


def route_lists_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event route lists in the ``A-B;C-D`` form, with messy tokens:
    lower case, padding, an empty token, a dash-less token, a padded pair
    whose destination itself contains a dash."""
    ev = table(spark, sf_dir, "events")
    csv = F.concat(F.lit(" mel-"), F.lower("event_type"), F.lit(" ; ;MELBKK;\t MEL - "),
                   F.upper(F.substring("event_type", 1, 3)), F.lit("-"),
                   (F.col("user_id") % 7).cast("string"), F.lit(" "))
    dests = F.concat(F.lit(" "), F.lower("event_type"), F.lit(" ,, bkk,PNH "))
    return ev.select(F.col("event_id").alias("list_id"), csv.alias("routes_csv"),
                     dests.alias("destinations"))


def smoke_quote(spark: SparkSession, as_of, as_of_ts) -> DataFrame:
    """The marked test quote, dated ``as_of + 60`` and stamped ``as_of_ts``."""
    return spark.range(1).select(
        F.lit(C.SMOKE_ORIGIN).alias("origin"),
        F.lit(C.SMOKE_DESTINATION).alias("destination"),
        F.date_add(F.lit(str(as_of)).cast("date"), C.SMOKE_DAYS_AHEAD).alias("departure_date"),
        F.lit(str(as_of_ts)).cast("timestamp").alias("quote_ts"),
        F.lit(C.SMOKE_PRICE).cast(PRICE).alias("price_aud"),
        F.lit(C.SMOKE_STOPS).cast("int").alias("stops"),
        F.lit(C.SMOKE_AIRLINE).alias("airline_code"),
        F.lit(C.SMOKE_SOURCE).alias("source"),
        F.lit(C.SMOKE_CABIN).alias("cabin"))


def smoke_json(spark: SparkSession, as_of_ts) -> DataFrame:
    return spark.range(1).select(
        F.lit(str(as_of_ts)).cast("timestamp").alias("ingested_at"),
        F.lit(f"{C.SMOKE_ORIGIN}-{C.SMOKE_DESTINATION}").alias("route_code"),
        F.parse_json(F.lit(C.SMOKE_PARAMS_JSON)).alias("params"),
        F.parse_json(F.lit(C.SMOKE_RESPONSE_JSON)).alias("response"))
