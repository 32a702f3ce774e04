"""Request grid, response extraction and quote-batch assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.functions import as_date
from skyfare.schemas import PRICE, REJECTED_JSON

GRID_KEY = ["origin", "destination", "departure_date"]


def request_params(origin: Column, destination: Column, departure: Column) -> Column:
    """The search request for one (route, departure date)."""
    day = F.date_format(departure, C.REQUEST_DATE_FORMAT)
    return F.struct(
        origin.alias("fly_from"), destination.alias("fly_to"),
        day.alias("date_from"), day.alias("date_to"),
        F.lit(C.REQUEST_CURRENCY).alias("curr"),
        F.lit(C.REQUEST_ONE_FOR_CITY).alias("one_for_city"),
        F.lit(C.REQUEST_ONE_PER_DATE).alias("one_per_date"),
        F.lit(C.REQUEST_LIMIT).alias("limit"),
        F.lit(C.REQUEST_SORT).alias("sort"),
        F.lit(C.REQUEST_ADULTS).alias("adults"),
    )


def request_grid(routes: DataFrame, as_of, horizon_days: int = C.DEFAULT_HORIZON_DAYS) -> DataFrame:
    """Every route x departure date as_of+1 .. as_of+horizon, with its request.

    A per-row generator (no join), so the grid is produced where the routes
    already are.
    """
    g = routes.select("origin", "destination",
                      F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("day_offset"))
    g = g.withColumn("departure_date", F.date_add(as_date(as_of), F.col("day_offset")))
    return g.select(*GRID_KEY, request_params(F.col("origin"), F.col("destination"),
                                              F.col("departure_date")).alias("params"))


def _offer(o: Column | str, prefix: str = "$") -> Column:
    """(price, stops, airline_code) of one offer object."""
    return F.struct(
        F.try_variant_get(o, f"{prefix}.price", "double").alias("price"),
        F.greatest(F.lit(0), F.size(F.try_variant_get(o, f"{prefix}.route",
                                                      "array<variant>")) - 1).alias("stops"),
        F.try_variant_get(o, f"{prefix}.airlines[0]", "string").alias("airline_code"))


def extract_quotes(responses: DataFrame, offer: str = "first", carry: tuple = ()) -> DataFrame:
    """Offer of each stored response as a quote.

    The request (params) gives route and date. ``offer="first"`` takes the
    first ``data`` entry (the source already sorts by price and returns
    one): price, stops (legs - 1, at least 0, 0 if absent) and the first
    airline. ``offer="cheapest"`` instead takes the lowest-priced entry
    (ties: fewer stops, then airline code), for responses holding several.
    A missing/empty ``data`` or a missing price gives a NULL price; an
    empty airline list gives a NULL airline. Columns ``carry`` are passed on.
    """
    if offer == "first":
        best = _offer("response", "$.data[0]")
    elif offer == "cheapest":
        offers = F.transform(F.try_variant_get("response", "$.data", "array<variant>"),
                             lambda o: _offer(o))
        best = F.array_min(F.filter(offers, lambda x: x["price"].isNotNull()))
    else:
        raise ValueError(f"unknown offer rule {offer!r}")
    return responses.select(
        "ingested_at", "route_code",
        F.try_variant_get("params", "$.fly_from", "string").alias("origin"),
        F.try_variant_get("params", "$.fly_to", "string").alias("destination"),
        F.try_to_date(F.try_variant_get("params", "$.date_from", "string"),
                      C.REQUEST_DATE_FORMAT).alias("departure_date"),
        best.alias("_best"), *carry,
    ).select("ingested_at", "route_code", "origin", "destination", "departure_date", *carry,
             F.col("_best.price").alias("price"),
             F.coalesce(F.col("_best.stops"), F.lit(0)).alias("stops"),
             F.col("_best.airline_code").alias("airline_code"))


def explode_offers(responses: DataFrame) -> DataFrame:
    """One row per offer of each response, with its place ``pos`` in the list.

    The list is exploded beside its response (a lateral join, no shuffle). An
    offer without a date of its own (``local_departure``) has the requested one;
    a response without a list, or with an empty one, has no rows. Unpriced
    offers are kept here.
    """
    listed = responses.select(
        "ingested_at", "route_code",
        F.try_variant_get("params", "$.fly_from", "string").alias("origin"),
        F.try_variant_get("params", "$.fly_to", "string").alias("destination"),
        F.try_to_date(F.try_variant_get("params", "$.date_from", "string"),
                      C.REQUEST_DATE_FORMAT).alias("request_date"),
        F.try_variant_get("response", "$.data", "variant").alias("_offers"))
    spark = responses.sparkSession
    each = listed.lateralJoin(spark.tvf.variant_explode(F.col("_offers").outer()))
    offer = _offer("value")
    own = F.try_to_date(F.substring(F.try_variant_get("value", "$.local_departure", "string"), 1, 10))
    return each.select(
        "ingested_at", "route_code", "origin", "destination", "request_date", "pos",
        F.coalesce(own, F.col("request_date")).alias("departure_date"),
        offer["price"].alias("price"), F.coalesce(offer["stops"], F.lit(0)).alias("stops"),
        offer["airline_code"].alias("airline_code"))


OFFER_GROUP = ["ingested_at", "route_code", "origin", "destination", "request_date", "departure_date"]


def offers_by_date(offers: DataFrame, rule: str = "cheapest") -> DataFrame:
    """The best offer of each response and departure date.

    ``cheapest``: the lowest price (ties: fewer stops, airline, place in the
    list). ``first``: the first in the list, which a source that sorts by price
    makes the cheapest; a date whose first offer has no price has no quote.
    A rank limit of 1 is applied in each task before the exchange.
    """
    if rule == "cheapest":
        order = [F.col("price").asc_nulls_last(), F.col("stops").asc(), F.col("airline_code").asc_nulls_last(),
                 F.col("pos").asc()]
    elif rule == "first":
        order = [F.col("pos").asc()]
    else:
        raise ValueError(f"unknown offer rule {rule!r}")
    w = Window.partitionBy(*OFFER_GROUP).orderBy(*order)
    return (offers.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "pos")
            .filter(F.col("price").isNotNull()))


def parse_responses(responses: DataFrame, offer: str = "first", carry: tuple = ()) -> DataFrame:
    """Extracted quotes, unpriced responses dropped."""
    return extract_quotes(responses, offer, carry).filter(F.col("price").isNotNull())


def build_quote_batch(grid: DataFrame, quotes: DataFrame,
                      source_name: str = C.DEFAULT_SOURCE_NAME, carry: tuple = (),
                      run_ts=None) -> DataFrame:
    """Grid cells with a priced response -> raw quote rows.

    With ``run_ts``, the one time of the run, each cell has one row: all
    responses to it would have one key, and the latest one speaks for the cell
    (ties: cheapest, fewest stops, airline). Otherwise ``quote_ts`` is the
    response's own ingestion time and each response gives a row. The join keeps
    grid multiplicity, as one fetch per grid cell would.
    """
    priced = quotes.filter(F.col("price").isNotNull())
    if run_ts is not None:
        latest = Window.partitionBy(*GRID_KEY).orderBy(
            F.col("ingested_at").desc_nulls_last(), "price", "stops", F.col("airline_code").asc_nulls_last())
        priced = priced.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn")
    joined = grid.select(*GRID_KEY).join(priced, GRID_KEY, "inner")
    return joined.select(
        *GRID_KEY,
        (F.col("ingested_at") if run_ts is None
         else F.lit(str(run_ts)).cast("timestamp")).alias("quote_ts"),
        F.col("price").cast(PRICE).alias("price_aud"),
        F.col("stops").cast("int").alias("stops"),
        "airline_code",
        F.lit(source_name).alias("source"),
        *carry,
    )


def json_rows(rows: DataFrame, ingested_at: str = "ingested_at", route: str = "route_code",
              params_json: str = "params_json", response_json: str = "response_json",
              strict: bool = False) -> DataFrame:
    """JSON text columns -> rows of the RAW JSON table (VARIANT columns).

    Untrusted text goes through ``try_parse_json`` (malformed -> NULL);
    ``strict`` uses ``parse_json`` and fails on the first malformed value.
    """
    parse = F.parse_json if strict else F.try_parse_json
    return rows.select(F.col(ingested_at).cast("timestamp").alias("ingested_at"),
                       F.col(route).alias("route_code"),
                       parse(F.col(params_json)).alias("params"),
                       parse(F.col(response_json)).alias("response"))


def check_json(rows: DataFrame, params_json: str = "params_json",
               response_json: str = "response_json") -> DataFrame:
    """``rows`` with ``params``, ``response`` and ``reason``: what is wrong with
    the texts, NULL if nothing is. Text that does not parse is told apart from
    text that is not there, which is no fault."""
    def fault(col, name):
        return F.when(F.col(col).isNotNull() & F.try_parse_json(F.col(col)).isNull(), F.lit(f"malformed {name}"))
    reason = F.concat_ws(", ", fault(params_json, "params"), fault(response_json, "response"))
    return rows.withColumns({"params": F.try_parse_json(F.col(params_json)),
                             "response": F.try_parse_json(F.col(response_json)),
                             "reason": F.nullif(reason, F.lit(""))})


def split_json(rows: DataFrame, ingested_at: str = "ingested_at", route: str = "route_code",
               params_json: str = "params_json", response_json: str = "response_json"
               ) -> tuple[DataFrame, DataFrame]:
    """(rows of the RAW JSON table, quarantined rows). A quarantined row keeps
    its texts as they came and says why it is there; no row is lost or stored
    as NULL."""
    named = rows.select(F.col(ingested_at).cast("timestamp").alias("ingested_at"), F.col(route).alias("route_code"),
                        F.col(params_json).alias("params_json"), F.col(response_json).alias("response_json"))
    checked = check_json(named)
    good = checked.filter(F.col("reason").isNull()).select("ingested_at", "route_code", "params", "response")
    return good, checked.filter(F.col("reason").isNotNull()).select(*[f.name for f in REJECTED_JSON])


def archive_rows(responses: DataFrame, keep_unpriced: bool = False) -> DataFrame:
    """Responses to store in the JSON archive.

    By default only responses that yielded a price are archived (unpriced
    ones are skipped before the archive step); ``keep_unpriced`` keeps
    every non-empty response.
    """
    nonempty = F.col("response").isNotNull() & (F.to_json("response") != "{}")
    out = responses.filter(nonempty)
    if not keep_unpriced:
        price = F.try_variant_get("response", "$.data[0].price", "double")
        out = out.filter(price.isNotNull())
    return out.select("ingested_at", "route_code", "params", "response")

