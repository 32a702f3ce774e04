import datetime as dt

from pyspark.sql import functions as F

from skyfare import constants as C
from skyfare.operators import ingest


def responses(spark, bodies):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i), "MEL-BKK",
             '{"fly_from":"MEL","fly_to":"BKK","date_from":"01/06/2024"}', b)
            for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "ingested_at timestamp, route_code string, p string, r string")
    return df.select("ingested_at", "route_code", F.parse_json("p").alias("params"),
                     F.parse_json("r").alias("response"))


def test_extraction_rules(spark):
    bodies = ['{"data":[{"price":100.5,"route":[{},{},{}],"airlines":["JQ","TR"]}]}',
              '{"data":[{"price":80,"airlines":["QF"]}]}',
              '{"data":[{"price":"70.25","route":[{}],"airlines":[]}]}',
              '{"data":[{"route":[{}]}]}',
              '{"data":[]}',
              '{}']
    out = ingest.extract_quotes(responses(spark, bodies)).orderBy("ingested_at").collect()
    got = [(r.price, r.stops, r.airline_code) for r in out]
    assert got == [(100.5, 2, "JQ"), (80.0, 0, "QF"), (70.25, 0, None),
                   (None, 0, None), (None, 0, None), (None, 0, None)]
    assert out[0].departure_date == dt.date(2024, 6, 1) and out[0].origin == "MEL"
    assert ingest.parse_responses(responses(spark, bodies)).count() == 3


def test_archive_only_priced_by_default(spark):
    r = responses(spark, ['{"data":[{"price":1}]}', '{"data":[]}', '{}'])
    assert ingest.archive_rows(r).count() == 1
    assert ingest.archive_rows(r, keep_unpriced=True).count() == 2


def test_batch_stamps_ingestion_time(spark):
    r = responses(spark, ['{"data":[{"price":12.345,"route":[{},{}],"airlines":["JQ"]}]}'])
    grid = ingest.request_grid(spark.createDataFrame([("MEL", "BKK")], "origin string, destination string"),
                               "2024-05-31", 2)
    b = ingest.build_quote_batch(grid, ingest.parse_responses(r)).collect()
    assert len(b) == 1
    assert b[0].quote_ts == dt.datetime(2024, 1, 1) and str(b[0].price_aud) == "12.35"
    assert b[0].stops == 1 and b[0].source == C.DEFAULT_SOURCE_NAME


def test_cheapest_offer_rule(spark):
    bodies = ['{"data":[{"price":90,"route":[{}],"airlines":["JQ"]},'
              '{"price":70,"route":[{},{}],"airlines":["TR"]},{"route":[]}]}',
              '{"data":[{"price":5,"route":[{},{}],"airlines":["B"]},{"price":5,"airlines":["A"]}]}',
              '{"data":[]}']
    out = ingest.extract_quotes(responses(spark, bodies), offer="cheapest").orderBy("ingested_at").collect()
    assert [(r.price, r.stops, r.airline_code) for r in out] == [(70.0, 1, "TR"), (5.0, 0, "A"), (None, 0, None)]


def test_json_rows_tolerates_malformed_text(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "MEL-HKG", '{"curr":"AUD"}', '{"min_price":555}'),
                                ("2024-01-01 00:00:00", "MEL-HKG", '{bad', 'nope')],
                               "ingested_at string, route_code string, params_json string, response_json string")
    out = ingest.json_rows(df).select(F.to_json("params").alias("p"), F.to_json("response").alias("r")).collect()
    assert sorted([(r.p, r.r) for r in out], key=str) == [('{"curr":"AUD"}', '{"min_price":555}'), (None, None)]


def test_offers_explode_in_order_and_are_ranked_by_date(spark):
    bodies = ['{"data":[{"price":9,"airlines":["A"]},{"price":7,"local_departure":"2024-06-02T01:00:00","airlines":["B"]},'
              '{"price":8,"airlines":["C"],"route":[{},{}]},{"airlines":["D"],"local_departure":"2024-06-02"},'
              '{"price":8,"airlines":["E"],"local_departure":"nonsense"}]}',
              '{"data":[{"airlines":["F"]},{"price":3}]}', '{"data":[]}', '{}', '{"data":5}']
    offers = ingest.explode_offers(responses(spark, bodies))
    got = [(r.ingested_at.second, r.pos, r.departure_date.day, r.price) for r in offers.orderBy("ingested_at", "pos").collect()]
    assert got == [(0, 0, 1, 9.0), (0, 1, 2, 7.0), (0, 2, 1, 8.0), (0, 3, 2, None), (0, 4, 1, 8.0),
                   (1, 0, 1, None), (1, 1, 1, 3.0)]

    def best(rule):
        return sorted((r.ingested_at.second, r.departure_date.day, r.price, r.airline_code)
                      for r in ingest.offers_by_date(offers, rule).collect())
    # Equal prices: fewer stops win. A first offer without a price gives no quote.
    assert best("cheapest") == [(0, 1, 8.0, "E"), (0, 2, 7.0, "B"), (1, 1, 3.0, None)]
    assert best("first") == [(0, 1, 9.0, "A"), (0, 2, 7.0, "B")]


def test_malformed_json_is_quarantined_with_its_text(spark):
    rows = [("2024-01-01 00:00:00", "R", '{"a":1}', '{"b":2}'), ("2024-01-01 00:00:00", "R", '{"a":', '{"b":2}'),
            ("2024-01-01 00:00:00", "R", "nope", "{{"), ("2024-01-01 00:00:00", "R", None, ""), (None, None, None, None)]
    df = spark.createDataFrame(rows, "ingested_at string, route_code string, params_json string, response_json string")
    good, bad = ingest.split_json(df)
    assert good.count() == 2 and good.filter("params IS NULL AND response IS NULL").count() == 1
    assert sorted((r.params_json or "", r.response_json or "", r.reason) for r in bad.collect()) == [
        ("", "", "malformed response"), ("nope", "{{", "malformed params, malformed response"),
        ('{"a":', '{"b":2}', "malformed params")]


def test_run_time_gives_one_row_a_cell(spark):
    r = responses(spark, ['{"data":[{"price":5}]}', '{"data":[{"price":9}]}', '{"data":[]}'])
    grid = ingest.request_grid(spark.createDataFrame([("MEL", "BKK")], "origin string, destination string"),
                               "2024-05-31", 2)
    quotes = ingest.parse_responses(r)
    assert ingest.build_quote_batch(grid, quotes).count() == 2
    one = ingest.build_quote_batch(grid, quotes, run_ts="2024-01-31 01:00:00").collect()
    assert [(x.quote_ts, float(x.price_aud)) for x in one] == [(dt.datetime(2024, 1, 31, 1), 9.0)]
