"""Oracle SQL (DuckDB dialect) for each registered query.

Every statement starts from the same fixture projection as the Spark query
and spells out NULL ordering and tie-breakers, so the two engines must
return identical rows.
"""

from __future__ import annotations

from skyfare import constants as C
from skyfare.operators.quality import CHECKS, unique_key_name
from skyfare.plans import params as P

RAW_EVENTS = """raw AS (
  SELECT 'MEL' AS origin,
         upper(event_type) AS destination,
         DATE '2024-06-01' + CAST(user_id % 7 AS INTEGER) AS departure_date,
         CAST(ts AS TIMESTAMP) AS quote_ts,
         CAST(value AS DECIMAL(10,2)) AS price_aud,
         CAST(nullif(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4, 3) AS INTEGER) AS stops,
         CASE event_id % 3 WHEN 0 THEN 'JQ' WHEN 1 THEN 'TR' WHEN 2 THEN 'ZZ' END AS airline_code,
         '{SRC}' AS source,
         CAST(NULL AS VARCHAR) AS cabin
  FROM events)""".replace("{SRC}", C.DEFAULT_SOURCE_NAME)

RAW_LINEITEM = """raw AS (
  SELECT 'MEL' AS origin,
         CASE l_suppkey % 6 WHEN 0 THEN 'BKK' WHEN 1 THEN 'PNH' WHEN 2 THEN 'SGN'
                            WHEN 3 THEN 'MNL' WHEN 4 THEN 'HND' WHEN 5 THEN 'ICN' END AS destination,
         DATE '2024-06-01' + CAST(l_partkey % 30 AS INTEGER) AS departure_date,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER))
           + to_minutes(CAST(l_suppkey % 1440 AS INTEGER)) AS quote_ts,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price_aud,
         CAST(nullif(l_linenumber - 1, 6) AS INTEGER) AS stops,
         l_returnflag AS airline_code,
         '{SRC}' AS source,
         CAST(NULL AS VARCHAR) AS cabin
  FROM lineitem)""".replace("{SRC}", C.DEFAULT_SOURCE_NAME)

STG = """stg AS (
  SELECT origin, destination, origin || '-' || destination AS route_code,
         departure_date, quote_ts, price_aud, coalesce(stops, 0) AS stops,
         airline_code, source, cabin
  FROM raw)"""

CORE_SELECT = """SELECT route_code, origin, destination, departure_date, quote_day,
         price_aud AS daily_min_price_aud, stops, airline_code, source, cabin,
         quote_ts AS observed_at
  FROM (SELECT *, row_number() OVER (
                 PARTITION BY route_code, departure_date, quote_day
                 ORDER BY price_aud ASC NULLS LAST, quote_ts DESC NULLS FIRST,
                          airline_code ASC NULLS LAST, stops ASC NULLS LAST,
                          source ASC NULLS LAST, cabin ASC NULLS LAST) AS rn
        FROM (SELECT *, date_trunc('day', quote_ts) AS quote_day FROM stg) b) r
  WHERE rn = 1"""

CORE = f"core AS (\n  {CORE_SELECT})"

MART = """mart AS (
  SELECT route_code, origin, destination, departure_date, quote_day,
         daily_min_price_aud, stops, airline_code, source, cabin, observed_at
  FROM core)"""

# Rows of the mart that no later day of their route and departure outdates.
LATEST = """current_fares AS (
  SELECT a.* FROM mart a
  WHERE a.quote_day IS NOT NULL AND a.route_code IS NOT NULL AND a.departure_date IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM mart b WHERE b.quote_day > a.quote_day
                    AND b.departure_date = a.departure_date AND b.route_code = a.route_code))"""

ROUTES_DIM = """routes AS (
  SELECT DISTINCT 'MEL-' || upper(event_type) AS route_code
  FROM events WHERE event_type IS NOT NULL
  UNION ALL SELECT 'MEL-SYD' AS route_code)"""

LABELS = "labels AS (SELECT * FROM (VALUES " + ", ".join(
    "('{}', '{}')".format(code, name.replace("'", "''")) for code, name in C.AIRLINE_NAMES
) + ") AS t(airline_code, airline))"

USAGE = """usage AS (
  SELECT CAST(ts AS TIMESTAMP) AS start_time, event_type AS resource, value AS amount
  FROM events)"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


EVENTS_LAYERS = [RAW_EVENTS, STG, CORE, MART]

FARES_BODY = f"""SELECT route_code, departure_date, daily_min_price_aud::DOUBLE AS price_aud, airline_code,
       stops, quote_day
FROM current_fares
WHERE departure_date >= '{P.WINDOW_START}' AND departure_date <= '{P.WINDOW_END}'
  AND route_code = '{P.ROUTE}'
ORDER BY 3 NULLS LAST, 2 NULLS LAST, 4 NULLS LAST
LIMIT {C.FARE_LIMIT}"""

FARES = f"fares AS (\n{FARES_BODY})"

TREND_BODY = f"""SELECT route_code, departure_date, quote_day,
       CAST(daily_min_price_aud AS DOUBLE) AS price_aud, airline_code, stops
FROM mart
WHERE route_code = '{P.ROUTE}' AND departure_date = DATE '{P.TREND_DEPARTURE}'
ORDER BY quote_day"""

GUARDED = f"""guarded AS (
  SELECT * FROM ({TREND_BODY}) t
  WHERE price_aud BETWEEN {P.GUARD_LO} AND {P.GUARD_HI})"""


def _dq_sql(layer_ctes: list[str]) -> str:
    parts = []
    for spec in CHECKS:
        for c in spec.not_null:
            parts.append(f"SELECT '{spec.layer}' AS layer, 'not_null' AS test, '{c}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures "
                         f"FROM {spec.layer}")
        for keys in spec.unique:
            k = ", ".join(keys)
            nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
            parts.append(f"SELECT '{spec.layer}' AS layer, 'unique' AS test, "
                         f"'{unique_key_name(keys)}' AS column_name, CAST(count(*) AS BIGINT) AS failures "
                         f"FROM (SELECT {k} FROM {spec.layer} WHERE {nn} GROUP BY {k} "
                         f"HAVING count(*) > 1) d")
    return with_(layer_ctes, "\nUNION ALL\n".join(parts))


RAW_EVENTS_ID = RAW_EVENTS.replace("raw AS (\n  SELECT 'MEL' AS origin,",
                                   "raw_id AS (\n  SELECT event_id, 'MEL' AS origin,")

SEEDED = [
    RAW_EVENTS_ID,
    """bad AS (
  SELECT event_id,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE origin END AS origin,
         destination, departure_date, quote_ts,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE price_aud END AS price_aud,
         stops, airline_code, source, cabin
  FROM raw_id)""",
    """raw AS (SELECT origin, destination, departure_date, quote_ts, price_aud, stops,
                   airline_code, source, cabin FROM bad)""",
    STG,
    f"core_clean AS (\n  {CORE_SELECT})",
    """core AS (
  SELECT * FROM core_clean
  UNION ALL
  SELECT * FROM core_clean c
  WHERE EXISTS (SELECT 1 FROM bad b
                WHERE b.event_id % 89 = 0
                  AND b.origin || '-' || b.destination = c.route_code
                  AND b.departure_date = c.departure_date
                  AND b.quote_ts = c.observed_at))""",
    MART,
]

ORACLE = {
    "stg_quotes": with_([RAW_EVENTS, STG], "SELECT * FROM stg"),
    "core_daily_quotes": with_([RAW_EVENTS, STG, CORE], "SELECT * FROM core"),
    "mart_lowest_price": with_(EVENTS_LAYERS, "SELECT * FROM mart"),
    "cheapest_latest": with_(EVENTS_LAYERS + [LATEST], FARES_BODY),
    "core_daily_quotes_volume": with_([RAW_LINEITEM, STG, CORE], "SELECT * FROM core"),
    "routes_in_window": with_(EVENTS_LAYERS + [ROUTES_DIM], f"""SELECT route_code FROM routes
WHERE EXISTS (SELECT 1 FROM mart WHERE mart.route_code = routes.route_code
              AND departure_date >= '{P.WINDOW_START}' AND departure_date <= '{P.WINDOW_END}')"""),
    "price_trend": with_(EVENTS_LAYERS, TREND_BODY),
    "trend_guarded": with_(EVENTS_LAYERS + [GUARDED], "SELECT * FROM guarded"),
    "trend_display": with_(EVENTS_LAYERS + [GUARDED, LABELS], """SELECT g.route_code, g.departure_date,
       CAST(g.quote_day AS DATE) AS "Quote day",
       g.price_aud AS "Price_AUD",
       g.airline_code AS "Airline_Code",
       g.stops AS "Stops",
       coalesce(l.airline, g.airline_code) AS "Airline",
       strftime(CAST(g.quote_day AS DATE), '%d/%m/%y') AS quote_day_label,
       '$' || printf('%.0f', round(g.price_aud, 0)) AS price_label
FROM guarded g LEFT JOIN labels l ON g.airline_code = l.airline_code"""),
    "kpi_summary": with_(EVENTS_LAYERS + [LATEST, FARES], """SELECT min(price_aud) AS min_price,
       count(*) AS "rows",
       max(quote_day) AS last_quote_day,
       'AUD ' || format('{:,.0f}', min(price_aud)) AS min_price_label
FROM fares"""),
    "departure_dates": with_(EVENTS_LAYERS + [LATEST, FARES],
                             "SELECT DISTINCT departure_date FROM fares ORDER BY departure_date"),
    "airline_labels": with_(EVENTS_LAYERS + [LABELS], """SELECT m.route_code, m.departure_date, m.quote_day,
       m.airline_code, coalesce(l.airline, m.airline_code) AS airline
FROM mart m LEFT JOIN labels l ON m.airline_code = l.airline_code"""),
    "fare_display": with_(EVENTS_LAYERS + [LATEST, FARES, LABELS], """SELECT f.route_code AS "Route",
       f.departure_date AS "Departure date",
       'AUD ' || format('{:,.0f}', f.price_aud) AS "Price (AUD)",
       coalesce(l.airline, f.airline_code) AS "Airline",
       f.stops AS "Stops"
FROM fares f LEFT JOIN labels l ON f.airline_code = l.airline_code"""),
    "volume_by_quote_day": with_(EVENTS_LAYERS, """SELECT quote_day, count(*) AS quotes
FROM mart GROUP BY quote_day ORDER BY quote_day DESC NULLS FIRST"""),
    "cheapest_recent": with_(EVENTS_LAYERS, f"""SELECT DISTINCT ON (route_code, departure_date)
       route_code, departure_date,
       list_min(list(daily_min_price_aud) OVER (PARTITION BY route_code, departure_date)) AS min_price_aud
FROM mart WHERE date_diff('day', quote_day::DATE, DATE '{P.AS_OF}') <= 7
ORDER BY min_price_aud NULLS LAST, route_code NULLS LAST, departure_date NULLS LAST
LIMIT {C.RECENT_LIMIT}"""),
    "latest_snapshot": with_(EVENTS_LAYERS + [LATEST], f"""SELECT * FROM current_fares
ORDER BY daily_min_price_aud NULLS LAST, route_code NULLS LAST, departure_date NULLS LAST
LIMIT {C.SNAPSHOT_LIMIT}"""),
    "usage_daily_rollup": with_([USAGE], f"""SELECT date_trunc('day', start_time) AS usage_day,
       sum(CAST(amount AS DECIMAL(38,9))) AS credits_used
FROM usage
WHERE resource = '{P.USAGE_RESOURCE}'
  AND start_time >= TIMESTAMP '{P.USAGE_AS_OF_TS}' - INTERVAL 7 DAY
GROUP BY 1
ORDER BY 1 DESC"""),
    "parsed_row_count": with_([RAW_EVENTS], "SELECT count(*) AS parsed_rows FROM raw"),
    "dq_checks": _dq_sql(EVENTS_LAYERS),
    "dq_checks_seeded": _dq_sql(SEEDED),
    "dq_unique_seeded": with_(SEEDED, """SELECT route_code, departure_date, quote_day, count(*) AS n
FROM core
WHERE route_code IS NOT NULL AND departure_date IS NOT NULL AND quote_day IS NOT NULL
GROUP BY route_code, departure_date, quote_day
HAVING count(*) > 1"""),
}

# ---- steps 5-8 -------------------------------------------------------------

_WS = r"'^\s+|\s+$'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_WS}, '', 'g')"


DEP = "DATE '2024-06-01' + CAST(user_id % 7 AS INTEGER)"
AIRLINE = "CASE event_id % 3 WHEN 0 THEN 'JQ' WHEN 1 THEN 'TR' WHEN 2 THEN 'ZZ' END"
RESP_STOPS = "greatest(0, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS INTEGER) - 1)"

PAIRS = f"""pairs AS (
  SELECT substr(v, 1, strpos(v, '-') - 1) AS origin, substr(v, strpos(v, '-') + 1) AS destination
  FROM (SELECT upper({_strip('route_code')}) AS v FROM routes
        WHERE route_code IS NOT NULL AND route_code <> '' AND strpos(route_code, '-') > 0) s)"""

LISTS = f"""lists AS (
  SELECT event_id AS list_id,
         ' mel-' || lower(event_type) || ' ; ;MELBKK;' || chr(9) || ' MEL - '
           || upper(substr(event_type, 1, 3)) || '-' || CAST(user_id % 7 AS VARCHAR) || ' ' AS routes_csv,
         ' ' || lower(event_type) || ' ,, bkk,PNH ' AS destinations
  FROM events)"""


def _grid(h: int) -> str:
    return f"""grid AS (
  SELECT origin, destination, DATE '{P.GRID_AS_OF}' + CAST(i AS INTEGER) AS departure_date
  FROM (SELECT origin, destination, unnest(range(1, {h} + 1)) AS i FROM pairs) g)"""


PARSED = f"""parsed AS (
  SELECT CAST(ts AS TIMESTAMP) AS ingested_at, 'MEL-' || upper(event_type) AS route_code,
         'MEL' AS origin, upper(event_type) AS destination, {DEP} AS departure_date,
         value AS price, {RESP_STOPS} AS stops, {AIRLINE} AS airline_code
  FROM events
  WHERE event_id % 10 <> 0 AND value IS NOT NULL)"""

ARCHIVED = f"""archived AS (
  SELECT ingested_at, route_code, 'AUD' AS params_curr, strftime(departure_date, '%d/%m/%Y') AS date_from,
         price, airline_code AS airline
  FROM parsed
  UNION ALL
  SELECT TIMESTAMP '{P.SMOKE_AS_OF_TS}', 'MEL-HKG', 'AUD', NULL, CAST(555 AS DOUBLE), 'XX')"""

SMOKE_ROW = f"""SELECT 'MEL' AS origin, 'HKG' AS destination, DATE '{P.AS_OF}' + 60 AS departure_date,
       TIMESTAMP '{P.SMOKE_AS_OF_TS}' AS quote_ts, CAST(555.00 AS DECIMAL(10,2)) AS price_aud,
       0 AS stops, 'XX' AS airline_code, 'ingestion_test' AS source, 'Y' AS cabin"""

# Quotes with every 53rd one from an earlier test load, then the literal row.
TESTED = [RAW_EVENTS_ID, f"""tested AS (
  SELECT origin, destination, departure_date, quote_ts, price_aud, stops, airline_code,
         CASE WHEN event_id % 53 = 0 THEN 'ingestion_test' ELSE source END AS source, cabin
  FROM raw_id
  UNION ALL {SMOKE_ROW})"""]

KEY_EQ = " AND ".join(f"t.{k} = d.{k}" for k in ["origin", "destination", "departure_date", "quote_ts"])
KEY_NN = " AND ".join(f"{k} IS NOT NULL" for k in ["origin", "destination", "departure_date", "quote_ts"])
UPSERT = [RAW_EVENTS_ID, """target AS (
  SELECT origin, destination, departure_date, quote_ts, price_aud, stops, airline_code, source, cabin
  FROM raw_id WHERE event_id % 10 < 6)""", """src AS (
  SELECT origin, destination, departure_date, quote_ts, CAST(price_aud + 1 AS DECIMAL(10,2)) AS price_aud,
         stops, airline_code, source, event_id AS seq
  FROM raw_id WHERE event_id % 10 >= 5
  UNION ALL
  SELECT origin, destination, departure_date, quote_ts, CAST(price_aud + 2 AS DECIMAL(10,2)),
         stops, airline_code, source, event_id + 1000000000000
  FROM raw_id WHERE event_id % 50 = 5
  UNION ALL
  SELECT origin, CAST(NULL AS VARCHAR), departure_date, quote_ts, CAST(price_aud + 1 AS DECIMAL(10,2)),
         stops, airline_code, source, event_id + 2000000000000
  FROM raw_id WHERE event_id % 70 = 5)""", f"""dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY origin, destination, departure_date, quote_ts
                                 ORDER BY seq DESC) AS rn
    FROM src WHERE {KEY_NN}) x
  WHERE rn = 1)""", f"""nullkey AS (SELECT * FROM src WHERE NOT ({KEY_NN}))"""]

UPSERT_BODY = f"""SELECT t.origin, t.destination, t.departure_date, t.quote_ts,
       CASE WHEN d.seq IS NOT NULL THEN d.price_aud ELSE t.price_aud END AS price_aud,
       CASE WHEN d.seq IS NOT NULL THEN d.stops ELSE t.stops END AS stops,
       CASE WHEN d.seq IS NOT NULL THEN d.airline_code ELSE t.airline_code END AS airline_code,
       CASE WHEN d.seq IS NOT NULL THEN d.source ELSE t.source END AS source,
       t.cabin
FROM target t LEFT JOIN dedup d ON {KEY_EQ}
UNION ALL
SELECT origin, destination, departure_date, quote_ts, price_aud, stops, airline_code, source,
       CAST(NULL AS VARCHAR) AS cabin
FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {KEY_EQ})
UNION ALL
SELECT origin, destination, departure_date, quote_ts, price_aud, stops, airline_code, source,
       CAST(NULL AS VARCHAR) AS cabin
FROM nullkey"""

ORACLE.update({
    "routes_from_dim": with_([ROUTES_DIM, PAIRS], "SELECT * FROM pairs"),
    "routes_from_csv": with_([LISTS, """tok AS (
  SELECT list_id, CAST(unnest(range(len(string_split(routes_csv, ';')))) AS INTEGER) AS pos,
         unnest(string_split(routes_csv, ';')) AS token
  FROM lists)""", f"""t2 AS (
  SELECT list_id, pos, upper({_strip('token')}) AS token FROM tok)"""], f"""SELECT list_id, pos,
       {_strip("substr(token, 1, strpos(token, '-') - 1)")} AS origin,
       {_strip("substr(token, strpos(token, '-') + 1)")} AS destination
FROM t2 WHERE token <> '' AND strpos(token, '-') > 0"""),
    "routes_default": with_([LISTS, """d AS (
  SELECT list_id, CAST(unnest(range(len(string_split(destinations, ',')))) AS INTEGER) AS pos,
         unnest(string_split(destinations, ',')) AS dest
  FROM lists)"""], f"""SELECT list_id, pos, 'MEL' AS origin, upper({_strip('dest')}) AS destination
FROM d WHERE {_strip('dest')} <> ''"""),
    "routes_resolved": with_([ROUTES_DIM, PAIRS], "SELECT origin, destination FROM pairs"),
    "request_grid": with_([ROUTES_DIM, PAIRS, _grid(C.DEFAULT_HORIZON_DAYS)], """SELECT origin, destination, departure_date,
       origin AS fly_from, destination AS fly_to,
       strftime(departure_date, '%d/%m/%Y') AS date_from,
       strftime(departure_date, '%d/%m/%Y') AS date_to,
       'AUD' AS curr, 1 AS one_for_city, 1 AS one_per_date, 1 AS "limit", 'price' AS sort,
       1 AS adults
FROM grid"""),
    "parse_responses": with_([PARSED], "SELECT * FROM parsed"),
    "build_quote_batch": with_([ROUTES_DIM, PAIRS, _grid(C.DEFAULT_HORIZON_DAYS), PARSED], f"""SELECT g.origin, g.destination, g.departure_date, p.ingested_at AS quote_ts,
       CAST(p.price AS DECIMAL(10,2)) AS price_aud, p.stops, p.airline_code, '{C.DEFAULT_SOURCE_NAME}' AS source
FROM grid g
JOIN parsed p ON g.origin = p.origin AND g.destination = p.destination
             AND g.departure_date = p.departure_date"""),
    "raw_json_append": with_([PARSED, ARCHIVED], "SELECT * FROM archived"),
    "last_json_row": with_([PARSED, ARCHIVED], """SELECT * FROM archived
ORDER BY ingested_at DESC NULLS FIRST, route_code ASC NULLS LAST LIMIT 1"""),
    "delete_by_json_path": with_([PARSED, ARCHIVED], f"""SELECT * FROM archived
WHERE NOT (route_code = 'MEL-HKG' AND airline = 'XX')
  AND NOT (route_code = '{P.JSON_DELETE_ROUTE}' AND airline = '{P.JSON_DELETE_VALUE}')"""),
    "append_smoke_row": with_(TESTED, "SELECT * FROM tested"),
    "last_test_row": with_(TESTED, """SELECT * FROM tested WHERE source = 'ingestion_test'
ORDER BY quote_ts DESC NULLS FIRST, departure_date NULLS LAST, price_aud NULLS LAST LIMIT 1"""),
    "delete_by_source": with_(TESTED, "SELECT * FROM tested WHERE source IS DISTINCT FROM 'ingestion_test'"),
    "upsert_quotes": with_(UPSERT, UPSERT_BODY),
    "refresh_layers": with_(EVENTS_LAYERS, "SELECT * FROM mart"),
    "ingest_landed": with_([PARSED], f"""SELECT origin, destination, departure_date, ingested_at AS quote_ts,
       CAST(price AS DECIMAL(10,2)) AS price_aud, stops, airline_code, '{C.DEFAULT_SOURCE_NAME}' AS source,
       CAST(NULL AS VARCHAR) AS cabin
FROM parsed"""),
})

# The SQL-text variants return exactly what their DataFrame twins return.
for _k in ["cheapest_latest", "routes_in_window", "price_trend", "volume_by_quote_day",
           "cheapest_recent", "latest_snapshot", "usage_daily_rollup"]:
    ORACLE[f"{_k}_sql"] = ORACLE[_k]
ORACLE["mart_by_name"] = ORACLE["mart_lowest_price"]

ORACLE["daily_run"] = with_([PARSED, f"""raw AS (
  SELECT origin, destination, departure_date, ingested_at AS quote_ts,
         CAST(price AS DECIMAL(10,2)) AS price_aud, stops, airline_code,
         '{C.DEFAULT_SOURCE_NAME}' AS source, CAST(NULL AS VARCHAR) AS cabin
  FROM parsed)""", STG, CORE, MART], "SELECT * FROM mart")

# ---- write paths seen from outside -------------------------------------------

ORACLE["upsert_counts"] = with_(UPSERT + ["result AS (\n" + UPSERT_BODY + ")"], f"""SELECT
  (SELECT count(*) FROM src) AS input_rows,
  (SELECT count(*) FROM result) - (SELECT count(*) FROM target) AS inserted,
  (SELECT count(*) FROM target t WHERE EXISTS (SELECT 1 FROM dedup d WHERE {KEY_EQ})) AS updated,
  (SELECT count(DISTINCT quote_ts::DATE) FROM src) AS days_touched,
  (SELECT count(DISTINCT t.quote_ts::DATE) FROM target t
   WHERE EXISTS (SELECT 1 FROM dedup d WHERE {KEY_EQ})) AS days_rewritten""")

# No event time has a microsecond of 1, so no moved key meets the target.
ORACLE["upsert_inserts"] = with_(
    [c.replace("departure_date, quote_ts, CAST(price_aud", "departure_date, "
               "quote_ts + INTERVAL 1 HOUR + INTERVAL 1 MICROSECOND AS quote_ts, CAST(price_aud") for c in UPSERT],
    f"SELECT *, 0 AS days_rewritten FROM ({UPSERT_BODY})")

ORACLE["ingest_landed_replayed"] = with_([PARSED, """landed AS (
  SELECT nullif(destination, 'VIEW') AS destination, departure_date, ingested_at AS quote_ts,
         CAST(price AS DECIMAL(10,2)) AS price_aud
  FROM parsed)"""], """SELECT 'quotes' AS raw_table, * FROM landed
UNION ALL SELECT 'json', * FROM landed""")

OFFERS = f"""offers AS (
  SELECT ingested_at, route_code, origin, destination, request_date, CAST(j AS INTEGER) AS pos,
         request_date + CAST(j % 2 AS INTEGER) AS departure_date,
         CASE WHEN (event_id + j) % 11 <> 0 THEN value + (7 * j + event_id) % 5 END AS price,
         CAST(greatest(0, (k + j) % 4 - 1) AS INTEGER) AS stops,
         CASE (event_id + j) % 3 WHEN 0 THEN 'JQ' WHEN 1 THEN 'TR' WHEN 2 THEN 'ZZ' END AS airline_code
  FROM (SELECT CAST(ts AS TIMESTAMP) AS ingested_at, 'MEL-' || upper(event_type) AS route_code, 'MEL' AS origin,
               upper(event_type) AS destination, {DEP} AS request_date, event_id, value,
               coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
               unnest(range(event_id % 5)) AS j
        FROM events) e)"""


def _best_offer(order: str) -> str:
    return with_([OFFERS], f"""SELECT * EXCLUDE (pos) FROM (
  SELECT * FROM offers QUALIFY row_number() OVER (
    PARTITION BY ingested_at, route_code, origin, destination, request_date, departure_date ORDER BY {order}) = 1) x
WHERE price IS NOT NULL""")


ORACLE["offers_exploded"] = with_([OFFERS], "SELECT * FROM offers")
ORACLE["offers_cheapest"] = _best_offer("price NULLS LAST, stops, airline_code NULLS LAST, pos")
ORACLE["offers_first"] = _best_offer("pos")

# Wall clocks of the zone, made from event times that are UTC.
RAW_LOCAL = RAW_EVENTS.replace("CAST(ts AS TIMESTAMP) AS quote_ts",
                               f"(CAST(ts AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE '{P.ZONE}' AS quote_ts")
ORACLE["core_daily_quotes_zone"] = with_([RAW_LOCAL, STG, CORE],
                                         "SELECT *, CAST(quote_day AS DATE) AS quote_date FROM core")
ORACLE["refresh_layers_zone"] = ORACLE["core_daily_quotes_zone"]

ORACLE["routes_resolved_configured"] = f"SELECT origin, destination FROM ({ORACLE['routes_from_csv']}) x"
ORACLE["routes_resolved_default"] = ("SELECT * FROM (VALUES " + ", ".join(
    f"('{C.DEFAULT_ORIGIN}', '{d}')" for d in C.DEFAULT_DESTINATIONS.split(",")) + ") t(origin, destination)")
ORACLE["routes_resolved_unreadable"] = ORACLE["routes_resolved"]
ORACLE["stg_by_name"] = ORACLE["stg_quotes"]

ORACLE["table_replaced"] = """SELECT n.rows_before, 0::BIGINT AS rows_after, c.*
FROM (SELECT count(*) AS rows_before FROM events) n,
     (VALUES (0, 'origin', 'string'), (1, 'destination', 'string'), (2, 'departure_date', 'date'),
             (3, 'quote_ts', 'timestamp'), (4, 'price_aud', 'decimal(10,2)'), (5, 'stops', 'int'),
             (6, 'airline_code', 'string'), (7, 'source', 'string'), (8, 'cabin', 'string'),
             (9, 'quote_date', 'date')) c(position, column_name, column_type)"""

TEXTS = """texts AS (
  SELECT CAST(ts AS TIMESTAMP) AS ingested_at, 'MEL-' || upper(event_type) AS route_code,
         CASE WHEN event_id % 11 = 0 THEN left(props, length(props) - 1) ELSE props END AS params_json,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 7 = 0 THEN '{{"price":' || event_id || '}'
              ELSE '{"price":' || event_id || '}' END AS response_json
  FROM events),
checked AS (
  SELECT *, nullif(concat_ws(', ', CASE WHEN NOT json_valid(params_json) THEN 'malformed params' END,
                             CASE WHEN NOT json_valid(response_json) THEN 'malformed response' END), '') AS reason
  FROM texts)"""
ORACLE["raw_json_from_text"] = with_([TEXTS], """SELECT ingested_at, route_code,
       TRY_CAST(json_extract_string(params_json, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(response_json, '$.price') AS BIGINT) AS price
FROM checked WHERE reason IS NULL""")
ORACLE["raw_json_rejected"] = with_([TEXTS], "SELECT * FROM checked WHERE reason IS NOT NULL")

ORACLE["archive_switch"] = """WITH e AS (
  SELECT 'MEL-' || upper(event_type) AS route_code, event_id, event_id % 10 <> 0 AND value IS NOT NULL AS priced
  FROM events)
SELECT route_code, raw_table, count(*) AS n, archive FROM (
  SELECT route_code, 'quotes' AS raw_table, unnest(['on', 'off', 'all']) AS archive FROM e WHERE priced
  UNION ALL SELECT route_code, 'json', 'on' FROM e WHERE priced
  UNION ALL SELECT route_code, 'json', 'all' FROM e WHERE event_id % 20 <> 0) x
GROUP BY route_code, raw_table, archive"""

ORACLE["build_quote_batch_run"] = with_([ROUTES_DIM, PAIRS, _grid(C.DEFAULT_HORIZON_DAYS), PARSED], f"""
SELECT g.origin, g.destination, g.departure_date, TIMESTAMP '{P.RUN_TS}' AS quote_ts,
       CAST(p.price AS DECIMAL(10,2)) AS price_aud, p.stops, p.airline_code, '{C.DEFAULT_SOURCE_NAME}' AS source
FROM grid g
JOIN parsed p USING (origin, destination, departure_date)
QUALIFY row_number() OVER (PARTITION BY g.origin, g.destination, g.departure_date
                           ORDER BY p.ingested_at DESC, p.price, p.stops, p.airline_code NULLS LAST) = 1""")
