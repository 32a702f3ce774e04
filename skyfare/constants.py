"""Fixed values that must equal the behaviour being reproduced.

Fixed values (do not edit to make a result change):
- airline labels: JQ Jetstar; TR Scoot; VJ VietJet Air; D7 AirAsia X;
  AK AirAsia; QF Qantas; SQ Singapore Airlines; CX Cathay Pacific;
  HX Hong Kong Airlines; MU China Eastern; HU Hainan Airlines
- default origin MEL; default destinations BKK,PNH,SGN,MNL,HND,ICN
- default horizon 60 days; default source name "tequila"
- display price guard 50 to 3000 AUD inclusive
- result caps: 200 fares, 20 recent cheapest, 50 latest snapshot
- request date format dd/MM/yyyy, chart axis format dd/MM/yy
- request parameters: curr AUD, one_for_city 1, one_per_date 1, limit 1,
  sort price, adults 1
- smoke row: MEL, HKG, today + 60, now, 555.00, 0, XX, ingestion_test, Y;
  smoke JSON params {"curr":"AUD","stops":0,"provider":"test"},
  response {"min_price":555,"airline":"XX"}
"""

AIRLINE_NAMES = [
    ("JQ", "Jetstar"),
    ("TR", "Scoot"),
    ("VJ", "VietJet Air"),
    ("D7", "AirAsia X"),
    ("AK", "AirAsia"),
    ("QF", "Qantas"),
    ("SQ", "Singapore Airlines"),
    ("CX", "Cathay Pacific"),
    ("HX", "Hong Kong Airlines"),
    ("MU", "China Eastern"),
    ("HU", "Hainan Airlines"),
]

DEFAULT_ORIGIN = "MEL"
DEFAULT_DESTINATIONS = "BKK,PNH,SGN,MNL,HND,ICN"
DEFAULT_HORIZON_DAYS = 60
DEFAULT_SOURCE_NAME = "tequila"

MIN_PRICE, MAX_PRICE = 50, 3000

FARE_LIMIT = 200
RECENT_LIMIT = 20
SNAPSHOT_LIMIT = 50
RECENT_DAYS = 7

REQUEST_DATE_FORMAT = "dd/MM/yyyy"
AXIS_DATE_FORMAT = "dd/MM/yy"

REQUEST_CURRENCY = "AUD"
REQUEST_ONE_FOR_CITY = 1
REQUEST_ONE_PER_DATE = 1
REQUEST_LIMIT = 1
REQUEST_SORT = "price"
REQUEST_ADULTS = 1

SMOKE_ORIGIN, SMOKE_DESTINATION = "MEL", "HKG"
SMOKE_DAYS_AHEAD = 60
SMOKE_PRICE = "555.00"
SMOKE_STOPS = 0
SMOKE_AIRLINE = "XX"
SMOKE_SOURCE = "ingestion_test"
SMOKE_CABIN = "Y"
SMOKE_PARAMS_JSON = '{"curr":"AUD","stops":0,"provider":"test"}'
SMOKE_RESPONSE_JSON = '{"min_price":555,"airline":"XX"}'
