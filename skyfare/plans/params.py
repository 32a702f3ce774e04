"""Parameters for the registered queries over the driver's tables."""

AS_OF = "2024-01-30"
WINDOW_START, WINDOW_END = "2024-06-01", "2024-06-05"
ROUTE = "MEL-CLICK"
TREND_DEPARTURE = "2024-06-03"
GUARD_LO, GUARD_HI = 5, 3000
USAGE_RESOURCE = "click"
USAGE_AS_OF_TS = "2024-01-30 23:59:59"
# lineitem projection: prices run ~900 to ~105,000
VOLUME_ROUTE = "MEL-BKK"
VOLUME_GUARD_LO, VOLUME_GUARD_HI = 5000, 50000
VOLUME_WINDOW_START, VOLUME_WINDOW_END = "2024-06-01", "2024-06-30"
VOLUME_TREND_DEPARTURE = "2024-06-10"
GRID_AS_OF = "2024-05-31"
SMOKE_AS_OF_TS = "2024-01-30 12:00:00"
JSON_DELETE_ROUTE, JSON_DELETE_PATH, JSON_DELETE_VALUE = "MEL-CLICK", "$.data[0].airlines[0]", "ZZ"
SMOKE_JSON_PATH = "$.airline"
RUN_TS = "2024-01-31 01:00:00"
ZONE = "Australia/Melbourne"
