"""Values that must equal the reference's for identical results.

Fixed values (formats, layouts, defaults and names used by the producers and
models), stated once and in natural order:
"""

# Fixed values ---------------------------------------------------------------
DATASETS = ("most_played", "player_counts", "reviews", "app_details")
SOURCE_NAMES = {
    "most_played": "GetMostPlayedGames",
    "player_counts": "GetNumberOfCurrentPlayers",
    "reviews": "appreviews",
    "app_details": "appdetails",
}
LANDING_DATE_FORMAT = "yyyy-MM-dd"
LANDING_STAMP_FORMAT = "yyyyMMdd'T'HHmmss"
PART_DIGITS = 2
TOP_N = 100
CHUNK_SIZE = 50
REVIEW_LOOKBACK_HOURS = 24
RELEASE_DATE_FORMAT = "d MMM, yyyy"
PLACEHOLDER_NAME = ("Unknown (", ")")
MINOR_UNITS_PER_UNIT = 100
HOURS_SCALE = 1
REPORT_SCALE = 3
MEDIAN_SCALE = 3
HIGH_WATER_DEFAULT = "1970-01-01 00:00:00"
DEBOUNCE = "900 seconds"
# ----------------------------------------------------------------------------
