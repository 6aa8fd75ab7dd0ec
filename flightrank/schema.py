"""The one typed flight record every operator works on."""

from pyspark.sql import types as T

FLIGHT = T.StructType(
    [
        T.StructField("flight_num", T.StringType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("dest", T.StringType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("dep_time", T.StringType()),
        T.StructField("dep_delay", T.DoubleType()),
        T.StructField("arr_delay", T.DoubleType()),
    ]
)

# Positions of the fields after a plain split on commas. The two
# quoted city names hold a comma each, so these are not the positions a
# quote-aware CSV reader would use.
FIELD_POSITION = {
    "year": 0,
    "flight_date": 5,
    "carrier": 6,
    "flight_num": 10,
    "origin": 14,
    "dest": 24,
    "dep_time": 32,
    "dep_delay": 33,
    "arr_delay": 44,
}

# Fixed value: lines with fewer fields are never read.
MIN_FIELDS = 35

# Lines must reach the last field for questions about the arrival delay. Others
# read nothing behind the departure delay.
ALL_FIELDS = max(FIELD_POSITION.values()) + 1
FIELDS_FOR = {"dep_delay": MIN_FIELDS, "arr_delay": ALL_FIELDS}

# Fixed value: first field of a header line.
HEADER_MARK = "YEAR"

# Column names used when a file has a header and is read by name.
HEADER_NAMES = {
    "flight_date": "FL_DATE",
    "carrier": "CARRIER",
    "flight_num": "FL_NUM",
    "origin": "ORIGIN",
    "dest": "DEST",
    "dep_time": "DEP_TIME",
    "dep_delay": "DEP_DELAY",
    "arr_delay": "ARR_DELAY",
}
