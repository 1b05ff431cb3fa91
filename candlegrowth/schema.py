"""Table shapes shared by sources, operators and sinks."""

from pyspark.sql import types as T

# The report's column names, the file layout and the constants of the growth rules.
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
HEADER_CELL = "Time (UTC)"
HEADER_LINE = "Time (UTC);Open;High;Low;Close;Volume"
DELIMITER = ";"
BID_GLOB = "*Bid*"
NULL_TEXT = "NULL"
BARS_PER_DAY = 8640
CHUNK_LINES = 8641  # a day's bars and a header line
FIRST_BASE_CONSTANT = 1569.093

CORRUPT = "corrupt_line"  # the whole line where it has more or fewer cells than the header

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(text):
    """A StructType from `name type, name type`; needs no running session."""
    fields = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_CANDLES = struct(
    "time_text string, open_text string, high_text string, low_text string, "
    "close_text string, volume_text string"
)
PARTITIONS = struct("stock_name string, current_year int")
BOUNDARY = struct(
    "stock_name string, year int, month int, "
    "first_time timestamp_ntz, first_seq bigint, first_open double, first_close double, "
    "last_time timestamp_ntz, last_seq bigint, last_open double, last_close double, n bigint"
)
REPORT = struct(
    "stock_name string, current_year int, algorithm_type string, "
    + ", ".join(f"{m} double" for m in MONTHS)
    + ", total_per_year double"
)
AVERAGES = struct(
    "stock_name string, algorithm_type string, "
    + ", ".join(f"avg_{m} double" for m in MONTHS)
    + ", avg_total double"
)
DESTINATION_AUDIT = struct(
    "stock_name string, algorithm_type string, current_year int, file_type string, "
    "task_name string, start_load_date timestamp, end_load_date timestamp, "
    "number_of_processed_rows bigint, load_with_error boolean"
)
STAGING_AUDIT = struct(
    "file_name string, stock_name string, current_year int, file_type string, md5_sum string, "
    "row_fingerprint string, start_load_date timestamp, end_load_date timestamp, number_of_processed_rows bigint, "
    "load_with_error boolean"
)
