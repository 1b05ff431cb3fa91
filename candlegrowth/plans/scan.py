"""Queries on sources, parsing and data quality."""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions import parse
from candlegrowth.functions.percent import growth_percent, nan_to_null, rounded
from candlegrowth.operators import boundary, clean, quality
from candlegrowth.plans import sqltext
from candlegrowth.session import scratch_path
from candlegrowth.sinks import files as sinks
from candlegrowth.sources import files as sources
from candlegrowth.sources import mapped

TIES = {"tie_break": "seq", "dense_ties": True}


def csv_scan(spark, folder):
    """Bid and ask files side by side; only the bid side is read back, typed."""
    path = scratch_path(spark, "csv-scan")
    cells = mapped.order_cells(spark, folder)
    sinks.write_candle_csv(cells, path, "CANDLES_10 Secs_Bid_1995.01.01")
    sinks.write_candle_csv(cells, path, "CANDLES_10 Secs_Ask_1995.01.01")
    raw = sources.read_candles(spark, path, layout="partitions")
    return clean.valid_rows(clean.parse_candles(raw)).select(
        "stock_name",
        "current_year",
        "file_type",
        "time_utc",
        *[F.col(f"{c}_price").alias(c) for c in ("open", "high", "low", "close")],
        "volume",
    )


def csv_chunks_headerless(spark, folder):
    """Month boundaries of files of which only some have a header."""
    path = scratch_path(spark, "csv-chunks")
    sinks.write_lines(mapped.chunk_lines(spark, folder), path, ["stock_name", "current_year", "chunk"])
    raw = sources.read_candles(spark, path, glob="*", layout="partitions")
    candles = clean.valid_rows(clean.parse_candles(raw)).withColumn("seq", F.col("volume").cast("bigint"))
    return boundary.month_boundary(candles, **TIES)


def header_filter(spark, folder):
    """Lines of text with headers among them, split by position."""
    path = scratch_path(spark, "header-filter")
    sinks.write_lines(mapped.order_lines(spark, folder), path, ["stock_name", "current_year"])
    return sources.read_lines(spark, path).select(
        "stock_name", "current_year", "time_text", "open_text", "close_text"
    )


def path_columns(spark, folder):
    """Stock, quote side and year out of paths, with the number of rows behind each path."""
    cells = mapped.order_cells(spark, folder)
    path = F.concat(
        F.lit("/landing/"), "stock_name", F.lit("/"), F.col("current_year").cast("string"),
        F.lit("/"), "stock_name", F.lit("_10%20Secs_Bid_"), F.col("current_year").cast("string"),
        F.lit(".01.01_"), F.col("current_year").cast("string"), F.lit(".12.31.csv"),
    )
    paths = cells.groupBy(path.alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    folders = sources.with_path_columns(paths, "folders").withColumnsRenamed(
        {"stock_name": "folder_stock", "current_year": "folder_year"}
    )
    named = sources.with_path_columns(folders, "file_name")
    return named.withColumn("file_path", parse.decode_path(F.col("file_path")))


def list_files(spark, folder):
    """The number of files of each quote side and folder."""
    path = scratch_path(spark, "list-files")
    cells = mapped.order_cells(spark, folder)
    sinks.write_candle_csv(cells, path, "CANDLES_10 Secs_Bid_1995.01.01")
    sinks.write_candle_csv(cells, path, "CANDLES_10 Secs_Ask_1995.01.01")
    return sources.list_files(spark, path, "*Secs*").groupBy(
        parse.quote_side_of_name(F.col("file_path")).alias("file_type"),
        parse.path_part(F.col("file_path"), 3).alias("stock_folder"),
        parse.path_part(F.col("file_path"), 2).alias("year_folder"),
    ).agg(F.count(F.lit(1)).alias("n"))


def parse_time(spark, folder):
    cells = mapped.order_cells_with_errors(spark, folder)
    time = parse.parse_time(F.col("time_text"))
    return cells.select(
        "seq", "time_text", parse.time_to_text(time).alias("time_utc"),
        time.isNotNull().alias("is_time"),
    )


def decimal_comma(spark, folder):
    cells = mapped.order_cells_with_errors(spark, folder).select("seq", "open_text")
    price = parse.parse_decimal(F.col("open_text"))
    return cells.unionByName(mapped.large_cells(spark, folder)).select(
        "seq", "open_text", price.alias("open_price"), price.isNotNull().alias("is_number")
    )


def nan_to_null_query(spark, folder):
    """A growth that is NaN for some rows becomes NULL."""
    source = mapped.orders(spark, folder)
    close = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(
        F.col("o_totalprice") * 2
    )
    value = nan_to_null(growth_percent(close, F.col("o_totalprice")))
    result = source.select(
        F.col("o_orderkey").alias("seq"), value.alias("growth"), value.isNull().alias("is_missing")
    )
    return rounded(result)


def reject_rows(spark, folder):
    """Lines with bad cells, with a cell too many and with one too few."""
    path = scratch_path(spark, "reject-rows")
    sinks.write_lines(mapped.odd_lines(spark, folder), path, ["stock_name", "current_year"])
    parsed = clean.parse_candles(sources.read_candles(spark, path, glob="*", layout="partitions"))
    return clean.reject_rows(parsed).select(
        "stock_name", "current_year", F.col("volume_text").cast("bigint").alias("seq"),
        "reject_reason", "time_text", "open_text",
    )


def valid_rows(spark, folder):
    parsed = clean.parse_candles(mapped.order_cells_with_errors(spark, folder))
    return clean.valid_rows(parsed).select(
        "stock_name", "seq", "time_utc",
        "open_price", "close_price",
    )


def dq_nulls(spark, folder):
    parsed = clean.parse_candles(mapped.order_cells_with_errors(spark, folder))
    return quality.dq_nulls(parsed, ["time_utc", "open_price", "high_price", "close_price", "volume"])


def dq_duplicate_keys(spark, folder):
    return quality.dq_duplicate_keys(mapped.order_candles(spark, folder), ["stock_name", "time_utc"])


def missing_months(spark, folder):
    months = boundary.month_boundary(mapped.customer_candles(spark, folder), **TIES)
    return quality.missing_months(months)


def candle_projection(spark, folder):
    return mapped.order_candles(spark, folder).select(
        F.col("time_utc").alias("time"), F.col("open_price").alias("open"),
        F.round("close_price", 6).alias("close"),
    )


def calendar_parts(spark, folder):
    candles = mapped.order_candles(spark, folder)
    return candles.select("stock_name", "seq", *parse.calendar_parts(F.col("time_utc")))


def distinct_rows(spark, folder):
    candles = mapped.order_candles(spark, folder)
    return candles.select("stock_name", *parse.calendar_parts(F.col("time_utc"))).dropDuplicates()


def rows_per_group(spark, folder):
    candles = mapped.order_candles(spark, folder)
    return candles.groupBy("stock_name", F.year("time_utc").alias("current_year")).agg(
        F.count(F.lit(1)).alias("number_of_processed_rows")
    )


QUERIES = {
    "csv_scan": csv_scan,
    "csv_chunks_headerless": csv_chunks_headerless,
    "header_filter": header_filter,
    "path_columns": path_columns,
    "list_files": list_files,
    "parse_time": parse_time,
    "decimal_comma": decimal_comma,
    "nan_to_null": nan_to_null_query,
    "reject_rows": reject_rows,
    "valid_rows": valid_rows,
    "dq_nulls": dq_nulls,
    "dq_duplicate_keys": dq_duplicate_keys,
    "missing_months": missing_months,
    "candle_projection": candle_projection,
    "calendar_parts": calendar_parts,
    "distinct_rows": distinct_rows,
    "rows_per_group": rows_per_group,
}

_CLOSE = sqltext.CLOSE
_text = sqltext.price_text
_price = sqltext.price

# The same results in SQL. `cells_bad` holds the text cells with errors.
_BAD = """
WITH cells_bad AS (
  SELECT o_orderkey AS seq, o_orderpriority AS stock_name,
         CAST(year(o_orderdate) AS INTEGER) AS current_year, o_orderdate, o_totalprice,
         o_totalprice * (1 + CAST((o_orderkey % 21) - 10 AS DOUBLE) / 1000) AS close_raw,
         o_orderstatus = 'P' AS bad_price,
         o_orderstatus = 'F' AND o_orderpriority IN ('2-HIGH', '3-MEDIUM') AS bad_time,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'
              THEN strftime(o_orderdate, '%Y-%m-%d ') || '9:00:00Z'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
              THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time_text,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a'
              ELSE replace(CAST(CAST(round(o_totalprice, 5) AS DECIMAL(18,5)) AS VARCHAR), '.', ',')
         END AS open_text
  FROM orders
)
"""
SQL = {
    "csv_scan": f"""
SELECT o_orderpriority AS stock_name, CAST(year(o_orderdate) AS INTEGER) AS current_year,
       'Bid' AS file_type, o_orderdate AS time_utc,
       {_price('o_totalprice')} AS open,
       {_price(f'greatest(o_totalprice, {_CLOSE})')} AS high,
       {_price(f'least(o_totalprice, {_CLOSE})')} AS low,
       {_price(_CLOSE)} AS close,
       CAST(o_orderkey AS DOUBLE) AS volume
FROM orders""",
    "csv_chunks_headerless": sqltext.query(
        f"""candles AS (
  SELECT o_orderpriority AS stock_name, o_orderdate AS time_utc, o_orderkey AS seq,
         {_price('o_totalprice')} AS open_price, {_price(_CLOSE)} AS close_price
  FROM orders
)""", sqltext.BOUNDARY,
        select="SELECT stock_name, year, month, first_time, first_seq, first_open, first_close, "
        "last_time, last_seq, last_open, last_close, n FROM boundary",
    ),
    "header_filter": f"""
SELECT o_orderpriority AS stock_name, CAST(year(o_orderdate) AS INTEGER) AS current_year,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time_text,
       {_text('o_totalprice')} AS open_text, {_text(_CLOSE)} AS close_text
FROM orders""",
    "path_columns": """
WITH p AS (
  SELECT o_orderpriority AS s, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n
  FROM orders GROUP BY 1, 2
)
SELECT '/landing/' || s || '/' || y || '/' || s || '_10 Secs_Bid_' || y || '.01.01_' || y
         || '.12.31.csv' AS file_path,
       s || '_10 Secs_Bid_' || y || '.01.01_' || y || '.12.31.csv' AS file_name,
       'Bid' AS file_type, s AS folder_stock, y AS folder_year,
       s AS stock_name, y AS current_year, n
FROM p""",
    "list_files": """
SELECT DISTINCT side AS file_type, 'stock_name=' || o_orderpriority AS stock_folder,
       'current_year=' || year(o_orderdate) AS year_folder, CAST(1 AS BIGINT) AS n
FROM orders, (VALUES ('Bid'), ('Ask')) AS sides(side)""",
    "parse_time": _BAD + """
SELECT seq, time_text, CASE WHEN bad_time THEN NULL ELSE time_text END AS time_utc,
       NOT bad_time AS is_time
FROM cells_bad""",
    "decimal_comma": _BAD + """
SELECT seq, open_text, TRY_CAST(replace(open_text, ',', '.') AS DOUBLE) AS open_price,
       TRY_CAST(replace(open_text, ',', '.') AS DOUBLE) IS NOT NULL AS is_number
FROM (SELECT seq, open_text FROM cells_bad UNION ALL
      SELECT o_orderkey, """ + _text("o_totalprice * 100 + 0.12345") + """ FROM orders)""",
    "nan_to_null": """
SELECT o_orderkey AS seq,
       CASE WHEN o_orderstatus <> 'P'
            THEN round((o_totalprice * 2 - o_totalprice) * 100 / nullif(o_totalprice, 0), 6) END
         AS growth,
       o_orderstatus = 'P' AS is_missing
FROM orders""",
    "reject_rows": _BAD + """
SELECT stock_name, current_year, CASE WHEN seq % 7 <> 1 THEN seq END AS seq,
       concat_ws(',', CASE WHEN bad_time THEN 'time' END, CASE WHEN bad_price THEN 'open' END,
                 CASE WHEN seq % 7 IN (0, 1) THEN 'cells' END) AS reject_reason,
       time_text, open_text
FROM cells_bad WHERE bad_time OR bad_price OR seq % 7 IN (0, 1)""",
    "valid_rows": _BAD + f"""
SELECT stock_name, seq, o_orderdate AS time_utc, {_price('o_totalprice')} AS open_price,
       {_price('close_raw')} AS close_price
FROM cells_bad WHERE NOT bad_time AND NOT bad_price""",
    "dq_nulls": _BAD + """
SELECT 'time_utc' AS column_name, count(*) FILTER (WHERE bad_time) AS n_null FROM cells_bad
UNION ALL SELECT 'open_price', count(*) FILTER (WHERE bad_price) FROM cells_bad
UNION ALL SELECT 'high_price', count(*) FILTER (WHERE o_totalprice IS NULL) FROM cells_bad
UNION ALL SELECT 'close_price', count(*) FILTER (WHERE close_raw IS NULL) FROM cells_bad
UNION ALL SELECT 'volume', count(*) FILTER (WHERE seq IS NULL) FROM cells_bad""",
    "dq_duplicate_keys": """
SELECT o_orderpriority AS stock_name, o_orderdate AS time_utc, count(*) AS n
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
    "missing_months": """
WITH present AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS stock_name,
         year(o_orderdate) * 12 + month(o_orderdate) - 1 AS m FROM orders
), span AS (SELECT stock_name, min(m) AS lo, max(m) AS hi FROM present GROUP BY 1),
calendar AS (SELECT stock_name, unnest(range(lo, hi + 1)) AS m FROM span)
SELECT c.stock_name, CAST(c.m // 12 AS INTEGER) AS year, CAST(c.m % 12 + 1 AS INTEGER) AS month
FROM calendar c ANTI JOIN present p ON c.stock_name = p.stock_name AND c.m = p.m""",
    "candle_projection": f"""
SELECT o_orderdate AS time, o_totalprice AS open, round({_CLOSE}, 6) AS close FROM orders""",
    "calendar_parts": """
SELECT o_orderpriority AS stock_name, o_orderkey AS seq,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders""",
    "distinct_rows": """
SELECT DISTINCT o_orderpriority AS stock_name, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders""",
    "rows_per_group": """
SELECT o_orderpriority AS stock_name, CAST(year(o_orderdate) AS INTEGER) AS current_year,
       count(*) AS number_of_processed_rows
FROM orders GROUP BY 1, 2""",
}
