"""Candle views over order and event tables.

Orders stand for candles by month: several orders share one date, so `seq` breaks the ties.
Events stand for candles by day: their times are unique.
"""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions import parse

_ORDER_CLOSE = "o_totalprice * (1 + CAST((o_orderkey % 21) - 10 AS DOUBLE) / 1000)"
_EVENT_CLOSE = "value * (1 + CAST((event_id % 21) - 10 AS DOUBLE) / 1000)"


def orders(spark, folder):
    return spark.read.parquet(f"{folder}/orders.parquet")


def order_candles(spark, folder, stock="o_orderpriority"):
    return orders(spark, folder).selectExpr(
        f"CAST({stock} AS STRING) AS stock_name",
        "o_orderdate AS time_utc",
        "o_orderkey AS seq",
        "o_totalprice AS open_price",
        f"{_ORDER_CLOSE} AS close_price",
    )


def customer_candles(spark, folder):
    """Many stocks with few bars each: most months are missing or hold one bar."""
    return order_candles(spark, folder, stock="o_custkey")


def event_candles(spark, folder):
    return spark.read.parquet(f"{folder}/events.parquet").selectExpr(
        "event_type AS stock_name",
        "ts AS time_utc",
        "event_id AS seq",
        "value AS open_price",
        f"{_EVENT_CLOSE} AS close_price",
    )


def order_cells(spark, folder):
    """Order candles as the text cells of a candle file; the volume cell holds `seq`."""
    candles = order_candles(spark, folder)
    low = F.least("open_price", "close_price")
    high = F.greatest("open_price", "close_price")
    return candles.select(
        parse.time_to_text(F.col("time_utc")).alias("time_text"),
        parse.decimal_to_text(F.col("open_price")).alias("open_text"),
        parse.decimal_to_text(high).alias("high_text"),
        parse.decimal_to_text(low).alias("low_text"),
        parse.decimal_to_text(F.col("close_price")).alias("close_text"),
        F.col("seq").cast("string").alias("volume_text"),
        "stock_name",
        F.year("time_utc").alias("current_year"),
    )


def order_cells_with_errors(spark, folder):
    """The same cells with bad ones: status P has no price, status F of one stock a wrong time."""
    source = orders(spark, folder)
    bad_price = F.col("o_orderstatus") == "P"
    bad_time = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    time = parse.time_to_text(F.col("o_orderdate"))
    odd_time = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "3-MEDIUM")
    other_form = F.concat_ws(
        "/", F.dayofmonth("o_orderdate"), F.month("o_orderdate"), F.year("o_orderdate")
    )
    price = parse.decimal_to_text(F.col("o_totalprice"))
    return source.select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderpriority").alias("stock_name"),
        F.year("o_orderdate").alias("current_year"),
        F.when(bad_time, other_form).when(odd_time, F.concat(F.substring(time, 1, 11), F.lit("9:00:00Z")))
        .otherwise(time).alias("time_text"),
        F.when(bad_price, F.lit("n/a")).otherwise(price).alias("open_text"),
        price.alias("high_text"),
        price.alias("low_text"),
        parse.decimal_to_text(F.expr(_ORDER_CLOSE)).alias("close_text"),
        F.col("o_orderkey").cast("string").alias("volume_text"),
    )


def odd_lines(spark, folder):
    """Lines of which some have a cell too many, some one too few: by the key's remainder of 7."""
    cells = order_cells_with_errors(spark, folder)
    line = F.concat_ws(schema.DELIMITER, *schema.RAW_CANDLES.names)
    turn = F.col("seq") % 7
    return cells.select(
        "stock_name", "current_year",
        F.when(turn == 0, F.concat(line, F.lit(";1;2")))
        .when(turn == 1, F.substring_index(line, schema.DELIMITER, 5)).otherwise(line).alias("value"),
    )


def chunk_lines(spark, folder):
    """Order lines in three chunks per stock and year, of which only the first has a header."""
    cells = order_cells(spark, folder)
    line = F.concat_ws(schema.DELIMITER, *schema.RAW_CANDLES.names)
    lines = cells.select(
        "stock_name", "current_year", (F.col("volume_text").cast("bigint") % 3).alias("chunk"), line.alias("value")
    )
    headers = cells.select("stock_name", "current_year").distinct().select(
        "*", F.lit(0).cast("bigint").alias("chunk"), F.lit(schema.HEADER_LINE).alias("value")
    )
    return lines.unionByName(headers)


def large_cells(spark, folder):
    """Cells with prices over a million and five decimals."""
    candles = order_candles(spark, folder).withColumn("open_price", F.col("open_price") * 100 + 0.12345)
    return candles.select(
        "seq", parse.decimal_to_text(F.col("open_price")).alias("open_text"),
    )


def order_lines(spark, folder):
    """Order candles as lines of a file, with one header line per stock and year among them."""
    cells = order_cells(spark, folder)
    key = ["stock_name", "current_year"]
    lines = cells.select(*key, F.concat_ws(schema.DELIMITER, *schema.RAW_CANDLES.names).alias("value"))
    headers = cells.select(*key).distinct().withColumn("value", F.lit(schema.HEADER_LINE))
    return lines.unionByName(headers)
