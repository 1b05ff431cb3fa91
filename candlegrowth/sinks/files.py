"""Writers of partitioned parquet and delimited text."""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions import parse
from candlegrowth.operators import positions


# A session may ask for dynamic partition overwrite; a whole folder is then not emptied.
STATIC = {"partitionOverwriteMode": "static"}


def write_partitioned(df, path, partition_columns, mode="append", max_records=0):
    """Partitioned parquet.

    The rebalance hint brings the rows of a partition together, so there are few files, and lets
    adaptive execution split a partition that is larger than the advisory size.
    """
    writer = df.hint("rebalance", *partition_columns).write.options(**STATIC).mode(mode)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.partitionBy(*partition_columns).parquet(path)


def stage_candles(candles, path, mode="append"):
    """Candles by stock and year."""
    write_partitioned(candles, path, ["stock_name", "current_year"], mode)


def split_by_month(candles, path, mode="overwrite"):
    """Candles by stock, year and month."""
    parts = candles.withColumns({"year": F.year("time_utc"), "month": F.month("time_utc")})
    write_partitioned(parts, path, ["stock_name", "year", "month"], mode)


def write_lines(lines, path, partition_columns, mode="overwrite"):
    """Lines as text files below partition folders."""
    balanced = lines.hint("rebalance", *partition_columns)
    balanced.write.options(**STATIC).mode(mode).partitionBy(*partition_columns).text(path)


def split_lines_by_month(lines, path, delimiter=schema.DELIMITER, mode="overwrite"):
    """Lines of candle files, unchanged, by stock, year and month; headers are left out.

    A line without a readable time goes to the partition that stands for NULL.
    """
    time = parse.parse_time(F.substring_index("value", delimiter, 1))
    parts = lines.where(~parse.is_header(F.col("value"), delimiter)).select(
        "stock_name", F.year(time).alias("year"), F.month(time).alias("month"), "value"
    )
    write_lines(parts, path, ["stock_name", "year", "month"], mode)


def split_by_day(candles, path, mode="overwrite", max_records=schema.BARS_PER_DAY):
    """Candles by day, in files of at most one full day of ten-second bars."""
    parts = candles.withColumn("day", F.to_date("time_utc"))
    write_partitioned(parts, path, ["day"], mode, max_records)


def split_by_lines(lines, path, chunk_lines=schema.CHUNK_LINES, keys=None, mode="overwrite"):
    """Files cut into chunks of so many lines, header lines counted, each chunk a text file of its lines
    in their order; a chunk is written by one task, a file by many.

    `lines` are those of `spark.read.text`. `keys` names the folders above `chunk=` and how to make
    them from the column `file_path`, by default `file` from the file's name; they should tell the
    files apart. An empty file has no chunk, and the last one may be short.
    """
    numbered = positions.numbered_lines(lines)
    keys = keys or {"file": parse.path_part(F.col("file_path"), 1)}
    named = numbered.withColumns({**keys, "chunk": F.floor(F.col("line") / chunk_lines).cast("long")})
    folders = [*keys, "chunk"]
    ordered = named.repartition("file_path", "chunk").sortWithinPartitions(*folders, "file_path", "line")
    ordered.select(*folders, "value").write.options(**STATIC).mode(mode).partitionBy(*folders).text(path)


def write_report_csv(df, path, delimiter=schema.DELIMITER, mode="overwrite"):
    """Delimited text with a header; a missing value is written as NULL."""
    options = {"sep": delimiter, "header": "true", "nullValue": schema.NULL_TEXT}
    df.write.options(**options).mode(mode).csv(path)


def read_report_csv(spark, path, table_schema=schema.REPORT, delimiter=schema.DELIMITER):
    options = {"sep": delimiter, "header": "true", "nullValue": schema.NULL_TEXT}
    return spark.read.schema(table_schema).options(**options).csv(path)


def write_candle_csv(cells, path, name, mode="append", delimiter=schema.DELIMITER, options=STATIC):
    """Text cells as candle files below `stock_name=/current_year=` folders.

    `name` starts the file names, which the readers match with a glob such as `*Bid*`.
    """
    header = dict(zip(schema.RAW_CANDLES.names, schema.HEADER_LINE.split(";")))
    columns = [F.col(c).alias(header.get(c, c)) for c in cells.columns]
    partitions = list(schema.PARTITIONS.names)
    written = {"sep": delimiter, "header": "true", "mapreduce.output.basename": name}
    (
        cells.select(*columns)
        .hint("rebalance", *partitions)
        .write.options(**written, **options)
        .partitionBy(*partitions)
        .mode(mode)
        .csv(path)
    )
