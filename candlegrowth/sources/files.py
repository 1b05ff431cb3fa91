"""Delimited candle files: rows, lines and path columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrowth import schema
from candlegrowth.functions import parse

NO_AGE_LIMIT = "36500d"


def _reader(reader, delimiter, glob):
    return reader.options(
        sep=delimiter, header="false", pathGlobFilter=glob, mode="PERMISSIVE",
        ignoreLeadingWhiteSpace="true", ignoreTrailingWhiteSpace="true",
        columnNameOfCorruptRecord=schema.CORRUPT,
    )


def _raw_schema(partitioned):
    fields = [*schema.RAW_CANDLES.fields, T.StructField(schema.CORRUPT, T.StringType())]
    return T.StructType(fields + list(schema.PARTITIONS.fields) if partitioned else fields)


def is_header_row():
    """Header lines are known by their content, so a file without one loses nothing."""
    return F.col("time_text").eqNullSafe(schema.HEADER_CELL)


def _finish(raw, layout):
    raw = raw.withColumn("file_path", F.col("_metadata.file_path"))
    return with_path_columns(raw, layout).where(~is_header_row())


def with_path_columns(raw, layout="file_name"):
    """Add file_name, file_type, stock_name and current_year from `file_path`.

    The path is URL-encoded, as `_metadata` gives it; the added columns are decoded. Layouts:
    `file_name` takes stock and year from the name, `folders` from `stock/year/file`,
    `partitions` leaves the columns that partition discovery made. A column that is not selected
    later costs nothing, and columns of the file alone are best taken after a grouping by file.
    """
    path = F.col("file_path")
    added = {"file_name": parse.path_part(path, 1), "file_type": parse.quote_side_of_name(path)}
    if layout == "folders":
        added["stock_name"] = parse.path_part(path, 3)
        added["current_year"] = parse.path_part(path, 2).try_cast("int")
    elif layout == "file_name":
        added["stock_name"] = parse.stock_of_name(path)
        added["current_year"] = parse.year_of_name(path)
    elif layout == "partitions":
        if "stock_name" not in raw.columns:  # a listed file: partition discovery made no columns
            added["stock_name"] = F.substring_index(parse.path_part(path, 3), "stock_name=", -1)
            year = F.substring_index(parse.path_part(path, 2), "current_year=", -1)
            added["current_year"] = year.try_cast("int")
    else:
        raise ValueError(f"unknown layout: {layout}")
    return raw.withColumns(added)


def read_candles(
    spark, path, delimiter=schema.DELIMITER, glob=schema.BID_GLOB, layout="file_name", base=None
):
    """Candle rows as text cells, with the columns that the path carries. `path` may be a list of
    files; `base` is then the folder below which partition folders count.

    The schema is fixed: inference would scan the files twice and turn the time into a date.
    """
    reader = _reader(spark.read, delimiter, glob)
    if layout != "partitions":
        reader = reader.option("recursiveFileLookup", "true")
    elif base:
        reader = reader.option("basePath", base)
    raw = reader.schema(_raw_schema(layout == "partitions")).csv(path)
    return _finish(raw, layout)


def stream_candles(
    spark, path, delimiter=schema.DELIMITER, glob=schema.BID_GLOB, layout="file_name", max_files=None,
    headers=False,
):
    """The same rows as a stream over files as they arrive; with `headers` also the header lines, and
    length and modified of each row's file.

    By default a stream passes over files that are a week older than the newest; here no file is
    too old.
    """
    reader = _reader(spark.readStream, delimiter, glob).option("maxFileAge", NO_AGE_LIMIT)
    if layout != "partitions":
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.schema(_raw_schema(layout == "partitions")).csv(path)
    if not headers:
        return _finish(raw, layout)
    file = {"file_path": "file_path", "length": "file_size", "modified": "file_modification_time"}
    raw = raw.withColumns({name: F.col(f"_metadata.{field}") for name, field in file.items()})
    return with_path_columns(raw.withColumn("modified", F.unix_micros("modified")), layout)


def read_lines(spark, path, delimiter=schema.DELIMITER, glob="*"):
    """Candle files as lines: headers dropped wherever they stand, then split by position.

    A last empty field keeps its place, so a line always has the same positions. A line with more
    or fewer than six fields is no candle; `corrupt_line` then holds it whole.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    cells = F.split(F.col("value"), rf"\Q{delimiter}\E", -1)
    others = [c for c in lines.columns if c != "value"]
    return lines.where(~parse.is_header(F.col("value"), delimiter)).select(
        *others,
        F.get(cells, F.lit(0)).alias("time_text"),
        F.get(cells, F.lit(1)).alias("open_text"),
        F.get(cells, F.lit(4)).alias("close_text"),
        F.when(F.size(cells) != len(schema.RAW_CANDLES), F.col("value")).alias(schema.CORRUPT),
    )


def list_files(spark, path, glob="*"):
    """Files below a folder with their sizes, but for files of no bytes. Contents are not read: the columns
    are pruned."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=glob, recursiveFileLookup="true")
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            parse.path_part(F.col("_metadata.file_path"), 1).alias("file_name"),
            "path",
            "length",
            "modificationTime",
        )
    )
