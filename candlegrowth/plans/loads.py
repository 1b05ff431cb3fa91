"""Queries that write and read back: staging, sinks, tables, audits and the incremental load."""

import datetime

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions.percent import rounded
from candlegrowth.operators import audit, clean, growth, report, upsert
from candlegrowth.plans import sqltext
from candlegrowth.plans.bars import order_months
from candlegrowth.session import scratch_path
from candlegrowth.sinks import files as sinks
from candlegrowth.sinks import tables
from candlegrowth.sources import files as sources
from candlegrowth.sources import mapped
from candlegrowth.streaming.incremental import IncrementalLoad

BID_NAME = "CANDLES_10 Secs_Bid_1995.01.01"


def _report(spark, folder, algorithm_type="o-c", rules="lag_open"):
    return report.report_by_rules(order_months(spark, folder), algorithm_type, rules)


def _bars(rows, *keys):
    """The bars read back, whole."""
    return rows.select(*keys, "time_utc", "seq", "open_price", F.round("close_price", 6).alias("close_price"))


def staging_partitions(spark, folder):
    path = scratch_path(spark, "staging")
    candles = mapped.order_candles(spark, folder)
    sinks.stage_candles(candles.withColumn("current_year", F.year("time_utc")), path)
    return _bars(spark.read.parquet(path), "stock_name", "current_year")


def split_by_month(spark, folder):
    path = scratch_path(spark, "by-month")
    sinks.split_by_month(mapped.order_candles(spark, folder), path)
    return _bars(spark.read.parquet(path), "stock_name", "year", "month")


def split_lines_by_month(spark, folder):
    """Lines as text files by month, read back."""
    path = scratch_path(spark, "lines-by-month")
    sinks.split_lines_by_month(mapped.order_lines(spark, folder), path)
    return spark.read.text(path).select("stock_name", "year", "month", F.col("value").alias("line"))


def split_by_day(spark, folder):
    """Each file holds one day and at most a full day of ten-second bars."""
    path = scratch_path(spark, "by-day")
    sinks.split_by_day(mapped.event_candles(spark, folder), path)
    rows = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    sizes = rows.groupBy("file").agg((F.count(F.lit(1)) <= schema.BARS_PER_DAY).alias("fits"))
    return _bars(rows.join(sizes, "file"), F.col("day").cast("string").alias("day"), "stock_name", "fits")


def csv_round_trip(spark, folder):
    path = scratch_path(spark, "report-csv")
    sinks.write_report_csv(_report(spark, folder), path)
    return rounded(sinks.read_report_csv(spark, path))


def growth_csv(spark, folder):
    """Month growth and year totals as two text outputs, read back and joined."""
    path = scratch_path(spark, "growth-csv")
    months = growth.month_growth(order_months(spark, folder))
    sinks.write_report_csv(months, f"{path}/months")
    sinks.write_report_csv(report.year_total(months), f"{path}/totals")
    month_schema = schema.struct(
        "stock_name string, year int, month int, algorithm_type string, growth double"
    )
    total_schema = schema.struct(
        "stock_name string, current_year int, algorithm_type string, total_per_year double"
    )
    rows = sinks.read_report_csv(spark, f"{path}/months", month_schema)
    totals = sinks.read_report_csv(spark, f"{path}/totals", total_schema)
    joined = rows.withColumnRenamed("year", "current_year").join(
        totals, ["stock_name", "current_year", "algorithm_type"]
    )
    return rounded(joined)


def _database(spark, folder):
    """A database of its own for one call, kept in the shared folder."""
    location = scratch_path(spark, "tables")
    database = location.rsplit("/", 1)[1].replace("-", "_")
    tables.create_tables(spark, database, location)
    years = report.report_both_algorithms(order_months(spark, folder), "pairs")
    tables.insert_select(spark, f"`{database}`.year_report", years)
    return database


def table_insert_select(spark, folder):
    """Create the tables, append the report, then the averages from the table, read them back."""
    database = _database(spark, folder)
    stored = tables.read_table(spark, f"`{database}`.year_report")
    tables.insert_select(spark, f"`{database}`.average_report", report.average_report(stored))
    return rounded(tables.read_table(spark, f"`{database}`.average_report"))


def table_truncate(spark, folder):
    """A truncated table takes a second load alone."""
    database = _database(spark, folder)
    name = f"`{database}`.year_report"
    tables.truncate_table(spark, name)
    tables.insert_select(spark, name, _report(spark, folder))
    return rounded(tables.read_table(spark, name))


def text_table(spark, folder):
    """A report kept as a delimited text table."""
    database = _database(spark, folder)
    name = f"`{database}`.report_text"
    tables.create_text_table(spark, name, schema.REPORT)
    stored = tables.read_table(spark, f"`{database}`.year_report")
    tables.insert_select(spark, name, stored)
    return rounded(tables.read_table(spark, name))


def _candle_files(spark, folder, name):
    path = scratch_path(spark, name)
    sinks.write_candle_csv(mapped.order_cells(spark, folder), path, BID_NAME)
    return path


def _parsed_files(spark, folder, name):
    """Candle files with bad rows among them and one that holds a header only: listed, and parsed."""
    path = scratch_path(spark, name)
    cells = mapped.order_cells_with_errors(spark, folder).drop("seq")
    sinks.write_candle_csv(cells, path, BID_NAME)
    header = spark.createDataFrame([("NONE", 1990, schema.HEADER_LINE)], "stock_name string, current_year int, value string")
    header.write.option("mapreduce.output.basename", BID_NAME).partitionBy("stock_name", "current_year").mode(
        "append"
    ).text(path)
    parsed = clean.parse_candles(sources.read_candles(spark, path, layout="partitions"))
    return sources.list_files(spark, path, schema.BID_GLOB), parsed


def file_md5(spark, folder):
    """The fingerprint and the number of rows of every file."""
    files, parsed = _parsed_files(spark, folder, "md5")
    found = audit.file_fingerprints(files.select("file_path"), parsed)
    return sources.with_path_columns(found, "partitions").select(
        "stock_name", "current_year", "row_fingerprint", "number_of_processed_rows"
    )


def staging_audit(spark, folder):
    """The audit of every file of a load that has been written; of the clock, that the write
    lies between both times."""
    files, parsed = _parsed_files(spark, folder, "audit")
    path = scratch_path(spark, "audited")
    start = datetime.datetime.now()
    parsed.write.parquet(path)
    end = datetime.datetime.now()
    rows = audit.staging_audit(files, spark.read.schema(parsed.schema).parquet(path), start, end, "partitions")
    return rows.select(
        "stock_name", "current_year", "file_type", "row_fingerprint", "number_of_processed_rows", "load_with_error",
        (F.col("end_load_date") > F.col("start_load_date")).alias("in_order"),
    )


def staging_audit_counts(spark, folder):
    """The parts of the staging audit that do not depend on clock and file bytes."""
    files, parsed = _parsed_files(spark, folder, "audit-counts")
    now = datetime.datetime.now()
    rows = audit.staging_audit(files, parsed, now, now, "partitions")
    return rows.groupBy("stock_name", "current_year", "file_type").agg(
        F.sum("number_of_processed_rows").alias("number_of_processed_rows"),
        F.bool_or("load_with_error").alias("load_with_error"),
        F.bool_and(F.length("row_fingerprint") == 32).alias("has_md5"),
    )


def destination_audit(spark, folder):
    years = report.report_both_algorithms(order_months(spark, folder), "pairs")
    rows = audit.destination_audit(years, "year_report")
    return rows.drop("start_load_date", "end_load_date")


def _file_list(spark, folder):
    cells = mapped.order_candles(spark, folder)
    year = F.year("time_utc").alias("current_year")
    files = cells.groupBy("stock_name", year).agg(
        F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs")
    )
    return files.select(
        "current_year",
        F.concat_ws("_", "stock_name", F.lit("Bid"), "current_year").alias("file_name"),
        F.md5(F.concat_ws("|", "stock_name", "current_year", "n", "seqs")).alias("md5_sum"),
        "n",
    )


def new_files_only(spark, folder):
    """Files of the list that the audit of the years before 2000 does not hold."""
    files = _file_list(spark, folder)
    known = files.where(F.col("current_year") < 2000)
    return audit.new_files_only(files, known)


def upsert_report(spark, folder):
    """A newer report for later years replaces the rows of these years; the others stay. The newer
    rows come after older ones of the same keys."""
    path = scratch_path(spark, "upsert-months")
    order_months(spark, folder).write.parquet(path)
    months = spark.read.parquet(path)
    current = report.report_by_rules(months, "c-c", "lag_open").withColumn("version", F.lit(0))
    newer = report.report_by_rules(months, "c-c", "carry").withColumn("version", F.lit(1))
    incoming = current.unionByName(newer).where(F.col("current_year") >= 1999)
    return rounded(upsert.upsert(current, incoming, report.REPORT_KEYS, "version").drop("version"))


def _loaded(spark, name, **options):
    return IncrementalLoad(
        spark, scratch_path(spark, name), "pairs", tie_break="volume", dense_ties=True, **options
    )


def incremental_equals_full(spark, folder):
    """Reports after the files were loaded in several batches."""
    path = _candle_files(spark, folder, "incoming")
    load = _loaded(spark, "incremental")
    load.initialise()
    load.run(path, layout="partitions", max_files=20)
    return rounded(load.report().drop("stock_bucket"))


def incremental_corrected_files(spark, folder):
    """Month boundaries after all files were loaded, and then those of the years from 1997 on came
    with other prices and without every fifth bar, in place of the old ones."""
    path = _candle_files(spark, folder, "corrected")
    load = _loaded(spark, "corrections")
    load.initialise()
    load.run(path, layout="partitions")
    cells = mapped.order_cells(spark, folder).where("current_year >= 1997 AND CAST(volume_text AS BIGINT) % 5 <> 0")
    dynamic = {"partitionOverwriteMode": "dynamic"}
    sinks.write_candle_csv(
        cells.withColumn("close_text", F.concat("close_text", F.lit("5"))), path, BID_NAME, "overwrite", options=dynamic
    )
    load.run(path, layout="partitions", withdraw=True)
    return load.months()


QUERIES = {
    "staging_partitions": staging_partitions,
    "split_by_month": split_by_month,
    "split_lines_by_month": split_lines_by_month,
    "split_by_day": split_by_day,
    "csv_round_trip": csv_round_trip,
    "growth_csv": growth_csv,
    "table_insert_select": table_insert_select,
    "table_truncate": table_truncate,
    "text_table": text_table,
    "file_md5": file_md5,
    "staging_audit": staging_audit,
    "staging_audit_counts": staging_audit_counts,
    "destination_audit": destination_audit,
    "new_files_only": new_files_only,
    "upsert_report": upsert_report,
    "incremental_equals_full": incremental_equals_full,
    "incremental_corrected_files": incremental_corrected_files,
}


def _report_sql(algorithm):
    return sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY, sqltext.growth(algorithm), sqltext.report(),
        select=f"SELECT {sqltext.report_columns()} FROM report",
    )


def _both(candles, select, *more):
    return sqltext.query(
        candles, sqltext.BOUNDARY,
        sqltext.growth("open_close", True, "growth_open"),
        sqltext.growth("close_prev_month", True, "growth_close"),
        sqltext.report("report_open", "growth_open"),
        sqltext.report("report_close", "growth_close"),
        "both_reports AS (SELECT * FROM report_open UNION ALL SELECT * FROM report_close)",
        *more, select=select,
    )


_BOTH_COLUMNS = f"SELECT {sqltext.report_columns()} FROM both_reports"
# Prices as the files hold them: five decimals.
_FILE_CANDLES = f"""candles AS (
  SELECT o_orderpriority AS stock_name, o_orderdate AS time_utc, o_orderkey AS seq,
         {sqltext.price('o_totalprice')} AS open_price,
         {sqltext.price(sqltext.CLOSE)} AS close_price
  FROM orders
)"""
_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
_CLOSE = sqltext.CLOSE
_text = sqltext.price_text
_BARS = (
    "o_orderdate AS time_utc, o_orderkey AS seq, o_totalprice AS open_price, "
    f"round({_CLOSE}, 6) AS close_price"
)
_GOOD_CELLS = f"""strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), {_text('o_totalprice')},
         {_text(f'greatest(o_totalprice, {_CLOSE})')}, {_text(f'least(o_totalprice, {_CLOSE})')},
         {_text(_CLOSE)}, CAST(o_orderkey AS VARCHAR)"""
# The audit of files with bad rows, and of one that holds a header only.
_FILES = f"""WITH cells AS (
  SELECT o_orderpriority AS stock_name, {_YEAR} AS current_year,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
              THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
              WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'
              THEN strftime(o_orderdate, '%Y-%m-%d ') || '9:00:00Z'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time_text,
         CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE {_text('o_totalprice')} END AS open_text,
         {_text('o_totalprice')} AS price_text, {_text(_CLOSE)} AS close_text,
         CAST(o_orderkey AS VARCHAR) AS volume_text,
         o_orderstatus = 'P' OR (o_orderstatus = 'F' AND o_orderpriority IN ('2-HIGH', '3-MEDIUM')) AS bad
  FROM orders
), hashed AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws(chr(1), stock_name, time_text, open_text, price_text,
                 price_text, close_text, volume_text)), 1, 15) AS BIGINT) AS h
  FROM cells
), files AS (
  SELECT stock_name, current_year, 'Bid' AS file_type,
         md5(concat_ws('|', sum(h & ((1 << 30) - 1)), sum(h >> 30), count(*))) AS row_fingerprint,
         count(*) AS number_of_processed_rows, bool_or(bad) AS load_with_error
  FROM hashed GROUP BY 1, 2
  UNION ALL SELECT 'NONE', 1990, 'Bid', md5('0|0|0'), 0, false
)
"""

SQL = {
    "staging_partitions": f"""
SELECT o_orderpriority AS stock_name, {_YEAR} AS current_year, {_BARS} FROM orders""",
    "split_by_month": f"""
SELECT o_orderpriority AS stock_name, {_YEAR} AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, {_BARS} FROM orders""",
    "split_lines_by_month": f"""
SELECT o_orderpriority AS stock_name, {_YEAR} AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       concat_ws(';', {_GOOD_CELLS}) AS line
FROM orders""",
    "split_by_day": """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS stock_name, true AS fits, ts AS time_utc,
       event_id AS seq, value AS open_price,
       round(value * (1 + CAST((event_id % 21) - 10 AS DOUBLE) / 1000), 6) AS close_price
FROM events""",
    "csv_round_trip": _report_sql("open_close"),
    "growth_csv": sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY, sqltext.growth("open_close"),
        select="SELECT stock_name, year AS current_year, month, algorithm_type, "
        "round(growth, 6) AS growth, " + sqltext.rounded("avg(growth) OVER (PARTITION BY stock_name, year)")
        + " AS total_per_year FROM growth",
    ),
    "table_insert_select": _both(
        sqltext.candles(), f"SELECT {sqltext.average_columns()} FROM averages",
        sqltext.averages("both_reports"),
    ),
    "table_truncate": _report_sql("open_close"),
    "text_table": _both(sqltext.candles(), _BOTH_COLUMNS),
    "file_md5": _FILES + "SELECT stock_name, current_year, row_fingerprint, number_of_processed_rows FROM files",
    "staging_audit": _FILES + "SELECT *, true AS in_order FROM files",
    "staging_audit_counts": _FILES + "SELECT * EXCLUDE (row_fingerprint), true AS has_md5 FROM files",
    "destination_audit": _both(
        sqltext.candles(),
        "SELECT stock_name, algorithm_type, current_year, 'Bid' AS file_type, "
        "'year_report' AS task_name, CAST(sum(" + " + ".join(f"({m} IS NOT NULL)::INT" for m in schema.MONTHS)
        + ") AS BIGINT) AS number_of_processed_rows, "
        "bool_or(total_per_year IS NULL) AS load_with_error "
        "FROM both_reports GROUP BY stock_name, algorithm_type, current_year",
    ),
    "new_files_only": f"""
WITH files AS (
  SELECT o_orderpriority AS stock_name, {_YEAR} AS current_year, count(*) AS n,
         CAST(sum(o_orderkey) AS BIGINT) AS seqs
  FROM orders GROUP BY 1, 2
)
SELECT current_year, concat_ws('_', stock_name, 'Bid', current_year) AS file_name,
       md5(concat_ws('|', stock_name, current_year, n, seqs)) AS md5_sum, n
FROM files WHERE NOT current_year < 2000""",
    "upsert_report": sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY,
        sqltext.growth("close_lag2", name="growth_old"),
        sqltext.growth("close_first_year_carry", name="growth_new"),
        sqltext.report("report_old", "growth_old"), sqltext.report("report_new", "growth_new"),
        "merged AS (SELECT * FROM report_old WHERE current_year < 1999 "
        "UNION ALL SELECT * FROM report_new WHERE current_year >= 1999)",
        select=f"SELECT {sqltext.report_columns()} FROM merged",
    ),
    "incremental_equals_full": _both(_FILE_CANDLES, _BOTH_COLUMNS),
    "incremental_corrected_files": sqltext.query(
        f"""candles AS (
  SELECT o_orderpriority AS stock_name, o_orderdate AS time_utc, o_orderkey AS seq,
         {sqltext.price('o_totalprice')} AS open_price,
         CASE WHEN year(o_orderdate) < 1997 THEN {sqltext.price(sqltext.CLOSE)}
              ELSE CAST(replace({_text(sqltext.CLOSE)}, ',', '.') || '5' AS DOUBLE) END AS close_price
  FROM orders WHERE year(o_orderdate) < 1997 OR o_orderkey % 5 <> 0
)""", sqltext.BOUNDARY,
        select="SELECT stock_name, year, month, first_time, first_seq, first_open, first_close, "
        "last_time, last_seq, last_open, last_close, n FROM boundary",
    ),
}
