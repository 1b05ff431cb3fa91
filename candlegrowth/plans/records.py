"""Queries on loads as they are published, streams, line chunks, positions, metrics and SQL functions."""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions import parse, procedures
from candlegrowth.functions.percent import rounded
from candlegrowth.operators import audit, boundary, clean, digest, growth, metrics, positions, report
from candlegrowth.plans import loads, sqltext
from candlegrowth.plans.bars import order_months
from candlegrowth.session import scratch_path
from candlegrowth.sinks import buckets, tables
from candlegrowth.sinks import files as sinks
from candlegrowth.sources import files as sources
from candlegrowth.sources import mapped
from candlegrowth.streaming.incremental import IncrementalLoad

FIRST_YEARS = 1996  # the years before it come with the first load
STOCK = "2-HIGH"
LINES = 1000  # of a chunk
MENDED_FROM = 1997
TABLE_BUCKETS = 8


def _load(spark, name):
    load = IncrementalLoad(spark, scratch_path(spark, name), "pairs", tie_break="volume", dense_ties=True)
    load.initialise()
    return load


def report_as_of_load(spark, folder):
    """The report after each of two loads, read when both are there."""
    path, load = scratch_path(spark, "two-loads"), _load(spark, "as-of")
    cells = mapped.order_cells(spark, folder)
    early = F.col("current_year") < FIRST_YEARS
    for part in (cells.where(early), cells.where(~early)):
        sinks.write_candle_csv(part, path, loads.BID_NAME)
        load.run(path, layout="partitions")
    rows = [load.report(as_of=i).drop("stock_bucket").withColumn("as_of", F.lit(i)) for i in (0, 1)]
    return rounded(rows[0].unionByName(rows[1]))


def stream_equals_batch(spark, folder):
    """The report after the files came as a stream, in micro-batches of ten."""
    path = scratch_path(spark, "stream-files")
    sinks.write_candle_csv(mapped.order_cells(spark, folder), path, loads.BID_NAME)
    load = _load(spark, "streamed")
    load.run_stream(path, scratch_path(spark, "stream-checkpoint"), layout="partitions", max_files=10)
    return rounded(load.report().drop("stock_bucket"))


def split_by_lines(spark, folder):
    """One file per stock cut into chunks of lines; of each chunk the first and the last key as they
    stand in its file (a header has none) and its lines."""
    path = scratch_path(spark, "whole-files")
    cells = mapped.order_cells(spark, folder)
    line = F.concat_ws(schema.DELIMITER, *schema.RAW_CANDLES.names).alias("value")
    key = F.col("volume_text").cast("bigint").alias("key")
    lines = cells.select("stock_name", key, line)
    header = cells.select("stock_name").distinct().select(
        "stock_name", F.lit(-1).cast("bigint").alias("key"), F.lit(schema.HEADER_LINE).alias("value")
    )
    ordered = lines.unionByName(header).repartition("stock_name").sortWithinPartitions("stock_name", "key")
    ordered.select("stock_name", "value").write.partitionBy("stock_name").text(f"{path}/in")
    read = spark.read.option("recursiveFileLookup", "true").text(f"{path}/in")
    stock = F.regexp_extract(parse.decode_path(F.col("file_path")), "stock_name=([^/]*)/", 1)
    sinks.split_by_lines(read, f"{path}/out", LINES, {"stock_name": stock})
    chunks = positions.numbered_lines(spark.read.text(f"{path}/out"))
    cells = F.split("value", schema.DELIMITER)
    return chunks.groupBy("stock_name", F.col("chunk").cast("bigint").alias("chunk")).agg(
        *[f(F.get(cells, F.lit(5)), "line").try_cast("bigint").alias(name)
          for f, name in ((F.min_by, "first_key"), (F.max_by, "last_key"))],
        F.count(F.lit(1)).alias("n"),
    )


def global_period_index(spark, folder):
    """The place of every month of every stock in the order of year, month and stock."""
    months = order_months(spark, folder).select("stock_name", "year", "month")
    return positions.global_index(months, ["year", "month", "stock_name"], "seq")


def load_metrics(spark, folder):
    """The numbers of a load with bad rows, taken while it was written."""
    _, parsed = loads._parsed_files(spark, folder, "observed")
    hashed = parsed.withColumn("row_hash", audit.row_hash(["stock_name", *schema.RAW_CANDLES.names]))
    rows, seen = metrics.observed(hashed)
    rows.write.parquet(scratch_path(spark, "observed-rows"))
    found = metrics.numbers(seen)
    return spark.createDataFrame(
        [tuple(found[name] for name in metrics.NAMES)], ", ".join(f"{name} long" for name in metrics.NAMES)
    )


def _functions(spark, folder):
    procedures.register(spark, order_months(spark, folder))


def sql_year_report(spark, folder):
    """Both algorithms by the table function."""
    _functions(spark, folder)
    return rounded(spark.sql("SELECT * FROM year_report('o-c') UNION ALL SELECT * FROM year_report('c-c')"))


def sql_result_for_stock(spark, folder):
    """Averages of one stock, named by the session variable."""
    _functions(spark, folder)
    spark.sql(f"SET VARIABLE stock = '{STOCK}'")
    return rounded(spark.sql(
        "SELECT * FROM average_report_for_stock(session.stock, 'o-c') UNION ALL "
        "SELECT * FROM average_report_for_stock(session.stock, 'c-c')"
    ))


def report_for_touched(spark, folder):
    """The report of the stocks and years that one load touched, from staging that is partitioned by
    them: the join prunes the partitions at run time."""
    path = scratch_path(spark, "touched")
    candles = mapped.order_candles(spark, folder).withColumn("current_year", F.year("time_utc"))
    sinks.stage_candles(candles, f"{path}/staging")
    staged = spark.read.parquet(f"{path}/staging")
    ledger = candles.select("stock_name", "current_year").distinct().withColumn("load_id", F.col("current_year") % 3)
    ledger.write.parquet(f"{path}/ledger")
    touched = spark.read.parquet(f"{path}/ledger").where("load_id = 1")
    bars = staged.join(touched, ["stock_name", "current_year"], "left_semi")
    months = boundary.month_boundary(bars, tie_break="seq", dense_ties=True)
    return rounded(report.year_report(growth.month_growth(months)))


def _named_files(spark, cells, path):
    """Cells with `seq` as one file per stock and year, a header and the lines by seq; under the same name
    whenever it is written, so that it takes the place of the file before it."""
    key = ["stock_name", "current_year"]
    lines = cells.select(*key, "seq", F.concat_ws(schema.DELIMITER, *schema.RAW_CANDLES.names).alias("value"))
    header = cells.select(*key).distinct().select(
        *key, F.lit(-1).cast("bigint").alias("seq"), F.lit(schema.HEADER_LINE).alias("value")
    )
    ordered = lines.unionByName(header).repartition(*key).sortWithinPartitions(*key, "seq")
    ordered.select(*key, "value").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(
        *key
    ).text(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listFiles(root, True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().startswith("part-"):
            store.rename(file, spark._jvm.org.apache.hadoop.fs.Path(file.getParent(), f"{loads.BID_NAME}.csv"))


def reject_ledger(spark, folder):
    """The lines set apart over two loads: all files, and then those of the years from 1997 on with their
    prices mended, their times not."""
    path, load = scratch_path(spark, "rejects-in"), _load(spark, "ledger")
    cells = mapped.order_cells_with_errors(spark, folder)
    _named_files(spark, cells, path)
    load.run(path, layout="partitions")
    mended = cells.where(f"current_year >= {MENDED_FROM}").withColumn(
        "open_text", F.when(F.col("open_text") == "n/a", F.col("high_text")).otherwise(F.col("open_text"))
    )
    _named_files(spark, mended, path)
    load.run(path, layout="partitions")
    return sources.with_path_columns(load.reject_ledger(), "partitions").select(
        "stock_name", "current_year", "version", "line", "reason", "status", "closed_by"
    )


def file_content_md5(spark, folder):
    """Length and MD5 of the bytes of one file per stock and year."""
    path = scratch_path(spark, "md5-in")
    cells = mapped.order_cells(spark, folder).withColumn("seq", F.col("volume_text").cast("bigint"))
    _named_files(spark, cells, path)
    found = digest.content_md5(sources.list_files(spark, path, schema.BID_GLOB))
    return sources.with_path_columns(found, "partitions").select("stock_name", "current_year", "length", "md5_sum")


def _bucketed_tables(spark, folder, name):
    """The report and a newer one for later years, bucketed alike by the keys of the report."""
    path = scratch_path(spark, name)
    database = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_database(spark, database, path)
    months_path = f"{path}/months_of_orders"
    order_months(spark, folder).write.parquet(months_path)
    months = spark.read.parquet(months_path)
    current = report.report_by_rules(months, "c-c", "lag_open").withColumn("version", F.lit(0))
    newer = report.report_by_rules(months, "c-c", "carry").withColumn("version", F.lit(1))
    incoming = current.unionByName(newer).where(F.col("current_year") >= 1999)
    names = [f"`{database}`.{table}" for table in ("current_report", "incoming_report", "next_report")]
    for rows, table in zip((current, incoming), names):
        buckets.write_bucketed(rows, table, report.REPORT_KEYS, TABLE_BUCKETS)
    return names


def bucketed_upsert(spark, folder):
    """The same as `upsert_report` on bucketed tables, merged without a shuffle."""
    current, incoming, target = _bucketed_tables(spark, folder, "bucketed")
    buckets.upsert_bucketed(spark, current, incoming, target, report.REPORT_KEYS, TABLE_BUCKETS, "version")
    return rounded(spark.table(target).drop("version"))


QUERIES = {
    "reject_ledger": reject_ledger,
    "file_content_md5": file_content_md5,
    "bucketed_upsert": bucketed_upsert,
    "report_as_of_load": report_as_of_load,
    "stream_equals_batch": stream_equals_batch,
    "split_by_lines": split_by_lines,
    "global_period_index": global_period_index,
    "load_metrics": load_metrics,
    "sql_year_report": sql_year_report,
    "sql_result_for_stock": sql_result_for_stock,
    "report_for_touched": report_for_touched,
}

_EARLY = loads._FILE_CANDLES.replace("FROM orders", f"FROM orders WHERE year(o_orderdate) < {FIRST_YEARS}")
_ORDERS = sqltext.candles()

SQL = {
    "reject_ledger": f"""
WITH placed AS (
  SELECT o_orderpriority AS stock_name, {loads._YEAR} AS current_year, o_orderstatus AS s,
         row_number() OVER (PARTITION BY o_orderpriority, year(o_orderdate) ORDER BY o_orderkey) AS line
  FROM orders
), bad AS (
  SELECT *, CASE WHEN s = 'P' THEN 'open' ELSE 'time' END AS reason FROM placed
  WHERE s = 'P' OR (s = 'F' AND stock_name IN ('2-HIGH', '3-MEDIUM'))
)
SELECT stock_name, current_year, 0 AS version, line, reason,
       CASE WHEN current_year < {MENDED_FROM} THEN 'open' WHEN s = 'P' THEN 'mended' ELSE 'repeated' END AS status,
       CASE WHEN current_year >= {MENDED_FROM} THEN 1 END AS closed_by
FROM bad
UNION ALL
SELECT stock_name, current_year, 1, line, reason, 'open', NULL FROM bad
WHERE current_year >= {MENDED_FROM} AND s = 'F'""",
    "file_content_md5": f"""
WITH files AS (
  SELECT o_orderpriority AS stock_name, {loads._YEAR} AS current_year,
         '{schema.HEADER_LINE}' || chr(10) || string_agg(
           concat_ws(';', {loads._GOOD_CELLS}) || chr(10), '' ORDER BY o_orderkey) AS content
  FROM orders GROUP BY 1, 2
)
SELECT stock_name, current_year, strlen(content) AS length, md5(content) AS md5_sum FROM files""",
    "bucketed_upsert": loads.SQL["upsert_report"],
    "report_as_of_load": f"""
SELECT *, 0 AS as_of FROM ({loads._both(_EARLY, loads._BOTH_COLUMNS)})
UNION ALL SELECT *, 1 AS as_of FROM ({loads._both(loads._FILE_CANDLES, loads._BOTH_COLUMNS)})""",
    "stream_equals_batch": loads._both(loads._FILE_CANDLES, loads._BOTH_COLUMNS),
    "split_by_lines": f"""
WITH lines AS (
  SELECT o_orderpriority AS stock_name, o_orderkey AS key FROM orders
  UNION ALL SELECT DISTINCT o_orderpriority, NULL FROM orders
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY stock_name ORDER BY key NULLS FIRST) - 1 AS line FROM lines
)
SELECT stock_name, line // {LINES} AS chunk, max(CASE WHEN line % {LINES} = 0 THEN key END) AS first_key,
       max(key) AS last_key, count(*) AS n
FROM placed GROUP BY stock_name, line // {LINES}""",
    "global_period_index": sqltext.on_boundary(
        "SELECT stock_name, year, month, row_number() OVER (ORDER BY year, month, stock_name) - 1 AS seq FROM boundary"
    ),
    "load_metrics": loads._FILES + """
SELECT count(*) AS rows, count(*) FILTER (WHERE bad) AS rejected,
       count(*) FILTER (WHERE time_text NOT LIKE '____-__-__ __:__:__') AS bad_time,
       count(*) FILTER (WHERE open_text = 'n/a') AS bad_open,
       0::BIGINT AS bad_high, 0::BIGINT AS bad_low, 0::BIGINT AS bad_close, 0::BIGINT AS bad_volume,
       0::BIGINT AS bad_cells,
       sum(h & ((1 << 30) - 1))::BIGINT AS sum_low, sum(h >> 30)::BIGINT AS sum_high
FROM hashed""",
    "sql_year_report": loads._both(_ORDERS, loads._BOTH_COLUMNS),
    "sql_result_for_stock": loads._both(
        _ORDERS, f"SELECT {sqltext.average_columns()} FROM averages WHERE stock_name = '{STOCK}'",
        sqltext.averages("both_reports"),
    ),
    "report_for_touched": sqltext.query(
        _ORDERS.replace("FROM orders", "FROM orders WHERE year(o_orderdate) % 3 = 1"),
        sqltext.BOUNDARY, sqltext.growth("open_close"), sqltext.report(),
        select=f"SELECT {sqltext.report_columns()} FROM report",
    ),
}
