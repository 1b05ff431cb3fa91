"""What the plans of the queries must and must not hold."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from candlegrowth.functions import procedures
from candlegrowth.operators import boundary, growth, report
from candlegrowth.plans import records
from candlegrowth.sinks import buckets
from candlegrowth.sources import mapped

# The training-data queries may use Python; those that may not are tested in tests/llm.
QUERIES = {k: v for k, v in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
EAGER = {"incremental_equals_full"}
STREAMS_BYTES = {"file_content_md5"}  # a digest over bytes of any number is no built-in expression
PYTHON = ("Python", "ArrowEval", "MapInArrow", "InPandas", "MapInPandas")
ONE_WINDOW = r"Window.*\n.*Sort.*\n.*Exchange SinglePartition"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER - STREAMS_BYTES))
def test_no_cross_join_and_no_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", *PYTHON):
        assert word not in text
    assert not re.search(ONE_WINDOW, text)


def test_a_window_over_all_rows_would_be_seen(spark):
    rows = spark.range(10).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert re.search(ONE_WINDOW, plan(rows))


def test_touched_partitions_are_pruned_at_run_time(spark, data):
    assert "dynamicpruning" in plan(QUERIES["report_for_touched"](spark, data))


def test_bucketed_tables_are_merged_without_a_shuffle(spark, data):
    current, incoming, _ = records._bucketed_tables(spark, data, "plan")
    text = plan(buckets.merged(spark.table(current), spark.table(incoming), report.REPORT_KEYS, "version"))
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert text.count("FileScan") == 2


def test_global_index_needs_no_single_partition(spark, data):
    assert "SinglePartition" not in plan(QUERIES["global_period_index"](spark, data))


@pytest.mark.parametrize("kind", ["year_report", "average_report"])
def test_stock_of_the_sql_functions_reaches_the_scan(spark, data, kind):
    procedures.register(spark, boundary.month_boundary(mapped.order_candles(spark, data), "seq", dense_ties=True))
    text = plan(spark.sql(f"SELECT * FROM {kind}_for_stock('2-HIGH', 'c-c')"))
    assert "EqualTo(o_orderpriority,2-HIGH)" in text and text.count("FileScan") == 1
    spark.sql("SET VARIABLE stock = '2-HIGH'")
    text = plan(spark.sql(f"SELECT * FROM {kind}_for_stock(session.stock, 'c-c')"))
    assert "EqualTo(o_orderpriority,2-HIGH)" in text
    with pytest.raises(Exception, match="unknown algorithm type"):
        spark.sql(f"SELECT * FROM {kind}('x-c')").collect()


def test_bars_are_aggregated_before_they_are_shuffled(spark, data):
    text = plan(report.year_report(growth.month_growth(
        boundary.month_boundary(mapped.event_candles(spark, data))
    )))
    assert "SortAggregate" not in text and "Window" not in text and "Sort [" not in text
    assert "partial_min_by" in text and text.count("Exchange") == 2


def test_only_needed_columns_are_read(spark, data):
    text = plan(growth.month_growth(boundary.month_boundary(mapped.event_candles(spark, data))))
    columns = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"event_id", "ts", "event_type", "value"}
    months = QUERIES["missing_months"](spark, data)
    columns = re.search(r"ReadSchema: struct<([^>]*)", plan(months)).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"o_custkey", "o_orderdate"}


@pytest.mark.parametrize("name", ["report_for_stock", "averages_for_stock"])
def test_filter_on_the_stock_reaches_the_scan(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "EqualTo(o_orderpriority,2-HIGH)" in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["report_both_algorithms", "average_report"])
def test_reports_read_the_bars_once(spark, data, name):
    assert plan(QUERIES[name](spark, data)).count("FileScan") == 1


@pytest.mark.parametrize("name, scans", [("pivot_join_totals", 1), ("lag_by_self_join", 2)])
def test_joined_sides_share_passes_over_the_bars(spark, data, name, scans):
    df = QUERIES[name](spark, data)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == scans


def test_windows_hold_months_not_bars(spark, data):
    """The rows that reach a window do not grow with the bars of a stock."""
    bars = mapped.order_candles(spark, data)
    more = bars.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn(
        "seq", F.col("seq") * 5 + F.col("copy")
    )
    months = [boundary.month_boundary(b, "seq", dense_ties=True).count() for b in (bars, more)]
    assert months[0] == months[1]
    windowed = boundary.month_boundary_window(more, "seq", dense_ties=True)
    assert windowed.count() == months[0]
