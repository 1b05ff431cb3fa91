"""Boundary prices of each stock and period: the only pass over the raw bars.

Every form here aggregates before it shuffles, so a stock that holds a large share of all
bars still sends one row per task and period. What leaves this module is bounded by the
calendar: one row (or two) per stock and month.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth import schema

PERIOD_PARTS = {"month": ("year", "month"), "day": ("year", "month", "day")}
_PART = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def period_parts(period):
    if period not in PERIOD_PARTS:
        raise ValueError(f"unknown period: {period}")
    return PERIOD_PARTS[period]


def _period_keys(time, period):
    return [_PART[part](time).alias(part) for part in period_parts(period)]


def bar_prices(order, tie_break):
    """Open and close of the first and the last bar by `order`, and the number of bars."""
    seqs = [] if not tie_break else [
        F.min_by(tie_break, order).alias("first_seq"),
        F.max_by(tie_break, order).alias("last_seq"),
    ]
    return seqs + [
        F.min_by("open_price", order).cast("double").alias("first_open"),
        F.min_by("close_price", order).cast("double").alias("first_close"),
        F.max_by("open_price", order).cast("double").alias("last_open"),
        F.max_by("close_price", order).cast("double").alias("last_close"),
        F.count(F.lit(1)).alias("n"),
    ]


def edge_aggregates(order, tie_break=None):
    """Aggregates that reduce bars to a boundary, for a grouping of the caller's."""
    return [
        F.min("time_utc").alias("first_time"),
        F.max("time_utc").alias("last_time"),
        *bar_prices(order, tie_break),
    ]


def _boundary_names(period):
    names = list(schema.BOUNDARY.names)
    if period == "day":
        names.insert(names.index("month") + 1, "day")
    return names


def month_boundary(candles, tie_break=None, dense_ties=False, period="month"):
    """First and last bar of every stock and period, one row each.

    Times are unique per stock in candle data, and then ordering by time alone keeps the plan
    a hash aggregate. Where times tie, name an integer `tie_break` column. With `dense_ties`
    (many bars per time, such as daily dates) the bars of one time are merged first, again by
    hash aggregates; otherwise the pair (time, tie_break) orders the bars, which sorts them
    inside each task but needs no further shuffle.
    """
    keys = ["stock_name", *_period_keys(F.col("time_utc"), period)]
    if tie_break and dense_ties:
        times = candles.groupBy("stock_name", "time_utc").agg(
            *bar_prices(F.col(tie_break), tie_break)
        )
        times = times.select(
            "*",
            *keys[1:],
            F.col("time_utc").alias("first_time"),
            F.col("time_utc").alias("last_time"),
        )
        return merge_boundaries(times, period, unique=True)
    order = F.struct("time_utc", tie_break) if tie_break else F.col("time_utc")
    edges = candles.groupBy(*keys).agg(*edge_aggregates(order, tie_break))
    if not tie_break:
        none = F.lit(None).cast("bigint")
        edges = edges.withColumns({"first_seq": none, "last_seq": none})
    return edges.select(*_boundary_names(period))


def merge_boundaries(parts, period="month", unique=False, versions=()):
    """Merge boundaries of parts of the data (files, days, batches) into one row per key.

    The merge is associative and ignores the order of arrival, so late bars need no watermark.
    With `unique` no two parts share a time, and ordering by time alone is enough. `versions`
    names integer columns by which the newest part wins where times tie.
    """
    older, newer = [-F.col(c) for c in versions], [F.col(c) for c in versions]
    first = F.col("first_time") if unique else F.struct("first_time", "first_seq", *older)
    last = F.col("last_time") if unique else F.struct("last_time", "last_seq", *newer)
    merged = parts.groupBy("stock_name", *period_parts(period)).agg(*merged_edges(first, last))
    return merged.withColumnsRenamed(MERGED_TIMES).select(*_boundary_names(period))


MERGED_TIMES = {"min_time": "first_time", "max_time": "last_time"}


def merged_edges(first, last):
    """Aggregates that merge boundaries; the times are renamed by MERGED_TIMES afterwards."""
    return [
        F.min("first_time").alias("min_time"),
        *[F.min_by(c, first).alias(c) for c in ("first_seq", "first_open", "first_close")],
        F.max("last_time").alias("max_time"),
        *[F.max_by(c, last).alias(c) for c in ("last_seq", "last_open", "last_close")],
        F.sum("n").alias("n"),
    ]


def month_boundary_window(candles, tie_break=None, dense_ties=False):
    """First open and last close by `first`/`last` over an unbounded window frame.

    A window over raw bars would put a whole stock and month in one task. The bars are reduced
    to days first, so a window never holds more than 31 rows.
    """
    days = month_boundary(candles, tie_break, dense_ties, period="day")
    frame = (
        Window.partitionBy("stock_name", "year", "month")
        .orderBy("day")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return days.select(
        "stock_name",
        "year",
        "month",
        F.first("first_open").over(frame).alias("first_open"),
        F.last("last_close").over(frame).alias("last_close"),
    ).dropDuplicates()


def has_two_bars():
    """Whether first and last bar differ. The count would also see a bar that came twice."""
    return (F.col("first_time") != F.col("last_time")) | ~F.col("first_seq").eqNullSafe(
        F.col("last_seq")
    )


def boundary_rows(boundary):
    """Long form: the first and the last bar of each month, once where they are the same bar."""
    first = F.struct(
        F.col("first_time").alias("date_time"),
        F.col("first_seq").alias("seq"),
        F.col("first_open").alias("open_price"),
        F.col("first_close").alias("close_price"),
    )
    last = F.struct(
        F.col("last_time").alias("date_time"),
        F.col("last_seq").alias("seq"),
        F.col("last_open").alias("open_price"),
        F.col("last_close").alias("close_price"),
    )
    bars = F.when(has_two_bars(), F.array(first, last)).otherwise(F.array(first))
    return boundary.select("stock_name", "year", "month", F.inline(bars))


def month_min_max_time(candles, period="month"):
    """Earliest and latest time of each period over all stocks."""
    return candles.groupBy(*_period_keys(F.col("time_utc"), period)).agg(
        F.min("time_utc").alias("min_time"), F.max("time_utc").alias("max_time")
    )


def boundary_rows_global(candles, period="month"):
    """Bars of any stock at the earliest or latest time of a period over all stocks.

    For months the key side holds 24 times per calendar year whatever the size of the data, and
    240,000 over all years that a time can name, so it is safe to broadcast and the bars are
    filtered in place. For days the join is left to adaptive execution.
    """
    edges = month_min_max_time(candles, period)
    times = edges.select(F.explode(F.array("min_time", "max_time")).alias("time_utc"))
    times = F.broadcast(times) if period == "month" else times
    return candles.join(times, "time_utc", "left_semi")


def boundary_pair_rank(rows):
    """Boundary rows with their rank inside the month."""
    order = Window.partitionBy("stock_name", "year", "month").orderBy("date_time", "seq")
    return rows.withColumn("rn", F.row_number().over(order))
