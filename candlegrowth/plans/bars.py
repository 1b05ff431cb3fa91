"""Queries on month boundaries and growth."""

from pyspark.sql import functions as F

from candlegrowth.functions.percent import rounded
from candlegrowth.operators import boundary, growth
from candlegrowth.plans import sqltext
from candlegrowth.schema import FIRST_BASE_CONSTANT
from candlegrowth.sources import mapped

TIES = {"tie_break": "seq", "dense_ties": True}


def order_months(spark, folder):
    return boundary.month_boundary(mapped.order_candles(spark, folder), **TIES)


def customer_months(spark, folder):
    """Many stocks with gaps and one-bar months; times seldom tie."""
    return boundary.month_boundary(mapped.customer_candles(spark, folder), tie_break="seq")


def month_boundary(spark, folder):
    return rounded(order_months(spark, folder))


def month_boundary_sparse(spark, folder):
    return rounded(customer_months(spark, folder))


def day_boundary(spark, folder):
    """Times of events are unique, so time alone orders the bars."""
    days = boundary.month_boundary(mapped.event_candles(spark, folder), period="day")
    return rounded(days.drop("first_seq", "last_seq"))


def month_boundary_window(spark, folder):
    candles = mapped.order_candles(spark, folder)
    return rounded(boundary.month_boundary_window(candles, **TIES))


def month_min_max_time(spark, folder):
    return boundary.month_min_max_time(mapped.order_candles(spark, folder))


def boundary_rows(spark, folder):
    return rounded(boundary.boundary_rows(customer_months(spark, folder)))


def boundary_rows_global(spark, folder):
    return rounded(boundary.boundary_rows_global(mapped.order_candles(spark, folder)))


def boundary_pair_rank(spark, folder):
    """The second boundary row of each month that has two."""
    rows = boundary.boundary_rows(customer_months(spark, folder))
    return rounded(boundary.boundary_pair_rank(rows).where(F.col("rn") == 2))


def lag_column_default(spark, folder):
    rows = boundary.boundary_rows(order_months(spark, folder))
    return rounded(growth.boundary_rows_with_lags(rows))


def _growth(months, algorithm, **options):
    def run(spark, folder):
        return rounded(growth.month_growth(months(spark, folder), algorithm, **options))

    return run


def lag_by_self_join(spark, folder):
    return rounded(growth.lag_by_self_join(order_months(spark, folder)))


def period_index(spark, folder):
    months = growth.period_index(order_months(spark, folder))
    return months.select("stock_name", "year", "month", F.col("seq").cast("long").alias("seq"))


QUERIES = {
    "month_boundary": month_boundary,
    "month_boundary_sparse": month_boundary_sparse,
    "day_boundary": day_boundary,
    "month_boundary_window": month_boundary_window,
    "month_min_max_time": month_min_max_time,
    "boundary_rows": boundary_rows,
    "boundary_rows_global": boundary_rows_global,
    "boundary_pair_rank": boundary_pair_rank,
    "lag_column_default": lag_column_default,
    "lag_by_self_join": lag_by_self_join,
    "period_index": period_index,
    "month_growth_oc": _growth(order_months, growth.OPEN_CLOSE),
    "month_growth_oc_pairs": _growth(customer_months, growth.OPEN_CLOSE, pairs_only=True),
    "month_growth_cc_first": _growth(order_months, growth.CLOSE_FIRST),
    "month_growth_cc_carry": _growth(customer_months, growth.CLOSE_FIRST_YEAR_CARRY),
    "month_growth_cc_prev": _growth(customer_months, growth.CLOSE_PREV_MONTH, pairs_only=True),
    "month_growth_cc_lag2": _growth(customer_months, growth.CLOSE_LAG2),
    "month_growth_cc_lag2_const": _growth(
        order_months, growth.CLOSE_LAG2, default_base=FIRST_BASE_CONSTANT
    ),
}

_ROUNDED_BOUNDARY = """
SELECT stock_name, year, month, first_time, first_seq, round(first_open, 6) AS first_open,
       round(first_close, 6) AS first_close, last_time, last_seq,
       round(last_open, 6) AS last_open, round(last_close, 6) AS last_close, n
FROM boundary"""
_ROWS = """boundary_rows AS (
  SELECT stock_name, year, month, time_utc AS date_time, seq, open_price, close_price,
         from_start
  FROM ranked WHERE from_start = 1 OR from_end = 1
)"""


def _growth_sql(algorithm, stock="o_orderpriority", pairs_only=False):
    return sqltext.query(
        sqltext.candles(stock), sqltext.BOUNDARY, sqltext.growth(algorithm, pairs_only),
        select="SELECT stock_name, year, month, algorithm_type, round(growth, 6) AS growth "
        "FROM growth",
    )


SQL = {
    "month_boundary": sqltext.on_boundary(_ROUNDED_BOUNDARY),
    "month_boundary_sparse": sqltext.on_boundary(_ROUNDED_BOUNDARY, "o_custkey"),
    "day_boundary": """
WITH candles AS (
  SELECT event_type AS stock_name, ts, value AS open_price,
         value * (1 + CAST((event_id % 21) - 10 AS DOUBLE) / 1000) AS close_price
  FROM events
)
SELECT stock_name, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day,
       min(ts) AS first_time, round(arg_min(open_price, ts), 6) AS first_open,
       round(arg_min(close_price, ts), 6) AS first_close,
       max(ts) AS last_time, round(arg_max(open_price, ts), 6) AS last_open,
       round(arg_max(close_price, ts), 6) AS last_close, count(*) AS n
FROM candles GROUP BY 1, 2, 3, 4""",
    "month_boundary_window": """
WITH candles AS (
  SELECT o_orderpriority AS stock_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month, o_orderdate AS t, o_orderkey AS seq,
         o_totalprice AS open_price,
         o_totalprice * (1 + CAST((o_orderkey % 21) - 10 AS DOUBLE) / 1000) AS close_price
  FROM orders
)
SELECT DISTINCT stock_name, year, month,
       round(first_value(open_price) OVER w, 6) AS first_open,
       round(last_value(close_price) OVER w, 6) AS last_close
FROM candles
WINDOW w AS (PARTITION BY stock_name, year, month ORDER BY t, seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "month_min_max_time": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       min(o_orderdate) AS min_time, max(o_orderdate) AS max_time
FROM orders GROUP BY 1, 2""",
    "boundary_rows": sqltext.query(
        sqltext.candles("o_custkey"), sqltext.BOUNDARY, _ROWS,
        select="SELECT stock_name, year, month, date_time, seq, "
        "round(open_price, 6) AS open_price, round(close_price, 6) AS close_price "
        "FROM boundary_rows",
    ),
    "boundary_rows_global": sqltext.query(
        sqltext.candles(),
        """edges AS (
  SELECT min(time_utc) AS lo, max(time_utc) AS hi FROM candles
  GROUP BY year(time_utc), month(time_utc)
)""",
        select="SELECT time_utc, stock_name, seq, round(open_price, 6) AS open_price, "
        "round(close_price, 6) AS close_price FROM candles "
        "WHERE time_utc IN (SELECT hi FROM edges) OR time_utc IN (SELECT lo FROM edges)",
    ),
    "boundary_pair_rank": sqltext.query(
        sqltext.candles("o_custkey"), sqltext.BOUNDARY, _ROWS,
        select="SELECT stock_name, year, month, date_time, seq, "
        "round(open_price, 6) AS open_price, round(close_price, 6) AS close_price, "
        "CAST(2 AS INTEGER) AS rn FROM boundary_rows WHERE from_start > 1",
    ),
    "lag_column_default": sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY, _ROWS,
        """lagged AS (
  SELECT *, lag(open_price, 1, open_price) OVER w AS prev_open,
         lag(close_price, 1, open_price) OVER w AS prev_close
  FROM boundary_rows WINDOW w AS (PARTITION BY stock_name ORDER BY date_time, seq)
)""",
        select="SELECT stock_name, year, month, date_time, seq, "
        "round(open_price, 6) AS open_price, round(close_price, 6) AS close_price, "
        "round(prev_open, 6) AS prev_open, round(prev_close, 6) AS prev_close, "
        "round(lag(prev_close, 1, open_price) OVER (PARTITION BY stock_name "
        "ORDER BY date_time, seq), 6) AS prev_prev_close FROM lagged",
    ),
    "lag_by_self_join": sqltext.on_boundary("""
SELECT stock_name, year, month,
       round(coalesce(lag(last_close, 1) OVER w, first_open), 6) AS prev_close,
       round(coalesce(lag(last_close, 2) OVER w, first_open), 6) AS prev_prev_close
FROM boundary WINDOW w AS (PARTITION BY stock_name ORDER BY year, month)"""),
    "period_index": sqltext.on_boundary("""
SELECT stock_name, year, month,
       row_number() OVER (PARTITION BY stock_name ORDER BY year, month) - 1 AS seq
FROM boundary"""),
    "month_growth_oc": _growth_sql("open_close"),
    "month_growth_oc_pairs": _growth_sql("open_close", "o_custkey", pairs_only=True),
    "month_growth_cc_first": _growth_sql("close_first"),
    "month_growth_cc_carry": _growth_sql("close_first_year_carry", "o_custkey"),
    "month_growth_cc_prev": _growth_sql("close_prev_month", "o_custkey", pairs_only=True),
    "month_growth_cc_lag2": _growth_sql("close_lag2", "o_custkey"),
    "month_growth_cc_lag2_const": _growth_sql("close_lag2_const"),
}
