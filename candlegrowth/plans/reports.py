"""Queries on year reports and averages."""

from pyspark.sql import functions as F

from candlegrowth.functions.percent import rounded
from candlegrowth.operators import boundary, growth, report
from candlegrowth.plans import sqltext
from candlegrowth.plans.bars import customer_months, order_months
from candlegrowth.sources import mapped

STOCK = "2-HIGH"


def _report(algorithm_type, rules, months=order_months):
    def run(spark, folder):
        return rounded(report.report_by_rules(months(spark, folder), algorithm_type, rules))

    return run


def _averages(algorithm_type, rules, months=order_months):
    def run(spark, folder):
        years = report.report_by_rules(months(spark, folder), algorithm_type, rules)
        return rounded(report.averages_by_rules(years, rules))

    return run


def _open_close(spark, folder, months=order_months):
    return growth.month_growth(months(spark, folder), growth.OPEN_CLOSE)


def year_total(spark, folder):
    return rounded(report.year_total(_open_close(spark, folder, customer_months)))


def year_total_window(spark, folder):
    return rounded(report.year_total_window(_open_close(spark, folder)))


def year_total_zero_fill(spark, folder):
    return rounded(report.year_total(_open_close(spark, folder, customer_months), "zero"))


def pivot_join_totals(spark, folder):
    return rounded(report.pivot_join_totals(_open_close(spark, folder)))


def report_both_algorithms(spark, folder):
    return rounded(report.report_both_algorithms(order_months(spark, folder), "pairs"))


def _for_stock(spark, folder):
    both = report.report_both_algorithms(order_months(spark, folder), "pairs")
    return report.report_for_stock(spark, both, report.average_report(both), STOCK)


def report_for_stock(spark, folder):
    return rounded(_for_stock(spark, folder)[0])


def averages_for_stock(spark, folder):
    return rounded(_for_stock(spark, folder)[1])


def report_sorted(spark, folder):
    years = report.report_by_rules(order_months(spark, folder), "o-c", "lag_open")
    return report.report_sorted(rounded(years))


def report_top_n(spark, folder):
    years = report.report_by_rules(customer_months(spark, folder), "o-c", "lag_open")
    return rounded(report.report_top_n(years, 20))


def union_year_parts(spark, folder):
    """Boundaries of two parts of the data, split at a date inside a month, merged into one."""
    candles = mapped.order_candles(spark, folder)
    before = F.col("time_utc") < F.lit("1998-06-15").cast("timestamp_ntz")
    early = F.coalesce(before, F.lit(False))
    parts = [
        boundary.month_boundary(part, tie_break="seq", dense_ties=True)
        for part in (candles.where(early), candles.where(~early))
    ]
    return rounded(boundary.merge_boundaries(parts[0].unionByName(parts[1])))


QUERIES = {
    "year_report_oc": _report("o-c", "lag_open"),
    "year_report_oc_pairs": _report("o-c", "pairs", customer_months),
    "year_report_cc_first": _report("c-c", growth.Rules(growth.CLOSE_FIRST)),
    "year_report_cc_carry": _report("c-c", "carry", customer_months),
    "year_report_cc_prev": _report("c-c", "pairs", customer_months),
    "year_report_cc_lag2": _report("c-c", "lag_open"),
    "year_report_cc_lag2_const": _report("c-c", "lag_constant"),
    "year_report_zero_fill": _report("c-c", "zero_fill", customer_months),
    "year_total": year_total,
    "year_total_window": year_total_window,
    "year_total_zero_fill": year_total_zero_fill,
    "pivot_join_totals": pivot_join_totals,
    "average_report": _averages("o-c", "lag_open"),
    "average_report_zero_fill": _averages("c-c", "zero_fill"),
    "average_of_month_averages": _averages("c-c", "carry", customer_months),
    "report_both_algorithms": report_both_algorithms,
    "report_for_stock": report_for_stock,
    "averages_for_stock": averages_for_stock,
    "report_sorted": report_sorted,
    "report_top_n": report_top_n,
    "union_year_parts": union_year_parts,
}

_CUSTOMER = "o_custkey"


def _report_sql(algorithm, stock="o_orderpriority", pairs_only=False, zero=False, tail=""):
    return sqltext.query(
        sqltext.candles(stock), sqltext.BOUNDARY, sqltext.growth(algorithm, pairs_only),
        sqltext.report(zero=zero),
        select=f"SELECT {sqltext.report_columns()} FROM report {tail}",
    )


def _average_sql(algorithm, stock="o_orderpriority", zero=False, select=None):
    return sqltext.query(
        sqltext.candles(stock), sqltext.BOUNDARY, sqltext.growth(algorithm),
        sqltext.report(zero=zero), sqltext.averages(),
        select=select or f"SELECT {sqltext.average_columns()} FROM averages",
    )


_BOTH = (
    sqltext.candles(), sqltext.BOUNDARY,
    sqltext.growth("open_close", True, "growth_open"),
    sqltext.growth("close_prev_month", True, "growth_close"),
    sqltext.report("report_open", "growth_open"), sqltext.report("report_close", "growth_close"),
    "both_reports AS (SELECT * FROM report_open UNION ALL SELECT * FROM report_close)",
)
_AVG_MONTHS = [f"avg_{m}" for m in sqltext.MONTHS]
_MEAN_OF_MONTHS = (
    "(" + " + ".join(f"coalesce({m}, 0)" for m in _AVG_MONTHS) + ") / nullif("
    + " + ".join(f"CAST({m} IS NOT NULL AS INTEGER)" for m in _AVG_MONTHS) + ", 0)"
)


def _year_total(total):
    return f"""
SELECT stock_name, year AS current_year, algorithm_type, {sqltext.rounded(total)} AS total_per_year
FROM growth GROUP BY stock_name, year, algorithm_type"""



SQL = {
    "year_report_oc": _report_sql("open_close"),
    "year_report_oc_pairs": _report_sql("open_close", _CUSTOMER, pairs_only=True),
    "year_report_cc_first": _report_sql("close_first"),
    "year_report_cc_carry": _report_sql("close_first_year_carry", _CUSTOMER),
    "year_report_cc_prev": _report_sql("close_prev_month", _CUSTOMER, pairs_only=True),
    "year_report_cc_lag2": _report_sql("close_lag2"),
    "year_report_cc_lag2_const": _report_sql("close_lag2_const"),
    "year_report_zero_fill": _report_sql("close_first", _CUSTOMER, zero=True),
    "year_total": sqltext.query(
        sqltext.candles(_CUSTOMER), sqltext.BOUNDARY, sqltext.growth("open_close"),
        select=_year_total("avg(growth)"),
    ),
    "year_total_zero_fill": sqltext.query(
        sqltext.candles(_CUSTOMER), sqltext.BOUNDARY, sqltext.growth("open_close"),
        select=_year_total("coalesce(sum(growth), 0.0) / 12"),
    ),
    "year_total_window": sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY, sqltext.growth("open_close"),
        select="SELECT stock_name, year, month, algorithm_type, round(growth, 6) AS growth, "
        + sqltext.rounded("avg(growth) OVER (PARTITION BY stock_name, year)")
        + " AS total_growth FROM growth",
    ),
    "pivot_join_totals": sqltext.query(
        sqltext.candles(), sqltext.BOUNDARY, sqltext.growth("open_close"), sqltext.report("r"),
        "totals AS (SELECT stock_name, year, avg(growth) AS total FROM growth GROUP BY 1, 2)",
        select="SELECT r.stock_name, r.current_year, r.algorithm_type, "
        + ", ".join(f"{sqltext.rounded(f'r.{m}')} AS {m}" for m in sqltext.MONTHS)
        + f", {sqltext.rounded('t.total')} AS total_per_year FROM r LEFT JOIN totals t "
        "ON r.current_year = t.year AND r.stock_name = t.stock_name",
    ),
    "average_report": _average_sql("open_close"),
    "average_report_zero_fill": _average_sql("close_first", zero=True),
    "average_of_month_averages": _average_sql(
        "close_first_year_carry", _CUSTOMER,
        select="SELECT stock_name, algorithm_type, "
        + ", ".join(f"{sqltext.rounded(m)} AS {m}" for m in _AVG_MONTHS)
        + f", {sqltext.rounded(_MEAN_OF_MONTHS)} AS avg_total FROM averages",
    ),
    "report_both_algorithms": sqltext.query(
        *_BOTH, select=f"SELECT {sqltext.report_columns()} FROM both_reports"
    ),
    "report_for_stock": sqltext.query(
        *_BOTH,
        select=f"SELECT {sqltext.report_columns()} FROM both_reports WHERE stock_name = '{STOCK}'",
    ),
    "averages_for_stock": sqltext.query(
        *_BOTH, sqltext.averages("both_reports"),
        select=f"SELECT {sqltext.average_columns()} FROM averages WHERE stock_name = '{STOCK}'",
    ),
    "report_sorted": _report_sql(
        "open_close", tail="ORDER BY stock_name, current_year, algorithm_type"
    ),
    "report_top_n": _report_sql(
        "open_close", _CUSTOMER, tail="ORDER BY current_year, stock_name, algorithm_type LIMIT 20"
    ),
    "union_year_parts": sqltext.on_boundary("""
SELECT stock_name, year, month, first_time, first_seq, round(first_open, 6) AS first_open,
       round(first_close, 6) AS first_close, last_time, last_seq,
       round(last_open, 6) AS last_open, round(last_close, 6) AS last_close, n
FROM boundary"""),
}
