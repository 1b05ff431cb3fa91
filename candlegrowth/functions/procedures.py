"""Stored calculations as SQL: table functions with parameters, and a session variable.

They stand over a view of month boundaries and are used from plain SQL:

    SELECT * FROM year_report('o-c');
    SET VARIABLE stock = 'XAUUSD';
    SELECT * FROM year_report_for_stock(session.stock, 'c-c');
"""

from candlegrowth import schema
from candlegrowth.functions.percent import GROWTH_SQL

_REPORT = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.REPORT.fields)
_AVERAGES = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.AVERAGES.fields)
_MONTHS = ", ".join(f"sum(growth) FILTER (WHERE month = {i}) AS {m}" for i, m in enumerate(schema.MONTHS, 1))
_MEANS = ", ".join(f"avg({m}) AS avg_{m}" for m in schema.MONTHS)

# Parameters may stand in WHERE only, so both kinds are views, and the functions choose from them.
_VIEWS = f"""
CREATE OR REPLACE TEMPORARY VIEW year_reports AS
WITH lagged AS (
  SELECT stock_name, year, month, n, first_open, last_close,
    lag(last_close, 1, first_open) OVER (PARTITION BY stock_name ORDER BY year, month) AS before
  FROM month_boundaries
), based AS (
  SELECT stock_name, year, month, n, last_close, stack(2, 'o-c', first_open, 'c-c', before) AS (algorithm_type, base)
  FROM lagged
), grown AS (
  SELECT stock_name, year, month, algorithm_type, {GROWTH_SQL} AS growth FROM based WHERE n > 1
)
SELECT stock_name, year AS current_year, algorithm_type, {_MONTHS}, avg(growth) AS total_per_year
FROM grown GROUP BY stock_name, year, algorithm_type
""", f"""
CREATE OR REPLACE TEMPORARY VIEW average_reports AS
SELECT stock_name, algorithm_type, {_MEANS}, avg(total_per_year) AS avg_total
FROM year_reports GROUP BY stock_name, algorithm_type
"""
_KIND = """algorithm_type = CASE WHEN kind IN ('o-c', 'c-c') THEN kind
  ELSE raise_error(concat('unknown algorithm type: ', kind)) END"""
_FUNCTIONS = [
    f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{suffix}({more}kind STRING) RETURNS TABLE ({columns}) "
    f"RETURN SELECT * FROM {name}s WHERE {_KIND} {condition}"
    for name, columns in (("year_report", _REPORT), ("average_report", _AVERAGES))
    for suffix, more, condition in (("", "", ""), ("_for_stock", "stock STRING, ", "AND stock_name = stock"))
]


def register(spark, boundaries):
    """The functions year_report(kind), average_report(kind), year_report_for_stock(stock, kind) and
    average_report_for_stock(stock, kind), and the session variable `stock`.

    Months of one bar are left out and `c-c` grows from the last close of the month before. NULL for a
    stock gives no row; an unknown kind is an error.
    """
    boundaries.createOrReplaceTempView("month_boundaries")
    for text in (*_VIEWS, *_FUNCTIONS, "DECLARE OR REPLACE VARIABLE stock STRING DEFAULT NULL"):
        spark.sql(text)
