"""SQL building blocks for the comparison queries: candles, boundaries, growth and reports."""

from candlegrowth.schema import FIRST_BASE_CONSTANT, MONTHS


CLOSE = "o_totalprice * (1 + CAST((o_orderkey % 21) - 10 AS DOUBLE) / 1000)"


def price_text(value):
    """A price as the text of a cell: five decimals and a decimal comma."""
    return f"replace(CAST(CAST(round({value}, 5) AS DECIMAL(18,5)) AS VARCHAR), '.', ',')"


def price(value):
    """A price after it was written as text and read back."""
    return f"CAST(CAST(round({value}, 5) AS DECIMAL(18,5)) AS DOUBLE)"


def candles(stock="o_orderpriority"):
    return f"""candles AS (
  SELECT CAST({stock} AS VARCHAR) AS stock_name, o_orderdate AS time_utc, o_orderkey AS seq,
         o_totalprice AS open_price,
         {CLOSE} AS close_price
  FROM orders
)"""


BOUNDARY = """ranked AS (
  SELECT *, CAST(year(time_utc) AS INTEGER) AS year, CAST(month(time_utc) AS INTEGER) AS month,
         row_number() OVER (PARTITION BY stock_name, year(time_utc), month(time_utc)
                            ORDER BY time_utc, seq) AS from_start,
         row_number() OVER (PARTITION BY stock_name, year(time_utc), month(time_utc)
                            ORDER BY time_utc DESC, seq DESC) AS from_end
  FROM candles
), boundary AS (
  SELECT stock_name, year, month, count(*) AS n,
         max(CASE WHEN from_start = 1 THEN time_utc END) AS first_time,
         max(CASE WHEN from_start = 1 THEN seq END) AS first_seq,
         max(CASE WHEN from_start = 1 THEN open_price END) AS first_open,
         max(CASE WHEN from_start = 1 THEN close_price END) AS first_close,
         max(CASE WHEN from_end = 1 THEN time_utc END) AS last_time,
         max(CASE WHEN from_end = 1 THEN seq END) AS last_seq,
         max(CASE WHEN from_end = 1 THEN open_price END) AS last_open,
         max(CASE WHEN from_end = 1 THEN close_price END) AS last_close
  FROM ranked GROUP BY stock_name, year, month
)"""

_MONTHS = "(PARTITION BY stock_name ORDER BY year, month)"

BASE = {
    "open_close": "first_open",
    "close_first": "first_close",
    "close_first_year_carry":
        f"CASE WHEN lag(year) OVER {_MONTHS} < year THEN lag(last_close) OVER {_MONTHS} "
        "ELSE first_close END",
    "close_prev_month": f"coalesce(lag(last_close) OVER {_MONTHS}, first_open)",
    "close_lag2": f"coalesce(lag(last_close, 2) OVER {_MONTHS}, first_open)",
    "close_lag2_const":
        f"coalesce(lag(last_close, 2) OVER {_MONTHS}, CAST({FIRST_BASE_CONSTANT} AS DOUBLE))",
}


def growth(algorithm, pairs_only=False, name="growth"):
    kind = "o-c" if algorithm == "open_close" else "c-c"
    kept = "WHERE n > 1" if pairs_only else ""
    return f"""{name}_base AS (
  SELECT stock_name, year, month, n, last_close, {BASE[algorithm]} AS base FROM boundary
), {name} AS (
  SELECT stock_name, year, month, '{kind}' AS algorithm_type,
         (last_close - base) * 100 / nullif(base, 0) AS growth
  FROM {name}_base {kept}
)"""


def report(name="report", source="growth", zero=False):
    def value(i):
        total = f"sum(CASE WHEN month = {i} THEN growth END)"
        return f"coalesce({total}, 0.0)" if zero else total

    total = "coalesce(sum(growth), 0.0) / 12" if zero else "avg(growth)"
    columns = ",\n         ".join(f"{value(i)} AS {m}" for i, m in enumerate(MONTHS, 1))
    return f"""{name} AS (
  SELECT stock_name, year AS current_year, algorithm_type,
         {columns},
         {total} AS total_per_year
  FROM {source} GROUP BY stock_name, year, algorithm_type
)"""


def averages(source="report"):
    columns = ", ".join(f"avg({m}) AS avg_{m}" for m in MONTHS)
    return f"""averages AS (
  SELECT stock_name, algorithm_type, {columns}, avg(total_per_year) AS avg_total
  FROM {source} GROUP BY stock_name, algorithm_type
)"""


def rounded(value):
    """Six digits; a mean that rounds to zero from below is plain zero, as in Spark."""
    return f"round({value}, 6) + 0.0"


def report_columns():
    columns = ", ".join(f"{rounded(m)} AS {m}" for m in (*MONTHS, "total_per_year"))
    return f"stock_name, current_year, algorithm_type, {columns}"


def average_columns():
    columns = ", ".join(f"{rounded(f'avg_{m}')} AS avg_{m}" for m in (*MONTHS, "total"))
    return f"stock_name, algorithm_type, {columns}"


def query(*parts, select):
    return "WITH " + ",\n".join(parts) + "\n" + select


def on_boundary(select, stock="o_orderpriority"):
    return query(candles(stock), BOUNDARY, select=select)
