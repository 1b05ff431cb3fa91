"""Growth of each stock and month in percent, by one of several rules for the base price.

All rules read the month boundaries, so a window holds at most the months of one stock.
"""

from dataclasses import dataclass

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions.percent import growth_percent
from candlegrowth.operators.boundary import has_two_bars

OPEN_CLOSE = "open_close"
CLOSE_FIRST = "close_first"
CLOSE_FIRST_YEAR_CARRY = "close_first_year_carry"
CLOSE_PREV_MONTH = "close_prev_month"
CLOSE_LAG2 = "close_lag2"

ALGORITHM_TYPES = {
    OPEN_CLOSE: "o-c",
    CLOSE_FIRST: "c-c",
    CLOSE_FIRST_YEAR_CARRY: "c-c",
    CLOSE_PREV_MONTH: "c-c",
    CLOSE_LAG2: "c-c",
}


@dataclass(frozen=True)
class Rules:
    """One reading of the report: the rule behind `c-c` and how gaps are treated."""

    close_rule: str
    pairs_only: bool = False
    default_base: float | None = None
    missing: str = "null"
    average: str = "year_totals"

    def algorithm(self, algorithm_type):
        if algorithm_type == "o-c":
            return OPEN_CLOSE
        if algorithm_type == "c-c":
            return self.close_rule
        raise ValueError(f"unknown algorithm type: {algorithm_type}")


# The readings in use; they differ in `c-c`, in missing months and in one-bar months.
RULES = {
    "pairs": Rules(CLOSE_PREV_MONTH, pairs_only=True),
    "lag_constant": Rules(CLOSE_LAG2, default_base=schema.FIRST_BASE_CONSTANT),
    "lag_open": Rules(CLOSE_LAG2),
    "carry": Rules(CLOSE_FIRST_YEAR_CARRY, average="month_averages"),
    "zero_fill": Rules(CLOSE_FIRST, missing="zero"),
}


def _stock_months():
    return Window.partitionBy("stock_name").orderBy("year", "month")


def _base(algorithm, default_base):
    months = _stock_months()
    if algorithm == OPEN_CLOSE:
        return F.col("first_open")
    if algorithm == CLOSE_FIRST:
        return F.col("first_close")
    if algorithm == CLOSE_FIRST_YEAR_CARRY:
        new_year = F.lag("year", 1).over(months) < F.col("year")
        return F.when(new_year, F.lag("last_close", 1).over(months)).otherwise(F.col("first_close"))
    if algorithm == CLOSE_PREV_MONTH:
        return F.expr("lag(last_close, 1, first_open)").over(months)
    if algorithm == CLOSE_LAG2:
        if default_base is not None:
            return F.lag("last_close", 2, float(default_base)).over(months)
        return F.expr("lag(last_close, 2, first_open)").over(months)
    raise ValueError(f"unknown algorithm: {algorithm}")


def month_growth(boundary, algorithm=OPEN_CLOSE, pairs_only=False, default_base=None):
    """Growth percent per stock, year and month.

    `pairs_only` leaves out months of one bar, after they served as a base for the next month.
    """
    return _growths(boundary, [algorithm], pairs_only, default_base)


def growth_by_rules(boundary, algorithm_types, rules):
    """Growth for algorithm types (`o-c`, `c-c`) as one of the readings in RULES defines them."""
    rules = RULES[rules] if isinstance(rules, str) else rules
    algorithms = [rules.algorithm(kind) for kind in algorithm_types]
    return _growths(boundary, algorithms, rules.pairs_only, rules.default_base)


def _growths(boundary, algorithms, pairs_only, default_base):
    """Growth by one or more rules from one reading of the boundaries."""
    keys = ["stock_name", "year", "month"]
    growths = [
        [
            F.lit(ALGORITHM_TYPES.get(algorithm)).alias("algorithm_type"),
            growth_percent(F.col("last_close"), _base(algorithm, default_base)).alias("growth"),
        ]
        for algorithm in algorithms
    ]
    if len(growths) == 1:
        columns = growths[0]
    else:
        columns = [F.array(*[F.struct(*columns) for columns in growths]).alias("growths")]
    pair = [has_two_bars().alias("pair")] if pairs_only else []
    rows = boundary.select(*keys, *columns, *pair)
    if pairs_only:
        rows = rows.where("pair").drop("pair")
    return rows if len(growths) == 1 else rows.select(*keys, F.inline("growths"))


def boundary_rows_with_lags(rows):
    """Boundary rows with the previous open and the closes one and two rows back.

    Where there is no earlier row, the row's own open stands in.
    """
    order = Window.partitionBy("stock_name").orderBy("date_time", "seq")
    with_prev = rows.select(
        "*",
        F.expr("lag(open_price, 1, open_price)").over(order).alias("prev_open"),
        F.expr("lag(close_price, 1, open_price)").over(order).alias("prev_close"),
    )
    return with_prev.withColumn(
        "prev_prev_close", F.expr("lag(prev_close, 1, open_price)").over(order)
    )


def period_index(boundary):
    """Position of each month inside its stock, from zero."""
    return boundary.withColumn("seq", F.row_number().over(_stock_months()) - 1)


def lag_by_self_join(boundary):
    """Last close one and two months back, by joins on the shifted position."""
    indexed = period_index(boundary).select(
        "stock_name", "year", "month", "seq", "first_open", "last_close"
    )

    def shifted(months, name):
        return indexed.select(
            "stock_name", (F.col("seq") + months).alias("seq"), F.col("last_close").alias(name)
        )

    def earlier(rows, others):
        """Left join that also matches NULL stocks; without a NULL filter on one side, both sides
        read the same shuffled months."""
        others = others.withColumnsRenamed({"stock_name": "other_stock", "seq": "other_seq"})
        same = rows["stock_name"].eqNullSafe(others["other_stock"]) & rows["seq"].eqNullSafe(
            others["other_seq"]
        )
        return rows.join(others, same, "left").drop("other_stock", "other_seq")

    joined = earlier(indexed, shifted(1, "prev_close"))
    joined = earlier(joined, shifted(2, "prev_prev_close"))
    own_open = F.col("first_open")
    return joined.select(
        "stock_name",
        "year",
        "month",
        F.coalesce("prev_close", own_open).alias("prev_close"),
        F.coalesce("prev_prev_close", own_open).alias("prev_prev_close"),
    )
