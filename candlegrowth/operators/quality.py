"""Data-quality checks."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def dq_nulls(df, columns):
    """Number of NULLs per column, one row per column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_null")


def dq_duplicate_keys(df, keys):
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def missing_months(boundary):
    """Months between a stock's first and last month that have no bar.

    The gap after each month is read from the next present month, so nothing is joined and a
    window holds only the months of one stock.
    """
    order = Window.partitionBy("stock_name").orderBy("month_start")
    months = boundary.select(
        "stock_name", F.make_date("year", "month", F.lit(1)).alias("month_start")
    )
    gaps = months.withColumn("next_start", F.lead("month_start").over(order)).where(
        F.col("next_start") > F.add_months("month_start", 1)
    )
    absent = F.sequence(
        F.add_months("month_start", 1), F.add_months("next_start", -1), F.expr("interval 1 month")
    )
    return gaps.select("stock_name", F.explode(absent).alias("absent")).select(
        "stock_name", F.year("absent").alias("year"), F.month("absent").alias("month")
    )
