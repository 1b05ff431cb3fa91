"""Year reports, averages over the years and the queries on them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions.percent import zero_if_missing
from candlegrowth.operators import growth as growth_rules

REPORT_KEYS = ["stock_name", "current_year", "algorithm_type"]


def _checked(missing):
    if missing not in ("null", "zero"):
        raise ValueError(f"unknown rule for missing months: {missing}")
    return missing == "zero"


def _total(zero):
    growth = F.col("growth")
    return zero_if_missing(F.sum(growth)) / 12 if zero else F.avg(growth)


def year_report(growth, missing="null"):
    """Twelve month columns and the year's mean, in one aggregate.

    With `missing="zero"` an absent month counts as 0, also in the mean over twelve months.
    """
    zero = _checked(missing)

    def month(number):
        value = F.sum(F.when(F.col("month") == number, F.col("growth")))
        return zero_if_missing(value) if zero else value

    return growth.groupBy(
        "stock_name", F.col("year").alias("current_year"), "algorithm_type"
    ).agg(
        *[month(i).alias(name) for i, name in enumerate(schema.MONTHS, 1)],
        _total(zero).alias("total_per_year"),
    )


def year_total(growth, missing="null"):
    return growth.groupBy(
        "stock_name", F.col("year").alias("current_year"), "algorithm_type"
    ).agg(_total(_checked(missing)).alias("total_per_year"))


def year_total_window(growth):
    """Each month's growth next to the mean of its year; a window holds at most twelve rows."""
    year = Window.partitionBy("stock_name", "year")
    return growth.withColumn("total_growth", F.avg("growth").over(year))


def pivot_join_totals(growth):
    """The year report as a pivot joined with the year totals.

    The pivot names its twelve values, so no job is needed to find them and the schema does not
    depend on the data.
    """
    months = (
        growth.groupBy("stock_name", F.col("year").alias("current_year"), "algorithm_type")
        .pivot("month", list(range(1, 13)))
        .agg(F.sum("growth"))
    )
    months = months.select(
        *REPORT_KEYS, *[F.col(str(i)).alias(name) for i, name in enumerate(schema.MONTHS, 1)]
    )
    totals = year_total(growth).withColumnsRenamed({key: f"total_{key}" for key in REPORT_KEYS})
    # NULL-safe keys put no filter on one side only, so both sides share the pass over the bars.
    same = [months[key].eqNullSafe(totals[f"total_{key}"]) for key in REPORT_KEYS]
    return months.join(totals, same, "left").drop(*[f"total_{key}" for key in REPORT_KEYS])


def report_algorithms(boundary, algorithm_types, rules):
    """Year reports for some algorithm types as one of the readings in RULES defines them.

    All of them come from one reading of the boundaries.
    """
    rules = growth_rules.RULES[rules] if isinstance(rules, str) else rules
    growth = growth_rules.growth_by_rules(boundary, algorithm_types, rules)
    return year_report(growth, rules.missing)


def report_by_rules(boundary, algorithm_type, rules):
    return report_algorithms(boundary, [algorithm_type], rules)


def report_both_algorithms(boundary, rules):
    """Reports of both algorithm types in one table."""
    return report_algorithms(boundary, ["o-c", "c-c"], rules)


def average_report(report):
    """Mean of every column over the years; the total is the mean of the year totals."""
    return report.groupBy("stock_name", "algorithm_type").agg(
        *[F.avg(name).alias(f"avg_{name}") for name in schema.MONTHS],
        F.avg("total_per_year").alias("avg_total"),
    )


def average_of_month_averages(report):
    """The other reading of the total: the mean of the month averages that exist."""
    averages = average_report(report).drop("avg_total")
    months = F.array_compact(F.array(*[f"avg_{name}" for name in schema.MONTHS]))
    total = F.aggregate(months, F.lit(0.0), lambda total, value: total + value)
    count = F.nullif(F.size(months).cast("double"), F.lit(0.0))
    return averages.withColumn("avg_total", total / count)


def averages_by_rules(report, rules):
    rules = growth_rules.RULES[rules] if isinstance(rules, str) else rules
    if rules.average == "month_averages":
        return average_of_month_averages(report)
    return average_report(report)


def report_for_stock(spark, report, averages, stock):
    """Both results for one stock. The filter is on the grouping key, so it reaches the scan."""
    text = "SELECT * FROM {rows} WHERE stock_name = :stock"
    return (
        spark.sql(text, args={"stock": stock}, rows=report),
        spark.sql(text, args={"stock": stock}, rows=averages),
    )


def report_sorted(report):
    return report.orderBy("stock_name", "current_year", "algorithm_type")


def report_top_n(report, n=20):
    """The first n rows by year; stock and algorithm settle equal years."""
    return report.orderBy("current_year", "stock_name", "algorithm_type").limit(n)
