"""The percent formula and the rules for missing values."""

from pyspark.sql import functions as F


def growth_percent(last, base):
    """Growth from base to last in percent; NULL for a zero base."""
    return (last - base) * 100 / F.nullif(base, F.lit(0.0))


GROWTH_SQL = "(last_close - base) * 100 / nullif(base, 0D)"  # the same in SQL


def nan_to_null(value):
    return F.when(~F.isnan(value), value)


def zero_if_missing(value):
    return F.coalesce(value, F.lit(0.0))


def rounded(df, digits=6):
    """Round every double column; done once, at the edge of a report."""
    return df.select(
        *[
            F.round(F.col(name), digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )
