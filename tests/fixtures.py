"""A small worked example, calculated by hand: a year edge, a missing month, a one-bar month."""

BARS = [
    ("2019-11-01 00:00:00", 100, 101),
    ("2019-11-29 23:59:50", 108, 110),
    ("2019-12-02 00:00:00", 111, 112),
    ("2019-12-31 23:59:50", 119, 121),
    ("2020-01-02 00:00:00", 120, 118),
    ("2020-01-15 12:00:00", 119, 125),
    ("2020-01-31 23:59:50", 130, 132),
    ("2020-03-02 00:00:00", 128, 127),
    ("2020-03-31 23:59:50", 100, 99),
    ("2020-04-01 00:00:00", 90, 96),
]
MONTHS = [(2019, 11), (2019, 12), (2020, 1), (2020, 3), (2020, 4)]
BOUNDARY = {
    (2019, 11): (2, 100, 101, 110),
    (2019, 12): (2, 111, 112, 121),
    (2020, 1): (3, 120, 118, 132),
    (2020, 3): (2, 128, 127, 99),
    (2020, 4): (1, 90, 96, 96),
}
GROWTH = {
    "open_close": [10, 9.009009, 10, -22.65625, 6.666667],
    "close_first": [8.910891, 8.035714, 11.864407, -22.047244, 0],
    "close_first_year_carry": [8.910891, 8.035714, 9.090909, -22.047244, 0],
    "close_prev_month": [10, 10, 9.090909, -25, -3.030303],
    "close_lag2": [10, 9.009009, 20, -18.181818, -27.272727],
}
GROWTH_LAG2_CONSTANT = [-92.989581, -92.288539, 20, -18.181818, -27.272727]
# Per rule: totals of 2019 and 2020, with zero fill, of 2020 without one-bar months,
# mean of the year totals, mean of the month averages.
TOTALS = {
    "open_close": (9.504505, -1.996528, 1.584084, -0.499132, -6.328125, 3.753988, 2.603885),
    "close_first": (8.473303, -3.394279, 1.412217, -0.84857, -5.091419, 2.539512, 1.352754),
    "close_first_year_carry":
        (8.473303, -4.318778, 1.412217, -1.079695, -6.478168, 2.077262, 0.798054),
    "close_prev_month": (10, -6.313131, 1.666667, -1.578283, -7.954545, 1.843434, 0.212121),
    "close_lag2": (9.504505, -8.484848, 1.584084, -2.121212, 0.909091, 0.509828, -1.289107),
}


def bars(spark, stock="XAUUSD"):
    rows = [(stock, time, float(o), float(c)) for time, o, c in BARS]
    raw = spark.createDataFrame(
        rows, "stock_name string, time string, open_price double, close_price double"
    )
    return raw.selectExpr(
        "stock_name", "CAST(time AS timestamp_ntz) AS time_utc", "open_price", "close_price"
    )


def candle_lines(rows=BARS, header=True):
    """Text of a candle file with a decimal comma."""
    lines = ["Time (UTC);Open;High;Low;Close;Volume"] if header else []
    for time, open_price, close in rows:
        cells = [f"{v:.3f}".replace(".", ",") for v in (open_price, open_price, close, close)]
        lines.append(";".join([time, *cells, "1,5"]))
    return "\n".join(lines) + "\n"
