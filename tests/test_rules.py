"""The worked example through every growth rule, total and average."""

import pytest
from pyspark.sql import functions as F

import fixtures
from candlegrowth.operators import boundary, growth, report
from candlegrowth.schema import FIRST_BASE_CONSTANT


@pytest.fixture(scope="module")
def months(spark):
    return boundary.month_boundary(fixtures.bars(spark)).cache()


def _values(rows):
    return {(r["year"], r["month"]): round(r["growth"], 6) for r in rows.collect()}


def _totals(years):
    rows = years.orderBy("current_year").collect()
    return [round(r["total_per_year"], 6) for r in rows]


def test_boundary(months):
    found = {
        (r["year"], r["month"]): (r["n"], r["first_open"], r["first_close"], r["last_close"])
        for r in months.collect()
    }
    assert found == fixtures.BOUNDARY


@pytest.mark.parametrize("algorithm", sorted(fixtures.GROWTH))
def test_growth(months, algorithm):
    expected = dict(zip(fixtures.MONTHS, fixtures.GROWTH[algorithm]))
    assert _values(growth.month_growth(months, algorithm)) == pytest.approx(expected, abs=1e-6)


def test_growth_with_constant_base(months):
    found = growth.month_growth(months, growth.CLOSE_LAG2, default_base=FIRST_BASE_CONSTANT)
    expected = dict(zip(fixtures.MONTHS, fixtures.GROWTH_LAG2_CONSTANT))
    assert _values(found) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("algorithm", sorted(fixtures.GROWTH))
def test_pairs_only_drops_one_bar_months(months, algorithm):
    found = _values(growth.month_growth(months, algorithm, pairs_only=True))
    expected = dict(zip(fixtures.MONTHS[:-1], fixtures.GROWTH[algorithm][:-1]))
    assert found == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("algorithm", sorted(fixtures.TOTALS))
def test_totals_and_averages(months, algorithm):
    y19, y20, zero19, zero20, pairs20, by_years, by_months = fixtures.TOTALS[algorithm]
    rows = growth.month_growth(months, algorithm)
    years = report.year_report(rows)
    assert _totals(years) == pytest.approx([y19, y20], abs=2e-6)
    assert _totals(report.year_report(rows, "zero")) == pytest.approx([zero19, zero20], abs=2e-6)
    assert _totals(report.year_total(rows, "zero")) == pytest.approx([zero19, zero20], abs=2e-6)
    pairs = report.year_report(growth.month_growth(months, algorithm, pairs_only=True))
    assert _totals(pairs)[1] == pytest.approx(pairs20, abs=2e-6)
    assert report.average_report(years).first()["avg_total"] == pytest.approx(by_years, abs=2e-6)
    other = report.average_of_month_averages(years).first()
    assert other["avg_total"] == pytest.approx(by_months, abs=2e-6)


def test_report_columns(months):
    row = report.report_by_rules(months, "o-c", "lag_open").where("current_year = 2020").first()
    assert row["algorithm_type"] == "o-c"
    assert row["january"] == pytest.approx(10)
    assert row["february"] is None and row["december"] is None
    zero = report.report_by_rules(months, "c-c", "zero_fill").where("current_year = 2020").first()
    assert zero["february"] == 0.0


def test_pivot_form_equals_aggregate_form(months):
    rows = growth.month_growth(months)
    left = sorted(map(tuple, report.year_report(rows).collect()), key=str)
    right = sorted(map(tuple, report.pivot_join_totals(rows).collect()), key=str)
    assert left == right


def test_unknown_names_are_refused(months):
    with pytest.raises(ValueError):
        growth.month_growth(months, "x-x")
    with pytest.raises(ValueError):
        report.report_by_rules(months, "x-x", "pairs")
    with pytest.raises(ValueError):
        report.year_report(growth.month_growth(months), "nan")
    with pytest.raises(ValueError):
        boundary.month_boundary(months, period="week")


def test_zero_base_gives_null(spark):
    bars = fixtures.bars(spark).withColumn("open_price", F.lit(0.0))
    rows = growth.month_growth(boundary.month_boundary(bars)).collect()
    assert len(rows) == 5 and all(r["growth"] is None for r in rows)


def test_ties_are_ordered_by_the_tie_break(spark):
    rows = [("A", 2, 20.0, 21.0), ("A", 1, 10.0, 11.0), ("A", 3, 30.0, 31.0)]
    bars = spark.createDataFrame(
        rows, "stock_name string, seq bigint, open_price double, close_price double"
    ).withColumn("time_utc", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    for dense in (True, False):
        row = boundary.month_boundary(bars, "seq", dense_ties=dense).first()
        assert (row["first_open"], row["first_close"], row["last_close"]) == (10.0, 11.0, 31.0)
        assert (row["first_seq"], row["last_seq"], row["n"]) == (1, 3, 3)
        assert boundary.boundary_rows(boundary.month_boundary(bars, "seq", dense)).count() == 2


def test_a_bar_that_came_twice_stays_one_bar(spark):
    bars = fixtures.bars(spark)
    twice = boundary.month_boundary(bars.unionByName(bars))
    once = boundary.month_boundary(bars)
    for make in (boundary.boundary_rows, lambda m: growth.month_growth(m, pairs_only=True)):
        assert sorted(map(tuple, make(twice).collect())) == sorted(map(tuple, make(once).collect()))


def test_merge_does_not_depend_on_the_order_of_parts(spark):
    bars = fixtures.bars(spark)
    days = boundary.month_boundary(bars, period="day").drop("day")
    merged = boundary.merge_boundaries(days)
    expected = boundary.month_boundary(bars)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_boundary_rows_by_rank_equal_brute_force(spark, data):
    from candlegrowth.sources import mapped

    candles = mapped.order_candles(spark, data)
    found = {
        (r["stock_name"], r["year"], r["month"]): (r["first_seq"], r["last_seq"], r["n"])
        for r in boundary.month_boundary(candles, "seq", dense_ties=True).collect()
    }
    groups = {}
    for r in candles.collect():
        key = (r["stock_name"], r["time_utc"].year, r["time_utc"].month)
        groups.setdefault(key, []).append((r["time_utc"], r["seq"]))
    expected = {k: (min(v)[1], max(v)[1], len(v)) for k, v in groups.items()}
    assert found == expected


def test_lags_of_rows_equal_lags_of_months(months):
    """The two-row form gives the same bases as the month form where months have two bars."""
    rows = growth.boundary_rows_with_lags(boundary.boundary_rows(months))
    seconds = boundary.boundary_pair_rank(rows).where("rn = 2").collect()
    found = {
        (r["year"], r["month"]): (r["close_price"] - r["prev_prev_close"]) * 100
        / r["prev_prev_close"]
        for r in seconds
    }
    expected = _values(growth.month_growth(months, growth.CLOSE_PREV_MONTH, pairs_only=True))
    assert found == pytest.approx(expected, abs=1e-6)
