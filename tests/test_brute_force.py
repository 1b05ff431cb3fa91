"""Whole tables against plain Python, written from the rules and not from the operators."""

import random

import pytest

from candlegrowth.operators import boundary, growth, quality
from candlegrowth.sources import mapped


def month_table(rows):
    """(stock, year, month) to (first open, first close, last close, number of bars)."""
    groups = {}
    for stock, time, seq, open_price, close in rows:
        groups.setdefault((stock, time.year, time.month), []).append((time, seq, open_price, close))
    table = {}
    for key, bars in groups.items():
        first, last = min(bars), max(bars)
        table[key] = (first[2], first[3], last[3], len(bars))
    return table


def expected_growth(table, algorithm, default=None):
    by_stock = {}
    for stock, year, month in sorted(table):
        by_stock.setdefault(stock, []).append((year, month))
    result = {}
    for stock, months in by_stock.items():
        for i, (year, month) in enumerate(months):
            first_open, first_close, last, _ = table[stock, year, month]

            def close_before(k):
                return table[(stock, *months[i - k])][2] if i >= k else None

            if algorithm == growth.OPEN_CLOSE:
                base = first_open
            elif algorithm == growth.CLOSE_FIRST:
                base = first_close
            elif algorithm == growth.CLOSE_FIRST_YEAR_CARRY:
                later_year = i > 0 and months[i - 1][0] != year
                base = close_before(1) if later_year else first_close
            elif algorithm == growth.CLOSE_PREV_MONTH:
                base = close_before(1) if i else first_open
            else:
                base = close_before(2) if i > 1 else (default or first_open)
            result[stock, year, month] = (last - base) * 100 / base if base else None
    return result


@pytest.fixture(scope="module")
def customers(spark, data):
    candles = mapped.customer_candles(spark, data)
    rows = [tuple(r) for r in candles.collect()]
    return boundary.month_boundary(candles, tie_break="seq").cache(), month_table(rows)


@pytest.mark.parametrize("pairs_only", [False, True])
@pytest.mark.parametrize("algorithm", sorted(growth.ALGORITHM_TYPES))
def test_growth_of_sparse_stocks(customers, algorithm, pairs_only):
    months, table = customers
    expected = expected_growth(table, algorithm)
    if pairs_only:
        expected = {k: v for k, v in expected.items() if table[k][3] > 1}
    found = {
        (r["stock_name"], r["year"], r["month"]): r["growth"]
        for r in growth.month_growth(months, algorithm, pairs_only).collect()
    }
    assert found == pytest.approx(expected, rel=1e-12)


def test_missing_months_of_sparse_stocks(customers):
    months, table = customers
    expected = set()
    for stock in {k[0] for k in table}:
        present = {y * 12 + m - 1 for s, y, m in table if s == stock}
        absent = set(range(min(present), max(present))) - present
        expected |= {(stock, p // 12, p % 12 + 1) for p in absent}
    assert {tuple(r) for r in quality.missing_months(months).collect()} == expected


def test_parts_in_any_order_merge_to_the_whole(spark, data, customers):
    months, _ = customers
    candles = mapped.customer_candles(spark, data)
    parts = candles.randomSplit([1.0, 2.0, 3.0, 4.0], seed=7)
    random.Random(7).shuffle(parts)
    merged = boundary.month_boundary(parts[0], "seq")
    for part in parts[1:]:
        merged = boundary.merge_boundaries(
            merged.unionByName(boundary.month_boundary(part, "seq", dense_ties=True))
        )
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, months.collect()))
