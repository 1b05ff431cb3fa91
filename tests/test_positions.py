"""Places of rows and lines, line chunks and load metrics."""

import random

import pytest
from pyspark.sql import functions as F

import fixtures
from candlegrowth import schema
from candlegrowth.operators import audit, clean, metrics, positions
from candlegrowth.sinks import files as sinks
from candlegrowth.sources import files as sources

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    """Files are read in splits of 2000 bytes."""
    spark.conf.set(SPLIT, "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset(SPLIT)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _files(folder, sizes):
    rng = random.Random(1)
    folder.mkdir()
    texts = {}
    for name, n in sizes.items():
        texts[name] = [schema.HEADER_LINE] + [f"{i};{'x' * rng.randrange(60)}" for i in range(n)]
        (folder / name).write_text("\n".join(texts[name]) + "\n")
    return texts


SIZES = {"long name é.csv": 700, "b.csv": 0, "c.csv": 99, "d.csv": 100}


def test_lines_are_numbered_over_splits(spark, tmp_path, small_splits):
    texts = _files(tmp_path / "in", SIZES)
    (tmp_path / "in" / "empty.csv").write_text("")
    lines = spark.read.text(str(tmp_path / "in"))
    assert lines.rdd.getNumPartitions() > 10
    found = {}
    for row in positions.numbered_lines(lines).collect():
        found.setdefault(row.file_path.rsplit("/", 1)[1], {})[row.line] = row.value
    assert sorted(map(len, found.values())) == [1, 100, 101, 701]
    assert {tuple(x[i] for i in range(len(x))) for x in found.values()} == {tuple(x) for x in texts.values()}


@pytest.mark.parametrize("size", [100, 101, 1000])
def test_chunks_hold_so_many_lines_in_order(spark, tmp_path, small_splits, size):
    texts = _files(tmp_path / "in", SIZES)
    sinks.split_by_lines(spark.read.text(str(tmp_path / "in")), str(tmp_path / "out"), size)
    for name, lines in texts.items():
        found = {}
        for folder in (tmp_path / "out").glob(f"file={name}/chunk=*"):
            (part,) = folder.glob("part-*")
            found[int(folder.name[6:])] = part.read_text().splitlines()
        assert found == {i: lines[i * size:(i + 1) * size] for i in range(-(-len(lines) // size))}


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 3), (5000, 7), (40, 200)])
def test_global_index(spark, n, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = spark.range(n).select((F.col("id") * 7919 % 10007).alias("key"), F.lit("a").alias("_x"))
        found = {r["key"]: r["place"] for r in positions.global_index(rows, ["key"], "place").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert found == {key: i for i, key in enumerate(sorted(i * 7919 % 10007 for i in range(n)))}


def test_metrics_are_those_of_the_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    bad = "x;1;1;1;1;1\n2020-01-01 00:00:00;y;1;1;z;1\n2020-01-01 00:00:00;1;1;1;1\n"
    (tmp_path / "in" / "XAUUSD_10 Secs_Bid_2020.csv").write_text(fixtures.candle_lines() + bad)
    parsed = clean.parse_candles(sources.read_candles(spark, str(tmp_path / "in")))
    hashed = parsed.withColumn("row_hash", audit.row_hash(["stock_name", *schema.RAW_CANDLES.names]))
    rows, seen = metrics.observed(hashed)
    rows.write.parquet(str(tmp_path / "out"))
    found = metrics.numbers(seen)
    counts = {k: v for k, v in found.items() if v and not k.startswith("sum")}
    assert counts == {"rows": 13, "rejected": 3, "bad_time": 1, "bad_open": 1, "bad_close": 1, "bad_cells": 1}
    low, high = hashed.select(*audit.hash_sums("row_hash")).first()
    assert (found["sum_low"], found["sum_high"]) == (low, high)
