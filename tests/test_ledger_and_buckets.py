"""The ledger of rejected lines, the MD5 of files, and bucketed tables on small cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

import fixtures
from candlegrowth.functions import parse
from candlegrowth.operators import audit, clean, digest, ledger, upsert
from candlegrowth.sinks import buckets
from candlegrowth.sources import files as sources
from candlegrowth.streaming.incremental import IncrementalLoad

NAME = "XAUUSD_10 Secs_Bid_2020.csv"
GOOD = fixtures.candle_lines(fixtures.BARS[4:7])
BAD_PRICE, BAD_TIME = "2020-05-01 00:00:00;bad;1;1;1;1\n", "01.05.2020;1;1;1;1;1\n"
SHORT, LONG = "2020-05-01 00:00:10;1;1;1\n", "2020-05-01 00:00:40;1;1;1;1;1;7;8\n"


def _rows(load, as_of=None):
    rows = load.reject_ledger(as_of).orderBy("file_path", "version", "line").collect()
    return [(r["version"], r["line"], r["reason"], r["status"], r["closed_by"]) for r in rows]


def test_rejected_lines_are_those_the_reader_sets_apart(spark, tmp_path):
    """Headers in the middle, blank lines, a file without a header, and no line end at the end."""
    header = GOOD.splitlines(True)[0]
    (tmp_path / NAME).write_text(GOOD + BAD_PRICE + "\n" + header + SHORT + GOOD + LONG + BAD_TIME.strip())
    (tmp_path / "B C_10 Secs_Bid_2020.csv").write_text(BAD_TIME + BAD_TIME)
    parsed = clean.parse_candles(sources.read_candles(spark, str(tmp_path)))
    expected = clean.reject_rows(parsed).groupBy("file_path", "reject_reason").count().collect()
    found = ledger.rejected_lines(spark.read.text(str(tmp_path))).collect()
    assert sorted(map(tuple, expected)) == sorted(
        (path, reason, n) for (path, reason), n in _counted((r["file_path"], r["reason"]) for r in found).items()
    )
    whole = (tmp_path / NAME).read_text().splitlines()
    mine = {r["line"]: r["value"] for r in found if "XAUUSD" in r["file_path"]}
    assert mine and all(whole[line] == value for line, value in mine.items())
    assert sorted(mine) == [4, 7, 12, 13]


def _counted(items):
    counts = {}
    for item in items:
        counts[item] = counts.get(item, 0) + 1
    return counts


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    rows = [BAD_TIME if i % 97 == 0 else GOOD.splitlines(True)[1] for i in range(4000)]
    (tmp_path / NAME).write_text("".join(rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        found = sorted(r["line"] for r in ledger.rejected_lines(lines).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == list(range(0, 4000, 97))


def test_lines_are_split_into_cells_once(spark, tmp_path):
    (tmp_path / NAME).write_text(GOOD + BAD_PRICE)
    found = ledger.rejected_lines(spark.read.text(str(tmp_path)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1
    # Only rejected lines are joined with the splits.
    assert plan.index("Join") < plan.index("from_csv(")
    assert [r["line"] for r in found.collect()] == [4]


def test_numbers_about_as_long_as_the_largest_double(spark):
    """Texts of a length that no infinite number has are not parsed twice."""
    texts = ["9" * 308, "-" + "9" * 308, "9" * 309, "-" + "9" * 309, "0" * 400 + "1,5", "1" + "0" * 308, "2" + "0" * 308]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    found = [r[0] for r in rows.select(parse.parse_decimal(F.col("text"))).collect()]
    numbers = [float(x.replace(",", ".")) for x in texts]
    assert found == [x if abs(x) < float("inf") else None for x in numbers]
    assert found[4:] == [1.5, 1e308, None]


def test_entries_of_repeated_and_equal_lines(spark):
    """A line twice in both versions, the same text in another file, and versions without a later one."""
    rejects = [("a", 0, 1, "x", "v"), ("a", 0, 2, "x", "v"), ("a", 1, 5, "x", "v"), ("a", 1, 6, "x", "v"),
               ("b", 0, 1, "x", "v"), ("c", 1, 1, "x", "v"), ("c", 1, 2, "x", "w")]
    versions = [("a", 0, 9), ("a", 1, 9), ("b", 0, 9), ("b", 1, 9), ("c", 1, 9), ("c", 2, None)]
    found = ledger.entries(
        spark.createDataFrame(rejects, "file_path string, version int, line long, reason string, value string"),
        spark.createDataFrame(versions, "file_path string, version int, length long"),
    )
    assert sorted((r["file_path"], r["version"], r["line"], r["status"], r["closed_by"] or -1) for r in found.collect()) == [
        ("a", 0, 1, "repeated", 1), ("a", 0, 2, "repeated", 1), ("a", 1, 5, "open", -1), ("a", 1, 6, "open", -1),
        ("b", 0, 1, "mended", 1), ("c", 1, 1, "withdrawn", 2), ("c", 1, 2, "withdrawn", 2),
    ]


def test_entries_are_closed_by_the_next_version(spark, tmp_path):
    folder = tmp_path / "in [x]*"
    folder.mkdir()
    file = folder / NAME
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    assert load.reject_ledger().count() == 0
    glob = str(folder).replace("[", "\\[").replace("]", "\\]").replace("*", "\\*")

    def loaded(text):
        file.write_text(text)
        load.run(glob)

    loaded(GOOD + BAD_PRICE + BAD_TIME + BAD_TIME)
    first = [(0, 4, "open"), (0, 5, "time"), (0, 6, "time")]
    assert _rows(load) == [(*x, "open", None) for x in first]
    loaded(GOOD + BAD_TIME)  # a price mended, one line repeated
    second = [(0, 4, "open", "mended", 1), (0, 5, "time", "repeated", 1), (0, 6, "time", "repeated", 1)]
    assert _rows(load) == [*second, (1, 4, "time", "open", None)]
    loaded(GOOD)
    assert _rows(load) == [*second, (1, 4, "time", "mended", 2)]
    assert not (tmp_path / "out" / "epoch=0" / "rejects" / "load_id=2").exists()
    loaded(GOOD + SHORT + LONG)
    assert _rows(load)[-2:] == [(3, 4, "close,cells", "open", None), (3, 5, "cells", "open", None)]
    file.unlink()
    load.run(glob, withdraw=True)
    assert [x[3:] for x in _rows(load)[-2:]] == [("withdrawn", 4)] * 2
    # The ledger as it stood.
    assert _rows(load, as_of=0) == [(*x, "open", None) for x in first]
    assert _rows(load, as_of=1) == [*second, (1, 4, "time", "open", None)]


def test_a_load_done_again_leaves_no_lines_of_the_broken_one(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    (folder / NAME).write_text(GOOD + BAD_PRICE)
    with monkeypatch.context() as patch:
        patch.setattr(IncrementalLoad, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load.run(str(folder))
    assert load.reject_ledger().count() == 0
    (folder / NAME).write_text(GOOD)
    load.run(str(folder))
    assert load.reject_ledger().count() == 0 and load.table("audit").count() == 1


def test_rejects_of_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / NAME).write_text(GOOD.replace(";", "|") + BAD_PRICE.replace(";", "|"))
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    load.run_stream(str(folder), str(tmp_path / "checkpoint"), delimiter="|")
    assert _rows(load) == [(0, 4, "open", "open", None)]


@pytest.mark.parametrize("chunk", [7, 4096, digest.CHUNK_BYTES])
def test_md5_of_bytes(spark, tmp_path, chunk):
    """Files smaller and larger than a chunk, empty, not text, with odd names."""
    contents = {
        "a b+c%_Bid.csv": GOOD.encode(), "ü_Bid.csv": bytes(range(256)) * 100, "empty_Bid.csv": b"",
        "copy_Bid.csv": GOOD.encode(), "bom_Bid.csv": b"\xef\xbb\xbfx\r\n",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    files = sources.list_files(spark, str(tmp_path)).select("file_path", "file_name")
    empty = [(f"file://{tmp_path}/empty_Bid.csv", "empty_Bid.csv")]  # a listing leaves it out
    files = files.unionByName(spark.createDataFrame(empty, files.schema))
    found = digest.content_md5(files, chunk_bytes=chunk).join(files.select("file_path", "file_name"), "file_path")
    assert {(r["file_name"], r["length"], r["md5_sum"]) for r in found.collect()} == {
        (name, len(content), hashlib.md5(content).hexdigest()) for name, content in contents.items()
    }
    assert digest.content_md5(files.where("false")).count() == 0


def test_a_file_larger_than_a_chunk_is_never_held_whole(spark, tmp_path):
    block = bytes(range(256)) * 4096
    with open(tmp_path / NAME, "wb") as file:
        for _ in range(24):
            file.write(block)
    found = digest.content_md5(sources.list_files(spark, str(tmp_path))).first()
    assert (found["length"], found["md5_sum"]) == (len(block) * 24, hashlib.md5(block * 24).hexdigest())


def test_audit_holds_the_md5_of_the_file(spark, tmp_path):
    (tmp_path / NAME).write_text(GOOD)
    files = sources.list_files(spark, str(tmp_path))
    parsed = clean.parse_candles(sources.read_candles(spark, str(tmp_path)))
    row = audit.staging_audit(files, parsed, None, None, digests=digest.content_md5(files)).first()
    assert row["md5_sum"] == hashlib.md5(GOOD.encode()).hexdigest() != row["row_fingerprint"]
    assert audit.staging_audit(files, parsed, None, None).first()["md5_sum"] is None


SHAPE = "k string, y int, v double, version int"
CURRENT = [("a", 1, 1.0, 0), ("a", 2, 2.0, 0), ("b", 1, 3.0, 0), (None, 1, 4.0, 0), ("n", 1, None, 0)]
INCOMING = [("a", 2, 5.0, 1), ("a", 2, 6.0, 2), ("c", 1, 7.0, 1), (None, 1, 8.0, 1), ("b", 1, None, 1), ("c", 1, 7.0, 1)]


@pytest.mark.parametrize("old, new", [(CURRENT, INCOMING), (CURRENT, []), ([], INCOMING), ([], [])])
@pytest.mark.parametrize("version", ["version", None])
def test_bucketed_upsert_equals_upsert(spark, tmp_path, old, new, version):
    """NULL keys and values, ties, repeated rows, empty tables."""
    spark.sql(f"CREATE DATABASE bucketed_case LOCATION '{tmp_path}'")
    try:
        names = [f"bucketed_case.{x}" for x in ("old", "new", "next")]
        for rows, table in zip((old, new), names):
            buckets.write_bucketed(spark.createDataFrame(rows, SHAPE), table, ["k", "y"], 4)
        buckets.upsert_bucketed(spark, *names, ["k", "y"], 4, version)
        expected = upsert.upsert(spark.table(names[0]), spark.table(names[1]), ["k", "y"], version)
        found = spark.table(names[2])
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        # The result is bucketed alike: the next merge needs no shuffle either.
        text = buckets.merged(found, spark.table(names[1]), ["k", "y"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text
        assert spark.table(names[2]).select(F.col("_metadata.file_path")).distinct().count() <= 4
    finally:
        spark.sql("DROP DATABASE bucketed_case CASCADE")
