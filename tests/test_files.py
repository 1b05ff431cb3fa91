"""Sources, parsing, sinks and the incremental load on real files."""

import pytest
from pyspark.sql import functions as F

import fixtures
from candlegrowth.functions import parse
from candlegrowth.operators import audit, boundary, clean, growth, quality, report, upsert
from candlegrowth.plans import job
from candlegrowth.sinks import files as sinks
from candlegrowth.sinks import jdbc
from candlegrowth.sources import files as sources
from candlegrowth.streaming.incremental import IncrementalLoad

NAME = "XAUUSD_10 Secs_Bid_{year}.01.01_{year}.12.31.csv"


def _year_files(folder):
    folder.mkdir(parents=True, exist_ok=True)
    for year in ("2019", "2020"):
        rows = [r for r in fixtures.BARS if r[0].startswith(year)]
        (folder / NAME.format(year=year)).write_text(fixtures.candle_lines(rows))
    return folder


def _one(spark, column, **values):
    return spark.range(1).select(column(**values)).first()[0]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("text, value", [
    ("1282,455", 1282.455), ("1282.455", 1282.455), ("0", 0.0), ("bad", None), ("", None),
    ("1,2,3", None), ("99999999", 99999999.0), ("1,12345", 1.12345), ("-2,5", -2.5), ("NaN", None),
    ("Infinity", None), ("1e400", None), (" 1", None),
])
def test_decimal_comma(spark, text, value):
    found = spark.range(1).select(parse.parse_decimal(F.lit(text))).first()[0]
    assert (None if found is None else float(found)) == value


@pytest.mark.parametrize("text, ok", [
    ("2020-01-31 23:59:50", True), ("2020-02-30 00:00:00", False), ("31/01/2020", False),
    ("2020-01-31", False), ("2020-01-31T23:59:50", False), ("", False),
    ("2019-01-02 9:00:00Z", False), ("2019-01-02 09:00:0Z", False),
])
def test_time(spark, text, ok):
    found = spark.range(1).select(parse.parse_time(F.lit(text))).first()[0]
    assert (found is not None) == ok


def test_months_do_not_depend_on_the_session_zone(spark, tmp_path):
    folder = _year_files(tmp_path / "in")
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    for name in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            candles = clean.valid_rows(clean.parse_candles(sources.read_candles(spark, str(folder))))
            found.append(_sorted(growth.month_growth(boundary.month_boundary(candles))))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == found[2]


def test_path_columns(spark):
    paths = [
        "/in/XAUUSD/2019/XAUUSD_10%20Secs_Bid_2019.01.01_2019.12.31.csv",
        "/in/A%20B/2020/A+B_10%20Secs_Ask_2020.01.01_2020.07.17.csv",
        "/in/X2000/2018/X2000_10%20Secs_Bid_2018.01.01_2018.12.31.csv",
        "/in/S/2017/S-2017.csv",
        "/in/S/none/S.csv",
    ]
    rows = spark.createDataFrame([(p,) for p in paths], "file_path string")
    by_name = sources.with_path_columns(rows).select("stock_name", "current_year", "file_type")
    assert [tuple(r) for r in by_name.collect()] == [
        ("XAUUSD", 2019, "Bid"), ("A+B", 2020, "Ask"), ("X2000", 2018, "Bid"),
        ("S-2017.csv", 2017, None), ("S.csv", None, None),
    ]
    by_folder = sources.with_path_columns(rows, "folders").select("stock_name", "current_year")
    assert [tuple(r) for r in by_folder.collect()] == [
        ("XAUUSD", 2019), ("A B", 2020), ("X2000", 2018), ("S", 2017), ("S", None)
    ]
    with pytest.raises(ValueError):
        sources.with_path_columns(rows, "other")


def test_read_bid_files_only_with_stock_and_year(spark, tmp_path):
    folder = _year_files(tmp_path / "in")
    (folder / "XAUUSD_10 Secs_Ask_2019.01.01_2019.12.31.csv").write_text(fixtures.candle_lines())
    raw = sources.read_candles(spark, str(folder))
    assert raw.count() == 10
    found = {(r["stock_name"], r["current_year"], r["file_type"]) for r in raw.collect()}
    assert found == {("XAUUSD", 2019, "Bid"), ("XAUUSD", 2020, "Bid")}


def test_header_in_the_middle_is_dropped(spark, tmp_path):
    joined = fixtures.candle_lines(fixtures.BARS[:4]) + fixtures.candle_lines(fixtures.BARS[4:])
    (tmp_path / NAME.format(year="2019")).write_text(joined)
    assert sources.read_candles(spark, str(tmp_path)).count() == 10
    lines = sources.read_lines(spark, str(tmp_path))
    assert lines.count() == 10
    assert lines.orderBy("time_text").first()["open_text"] == "100,000"


def test_other_delimiters(spark, tmp_path):
    for number, delimiter in enumerate(("|", ",", "\t", "^")):
        folder = tmp_path / str(number)
        folder.mkdir()
        text = fixtures.candle_lines().replace(",", ".").replace(";", delimiter)
        (folder / NAME.format(year="2020")).write_text(text)
        rows = clean.valid_rows(
            clean.parse_candles(sources.read_candles(spark, str(folder), delimiter))
        )
        assert rows.count() == 10
        lines = sources.read_lines(spark, str(folder), delimiter)
        assert lines.orderBy("time_text").first()["close_text"] == "101.000"
        assert lines.count() == 10


def test_bad_cells_are_set_apart(spark, tmp_path):
    text = fixtures.candle_lines() + (
        "2020-05-01 00:00:00;bad;1;1;1;1\n"
        "01.05.2020;1;1;1;1;1\n"
        "2020-05-01 00:00:10;1;1;1\n"
        "2020-05-01 00:00:20;1;x;y;2;z\n"
        "2020-05-01 00:00:30;1;;;2;\n"
        "2020-05-01 00:00:40;1;1;1;1;1;7;8\n"
    )
    (tmp_path / NAME.format(year="2020")).write_text(text)
    parsed = clean.parse_candles(sources.read_candles(spark, str(tmp_path)))
    rejects = {r["time_text"]: r["reject_reason"] for r in clean.reject_rows(parsed).collect()}
    assert rejects == {
        "2020-05-01 00:00:00": "open",
        "01.05.2020": "time",
        "2020-05-01 00:00:10": "close,cells",
        "2020-05-01 00:00:40": "cells",
        "2020-05-01 00:00:20": "high,low,volume",
    }
    assert clean.valid_rows(parsed).count() == 11
    counts = {r["column_name"]: r["n_null"] for r in
              quality.dq_nulls(parsed, ["time_utc", "open_price", "close_price"]).collect()}
    assert counts == {"time_utc": 1, "open_price": 1, "close_price": 1}


def test_missing_months(spark):
    months = boundary.month_boundary(fixtures.bars(spark))
    assert [tuple(r) for r in quality.missing_months(months).collect()] == [("XAUUSD", 2020, 2)]


def test_missing_months_over_a_year_edge(spark):
    bars = fixtures.bars(spark).where("year(time_utc) = 2019 OR month(time_utc) = 4")
    found = _sorted(quality.missing_months(boundary.month_boundary(bars)))
    assert found == [("XAUUSD", 2020, m) for m in (1, 2, 3)]


def test_global_boundary_rows(spark):
    early = fixtures.bars(spark)
    late = fixtures.bars(spark, "OTHER").withColumn(
        "time_utc", F.col("time_utc") + F.expr("interval 1 second")
    )
    rows = boundary.boundary_rows_global(early.unionByName(late))
    firsts = rows.where("month(time_utc) = 3 AND year(time_utc) = 2020")
    assert {(r["stock_name"], r["time_utc"].day) for r in firsts.collect()} == {
        ("XAUUSD", 2), ("OTHER", 31)
    }


def test_files_without_a_header_lose_nothing(spark, tmp_path):
    text = fixtures.candle_lines(header=False)
    (tmp_path / NAME.format(year="2019")).write_text(text)
    (tmp_path / NAME.format(year="2020")).write_text(fixtures.candle_lines())
    raw = sources.read_candles(spark, str(tmp_path))
    assert raw.groupBy("current_year").count().orderBy("current_year").collect() == [(2019, 10), (2020, 10)]
    stream = sources.stream_candles(spark, str(tmp_path)).writeStream.format("memory").queryName("headerless")
    stream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("headerless").count() == 20


def test_lines_with_other_than_six_fields(spark, tmp_path):
    text = fixtures.candle_lines(fixtures.BARS[:2]) + "2020-05-01 00:00:00;1;1;1;1;1;1\n2020-05-01 00:00:10;1\n"
    (tmp_path / NAME.format(year="2020")).write_text(text)
    lines = sources.read_lines(spark, str(tmp_path))
    assert lines.where("corrupt_line IS NULL").count() == 2
    assert lines.where("corrupt_line IS NOT NULL").count() == 2


def test_fingerprints_of_files(spark, tmp_path):
    """Copies are alike, other files are not; a file with a header only has a row as well."""
    folder = _year_files(tmp_path / "in")
    (folder / NAME.format(year="2021")).write_bytes((folder / NAME.format(year="2020")).read_bytes())
    (folder / NAME.format(year="2022")).write_text(fixtures.candle_lines([]))
    parsed = clean.parse_candles(sources.read_candles(spark, str(folder)))
    files = sources.list_files(spark, str(folder)).select("file_path")
    found = {r["file_path"][-14:-10]: r for r in audit.file_fingerprints(files, parsed).collect()}
    assert len(found) == 4 and len({r["row_fingerprint"] for r in found.values()}) == 3
    assert found["2020"]["row_fingerprint"] == found["2021"]["row_fingerprint"]
    assert found["2022"]["number_of_processed_rows"] == 0
    rows = audit.staging_audit(files, parsed, None, None).where("current_year = 2022").collect()
    assert [(r["stock_name"], r["number_of_processed_rows"]) for r in rows] == [("XAUUSD", 0)]


def test_fingerprint_keeps_the_place_of_empty_cells(spark):
    rows = spark.createDataFrame([("1", "x", None), ("2", None, "x")], "f string, a string, b string")
    found = audit.content_fingerprint(rows, ["a", "b"], keys=["f"]).collect()
    assert found[0]["row_fingerprint"] != found[1]["row_fingerprint"]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, version int")
    new = spark.createDataFrame(
        [("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, version int"
    )
    found = upsert.upsert(old, new, ["k"], "version")
    assert _sorted(found.select("k", "v")) == [("a", 1), ("b", 4), ("c", 5)]
    tied = spark.createDataFrame([("b", 7, 1), ("b", 6, 1)], "k string, v int, version int")
    for version in ("version", None):
        assert _sorted(upsert.upsert(old, tied, ["k"], version).select("k", "v")) == [("a", 1), ("b", 7)]


def test_report_csv_keeps_missing_values(spark, tmp_path):
    years = report.report_by_rules(boundary.month_boundary(fixtures.bars(spark)), "o-c", "pairs")
    path = str(tmp_path / "report")
    sinks.write_report_csv(years, path)
    assert "NULL" in spark.read.text(path).where("value LIKE '%2020%'").first()[0]
    assert _sorted(sinks.read_report_csv(spark, path)) == _sorted(years)


def test_day_files_hold_at_most_the_given_rows(spark, tmp_path):
    path = str(tmp_path / "days")
    sinks.split_by_day(fixtures.bars(spark).unionByName(fixtures.bars(spark, "B")), path, max_records=1)
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) == 20 and all(r["count"] == 1 for r in sizes)


def test_jdbc_rows_are_prepared_without_a_database(spark):
    rows = spark.createDataFrame([("a", float("nan")), ("b", 12345.6789)], "k string, v double")
    found = jdbc.with_decimals(rows)
    assert dict(found.dtypes)["v"] == "decimal(18,6)"
    assert [r["v"] if r["v"] is None else float(r["v"]) for r in found.collect()] == [
        None, 12345.6789
    ]
    assert jdbc.connection("u", "d", "n", "p") == {
        "url": "u", "driver": "d", "user": "n", "password": "p"
    }


# Incremental load


def _reports(load):
    names = [c for c in load.report().columns if c != "stock_bucket"]
    return _sorted(load.report().select(*names)), _sorted(load.averages().drop("stock_bucket"))


def _expected(bars, rules):
    months = boundary.month_boundary(bars)
    years = report.report_both_algorithms(months, rules)
    return _sorted(years), _sorted(report.averages_by_rules(years, rules))


def _round(tables):
    def cell(value):
        return round(value, 6) if isinstance(value, float) else value

    return [sorted([tuple(map(cell, row)) for row in rows], key=str) for rows in tables]


@pytest.mark.parametrize("rules", ["carry"])
def test_late_files_give_the_same_report_as_a_full_load(spark, tmp_path, rules):
    """Newest bars come first, one file per run, with a merge of the state in between."""
    folder = tmp_path / "in"
    folder.mkdir()
    load = IncrementalLoad(spark, str(tmp_path / "out"), rules, merge_every=3)
    load.initialise()
    for i in range(0, len(fixtures.BARS), 2):
        rows = fixtures.BARS[::-1][i:i + 2]
        (folder / f"XAUUSD_10 Secs_Bid_{rows[0][0][:4]}.part{i}.csv").write_text(
            fixtures.candle_lines(rows, header=i % 4 == 0)
        )
        load.run(str(folder), max_files=1)
    assert _round(_reports(load)) == _round(_expected(fixtures.bars(spark), rules))
    assert load.table("base").select("load_id").distinct().count() == 1
    assert load.months().agg(F.sum("n")).first()[0] == 10


def test_loads_follow_the_settings_of_the_tables(spark, tmp_path):
    folder = str(_year_files(tmp_path / "in"))
    with pytest.raises(ValueError, match="no tables"):
        IncrementalLoad(spark, str(tmp_path / "out")).run(folder)
    IncrementalLoad(spark, str(tmp_path / "out")).initialise()
    with pytest.raises(ValueError, match="made with"):
        IncrementalLoad(spark, str(tmp_path / "out"), "carry").run(folder)
    with pytest.raises(ValueError, match="made with"):
        IncrementalLoad(spark, str(tmp_path / "out"), buckets=8).run(folder)


def _prices(rows, factor):
    return [(time, open_price, close * factor) for time, open_price, close in rows]


@pytest.mark.parametrize("merge_every", [2, 32])
def test_a_corrected_file_replaces_what_it_held(spark, tmp_path, merge_every):
    """Under its old name, under a new one beside it, with a bar less, and emptied."""
    folder = tmp_path / "in"
    folder.mkdir()
    name = folder / NAME.format(year="2019")
    load = IncrementalLoad(spark, str(tmp_path / "out"), "carry", merge_every=merge_every)
    load.initialise()

    def loaded(text):
        name.write_text(text)
        load.run(str(folder))
        return [(r["month"], r["n"], r["last_close"]) for r in load.months().orderBy("month").collect()]

    bars = fixtures.BARS[:4]
    assert loaded(fixtures.candle_lines(bars)) == [(11, 2, 110.0), (12, 2, 121.0)]
    assert loaded(fixtures.candle_lines(_prices(bars, 2))) == [(11, 2, 220.0), (12, 2, 242.0)]
    assert loaded(fixtures.candle_lines(bars[:3])) == [(11, 2, 110.0), (12, 1, 112.0)]
    other = folder / NAME.format(year="2019.new")
    other.write_text(fixtures.candle_lines(_prices(bars[:2], 3)))
    load.run(str(folder))
    assert [r["last_close"] for r in load.months().orderBy("month").collect()] == [330.0, 112.0]
    assert load.months().agg(F.sum("n")).first()[0] == 5
    assert loaded(fixtures.candle_lines([])) == [(11, 2, 330.0)]
    other.unlink()
    load.run(str(folder))
    assert load.months().count() == 1
    load.run(str(folder), withdraw=True)
    assert load.months().count() == 0 and load.report().count() == 0
    last = load.table("audit").orderBy(F.desc("load_id")).first()
    assert (last["stock_name"], last["number_of_processed_rows"]) == ("XAUUSD", 0)


WRITES = ["staging", "audit", "known", "report", "destination_audit", "pointer"]


@pytest.mark.parametrize("broken", WRITES)
def test_readers_see_the_old_or_the_new_state_only(spark, tmp_path, monkeypatch, broken):
    """The second load breaks off after each of its writes; then it is done again."""
    folder = _year_files(tmp_path / "in")
    load = IncrementalLoad(spark, str(tmp_path / "out"), merge_every=2)
    load.initialise()
    load.run(str(folder))
    before = _reports(load)
    held = load.report()
    (folder / NAME.format(year="2020")).write_text(fixtures.candle_lines(_prices(fixtures.BARS[4:], 3)))
    (folder / "OTHER_10 Secs_Bid_2019.csv").write_text(fixtures.candle_lines(fixtures.BARS[:4]))
    write = IncrementalLoad._write

    def broken_write(self, rows, table, *more, **options):
        write(self, rows, table, *more, **options)
        if table == broken:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(IncrementalLoad, "_write", broken_write)
        if broken == "pointer":
            patch.setattr(load.pointers, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load.run(str(folder))
    reader = IncrementalLoad(spark, str(tmp_path / "out"), merge_every=2)
    assert _reports(reader) == before
    assert reader.table("audit").select("load_id").distinct().count() == 1
    load.run(str(folder))
    bars = fixtures.bars(spark)
    late = F.when(F.year("time_utc") == 2020, F.col("close_price") * 3).otherwise(F.col("close_price"))
    bars = bars.withColumn("close_price", late).unionByName(fixtures.bars(spark, "OTHER").where("year(time_utc) = 2019"))
    assert _round(_reports(load)) == _round(_expected(bars, "pairs"))
    # Earlier states stay readable, also by a reader that planned its query before.
    assert _sorted(load.report(as_of=0).drop("stock_bucket")) == before[0]
    assert _sorted(held.drop("stock_bucket")) == before[0]
    assert load.report(as_of=-1).count() == 0
    with pytest.raises(ValueError, match="no load"):
        load.report(as_of=2)


def test_clean_up_leaves_what_is_pointed_to(spark, tmp_path):
    folder = _year_files(tmp_path / "in")
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    load.run(str(folder))
    (folder / "OTHER_10 Secs_Bid_2019.csv").write_text(fixtures.candle_lines(fixtures.BARS[:4]))
    load.run(str(folder))
    after = _reports(load)
    load.clean_up()
    assert _reports(load) == after and len(load.pointers.numbers()) == 1
    (folder / NAME.format(year="2019")).write_text(fixtures.candle_lines(_prices(fixtures.BARS[:4], 2)))
    load.run(str(folder))
    after = _reports(load)
    load.clean_up(keep=1)
    assert _reports(load) == after
    load.initialise(replace=True)
    assert load.report().count() == 0 and load.table("audit").count() == 0
    load.clean_up()
    assert not (tmp_path / "out" / "epoch=0").exists()


def test_two_loads_cannot_publish_the_same_number(spark, tmp_path):
    from candlegrowth.sinks.pointer import Pointers

    pointers = Pointers(spark, str(tmp_path / "pointers"))
    assert pointers.newest() is None
    pointers.publish(3, {"x": "é"})
    with pytest.raises(ValueError, match="another load"):
        pointers.publish(3, {"x": 2})
    assert pointers.newest() == (3, {"x": "é"}) and pointers.numbers() == [3]


def test_stream_of_chunks_in_any_order(spark, tmp_path, monkeypatch):
    """Loads by micro-batches; one is broken off before its pointer, one after it, and the stream
    starts again from its checkpoint."""
    folder = tmp_path / "in"
    folder.mkdir()
    where = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    load = IncrementalLoad(spark, where[0], "carry")
    load.initialise()
    order = [6, 0, 8, 2, 4]
    for i in order[:3]:
        rows = fixtures.BARS[i:i + 2]
        (folder / f"XAUUSD_10 Secs_Bid_{rows[0][0][:4]}.part{i}.csv").write_text(fixtures.candle_lines(rows, header=i % 4 == 0))
    publish = IncrementalLoad._publish
    for after in (False, True):
        def broken(self, *arguments, after=after):
            if after:
                publish(self, *arguments)
            raise RuntimeError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(IncrementalLoad, "_publish", broken)
            with pytest.raises(Exception, match="lost"):
                load.run_stream(str(folder), where[1], max_files=1)
        assert load._current()["load_id"] == (0 if after else -1)
    load.run_stream(str(folder), where[1], max_files=1)
    assert load._current()["load_id"] == 2
    for i in order[3:]:
        rows = fixtures.BARS[i:i + 2]
        (folder / f"XAUUSD_10 Secs_Bid_{rows[0][0][:4]}.part{i}.csv").write_text(fixtures.candle_lines(rows))
    IncrementalLoad(spark, where[0], "carry").run_stream(str(folder), where[1])
    assert _round(_reports(load)) == _round(_expected(fixtures.bars(spark), "carry"))
    assert load.months().agg(F.sum("n")).first()[0] == 10
    load.run_stream(str(folder), where[1])
    assert load._current()["load_id"] == 3
    assert load.table("audit").count() == 5


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    folder = _year_files(tmp_path / "in")
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    load.run_stream(str(folder), str(tmp_path / "checkpoint"))
    before, number = _reports(load), load.pointers.numbers()
    load.take_batch(sources.read_candles(spark, str(folder)), 0, str(tmp_path / "checkpoint"))
    assert _reports(load) == before and load.pointers.numbers() == number


def test_lines_by_month_stay_as_they_are(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / NAME.format(year="2020")).write_text(fixtures.candle_lines() + "bad;1\n")
    lines = spark.read.text(str(tmp_path / "in")).withColumn("stock_name", F.lit("XAUUSD"))
    sinks.split_lines_by_month(lines, str(tmp_path / "out"))
    found = spark.read.text(str(tmp_path / "out"))
    assert _sorted(found.select("value")) == sorted(
        (line,) for line in [*fixtures.candle_lines(header=False).splitlines(), "bad;1"]
    )
    assert found.where("year = 2020 AND month = 1").count() == 3
    assert found.where("year IS NULL").count() == 1


def test_copies_and_bad_rows(spark, tmp_path):
    """The last copy comes after the known files were merged into a base."""
    folder = _year_files(tmp_path / "in")
    (folder / "XAUUSD_10 Secs_Bid_2020.copy.csv").write_bytes(
        (folder / NAME.format(year="2020")).read_bytes()
    )
    load = IncrementalLoad(spark, str(tmp_path / "out"), merge_every=2)
    load.initialise()
    load.run(str(folder))
    (folder / "XAUUSD_10 Secs_Bid_2019.again.csv").write_bytes(
        (folder / NAME.format(year="2019")).read_bytes()
    )
    (folder / "OTHER_10 Secs_Bid_2019.csv").write_text(
        fixtures.candle_lines(fixtures.BARS[:4]) + "bad;1;1;1;1;1\n"
    )
    (folder / "EMPTY_10 Secs_Bid_2019.csv").write_text(fixtures.candle_lines([]))
    load.run(str(folder))
    (folder / "XAUUSD_10 Secs_Bid_2020.third.csv").write_bytes(
        (folder / NAME.format(year="2020")).read_bytes()
    )
    load.run(str(folder))
    files = load.table("audit").collect()
    assert len(files) == 7 and sum(r["is_new"] for r in files) == 4
    assert {r["load_id"] for r in files} == {0, 1, 2}
    assert {(r["stock_name"], r["current_year"]) for r in files} == {
        ("XAUUSD", 2019), ("XAUUSD", 2020), ("OTHER", 2019), ("EMPTY", 2019)
    }
    assert [r["number_of_processed_rows"] for r in files if r["stock_name"] == "EMPTY"] == [0]
    assert load.table("known").where("load_id = 1").count() == 6
    assert [r["file_name"] for r in files if r["load_with_error"]] == ["OTHER_10 Secs_Bid_2019.csv"]
    assert load.rejects().select("time_text").first()[0] == "bad"
    other = fixtures.bars(spark, "OTHER").where("year(time_utc) = 2019")
    bars = fixtures.bars(spark).unionByName(other)
    assert _round(_reports(load)) == _round(_expected(bars, "pairs"))
    assert load.months().agg(F.sum("n")).first()[0] == 14
    reported = load.table("destination_audit")
    assert reported.where("load_id = 0").count() == 4
    assert reported.where("load_id = 1 AND stock_name = 'OTHER'").count() == 2


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    folder = str(_year_files(tmp_path / "in"))
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    load.initialise()
    load.run(folder)
    before = _reports(load)
    load.run(folder)
    assert load.table("audit").select("load_id").distinct().count() == 1
    files = load.table("audit").select("file_path", "length", "modified")
    files = spark.createDataFrame(files.collect(), files.schema)
    for load_id in (0, 1):
        load.load(sources.read_candles(spark, folder), files, load_id)
        assert _reports(load) == before


def test_job_modes(spark, tmp_path, capsys):
    folder = _year_files(tmp_path / "in")
    arguments = ["-fl", str(folder), "-o", str(tmp_path / "out"), "-at", "both"]
    options = job.parser().parse_args([*arguments, "--csv", str(tmp_path / "csv")])
    first = _reports(job.run(spark, options))
    assert spark.read.text(f"{tmp_path}/csv/years").count() == 5
    with pytest.raises(ValueError):
        job.run(spark, job.parser().parse_args([*arguments, "--mode", "initial"]))
    (folder / "OTHER_10 Secs_Bid_2019.csv").write_text(fixtures.candle_lines(fixtures.BARS[:4]))
    second = _reports(job.run(spark, job.parser().parse_args([*arguments, "--mode", "incremental"])))
    assert len(second[0]) == len(first[0]) + 2
    (folder / "OTHER_10 Secs_Bid_2019.csv").unlink()
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "dynamic")
    try:
        full = job.run(spark, job.parser().parse_args([*arguments, "--mode", "full"]))
    finally:
        spark.conf.unset(mode)
    assert _round(_reports(full)) == _round(first)
    assert full.table("audit").count() == 2
    with pytest.raises(SystemExit):
        job.parser().parse_args([*arguments, "--mode", "other"])
