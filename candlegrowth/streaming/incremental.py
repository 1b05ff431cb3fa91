"""Incremental load: candle files arrive or change, month boundaries merge, reports follow.

Tables below one root folder, in a folder per epoch (an epoch is what `initialise` begins):

  staging    typed rows and rejects of each load, by load
  audit      one row per file of each load: size and time of change, fingerprint, rows
  rejects    the lines of each load's files that were set apart, by load, with their place and reason
  delta      month boundaries of each file of one load, by load and stock bucket
  base       those of the current files up to a load, by load and stock bucket
  known      the current files up to a load
  report, averages   the reports of the stock buckets that a load touched, by load and bucket
  destination_audit  one row per stock, algorithm and year that a load reported again
  pointers   one file per load: which load's folder holds the report of each bucket; settings

A run lists the files and takes those that no load has seen with this path, size and time of change.
A file that comes again with other content replaces what it held; of several current files with
equal content one counts. A load writes only its own `load_id` folders. Its pointer file is put in
place last, so readers see all of a load or nothing of it, and can read the state after any load; a
load that broke off left no pointer and is done again. The state is one row per file and month.

Carry and lag rules look across month and year edges, so a new bar can change later months too: all
months of the touched buckets are reported again, from the small state.
"""

import datetime
import re
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrowth import schema
from candlegrowth.operators import audit as audits
from candlegrowth.operators import boundary as boundaries
from candlegrowth.operators import clean, ledger, metrics, report
from candlegrowth.sinks.files import STATIC
from candlegrowth.sinks.pointer import Pointers
from candlegrowth.sources import files as sources

BUCKETS = 64
MERGE_EVERY = 32
MAX_FILES = 1000

FILE_KEY = ["file_path", "length", "modified"]
VERSION = schema.struct("file_path string, length bigint, modified bigint, row_fingerprint string, version int")
AUDIT = schema.struct(
    "file_path string, file_name string, stock_name string, current_year int, file_type string, "
    "length bigint, modified bigint, row_fingerprint string, number_of_processed_rows bigint, "
    "load_with_error boolean, is_new boolean, start_load_date timestamp, end_load_date timestamp"
)
WORK = schema.struct("path string, file_path string, length bigint, modified bigint")
CELLS = [*schema.RAW_CANDLES.names, schema.CORRUPT]
STAGED = schema.struct(
    "file_path string, stock_name string, time_utc timestamp_ntz, "
    "open_price double, high_price double, low_price double, close_price double, "
    "volume double, seq bigint, row_hash bigint, "
    "rejected boolean, reject_reason string, " + ", ".join(f"{name} string" for name in CELLS)
)
REJECTS = schema.struct("file_path string, line bigint, reason string, value string")
_FILE_BOUNDARY = [T.StructField("file_path", T.StringType()), *schema.BOUNDARY.fields]
NEWEST = ("version", "modified")  # where times of two files tie, the newer load, then file wins
_SUMS = ["sum_low", "sum_high"]
DELTA = T.StructType([
    *_FILE_BOUNDARY, T.StructField("rejected", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in _SUMS],
])
BASE = T.StructType([*_FILE_BOUNDARY, T.StructField("version", T.IntegerType())])

# Columns and partition columns of each table.
TABLES = {
    "staging": (STAGED, "load_id int"),
    "rejects": (REJECTS, "load_id int"),
    "audit": (AUDIT, "load_id int"),
    "destination_audit": (schema.DESTINATION_AUDIT, "load_id int"),
    "delta": (DELTA, "load_id int, stock_bucket int"),
    "base": (BASE, "load_id int, stock_bucket int"),
    "known": (VERSION, "load_id int"),
    "report": (schema.REPORT, "load_id int, stock_bucket int"),
    "averages": (schema.AVERAGES, "load_id int, stock_bucket int"),
}


def _full_schema(table):
    columns, partitions = TABLES[table]
    return T.StructType([*columns.fields, *schema.struct(partitions).fields])


def bucket_of(stock, buckets=BUCKETS):
    """A fixed number of groups of stocks, so partitions do not grow with the stocks."""
    return F.pmod(F.xxhash64(stock), F.lit(buckets)).cast("int")


def _literal(path):
    """A path that Spark takes as it stands, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class IncrementalLoad:
    """The tables below `root`, and the loads that maintain them.

    `tie_break` names an integer column of the parsed rows that orders bars of equal time; with
    `dense_ties` (many bars per time) the bars of one time are merged first, by hash aggregates.
    """

    def __init__(
        self, spark, root, rules="pairs", algorithm_types=("o-c", "c-c"), tie_break=None,
        dense_ties=False, buckets=BUCKETS, merge_every=MERGE_EVERY,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rules = rules
        self.algorithm_types = tuple(algorithm_types)
        self.tie_break = tie_break
        self.dense_ties = dense_ties
        self.buckets = buckets
        self.merge_every = merge_every
        self.pointers = Pointers(spark, f"{self.root}/pointers")

    def path(self, table, load_id=None):
        folder = f"{self.root}/epoch={self._current()['epoch']}/{table}"
        return folder if load_id is None else f"{folder}/load_id={load_id}"

    # Tables

    def initialise(self, replace=False):
        """Begin an epoch: tables without rows. With `replace` it takes the place of an earlier one,
        whose readers keep what they read until `clean_up`."""
        newest = self.pointers.newest()
        if newest and not replace:
            raise ValueError(f"{self.root} holds tables already")
        number, epoch = (newest[0] + 1, newest[1]["epoch"] + 1) if newest else (0, 0)
        self.pointers.publish(number, {
            "epoch": epoch, "load_id": -1, "settings": self._settings(), "report": {}, "averages": {},
            "batches": {},
        })

    def _settings(self):
        return f"{self.rules} {' '.join(self.algorithm_types)} {self.buckets} {self.merge_every}"

    def _current(self, as_of=None):
        """The newest pointer, or the one of an earlier load of its epoch."""
        newest = self.pointers.newest()
        if newest is None:
            raise ValueError(f"{self.root} holds no tables yet")
        number, content = newest
        if as_of is None:
            return content
        if not -1 <= as_of <= content["load_id"]:
            raise ValueError(f"there is no load {as_of}")
        return self.pointers.read(number - content["load_id"] + as_of)

    def _check(self):
        """Reports of untouched stocks are kept, so all loads must follow the same settings."""
        found = self._current()["settings"]
        if found != self._settings():
            raise ValueError(f"the tables were made with {found}, not {self._settings()}")

    def table(self, table):
        """The rows of a table that published loads wrote."""
        last = self._current()["load_id"]
        if last < 0 or not self.pointers.children(self.path(table)):
            return self.spark.createDataFrame([], _full_schema(table))
        return self._reader(table).parquet(self.path(table)).where(F.col("load_id") <= last)

    def _published(self, table, as_of=None):
        """The rows of the folders that a pointer names."""
        content = self._current(as_of)
        base = f"{self.root}/epoch={content['epoch']}/{table}"
        paths = [f"{base}/load_id={load}/stock_bucket={bucket}" for bucket, load in content[table].items()]
        if not paths:
            return self.spark.createDataFrame([], _full_schema(table)).drop("load_id")
        return self._reader(table).option("basePath", base).parquet(*paths).drop("load_id")

    def _reader(self, table):
        return self.spark.read.schema(_full_schema(table))

    def _loads(self, table, load_ids):
        """Rows of some loads, by their folders: those of all other loads are not even listed."""
        paths = [self.path(table, load_id) for load_id in load_ids]
        if not paths:
            return self.spark.createDataFrame([], _full_schema(table))
        return self._reader(table).option("basePath", self.path(table)).parquet(*paths)

    def _since_base(self, base, table, load_id):
        """Rows of the newest base before a load, and of the loads from there to it."""
        base_id = load_id // self.merge_every * self.merge_every - 1
        return (
            self._loads(base, [base_id] if base_id >= 0 else []),
            self._loads(table, range(base_id + 1, load_id + 1)),
        )

    def report(self, as_of=None):
        """The report, or the report as it was after an earlier load."""
        return self._published("report", as_of)

    def averages(self, as_of=None):
        return self._published("averages", as_of)

    def months(self):
        """The month boundaries of all current files."""
        return boundaries.merge_boundaries(self._state(self._current()["load_id"]), versions=NEWEST)

    def load_metrics(self, as_of=None):
        """Rows, rejects by reason and hash sums of a load, the last one by default."""
        return self._current(as_of)["metrics"]

    def rejects(self):
        return self.table("staging").where("rejected")

    def reject_ledger(self, as_of=None):
        """Every line that a load set apart and what became of it, as `ledger.entries` says; with
        `as_of` as it stood after an earlier load."""
        last = self._current(as_of)["load_id"]
        rows = {
            name: self.table(name).where(F.col("load_id") <= last).withColumnRenamed("load_id", "version")
            for name in ("rejects", "audit")
        }
        return ledger.entries(rows["rejects"], rows["audit"])

    def _write(self, rows, table, load_id, bucketed=False):
        writer = rows
        if bucketed:
            writer = rows.withColumn("stock_bucket", bucket_of("stock_name", self.buckets)).hint("rebalance", "stock_bucket")
        writer = writer.write.options(**STATIC).mode("overwrite")
        if bucketed:
            writer = writer.partitionBy("stock_bucket")
        writer.parquet(self.path(table, load_id))

    # Loads

    def run(
        self, path, delimiter=schema.DELIMITER, glob=schema.BID_GLOB, layout="file_name", max_files=None,
        withdraw=False,
    ):
        """Take in the files that are new or changed since the last run, `max_files` in a load. With
        `withdraw` a file that is no longer there counts as taken back; by default it stays, as
        files are moved away after a load."""
        self._check()
        load_id = self._current()["load_id"] + 1
        size = max_files or MAX_FILES
        work = iter(self._work(path, glob, load_id - 1, withdraw).toLocalIterator())
        while rows := list(islice(work, size)):
            files = self.spark.createDataFrame(
                [tuple(row)[1:4] for row in rows], "file_path string, length bigint, modified bigint"
            )
            names = [_literal(row["path"]) for row in rows if row["path"]]
            if names:
                raw = sources.read_candles(self.spark, names, delimiter, glob, layout, base=path)
            else:
                raw = sources.read_candles(self.spark, path, delimiter, glob, layout).where("false")
            self.load(raw, files, load_id, layout, delimiter)
            load_id += 1

    def _work(self, path, glob, load_id, withdraw):
        """The files to load in order, listed once for a run and written, as the loads change what is
        known: path, file_path, length, modified, and for files to take back a NULL path."""
        listed = sources.list_files(self.spark, path, glob).withColumn("modified", F.unix_micros("modificationTime"))
        versions = self._versions(load_id)
        rows = listed.join(versions.select(*FILE_KEY), FILE_KEY, "left_anti").select("path", *FILE_KEY)
        if withdraw:
            there = versions.where("length is not null")
            gone = there.join(listed, "file_path", "left_anti").selectExpr(
                "CAST(NULL AS string) path", "file_path", "CAST(NULL AS bigint) length", "CAST(NULL AS bigint) modified"
            )
            rows = rows.unionByName(gone)
        self._write(rows, "work", load_id + 1)
        work = self.spark.read.schema(WORK).parquet(self.path("work", load_id + 1))
        return work.orderBy(F.col("path").isNull(), "modified", "file_path")

    def run_stream(
        self, path, checkpoint, delimiter=schema.DELIMITER, glob=schema.BID_GLOB, layout="file_name", max_files=None
    ):
        """The same as a stream: take in what has arrived since the last run by this checkpoint, then end.

        Each micro-batch is one load. Spark may run a micro-batch again after a failure; the pointer
        keeps the number of the last one of each checkpoint, so a batch that was published changes nothing.
        A stream takes files by path once, so corrected files need a new name or `run`; a file
        without any line is not seen. Settings and tables are those of `run`, and both may be used.
        """
        self._check()
        raw = sources.stream_candles(
            self.spark, path, delimiter, glob, layout, max_files or MAX_FILES, headers=True
        )
        query = (
            raw.writeStream.foreachBatch(
                lambda rows, batch: self.take_batch(rows, batch, checkpoint, layout, delimiter)
            )
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def take_batch(self, rows, batch_id, stream, layout="file_name", delimiter=schema.DELIMITER):
        """One micro-batch of a stream as a load, unless a load of this batch was published. The
        files, at most those of a batch, are gathered while the rows are staged."""
        content = self._current()
        if content["batches"].get(stream, -1) >= batch_id:
            return
        seen = Observation()
        file = F.struct("file_path", "length", "modified")
        watched = rows.observe(seen, F.collect_set(file).alias("files")).where(~sources.is_header_row())
        start, load_id = datetime.datetime.now(), content["load_id"] + 1
        staged = self._stage(watched, load_id)
        found = [tuple(x) for x in seen.get["files"]]
        files = self.spark.createDataFrame(found, "file_path string, length bigint, modified bigint")
        self._take(staged, files, load_id, layout, delimiter, start, {stream: batch_id})

    # One load

    def load(self, raw, files, load_id, layout="file_name", delimiter=schema.DELIMITER):
        """Take one batch of files in: their raw rows, and file_path, length and modified of each.
        Loads count from 0 without gaps; one that is published already changes nothing."""
        last = self._current()["load_id"]
        if load_id <= last:
            return
        if load_id > last + 1:
            raise ValueError(f"load {load_id} follows load {last}")
        start = datetime.datetime.now()
        self._take(self._stage(raw, load_id), files, load_id, layout, delimiter, start)

    def _take(self, staged, files, load_id, layout, delimiter, start, batches=None):
        self._add_boundaries(staged, load_id)
        self._add_rejects(load_id, delimiter)
        self._audit(files, load_id, layout, start)
        if (load_id + 1) % self.merge_every == 0:
            self._merge(load_id)
        self._publish(load_id, self._report(load_id), batches or {})

    def _stage(self, raw, load_id):
        """Parse the text once; everything later reads the columns it needs from parquet.

        Text cells are kept for rejected rows only. The hash of all cells serves the audit. The numbers
        of the load are taken as the rows are written.
        """
        parsed = clean.parse_candles(raw)
        seq = F.col(self.tie_break) if self.tie_break else F.lit(None)
        rejected = F.col("reject_reason") != ""
        staged = parsed.select(
            "file_path", "stock_name", "time_utc",
            "open_price", "high_price", "low_price", "close_price", "volume",
            seq.cast("bigint").alias("seq"),
            audits.row_hash(["stock_name", *schema.RAW_CANDLES.names]).alias("row_hash"),
            rejected.alias("rejected"), "reject_reason",
            *[F.when(rejected, F.col(c)).alias(c) for c in CELLS],
        )
        staged, seen = metrics.observed(staged)
        self._write(staged, "staging", load_id)
        self._numbers = metrics.numbers(seen)
        return self.spark.read.schema(STAGED).parquet(self.path("staging", load_id))

    def _add_boundaries(self, staged, load_id):
        """Boundaries and hash sums per file and month, in one scan; rejected rows have a row of
        their own, for the sums."""
        time = F.when(~F.col("rejected"), F.col("time_utc"))
        keys = ["file_path", "stock_name", F.year(time).alias("year"), F.month(time).alias("month"), "rejected"]
        sums = [x.alias(c) for c, x in zip(_SUMS, audits.hash_sums("row_hash"))]
        if self.tie_break and self.dense_ties:
            staged = staged.groupBy("file_path", "stock_name", "time_utc", "rejected").agg(
                *boundaries.bar_prices(F.col("seq"), "seq"), *sums
            ).withColumns({"first_time": F.col("time_utc"), "last_time": F.col("time_utc")})
            edges = boundaries.merged_edges(F.col("first_time"), F.col("last_time"))
            sums = [F.sum(c).alias(c) for c in _SUMS]
        else:
            order = F.struct("time_utc", "seq") if self.tie_break else F.col("time_utc")
            edges = boundaries.edge_aggregates(order, tie_break="seq")
        rows = staged.groupBy(*keys).agg(*edges, *sums).withColumnsRenamed(boundaries.MERGED_TIMES)
        self._write(rows.select(*DELTA.names), "delta", load_id, bucketed=True)

    def _add_rejects(self, load_id, delimiter):
        """The lines set apart, with their places: the files that hold any, at most those of a load,
        are read as lines. A load without any writes nothing."""
        if not self._numbers["rejected"]:
            if self.pointers.children(self.path("rejects", load_id)):  # of an attempt that broke off
                self._write(self.spark.createDataFrame([], REJECTS), "rejects", load_id)
            return
        bad = self._loads("delta", [load_id]).where("rejected").select("file_path").distinct().collect()
        names = [_literal(unquote(row[0])) for row in bad]
        lines = ledger.rejected_lines(self.spark.read.option("recursiveFileLookup", "true").text(names), delimiter)
        self._write(lines.select(*REJECTS.names), "rejects", load_id)

    def _audit(self, files, load_id, layout, start):
        """One row per file, also of those without rows, with a fingerprint of its rows. is_new marks
        content that no current file had before; of several copies in a load the first."""
        per_file = self._loads("delta", [load_id]).groupBy("file_path").agg(
            *[F.sum(c).alias(c) for c in _SUMS], F.sum("n").alias("n"),
            F.bool_or("rejected").alias("load_with_error"),
        )
        none = F.lit(0).cast("bigint")
        rows = files.join(per_file, "file_path", "left").withColumns(
            {c: F.coalesce(c, none) for c in (*_SUMS, "n")}
        ).withColumns({
            "row_fingerprint": audits.fingerprint_of(*map(F.col, _SUMS), F.col("n")),
            "number_of_processed_rows": F.col("n"),
            "load_with_error": F.coalesce("load_with_error", F.lit(False)),
        })
        before = self._versions(load_id - 1).select("row_fingerprint").distinct()
        firsts = audits.new_files_only(rows, before, ["row_fingerprint"]).groupBy("row_fingerprint").agg(
            F.min("file_path").alias("first_path")
        )
        rows = rows.join(firsts, "row_fingerprint", "left").withColumns({
            "is_new": F.coalesce(F.col("file_path") == F.col("first_path"), F.lit(False)),
            "start_load_date": F.lit(start), "end_load_date": F.lit(datetime.datetime.now()),
        })
        named = sources.with_path_columns(rows, layout)
        self._write(named.select(*AUDIT.names), "audit", load_id)

    def _versions(self, load_id):
        """The current files after a load: the newest version of each path."""
        if load_id < 0:
            return self.spark.createDataFrame([], VERSION)
        known, audit = self._since_base("known", "audit", load_id)
        rows = known.select(*VERSION.names).unionByName(
            audit.select(*VERSION.names[:-1], F.col("load_id").alias("version"))
        )
        newest = F.max_by(F.struct(*VERSION.names[1:]), "version").alias("newest")
        return rows.groupBy("file_path").agg(newest).select("file_path", "newest.*")

    def _state(self, load_id, buckets=None):
        """Boundaries of the current files after a load; of equal ones the first path's only."""
        base, delta = self._since_base("base", "delta", load_id)
        if buckets is not None:
            base, delta = (x.where(F.col("stock_bucket").isin(buckets)) for x in (base, delta))
        rows = base.select(*BASE.names).unionByName(
            delta.where(~F.col("rejected")).select(*BASE.names[:-1], F.col("load_id").alias("version"))
        )
        versions = self._versions(load_id)
        file = F.struct("file_path", "version", "modified")
        one = versions.groupBy("row_fingerprint").agg(F.min_by(file, "file_path").alias("one")).select("one.*")
        return rows.join(one, ["file_path", "version"])

    def _merge(self, load_id):
        """Merge the state now and then, so the number of loads to read stays small."""
        rows = self._since_base("base", "delta", load_id)
        current = self._versions(load_id)
        parts = rows[0].select(*BASE.names).unionByName(
            rows[1].where(~F.col("rejected")).select(*BASE.names[:-1], F.col("load_id").alias("version"))
        )
        kept = parts.join(current.select("file_path", "version"), ["file_path", "version"], "left_semi")
        self._write(kept.select(*BASE.names), "base", load_id, bucketed=True)
        self._write(current, "known", load_id)

    def _report(self, load_id):
        """Report the touched buckets again; returns their numbers."""
        start = datetime.datetime.now()
        stocks = self._loads("audit", [load_id]).select("stock_name").where("stock_name is not null")
        stocks = stocks.unionByName(self._loads("delta", [load_id]).select("stock_name"))
        # At most `buckets` numbers: they prune the folders of the state that are read.
        touched = [row[0] for row in stocks.select(bucket_of("stock_name", self.buckets)).distinct().collect()]
        state = self._state(load_id, touched)
        months = boundaries.merge_boundaries(state, versions=NEWEST)
        years = report.report_algorithms(months, self.algorithm_types, self.rules)
        self._write(years, "report", load_id, bucketed=True)
        written = self._loads("report", [load_id])
        self._write(report.averages_by_rules(written, self.rules), "averages", load_id, bucketed=True)
        done = audits.destination_audit(written, "year_report", start, datetime.datetime.now())
        self._write(done, "destination_audit", load_id)
        return touched

    def _publish(self, load_id, touched, batches):
        """Point to this load's folders for the buckets it touched. A bucket whose last row is gone
        has no folder and is no longer pointed to."""
        number, content = self.pointers.newest()
        for table in ("report", "averages"):
            kept = {b: load for b, load in content[table].items() if int(b) not in touched}
            names = self.pointers.children(self.path(table, load_id))
            own = {name.split("=")[1]: load_id for name in names if name.startswith("stock_bucket=")}
            content[table] = kept | own
        content["batches"] |= batches
        self.pointers.publish(number + 1, content | {"load_id": load_id, "metrics": self._numbers})

    def clean_up(self, keep=1):
        """Remove what only pointers before the last `keep` name: their files, report folders that no
        kept pointer names, and earlier epochs. Readers of an older state must have ended."""
        numbers = self.pointers.numbers()
        kept = [self.pointers.read(n) for n in numbers[-keep:]]
        for number in numbers[:-keep]:
            old = self.pointers.read(number)
            if old["epoch"] not in {x["epoch"] for x in kept}:
                self.pointers.delete_folder(f"{self.root}/epoch={old['epoch']}")
            else:
                for table in ("report", "averages"):
                    used = {load for x in kept for load in x[table].values()}
                    for load in set(old[table].values()) - used:
                        self.pointers.delete_folder(f"{self.root}/epoch={old['epoch']}/{table}/load_id={load}")
            self.pointers.delete(number)
