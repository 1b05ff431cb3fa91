"""Bucketed tables, and the merging of one into another without a shuffle."""

from pyspark.sql import functions as F

from candlegrowth.operators.upsert import newest_per_key

BUCKETS = 64


def write_bucketed(rows, table, keys, buckets=BUCKETS, mode="overwrite"):
    """Rows as a catalog table in buckets by all key columns, sorted by them, a file per bucket."""
    dealt = rows.repartition(buckets, *keys)
    _save(dealt, table, keys, buckets, mode)


def _save(rows, table, keys, buckets, mode):
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).mode(mode).format("parquet").saveAsTable(table)


def merged(current, incoming, keys, version=None):
    """The result of `upsert.upsert`, from one merge join of both tables.

    Where both are bucketed alike by `keys`, neither is shuffled: rows of a key lie in buckets of the
    same number, so reducing the incoming rows and joining happen bucket by bucket. A bucket holds
    whole keys, of which the incoming table may have many rows; these are reduced by a hash
    aggregate first. Rows with a NULL key match no other and are all kept, of the incoming ones one
    per key.
    """
    newest = newest_per_key(incoming, keys, version)
    others = [c for c in current.columns if c not in keys]
    left = current.select(*keys, F.struct(*others).alias("_old"))
    right = newest.hint("merge").select(*keys, F.struct(*others).alias("_new"))
    joined = left.join(right, keys, "full")
    return joined.select(*keys, F.coalesce("_new", "_old").alias("_row")).select(*keys, "_row.*").select(*current.columns)


def upsert_bucketed(spark, current, incoming, target, keys, buckets=BUCKETS, version=None):
    """Merge the table `incoming` into the table `current` and write it as the table `target`,
    bucketed alike, so it is the next `current`. A task holds one bucket and writes its only file. The
    older table stays as it is for its readers."""
    rows = merged(spark.table(current), spark.table(incoming), keys, version)
    _save(rows, target, keys, buckets, "overwrite")
