"""File fingerprints and audit rows."""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.sources.files import with_path_columns

_CELL, _MISSING = "\u0001", "\u0002"  # between the cells of a row, and in place of a NULL


def row_hash(columns):
    """The first 60 bits of the MD5 of a row of text cells, as a number."""
    cells = F.concat_ws(_CELL, *[F.coalesce(F.col(c), F.lit(_MISSING)) for c in columns])
    return F.conv(F.substring(F.md5(cells), 1, 15), 16, 10).cast("bigint")


def fingerprint(row_hash_column):
    """Aggregate that identifies a bag of rows, whatever their order and number: the sums of the low
    and the high 30 bits of the row hashes, and the number of rows, as one MD5. The sums combine in
    the tasks that read the rows, so a file of any size is spread over many tasks; a bigint holds
    them for 2**33 rows.
    """
    return fingerprint_of(*hash_sums(row_hash_column), F.count(F.col(row_hash_column)))


def hash_sums(row_hash_column):
    value = F.col(row_hash_column)
    low, high = value.bitwiseAND((1 << 30) - 1), F.shiftright(value, 30)
    return [F.coalesce(F.sum(part), F.lit(0)) for part in (low, high)]


def fingerprint_of(*sums):
    return F.md5(F.concat_ws("|", *[x.cast("string") for x in sums]))


def content_fingerprint(rows, columns, keys=("file_path",)):
    """Fingerprint per file from its rows."""
    hashed = rows.select(*keys, row_hash(columns).alias("row_hash"))
    return hashed.groupBy(*keys).agg(
        fingerprint("row_hash").alias("row_fingerprint"), F.count(F.lit(1)).alias("n")
    )


def file_fingerprints(files, parsed):
    """One row per listed file: row_fingerprint over its rows' cells, number of rows, whether any was
    rejected. A file without rows, as one with a header only, has 0 rows."""
    hashed = parsed.select(
        "file_path", (F.col("reject_reason") != "").alias("rejected"),
        row_hash(["stock_name", *schema.RAW_CANDLES.names]).alias("row_hash"),
    )
    sums = hashed.groupBy("file_path").agg(
        fingerprint("row_hash").alias("row_fingerprint"),
        F.count(F.lit(1)).alias("number_of_processed_rows"),
        F.bool_or("rejected").alias("load_with_error"),
    )
    empty = F.md5(F.lit("0|0|0"))
    return files.join(sums, "file_path", "left").withColumns({
        "row_fingerprint": F.coalesce("row_fingerprint", empty),
        "number_of_processed_rows": F.coalesce("number_of_processed_rows", F.lit(0)),
        "load_with_error": F.coalesce("load_with_error", F.lit(False)),
    })


def staging_audit(files, parsed, start, end, layout="file_name", digests=None):
    """One row per listed file: who, what, how many rows, and whether any row was rejected.

    `files` has file_path; stock and year are taken from it as for the rows. `digests` are those of
    `digest.content_md5`; without them md5_sum is NULL.
    """
    found = file_fingerprints(files.select("file_path"), parsed)
    if digests is None:
        found = found.withColumn("md5_sum", F.lit(None).cast("string"))
    else:
        found = found.join(digests.select("file_path", "md5_sum"), "file_path", "left")
    return with_path_columns(found, layout).withColumns(
        {"start_load_date": F.lit(start), "end_load_date": F.lit(end)}
    ).select(*schema.STAGING_AUDIT.names)


def destination_audit(report, task_name, start=None, end=None, file_type="Bid"):
    """One row per stock, algorithm and year of a written report; the rows processed are the months
    that the report row holds."""
    months = sum(F.col(m).isNotNull().cast("bigint") for m in schema.MONTHS)
    rows = report.groupBy("stock_name", "algorithm_type", "current_year").agg(
        F.sum(months).alias("number_of_processed_rows"),
        F.bool_or(F.col("total_per_year").isNull()).alias("load_with_error"),
    )
    return rows.withColumns(
        {
            "file_type": F.lit(file_type),
            "task_name": F.lit(task_name),
            "start_load_date": F.lit(start).cast("timestamp"),
            "end_load_date": F.lit(end).cast("timestamp"),
        }
    ).select(*schema.DESTINATION_AUDIT.names)


def new_files_only(files, audit, keys=("file_name", "md5_sum")):
    """Files that no earlier load has recorded."""
    return files.join(audit.select(*keys), list(keys), "left_anti")
