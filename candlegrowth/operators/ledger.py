"""Lines that were set apart, where they stand, and whether a later version of their file mends them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.operators import clean, positions

_CELLS = f"{', '.join(f'{name} string' for name in (*schema.RAW_CANDLES.names, schema.CORRUPT))}"
OPEN, MENDED, REPEATED, WITHDRAWN = "open", "mended", "repeated", "withdrawn"


def rejected_lines(lines, delimiter=schema.DELIMITER):
    """file_path, line (the place in the file from 0 on, headers counted), reason and value of the lines
    of candle files that the reader sets apart. Blank lines and headers are not; the cells are
    read as `read_candles` reads them. `lines` are those of `spark.read.text`.
    """
    options = {
        "sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": schema.CORRUPT,
        "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }

    def rejected(rows):
        # By a generator, as a projected column would be put into each place of the filter that names it,
        # and every line be split into cells dozens of times.
        cells = F.inline(F.array(F.from_csv("value", _CELLS, options)))
        parsed = clean.parse_candles(rows.where(F.trim("value") != "").select("*", cells))
        header = F.col("time_text").eqNullSafe(schema.HEADER_CELL)
        bad = parsed.where(~header & (F.col("reject_reason") != ""))
        return bad.select(*rows.columns, F.col("reject_reason").alias("reason"))

    return positions.numbered_lines(lines, rejected).select("file_path", "line", "reason", "value")


def entries(rejects, versions):
    """A row per rejected line of each version of a file: file_path, version, line, reason, value, status,
    closed_by.

    `rejects` has the columns of `rejected_lines` and version; `versions` has file_path, version and
    length, one row per version that a load took in, with a NULL length where the file was taken back. An
    entry is open while its version is the newest. The version after it closes it: mended; repeated,
    where this version holds a rejected line of the same text, which has an open entry of its own
    then; or withdrawn. What is joined is the versions of files, not their rows, and rejected lines.
    """
    order = Window.partitionBy("file_path").orderBy("version")
    spans = versions.select(
        "file_path", "version", F.lead("version").over(order).alias("closed_by"),
        F.lead(F.col("length").isNull()).over(order).alias("_gone"),
    )
    later = rejects.select("file_path", F.col("version").alias("closed_by"), "value").distinct().withColumn(
        "_again", F.lit(True)
    )
    rows = rejects.join(spans, ["file_path", "version"]).join(later, ["file_path", "closed_by", "value"], "left")
    status = (
        F.when(F.col("closed_by").isNull(), OPEN).when(F.col("_gone"), WITHDRAWN)
        .when(F.col("_again"), REPEATED).otherwise(MENDED)
    )
    return rows.withColumn("status", status).select(
        "file_path", "version", "line", "reason", "value", "status", "closed_by"
    )
