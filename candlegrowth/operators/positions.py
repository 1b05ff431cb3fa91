"""Places of rows in an order over all rows, and of lines in their files; no window over all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlegrowth.session import scratch_path

_IN_TASK = (1 << 33) - 1  # the bits of monotonically_increasing_id that count inside a task


def global_index(rows, order, name="index"):
    """The rows with their place from 0 on in the order of some columns, which should be unique.

    Rows are dealt to ranges and sorted there, and numbered in their range as they are written. What a
    range adds to its rows is the number of rows before it, known from one row per range; only these
    come to the driver, at most spark.sql.shuffle.partitions of them.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({
        "_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(_IN_TASK),
    }).write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(sizes):
        offsets.append((row["_range"], before))
        before += row["n"]
    offsets = spark.createDataFrame(offsets, "_range int, _before long")
    return ranged.join(F.broadcast(offsets), "_range").withColumn(
        name, F.col("_before") + F.col("_place")
    ).drop("_range", "_before", "_place")


def numbered_lines(lines, chosen=None):
    """Text lines as `spark.read.text` gives them, with file_path and `line`, the place in the file
    from 0 on, header lines counted. `chosen` may take rows away and add columns before the lines get
    their places, which stay those among all lines; it is given the lines with file_path.

    A large file is read in splits by different tasks. A task reads a split from start to end, so its
    own counter numbers the split's lines; the lines of the splits before it come from the counts of
    one more pass that reads no text columns, summed up per file.
    """
    marked = lines.withColumns({
        "file_path": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"),
        "_id": F.monotonically_increasing_id(),
    })
    splits = marked.groupBy("file_path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    marked = chosen(marked) if chosen else marked
    return marked.join(splits.drop("_n"), ["file_path", "_start"]).withColumn(
        "line", F.col("_before") + F.col("_id") - F.col("_first")
    ).drop("_start", "_id", "_first", "_before")
