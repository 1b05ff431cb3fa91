"""Reports and boundary rows to and from a database, by the batched reader and writer.

URL, driver, user and password come from the caller; none is kept here.
"""

from pyspark.sql import functions as F

MONEY = "decimal(18,6)"


def connection(url, driver, user, password):
    return {"url": url, "driver": driver, "user": user, "password": password}


def with_decimals(df, data_type=MONEY):
    """Double columns as decimals, wide enough that no percent overflows; NaN becomes NULL."""
    def convert(name):
        value = F.col(name)
        return F.when(~F.isnan(value), value).cast(data_type).alias(name)

    return df.select(*[convert(n) if kind == "double" else F.col(n) for n, kind in df.dtypes])


def write_table(df, table, conn, mode="append", connections=4, batch_size=10000):
    """Write rows through at most `connections` sessions, each in batches.

    `overwrite` keeps the table and its keys, and empties it first. A task that is retried after
    a lost executor may insert its rows again: append into a keyed table, or overwrite.
    """
    (
        with_decimals(df)
        .repartition(connections)
        .write.format("jdbc")
        .options(dbtable=table, batchsize=batch_size, truncate="true", **conn)
        .mode(mode)
        .save()
    )


def read_table(spark, table, conn, partition_column, lower, upper, parts):
    """Read a table, split over a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(
            dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
            numPartitions=parts, **conn,
        )
        .load()
    )
