"""Catalog tables: create, drop, insert, truncate and read back."""

from candlegrowth import schema


def _columns(table_schema):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema.fields)


def create_database(spark, database, location):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def drop_database(spark, database):
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def create_table(spark, table, table_schema, partition_columns=()):
    partitioned = f"PARTITIONED BY ({', '.join(partition_columns)})" if partition_columns else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(table_schema)}) USING parquet {partitioned}"
    )


def create_text_table(spark, table, table_schema, delimiter=schema.DELIMITER):
    """A table kept as delimited text."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns(table_schema)}) "
        f"USING csv OPTIONS (sep '{delimiter}', nullValue '{schema.NULL_TEXT}')"
    )


def create_tables(spark, database, location):
    """The destination tables of the reports."""
    create_database(spark, database, location)
    create_table(spark, f"`{database}`.year_report", schema.REPORT)
    create_table(spark, f"`{database}`.average_report", schema.AVERAGES)


def insert_select(spark, table, rows):
    """Append the rows to a table, matching columns by name."""
    names = spark.table(table).columns
    rows.select(*names).write.insertInto(table)


def truncate_table(spark, table):
    spark.sql(f"TRUNCATE TABLE {table}")


def read_table(spark, table):
    return spark.table(table)
