"""Spark results against SQL on the same tables, as bags of rows."""

import glob
import math
import os

import duckdb


def run_sql(folder, text):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.sql(text)
    kinds = dict(zip(result.columns, [str(t) for t in result.types]))
    return kinds, [dict(zip(result.columns, row)) for row in result.fetchall()]


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return repr(value)


def bag(rows):
    return sorted(tuple((k, _cell(v)) for k, v in sorted(row.items())) for row in rows)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def spark_rows(df):
    return [row.asDict() for row in df.collect()]


def differences(df, folder, text):
    """What differs between a DataFrame and the SQL text, as a list of messages."""
    kinds, expected = run_sql(folder, text)
    found = []
    spark_kinds = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if spark_kinds != kinds:
        found.append(f"types {sorted(set(spark_kinds.items()) ^ set(kinds.items()))}")
    left, right = bag(spark_rows(df)), bag(expected)
    if len(left) != len(right):
        found.append(f"rows {len(left)} against {len(right)}")
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2]
        only_right = [r for r in right if r not in set(left)][:2]
        found.append(f"spark {only_left} sql {only_right}")
    return found
