"""Runs a registered query and its SQL, and compares the two results."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def spark_result(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_result(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([column[0] for column in cursor.description], cursor.fetchall())
