"""Run registered queries next to their SQL and compare whole results."""

import glob
import os

import duckdb

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def connect(sf=SF):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), sorted_rows(columns, result.fetchall())
