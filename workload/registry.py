"""Register a query together with the SQL that must give the same rows."""

from __future__ import annotations

import functools

from vacantia.session import SETTINGS

QUERIES = {}
SQL = {}


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded(fn):
    """Batches on their way to Python as the engine wants them, also in a session that it has not built."""

    @functools.wraps(fn)
    def run(spark, *rest):
        spark.conf.set(ARROW_BYTES, SETTINGS[ARROW_BYTES])
        return fn(spark, *rest)

    return run


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = _bounded(fn)
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark, sf_dir: str, name: str, *columns: str):
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
