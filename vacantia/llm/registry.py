"""Register a query of this subpackage, with the SQL that must give the same rows where there is one."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import types as T

import vacantia

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = with_package(fn)
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


#: Bytes of a batch of rows on its way to Python: texts are long, and several copies of a batch are held.
BATCH_BYTES = "4m"


def with_package(fn):
    """Make sure that Python workers can import the package, and get batches of a fitting size."""

    @functools.wraps(fn)
    def run(spark, *rest):
        ship(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return fn(spark, *rest)

    return run


def ship(spark) -> None:
    """Add the package to the job's files, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_vacantia_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(vacantia.__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="vacantia-"), "vacantia_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "vacantia")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)  # Spark serves it to every executor
    context._vacantia_shipped = True


def table(spark, sf_dir: str, name: str, *columns: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df, folder: str):
    """Write a table to the shared folder and read it back: later steps start from files, not from lineage."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def releasing(run):
    """``run``, a function for mapInArrow, that gives freed batches back to the system at the end of a task.

    A worker outlives its task and goes on to other stages, and Arrow's pool keeps what was freed.
    """

    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return task


def map_batches(df, inputs: list[str], outputs: dict[str, T.DataType], start, keep: list[str] | None = None):
    """Columns ``keep`` (all by default) and ``outputs``, which Python makes of Arrow arrays of ``inputs``.

    ``start`` is called once in a task and gives two functions: one that makes the new arrays of a batch,
    and one for the end. Every operator that needs Python in a row goes this way, as Spark then has one
    pool of workers for all of them; a kept column named as an output is replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in outputs]
    more = [c for c in inputs if c not in kept]
    fields = [*(df.schema[c] for c in kept), *(T.StructField(n, t) for n, t in outputs.items())]
    places = [[*kept, *more].index(c) for c in inputs]
    names = [f.name for f in fields]

    def run(batches):
        work, end = start()
        for batch in batches:
            made = work(*(batch.column(i) for i in places))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=names)
        end()

    return df.select(*kept, *more).mapInArrow(releasing(run), T.StructType(fields))
