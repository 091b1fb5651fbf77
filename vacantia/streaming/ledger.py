"""Tables that streams add to batch by batch, and that are put together without stopping them.

A ledger has batches (``batches/[source=]/run=/batch_id=``), which a replay replaces whole, generations, which hold
what compaction put together, and manifests. The newest manifest names one generation and, for each run,
the last batch that is in it; readers take that generation and all later batches. Only batches that the
commit log of their run's checkpoint holds are put together, as any other may be replayed: a replay finds its own
rows in its own batch, whatever has been compacted meanwhile. A manifest is one file, so readers see the old
generation whole until they see the new one. What the manifest before has put together is deleted.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.schemas import plain
from vacantia.sources import files
from vacantia.sources.stored import read_table

MANIFEST = plain("generation string, buckets int, source string, run string, batch_id long, version int")
RUNS = plain("checkpoint string, run string")
#: Runs that write one batch, all at once: known when they are there.
IMPORT = "import-"


class Manifest(NamedTuple):
    version: int = 0
    generation: str | None = None
    buckets: int = 0
    folded: dict = {}

    def is_open(self) -> Column:
        """On batches: they are not in the generation. Of partition columns only, so the others are not read."""
        later = F.lit(True)
        for (source, run), batch_id in sorted(self.folded.items(), key=repr):
            own = F.col("run") == run
            own = own & (F.col("source") == source) if source is not None else own
            later = F.when(own, F.col("batch_id") > batch_id).otherwise(later)
        return later


def run_of(checkpoint: str) -> str:
    """A name for all that one checkpoint has taken; never mistaken for a number."""
    return f"r{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}"


def register(spark: SparkSession, path: str, checkpoint: str) -> str:
    """Remember where a run keeps its checkpoint; gives the run's name."""
    run = run_of(checkpoint)
    if f"run={run}" not in files.folders(spark, f"{path}/runs"):
        row = spark.createDataFrame([(checkpoint,)], "checkpoint string").coalesce(1)
        row.write.mode("overwrite").parquet(f"{path}/runs/run={run}")
    return run


def committed(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch that the checkpoint of each run has committed, -1 where none is."""
    last = {}
    for row in read_table(spark, f"{path}/runs", RUNS).collect():  # one row a run
        done = [int(n) for n in files.names(spark, f"{row['checkpoint']}/commits") if n.isdigit()]
        last[row["run"]] = max(done, default=-1)
    return last


def batches_path(path: str) -> str:
    return f"{path}/batches"


def manifest(spark: SparkSession, path: str) -> Manifest:
    versions = [int(n.split("=")[1]) for n in files.folders(spark, f"{path}/manifest") if n.startswith("version=")]
    for version in sorted(versions, reverse=True):
        rows = read_table(spark, f"{path}/manifest/version={version}", MANIFEST, base=f"{path}/manifest").collect()
        if rows:  # the file is there
            folded = {(r["source"], r["run"]): r["batch_id"] for r in rows if r["run"] is not None}
            return Manifest(version, rows[0]["generation"], rows[0]["buckets"], folded)
    return Manifest()


def _publish(spark: SparkSession, path: str, new: Manifest) -> None:
    """One file in a folder of its own; an error if another compaction has taken the version."""
    rows = [(new.generation, new.buckets, s, r, b) for (s, r), b in new.folded.items()] or [(new.generation, new.buckets, None, None, None)]
    schema = T.StructType(MANIFEST.fields[:-1])
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={new.version}")


def open_batches(spark: SparkSession, path: str, schema: T.StructType, known: Manifest | None = None, source: str | None = None) -> DataFrame:
    """Rows of the batches that are not in the generation, of one source if named."""
    known = manifest(spark, path) if known is None else known
    base = batches_path(path)
    rows = read_table(spark, f"{base}/source={source}" if source else base, schema, base=base)
    return rows.filter(known.is_open())


def generation(spark: SparkSession, path: str, schema: T.StructType, keys: list[str] | None = None, known: Manifest | None = None) -> DataFrame | None:
    """Rows of the generation, None if there is none yet; with ``keys``, as the table of buckets it was written as."""
    known = manifest(spark, path) if known is None else known
    if known.generation is None:
        return None
    folder = f"{path}/generations/{known.generation}"
    if not known.buckets:
        return spark.read.schema(schema).parquet(folder)
    name = f"vacantia_{known.generation}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {known.buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def compact(
    spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame], keys: list[str] | None = None,
    per_bucket: int = 1_000_000,
) -> bool:
    """Put the generation and all committed batches together by ``merge``; false if no batch has been added.

    ``schema`` is that of a generation's rows. With ``keys`` they are written in buckets by a hash of these, about
    ``per_bucket`` rows each, which later joins find in place. Streams may go on meanwhile.
    """
    known, last = manifest(spark, path), committed(spark, path)
    sourced = "source" in schema.names
    there = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    parts = ["source", "run", "batch_id"] if sourced else ["run", "batch_id"]
    fresh = open_batches(spark, path, there, known)
    newest = {}
    for row in fresh.select(*parts).distinct().collect():  # one row a batch that waits to be put together
        run, batch_id = row["run"], row["batch_id"]
        if run.startswith(IMPORT) or batch_id <= last.get(run, -1):
            key = (row["source"] if sourced else None, run)
            newest[key] = max(newest.get(key, batch_id), batch_id)
    if not newest:
        return False
    added = F.lit(False)
    for (source, run), batch_id in newest.items():
        own = (F.col("run") == run) & (F.col("batch_id") <= batch_id)
        added = added | (own & (F.col("source") == source) if sourced else own)
    rows = fresh.filter(added).select(*schema.names)
    old = generation(spark, path, schema, keys, known)
    rows = merge(rows if old is None else rows.unionByName(old))
    name, buckets = f"g{uuid.uuid4().hex}", 0
    folder = f"{path}/generations/{name}"
    if keys is None:
        rows.write.parquet(folder)
    else:
        buckets = max(8, -(-rows.count() // per_bucket))
        writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.format("parquet").option("path", folder).saveAsTable(f"vacantia_{name}")
    _publish(spark, path, Manifest(known.version + 1, name, buckets, known.folded | newest))
    _clean(spark, path, known, {name, known.generation})
    return True


def _clean(spark: SparkSession, path: str, before: Manifest, kept: set) -> None:
    """Delete batches that the manifest before has put together, and generations that neither it nor the new one names."""
    base = batches_path(path)
    for (source, run), batch_id in before.folded.items():
        at = "/".join([base, *([f"source={source}"] if source is not None else []), f"run={run}"])
        for folder in files.folders(spark, at):
            if folder.startswith("batch_id=") and int(folder.split("=")[1]) <= batch_id:
                files.remove(spark, f"{at}/{folder}")
    for name in files.folders(spark, f"{path}/generations"):
        if name not in kept:
            spark.sql(f"DROP TABLE IF EXISTS vacantia_{name}")
            files.remove(spark, f"{path}/generations/{name}")
