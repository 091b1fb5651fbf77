"""Session settings the engine relies on, and the shared folder for its own tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def build_session(app: str = "vacantia", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Work folders that this process has named.
_NAMED: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, it is made under the warehouse, if that is shared: a folder of one machine will
    do on one machine only. :func:`clean` removes it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = warehouse.startswith(("file:", "/"))
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{warehouse.rstrip('/')}/vacantia-work"
    _NAMED.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _NAMED[-1]


def clean(spark: SparkSession) -> None:
    """Remove the work folders of this process; results that have not been read or stored by then are lost."""
    from vacantia.sources import files

    while _NAMED:
        files.remove(spark, _NAMED.pop())
