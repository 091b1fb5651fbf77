"""Folders on whatever file system a path names: taking one away, and putting one in another's place."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; nothing happens if it is not there."""
    files, there = _at(spark, path)
    files.delete(there, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    files, there = _at(spark, path)
    if not files.exists(there):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(there) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    files, there = _at(spark, path)
    if not files.exists(there):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(there) if s.isFile())


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder; false if there is none, an error if it cannot be renamed."""
    files, there = _at(spark, path)
    if not files.exists(there):
        return False
    if not files.rename(there, _at(spark, to)[1]):
        raise OSError(f"{path} cannot be renamed to {to}")
    return True


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Put a folder that is written whole in the place of another, which is there until then.

    If the job is lost between the two renames, the earlier folder stands beside, under ``-before``;
    :func:`restore` puts it back.
    """
    before = f"{path.rstrip('/')}-before"
    restore(spark, path)
    move(spark, path, before)
    move(spark, staged, path)
    remove(spark, before)


def restore(spark: SparkSession, path: str) -> None:
    """Finish what a lost :func:`replace` left: the earlier folder comes back if no other has taken its place."""
    before = f"{path.rstrip('/')}-before"
    files, there = _at(spark, path)
    if not files.exists(there):
        move(spark, before, path)
    else:
        remove(spark, before)
