"""List records with their detail records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def list_detail(listed: DataFrame, details: DataFrame, key: Sequence[str]) -> DataFrame:
    """List fields carried along to the detail; a detail that never arrived gives no row.

    No hint: Spark broadcasts a side it knows to be small, and otherwise AQE may split the hot
    partitions of either side.
    """
    return listed.join(details, list(key), "inner")
