"""Shards by a hierarchical weighted hash tree.

A row descends from the root over region and rack to a shard. At each level every child draws a waiting
time from a hash of the row's key and the child, divided by the child's weight (the sum of the shards
below it), and the shortest one wins; so a child is chosen in proportion to its weight. If weights
change, only draws of changed children change: a row moves only into a subtree that grew or out of one
that shrank. A shard added later stands in a region of its own, and takes rows only into itself.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts that the rows of one shard are numbered in.
PARTS = 256


def layout(shards: int, planned: int = 16, racks: int = 2, per_rack: int = 2) -> list[tuple[int, int, int, float]]:
    """Region, rack, shard and weight of each shard: the first ``planned`` in full regions, later ones alone."""
    per_region, found = racks * per_rack, []
    regions = -(-planned // per_region)
    for shard in range(shards):
        place = (shard // per_region, shard % per_region // per_rack) if shard < planned else (regions + shard - planned, 0)
        found.append((*place, shard, 1.0))
    return found


def _children(rows, level: int) -> list[tuple[int, float]]:
    weights = {}
    for row in rows:
        weights[row[level]] = weights.get(row[level], 0.0) + row[3]
    return [(child, weight) for child, weight in weights.items() if weight > 0]


def _draw(key: list[Column], level: int, path: list[Column], children: Column) -> Column:
    """The child with the shortest waiting time; ties go to the smaller number."""

    def wait(child):
        bits = F.xxhash64(*key, F.lit(level), *path, child["child"]).bitwiseAND(F.lit((1 << 53) - 1))
        return F.struct((-F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / child["weight"]).alias("wait"), child["child"].alias("child"))

    return F.array_min(F.transform(children, wait))["child"]


def _literal(children: list[tuple[int, float]]) -> Column:
    return F.array(*(F.struct(F.lit(c).alias("child"), F.lit(w).alias("weight")) for c, w in children))


def _below(rows, level: int) -> Column:
    """A map from the path of a node to its children."""
    path = lambda row: row[:level]
    pairs = []
    for node, own in groupby(sorted(rows), key=path):
        pairs += [F.lit("/".join(map(str, node))), _literal(_children(list(own), level))]
    return F.create_map(*pairs)


def assign(df: DataFrame, tree: list[tuple[int, int, int, float]], key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """Add ``shard``, which depends on ``key`` and the tree alone, without moving a row.

    Rows without a key go where a null draws, all to one shard; repeated keys go together. A column
    already named ``shard`` is replaced, others are kept. Shards and subtrees of weight zero get nothing.
    """
    tree = [row for row in tree if row[3] > 0]
    own = [F.col(key).cast("string")]
    region = _draw(own, 0, [], _literal(_children(sorted(tree), 0)))
    rows = df.withColumn("__region", region)
    rack = _draw(own, 1, [F.col("__region")], F.element_at(_below(tree, 1), F.col("__region").cast("string")))
    rows = rows.withColumn("__rack", rack)
    path = F.concat_ws("/", F.col("__region"), F.col("__rack"))
    leaf = _draw(own, 2, [F.col("__region"), F.col("__rack")], F.element_at(_below(tree, 2), path))
    return rows.withColumn(shard, leaf).drop("__region", "__rack")


def number(df: DataFrame, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add ``slot``: places 0, 1, ... within each shard, by a hash of the row and then its columns.

    Equal rows are counted before they move, and each shard is numbered in ``PARTS`` parts whose
    starting places are sums of counts; no task sees a whole shard. All columns must be orderable.
    """
    columns = [c for c in df.columns if c != slot]
    part = F.pmod(F.xxhash64(*columns), F.lit(PARTS)).cast("int")
    same = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__part", part)
    sums = same.groupBy(shard, "__part").agg(F.sum("__n").alias("__sum"))
    before = Window.partitionBy(shard).orderBy("__part")  # at most PARTS rows each
    starts = sums.select(
        F.col(shard).alias("__shard"), F.col("__part").alias("__of"),
        (F.sum("__sum").over(before) - F.col("__sum")).alias("__start"),
    )
    within = Window.partitionBy(shard, "__part").orderBy(*columns).rowsBetween(Window.unboundedPreceding, 0)
    placed = same.withColumn("__end", F.sum("__n").over(within)).join(
        F.broadcast(starts),  # PARTS rows for each shard
        F.col(shard).eqNullSafe(F.col("__shard")) & (F.col("__part") == F.col("__of")),
    )
    first = F.col("__start") + F.col("__end") - F.col("__n")
    return placed.select(*columns, F.explode(F.sequence(first, first + F.col("__n") - 1)).alias(slot))
