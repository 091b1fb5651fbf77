"""Connected components of a table of links, by alternating large and small stars.

Links that one task holds are put together there, so what leaves a task is a star for each component of
its links. While there are more than one task may hold, rounds go on over all tasks: each round hangs
every node on the smallest one it knows of, until nothing moves. A round is an aggregate and a join on the
node; a node with very many links is combined before the shuffle in the aggregate and split by adaptive
execution in the join. Rounds are cut by tables in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.registry import releasing, stored
from vacantia.session import work_dir

#: Most links that a task holds at a time; 8 MB for nodes of 16 bytes.
TASK_LINKS = 1 << 18


def stars(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Links between ``a`` and ``b`` as one of each node to the smallest of its component, which has none itself."""
    both = pa.concat_arrays([a, b]).dictionary_encode()
    names = both.dictionary.take(order := pc.sort_indices(both.dictionary))
    place = np.empty(len(names), np.int64)
    place[order.to_numpy()] = np.arange(len(names))
    one, two = np.split(place[both.indices.to_numpy()], 2)
    root = np.arange(len(names))
    while True:
        one, two = root[one], root[two]
        apart = one != two
        one, two = one[apart], two[apart]
        if not len(one):
            break
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names.take(pa.array(moved)), names.take(pa.array(root[moved]))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of links ``a, b``; the root is the smallest node of its component.

    Nodes are of any type that has an order. Links to oneself, repeated links and links with a null
    count for nothing, and a node without another link gives no row.
    """
    spark = links.sparkSession
    folder = work_dir(spark, "components")
    links = stored(links.where(F.col("a") != F.col("b")).select("a", "b"), f"{folder}/links")
    if links.count() > TASK_LINKS:
        links = stored(_merged(links), f"{folder}/0")
    state, rounds = None, 0
    while (now := _state(links))[0] > TASK_LINKS and now != state:
        state, rounds = now, rounds + 1
        links = stored(_small_star(_large_star(links)), f"{folder}/{rounds}")
    if now[0] <= TASK_LINKS:
        links = stored(_merged(links.coalesce(1)), f"{folder}/all")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _merged(links: DataFrame) -> DataFrame:
    """Stars of the links of each task, ``TASK_LINKS`` at a time."""
    most = TASK_LINKS

    def merge(batches):
        held, rows = [], 0
        for batch in batches:
            if rows and rows + batch.num_rows > most:
                yield star(held)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield star(held)

    def star(held):
        columns = (pa.concat_arrays([batch.column(i) for batch in held]) for i in (0, 1))
        return pa.RecordBatch.from_arrays(list(stars(*columns)), names=["a", "b"])

    return links.mapInArrow(releasing(merge), links.schema)


def _state(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a")))  # a: the node, b: a neighbour
    least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
    least = least.withColumn("least", F.least("of", "least"))
    far = both.where(F.col("b") > F.col("a"))
    return far.join(least, far["a"] == least["of"]).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    links = links.where(F.col("a") != F.col("b")).distinct()
    least = links.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("least"))
    met = links.join(least, links["a"] == least["of"])
    moved = met.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        met.select("a", F.col("least").alias("b"))
    )
    return moved.where(F.col("a") != F.col("b")).distinct()
