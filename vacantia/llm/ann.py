"""Nearest neighbours by a block matrix join.

Candidates and queries are dealt to bands by a hash of their id, and every query band meets every
candidate band once. In a task the two are multiplied in tiles of int8 values. The part of a vector
that int8 cannot hold is measured, which bounds the error of every product; a candidate whose upper
bound is below the k-th best lower bound so far cannot be among the nearest. What survives is computed
in double precision from the original vectors and kept in a heap per query, so the result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes, about, of the double vectors of a band, and most rows: what one task holds.
CANDIDATE_BYTES, QUERY_BYTES = 1 << 27, 1 << 24
CANDIDATE_BAND, QUERY_BAND = 262_144, 32_768
#: Fewest rows worth a band of their own, and how many bands small tables are cut into at most.
SMALL_BAND, SPREAD = 4_096, 24
#: Rows of a tile.
TILE_QUERIES, TILE_CANDIDATES = 256, 4_096
#: Dimensions whose int8 products a float32 sum holds exactly.
EXACT_DIMS = 1_024
#: Largest components that float32 bounds hold as they are; tables with others are scaled for the bounds.
ORDINARY = 1e-12, 1e12
#: Survivors whose scores are computed at once.
SURVIVORS = 65_536


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id`` and ``vec`` of the rows that take part: an id, and components that are all finite and not all zero."""
    element = df.schema[vector].dataType.elementType
    vec = F.col(vector) if isinstance(element, T.FloatType) else F.col(vector).cast("array<double>")
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), vec.alias("vec"))
    return rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def _extent(rows: DataFrame) -> tuple[int, int]:
    """How many rows, and the length of the longest vector; 1 if there are none."""
    n, dim = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    return n, dim or 1


def nearest(
    candidates: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` candidates of largest inner product for each query, but for the query's own id.

    Gives ``query_id, rank, vec_id, score``, nearest first, ties to the smaller id; fewer rows where
    there are fewer candidates. Rows without an id or vector, with null or non-finite components, or
    all zero take no part. Vectors meet those of their own length only. Of rows that repeat an id the
    one with the smallest vector counts, in order of its components. Other columns are ignored.
    """
    base, asked = usable(candidates, vec_id, vector), usable(queries, vec_id, vector)
    n_base, base_dim = _extent(base)
    n_asked, asked_dim = _extent(asked)
    base_rows = max(1, min(CANDIDATE_BAND, CANDIDATE_BYTES // (8 * base_dim)))
    asked_rows = max(1, min(QUERY_BAND, QUERY_BYTES // (8 * asked_dim)))
    base_bands = max(-(-n_base // base_rows), min(SPREAD, -(-n_base // SMALL_BAND)), 1)
    asked_bands = max(-(-n_asked // asked_rows), 1)
    band = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = base.select("id", "vec", F.size("vec").alias("dim"), band(base_bands).alias("c"), every(asked_bands).alias("q"))
    right = asked.select("id", "vec", F.size("vec").alias("dim"), band(asked_bands).alias("q"), every(base_bands).alias("c"))
    meet = ["dim", "c", "q"]

    def tiles(own: pa.Table, wanted: pa.Table) -> pa.Table:
        found = _nearest(*_matrix(own), *_matrix(wanted), k) if own.num_rows and wanted.num_rows else []
        columns = zip(*found) if found else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    met = left.groupBy(*meet).cogroup(right.groupBy(*meet)).applyInArrow(tiles, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows from each band
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order, each once, and their vectors in double precision."""
    ids = rows["id"].to_numpy()
    flat = pa.concat_arrays([c.flatten() for c in rows["vec"].chunks]).to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    if (ids[1:] == ids[:-1]).any():
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        first = np.append(True, ids[1:] != ids[:-1])
        ids, vectors = ids[first], vectors[first]
    return ids, vectors


def _few_of_each(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of equal vectors the ``most`` with the smallest ids: no other copy can be among the nearest."""
    whole = np.ascontiguousarray(vectors).view([("", f"V{vectors.shape[1] * 8}")]).ravel()
    _, group = np.unique(whole, return_inverse=True)
    order = np.argsort(group, kind="stable")  # ids stay in order within a group
    starts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    return np.sort(order[place < most])


def _quantised(vectors: np.ndarray):
    """Int8 values with their scale, the norms of original and held part, and the norm of what is lost."""
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = 1  # a vector that scaling made zero
    whole = np.rint(vectors / scale[:, None])
    held = whole * scale[:, None]
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    return whole.astype(np.int8), scale, norm(vectors), norm(held), norm(vectors - held)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of int8 rows, exact: float32 sums of so few dimensions stay below 2**24."""
    total = 0
    for at in range(0, left.shape[1], EXACT_DIMS):
        part = slice(at, at + EXACT_DIMS)
        total = total + left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return total


def _nearest(ids, vectors, query_ids, query_vectors, k):
    few = _few_of_each(ids, vectors, k + 1)  # one more, as a query's own row does not count
    ids, vectors = ids[few], vectors[few]
    largest, q_largest = np.abs(vectors).max(axis=1), np.abs(query_vectors).max(axis=1)
    every = np.append(largest, q_largest)
    slack, wild = np.float32(0), np.zeros(len(query_ids), bool)
    if ORDINARY[0] <= every.min() and every.max() <= ORDINARY[1]:
        whole, scale, norm, held, lost = _quantised(vectors)
        q_whole, q_scale, q_norm, q_held, q_lost = _quantised(query_vectors)
    else:  # powers of two: one for all candidates, so that they compare, and one for each query
        power, q_power = np.frexp(largest.max())[1], np.frexp(q_largest)[1]
        whole, scale, norm, held, lost = _quantised(np.ldexp(vectors, -power))
        q_whole, q_scale, q_norm, q_held, q_lost = _quantised(np.ldexp(query_vectors, -q_power[:, None]))
        slack = np.float32(1e-35 * vectors.shape[1])  # what float32 loses of candidates far below the largest
        wild = np.abs(power + q_power) > 900  # doubles may overflow to ties, or vanish: no bounds
    found = []
    for q in range(0, len(query_ids), TILE_QUERIES):
        asked = slice(q, q + TILE_QUERIES)
        heaps = [[] for _ in query_ids[asked]]
        best = np.full((len(heaps), k), -np.inf, np.float32)
        for c in range(0, len(ids), TILE_CANDIDATES):
            tile = slice(c, c + TILE_CANDIDATES)
            near = _products(q_whole[asked], whole[tile])
            near *= q_scale[asked, None].astype(np.float32)
            near *= scale[None, tile].astype(np.float32)
            # what quantising and rounding to float32 can change a product by
            left = np.stack([q_lost[asked], q_held[asked], q_held[asked] * 1e-6], axis=1).astype(np.float32)
            right = np.stack([norm[tile], lost[tile], held[tile]]).astype(np.float32)
            error = left @ right
            error *= np.float32(1 + 1e-5)
            error += slack
            low, high = near - error, near + error
            low[wild[asked]], high[wild[asked]] = -np.inf, np.inf
            low[np.isnan(low)] = -np.inf
            high[np.isnan(high)] = np.inf
            own = np.searchsorted(ids[tile], query_ids[asked])
            at = np.flatnonzero((own < len(ids[tile])) & (ids[tile][np.minimum(own, len(ids[tile]) - 1)] == query_ids[asked]))
            low[at, own[at]] = high[at, own[at]] = -np.inf
            best = np.partition(np.concatenate([best, low], axis=1), -k, axis=1)[:, -k:]
            rows, columns = np.nonzero((high >= best.min(axis=1)[:, None]) & (high > -np.inf))
            scores = np.zeros(len(rows))
            for begin in range(0, len(rows), SURVIVORS):
                some = slice(begin, begin + SURVIVORS)
                one, other = query_vectors[asked][rows[some]], vectors[tile][columns[some]]
                for d in range(one.shape[1]):
                    scores[some] += one[:, d] * other[:, d]
            for row, score, vec in zip(rows.tolist(), scores.tolist(), ids[tile][columns].tolist()):
                heap = heaps[row]
                if len(heap) < k:
                    heapq.heappush(heap, (score, -vec))
                elif (score, -vec) > heap[0]:
                    heapq.heapreplace(heap, (score, -vec))
        for query, heap in zip(query_ids[asked].tolist(), heaps):
            found += [(query, -minus, score) for score, minus in heap]
    return found
