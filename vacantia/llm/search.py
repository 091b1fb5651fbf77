"""Ranked lexical search over blocks of inverted lists, evaluated partly by term and partly by document.

1. Every task turns its documents into blocks of bounded size: sorted lists of document numbers and counts
   by term, with the lengths of the documents. Nothing is shuffled. Terms of no query are left out by a filter of
   bounded size. Document frequencies and the two totals are sums over the blocks.
2. Queries go to the tasks in rounds of bounded size, however many there are, and every task searches its
   blocks for all of a round. In a block, the short lists of a query are read term at a time into summed accumulators.
   From then on these are one more iterator with a bound, its largest sum, beside the long lists. All are
   read document at a time, a window after the other: a window whose bounds cannot reach the k-th best score is
   skipped, iterators whose bounds together cannot reach it are only probed for documents that others have
   brought, and a document is given up as soon as what is left cannot lift it.
3. A task keeps the k best of each query over all its blocks; the best of these are the result, taken in two steps
   so that no query gathers the finds of all tasks at once.

Scores are integers, so neither order changes them; documents of equal score go by ascending id.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.minhash import member_filter
from vacantia.llm.registry import stored
from vacantia.session import work_dir

#: Documents and tokens of a block; a longer document is a block by itself.
BLOCK_DOCS, BLOCK_TOKENS = 1 << 16, 1 << 22
#: Terms of the queries of one round, all of which a task holds.
ROUND_TERMS = 1 << 20
#: Documents in a window, and one in so many of which make a list long.
WINDOW, LONG = 4_096, 16
#: Parts in which the finds of a query are thinned before they meet.
PARTS = 64
# --- fixed values: parameters of the score ----------------------------------------------------------
SCALE, LENGTH_SHARE, SATURATION = 1_000_000_000, 75, 8

#: Bytes to terms: letters in lower case, digits and all of UTF-8 beyond ASCII stay, the rest separates.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

INDEX = (
    "n_docs long, n_terms long, ids array<long>, lengths binary, terms array<binary>, dfs array<int>, "
    "docs binary, tfs binary"
)
_INDEX = pa.schema(
    [
        ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
        ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int32())), ("docs", pa.binary()), ("tfs", pa.binary()),
    ]
)
FOUND = "item_id long, item long, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order: maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEPT).split(b" ") if text else []


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


class _Builder:
    """One block in the making."""

    def __init__(self, docs: int, tokens: int):
        self.most_docs, self.most_tokens = docs, tokens
        self.numbers, self.ids, self.lengths, self.terms, self.tfs, self.tokens = _Numbers(), [], [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = [t for t in terms_of(text) if t]
        if not words:
            return
        own, counts = np.unique(
            np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)), return_counts=True
        )
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.terms.append(own)
        self.tfs.append(counts.astype(np.int32))
        self.tokens += len(words)

    def full(self) -> bool:
        return len(self.ids) >= self.most_docs or self.tokens >= self.most_tokens

    def block(self, wanted) -> pa.RecordBatch:
        import xxhash

        names = np.array(list(self.numbers), object)
        hashes = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in names), np.uint64, len(names))
        used = wanted.may_hold(pa.array(hashes.view(np.int64))) if wanted else np.ones(len(names), bool)
        kept = sorted(np.flatnonzero(used).tolist(), key=names.__getitem__)
        place = np.full(len(names), -1, np.int64)
        place[kept] = np.arange(len(kept))
        term = place[np.concatenate(self.terms)]
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), [len(t) for t in self.terms])
        some = np.flatnonzero(term >= 0)
        order = some[np.argsort(term[some], kind="stable")]
        columns = [
            [len(self.ids)], [self.tokens], [self.ids], [np.array(self.lengths, np.int64).tobytes()],
            [[names[i] for i in kept]], [np.bincount(term[some], minlength=len(kept)).tolist()],
            [doc[order].tobytes()], [np.concatenate(self.tfs)[order].tobytes()],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX)], schema=_INDEX)


def build_index(docs: DataFrame, folder: str, wanted=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of inverted lists of all documents, written to ``folder``, which is read back.

    ``wanted``, a broadcast filter of term hashes, leaves out the lists of other terms; lengths and totals count
    all terms. A null or empty text, or one without a term, is in no list and counts for nothing. Rows
    that repeat an id are documents of their own; other columns are ignored.
    """

    limits = BLOCK_DOCS, BLOCK_TOKENS

    def build(batches):
        block = _Builder(*limits)
        for batch in batches:
            for own, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(own, words.as_py())
                if block.full():
                    yield block.block(wanted and wanted.value)
                    block = _Builder(*limits)
        if block.ids:
            yield block.block(wanted and wanted.value)

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stored(rows.mapInArrow(build, INDEX), folder)


def query_terms(queries: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, item, term, times`` of distinct queries; ``item`` tells texts of one id apart."""
    rows = queries.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    schema = pa.schema([("item_id", pa.int64()), ("item", pa.int64()), ("term", pa.binary()), ("times", pa.int64())])

    def split(batches):
        for batch in batches:
            out = []
            for own, item, words in zip(*(c.to_pylist() for c in batch.columns)):
                times = defaultdict(int)
                for term in terms_of(words):
                    if term:
                        times[term] += 1
                out += [(own, item, term, n) for term, n in times.items()]
            arrays = zip(*out) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(arrays, schema)], schema=schema)

    keyed = rows.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text")
    return keyed.mapInArrow(split, "item_id long, item long, term binary, times long")


def _weighted(index: DataFrame, terms: DataFrame) -> tuple[DataFrame, int, int]:
    """Queries with the weights of their terms, times repeats; and the two totals."""
    total = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n, length = total["docs"] or 0, total["terms"] or 0
    held = index.select(F.inline(F.arrays_zip("terms", "dfs"))).groupBy(F.col("terms").alias("term"))
    held = held.agg(F.sum("dfs").alias("df"))
    weight = F.floor(1000 * F.ln((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("long")
    met = terms.join(held, "term").withColumn("weight", weight * F.col("times")).where("weight > 0")
    return met.groupBy("item_id", "item").agg(F.collect_list(F.struct("term", "weight")).alias("terms")), n, length


class _Block:
    """A block of the index, ready to be searched."""

    def __init__(self, row: dict, n: int, length: int, window: int, long: int):
        self.long = long
        ids = row["ids"]
        self.none = np.array([i is None for i in ids])
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        self.at = {t: i for i, t in enumerate(row["terms"])}
        self.docs = np.frombuffer(row["docs"], np.int32)
        tfs, dfs = np.frombuffer(row["tfs"], np.int32).astype(np.int64), np.array(row["dfs"], np.int64)
        own = np.frombuffer(row["lengths"], np.int64)
        norm = 100 - LENGTH_SHARE + LENGTH_SHARE * own * n // length
        self.impacts = SCALE * tfs // (1000 * tfs + SATURATION * norm[self.docs])
        self.ends = np.concatenate([[0], np.cumsum(dfs)])
        self.bounds = np.append(np.arange(0, len(ids), window), len(ids))
        # where every window begins in every list, and the largest impact there
        key = np.repeat(np.arange(len(dfs)), dfs) * len(ids) + self.docs
        self.starts = np.searchsorted(key, np.arange(len(dfs))[:, None] * len(ids) + self.bounds[None, :])
        flat = np.append(self.impacts, 0)
        most = np.maximum.reduceat(flat, self.starts[:, :-1].ravel()) if len(dfs) else np.empty(0, np.int64)
        self.most = np.where(self.starts[:, 1:] > self.starts[:, :-1], most.reshape(len(dfs), len(self.bounds) - 1), 0)

    def search(self, terms: list[tuple[bytes, int]], best: _Best) -> None:
        lists = [(self.at[t], w) for t, w in terms if t in self.at]
        size = lambda x: self.ends[x[0] + 1] - self.ends[x[0]]
        short = [x for x in lists if size(x) * self.long <= len(self.ids)]
        long = [x for x in lists if size(x) * self.long > len(self.ids)]
        sums = np.zeros(len(self.ids), np.int64)  # the accumulators
        for at, weight in short:  # term at a time
            own = slice(self.ends[at], self.ends[at + 1])
            sums[self.docs[own]] += weight * self.impacts[own]
        for window, (begin, end) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())):
            part = sums[begin:end]
            # (bound, list or None for the accumulators), the weakest first
            each = [(int(self.most[at, window]) * weight, at, weight) for at, weight in long]
            each = sorted([x for x in each if x[0]] + [(int(part.max()), None, 0)], key=lambda x: x[0])
            left = np.cumsum([x[0] for x in each])
            if left[-1] < max(best.least, 1):
                continue  # nothing in the window can get in
            probed = int(np.searchsorted(left, best.least, side="left"))  # of these alone no document can
            score, reached = np.zeros(end - begin, np.int64), []
            for _, at, weight in each[probed:]:
                if at is None:
                    score += part
                else:
                    own = slice(self.starts[at, window], self.starts[at, window + 1])
                    score[self.docs[own] - begin] += weight * self.impacts[own]
                    reached.append(self.docs[own] - begin)
            docs = np.flatnonzero(score)
            for rank in range(probed - 1, -1, -1):
                docs = docs[score[docs] + left[rank] >= best.least]
                if not len(docs):
                    break
                _, at, weight = each[rank]
                if at is None:
                    score[docs] += part[docs]
                    continue
                own = slice(self.starts[at, window], self.starts[at, window + 1])
                there, impacts = self.docs[own] - begin, self.impacts[own]
                place = np.minimum(np.searchsorted(there, docs), len(there) - 1)
                met = there[place] == docs
                score[docs[met]] += weight * impacts[place[met]]
            docs = docs[score[docs] >= max(best.least, 1)]
            if len(docs):
                best.add(score[docs], self.none[begin + docs], self.ids[begin + docs])


class _Best:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.scores, self.none, self.ids = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def add(self, scores, none, ids) -> None:
        found = [np.concatenate(x) for x in ((self.scores, scores), (self.none, none), (self.ids, ids))]
        first = np.lexsort((found[2], found[1], -found[0]))[: self.k]
        self.scores, self.none, self.ids = (x[first] for x in found)
        if len(first) == self.k:
            self.least = int(self.scores[-1])


def search(index: DataFrame, terms: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, item, rank, doc_id, score``: for each query its ``k`` best documents with a score above 0.

    ``terms`` is of :func:`query_terms`. Equal scores go by ascending id, documents without an id last. Queries
    without a term that any document holds give no row; neither does an empty index.
    """
    spark = index.sparkSession
    folder = work_dir(spark, "search")
    weighted, n, length = _weighted(index, terms)
    weighted = stored(weighted, f"{folder}/queries")
    rounds = weighted.agg(F.sum(F.size("terms")).alias("terms")).first()["terms"] or 0
    rounds = max(1, -(-rounds // ROUND_TERMS))
    found, sizes = None, (WINDOW, LONG)
    schema = pa.schema([("item_id", pa.int64()), ("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    for number in range(rounds):  # rounds of bounded size, each one pass over the index
        own = weighted.where(F.pmod("item", F.lit(rounds)) == number).collect()
        own = [(r["item_id"], r["item"], [(bytes(t["term"]), t["weight"]) for t in r["terms"]]) for r in own]
        asked = spark.sparkContext.broadcast(own)

        def run(batches, asked=asked):
            best = [_Best(k) for _ in asked.value]
            for batch in batches:
                for row in batch.to_pylist():
                    block = _Block(row, n, length, *sizes)
                    for (_, _, wanted), one in zip(asked.value, best):
                        block.search(wanted, one)
            columns = [[], [], [], []]
            for (item_id, item, _), one in zip(asked.value, best):
                ids = [None if gone else i for gone, i in zip(one.none.tolist(), one.ids.tolist())]
                for column, values in zip(columns, ([item_id] * len(ids), [item] * len(ids), ids, one.scores.tolist())):
                    column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        part = index.mapInArrow(run, FOUND)
        found = part if found is None else found.union(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    thinned = found.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    item = Window.partitionBy("item_id", "item")
    thinned = thinned.withColumn("__rank", F.row_number().over(Window.partitionBy("item_id", "item", "__part").orderBy(*order)))
    ranked = thinned.where(F.col("__rank") <= k).withColumn("rank", F.row_number().over(item.orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "item", "rank", "doc_id", "score")


def best_documents(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: all documents ranked for all queries, by an index of the queries' terms.

    Equal query rows count once; several texts under one item id are ranked each for itself.
    """
    spark = docs.sparkSession
    terms = stored(query_terms(queries), work_dir(spark, "query-terms"))
    wanted = member_filter(terms.select(F.xxhash64("term").alias("hash")).distinct())
    index = build_index(docs, work_dir(spark, "index"), wanted)
    return search(index, terms, k).select("item_id", "rank", "doc_id", "score")
