"""Quality classifier by importance resampling.

Words and marks of a text, and pairs of neighbours, are hashed to ``BUCKETS``. One generative model
counts them in labelled target documents, another in all documents. The log ratio of the two, summed
over a text, is its log importance weight. A sum grows with the text, so texts are compared at one
length, ``LENGTH`` n-grams, at their own mean. With a standard Gumbel draw added, the k largest keys are a
sample without replacement in proportion to these weights. k is the number of documents whose weight
reaches a cut, so what is unlike the target is rejected. The cut is the one with the fewest errors on
labelled documents, good and bad, that the model has not counted, as it favours those that it has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.registry import map_batches, releasing, stored
from vacantia.session import work_dir

BUCKETS = 1 << 16
#: Most labelled documents that are used, chosen by a hash of the id: three in four for the target model, one for the cut.
SAMPLE = 20_000
#: Share of the other labelled target documents that must reach the cut where none of them is bad, and else.
REACH, FLOOR = 0.998, 0.99
#: N-grams of the text that a weight is compared at, and neutral ones that each text is given, as few tell little.
LENGTH, NEUTRAL = 1_000, 50
#: Most keys that are sorted on the driver to find the k-th.
FEW = 10_000
#: Most words that a worker remembers, and n-grams that it holds before it counts them.
MEMO, HELD = 120_000, 500_000

_PARTS = re.compile(r"\w+|[^\w\s]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def ngrams(text: str) -> np.ndarray:
    """Buckets of all words, marks and pairs of them."""
    parts = _PARTS.findall(text)
    one = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    two = one[:-1] * _ODD + one[1:]
    two ^= two >> np.uint64(29)
    return (np.concatenate([one, two]) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    """Log ratio of target to raw probability by bucket, and the weight at ``LENGTH`` that a document must reach."""

    ratio: np.ndarray
    cut: float = 0.0

    def weights(self, text: str | None) -> tuple[float, float] | tuple[None, None]:
        """Log importance weight of a text, and what it would be at its mean for ``LENGTH`` n-grams."""
        found = ngrams(text) if text else ()
        if not len(found):
            return None, None
        total = float(self.ratio[found].sum())
        return total, LENGTH * total / (len(found) + NEUTRAL)

    def weight(self, text: str | None) -> float | None:
        return self.weights(text)[1]


def _sampled(labels: DataFrame, doc_id: str, quality: str) -> DataFrame:
    one = labels.where(F.col(doc_id).isNotNull() & F.col(quality).isNotNull())
    one = one.groupBy(F.col(doc_id).alias("label_of")).agg(F.max(quality).alias("good"))
    few = one.orderBy(F.xxhash64("label_of"), "label_of").limit(SAMPLE)
    return few.withColumn("counted", F.xxhash64("label_of", F.lit(1)) % 4 != 0)


def _counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of target documents and of all; ``rows`` has ``text, good``."""

    def tally(counts, held) -> int:
        for kind, found in enumerate(held):
            if found:
                counts[kind] += np.bincount(np.concatenate(found), minlength=BUCKETS)
                found.clear()
        return 0

    def count(batches):
        counts, held, waiting = np.zeros((2, BUCKETS), np.int64), ([], []), 0
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1)):
                found = ngrams(text.as_py() or "")
                held[1].append(found)
                if good.as_py() == 1:
                    held[0].append(found)
                waiting += len(found)
                if waiting > HELD:
                    waiting = tally(counts, held)
        tally(counts, held)
        _WORDS.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([c.tobytes() for c in counts], pa.binary())], names=["kind", "counts"]
        )

    def add(key, parts):
        total = np.zeros(BUCKETS, np.int64)
        for counts in parts["counts"]:
            total += np.frombuffer(counts.as_py(), np.int64)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["kind", "counts"])

    # each task's counts are of fixed length; they are summed in a few groups first
    parts = rows.select("text", "good").mapInArrow(releasing(count), "kind int, counts binary")
    parts = parts.withColumn("kind", F.col("kind") + 2 * (F.spark_partition_id() % 16))
    sums = parts.groupBy("kind").applyInArrow(add, "kind int, counts binary").collect()  # at most 32 rows
    of = lambda k: sum((np.frombuffer(r["counts"], np.int64) for r in sums if r["kind"] % 2 == k), np.zeros(BUCKETS, np.int64))
    return of(0), of(1)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Model:
    """Models of target (label 1) and of all documents, and the cut.

    Labels without id or value are ignored; of labels that repeat an id the largest counts. At most
    ``SAMPLE`` labels are used, the raw model counts every document. Without labels nothing is cut off.
    """
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    sample = _sampled(labels, doc_id, quality)
    counted = F.broadcast(sample.where("counted"))  # at most SAMPLE rows, as are the others
    others = F.broadcast(sample.where("NOT counted"))
    target, raw = _counts(own.join(counted, own["id"] == counted["label_of"], "left"))
    log = lambda c: np.log((c + 1) / (c.sum() + BUCKETS))
    model = Model(log(target) - log(raw))
    labelled = _weighed(own.join(others, own["id"] == others["label_of"]), model, "text")
    one = labelled.where("__even IS NOT NULL").groupBy("label_of").agg(F.min("__even").alias("__even"), F.max("good").alias("good"))
    rows = one.select("__even", "good").collect()  # one of the rows that repeat an id, so at most SAMPLE
    of = lambda good: np.sort([r["__even"] for r in rows if (r["good"] == 1) == good])
    model.cut = _cut(of(True), of(False))
    return model


def _cut(good: np.ndarray, bad: np.ndarray) -> float:
    """Of the weights of good documents that ``FLOOR`` of them reach, the lowest with the fewest errors. Both are sorted."""
    if not len(good):
        return float("-inf")
    if not len(bad):
        return float(good[int((1 - REACH) * len(good))])
    lost = np.arange(int((1 - FLOOR) * len(good)) + 1)
    kept = len(bad) - np.searchsorted(bad, good[lost])
    return float(good[np.argmin(lost + kept)])


def _weighed(docs: DataFrame, model: Model, text: str, keep: list[str] | None = None) -> DataFrame:
    """With ``weight``, and ``__even``, the same at one length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def start():
        def work(texts):
            both = [shared.value.weights(t.as_py()) for t in texts]
            return [pa.array([b[at] for b in both], pa.float64()) for at in (0, 1)]

        return work, _WORDS.clear  # the worker outlives the task

    return map_batches(docs, [text], {"weight": T.DoubleType(), "__even": T.DoubleType()}, start, keep)


def kth_largest(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest of a column without nulls, exactly: a range around it is narrowed until few are left."""
    low, high, above = float("-inf"), float("inf"), 0
    while True:
        inside = rows.where((F.col(key) >= low) & (F.col(key) <= high))
        n, least, most = inside.agg(F.count("*"), F.min(key), F.max(key)).first()
        if n <= FEW or least == most:
            values = sorted((r[0] for r in inside.select(key).limit(FEW).collect()), reverse=True)
            return values[min(k - above, len(values)) - 1]
        share = 1 - (k - above) / n
        near = [max(0.0, share - 0.01), min(1.0, share + 0.01)]
        low_, high_ = inside.agg(F.percentile_approx(key, near, 10_000)).first()[0]
        over = inside.where(F.col(key) > high_).count()
        within = inside.where((F.col(key) >= low_) & (F.col(key) <= high_)).count()
        if over < k - above <= over + within and within < n:
            low, high, above = low_, high_, above + over
        else:  # many equal keys at a border: halve the range instead
            middle = (least + most) / 2
            over = inside.where(F.col(key) > middle).count()
            low, high, above = (middle, most, above) if over >= k - above else (least, middle, above + over)
            low = float(np.nextafter(low, np.inf)) if low == middle else low


def resample(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, seed: int = 0
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``weight``, ``key`` and ``kept``, true for the k largest keys.

    ``weight`` is the log importance weight; ``key`` is drawn from what it would be for ``LENGTH`` n-grams.
    A text without words or marks, or null, has no weight and is not kept. Equal keys at the border stay together, so repeated rows do. Columns of these names
    are replaced; an empty table stays empty.
    """
    spark = docs.sparkSession
    bits = F.xxhash64(F.lit(seed), F.col(doc_id)).bitwiseAND(F.lit((1 << 53) - 1))
    gumbel = -F.ln(-F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))))
    own = [c for c in (docs.columns if keep is None else keep) if c not in ("weight", "key", "kept")]
    rows = _weighed(docs.withColumn("__gumbel", gumbel), model, text, [*own, "__gumbel"])
    rows = rows.select(*own, "weight", (F.col("__even") + F.col("__gumbel")).alias("key"), "__even")
    rows = stored(rows, work_dir(spark, "resample"))
    k = rows.where(F.col("__even") >= model.cut).count()
    rows = rows.drop("__even")
    least = kth_largest(rows.where("key IS NOT NULL"), "key", k) if k else float("inf")
    return rows.withColumn("kept", F.coalesce(F.col("key") >= least, F.lit(False)))
