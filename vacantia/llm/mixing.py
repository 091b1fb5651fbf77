"""Mix sources to target weights by weighted sampling without replacement.

Every document gets an exponential key scaled by its quality weight (Efraimidis and Spirakis); the
smallest keys of a source come first. A source gives whole epochs while its target holds them, and then
the documents of smallest key up to the words that are left. Where the cut lies is found from sums of
words in ranges of keys; only the one range that holds the cut is sorted. The cut of each source is
all that a row needs to know, so texts are not shuffled. Of equal rows that the cut falls among, as many are
taken as fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.registry import stored
from vacantia.session import work_dir

#: Most sources whose targets are found on the driver and sent to every task; with more, all of it is joins.
SOURCES = 100_000
#: Parts in which equal rows are counted.
PARTS = 64
#: Ranges of keys that the words of a source are summed in.
RANGES = 4_096
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Number of words; none in a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prose_weight(text: str = "text", size: str = "size") -> Column:
    """A quality weight from the mean length of a word: prose has 3 to 12 characters and a space."""
    mean = F.length(F.col(text)) / F.greatest(F.col(size), F.lit(1))
    return F.when(mean.between(3, 13), 1.0).otherwise(0.25)


@dataclass
class Shares:
    """Targets of the sources that have any words to give."""

    weights: list[float]
    sizes: list[int]
    most: float

    def targets(self) -> list[float]:
        """Shares of all words by weight, none above ``most`` times its source; the excess is shared again."""
        left, given = set(range(len(self.sizes))), [0.0] * len(self.sizes)
        rest = float(sum(self.sizes))
        while left:
            total = sum(self.weights[i] for i in sorted(left))
            over = {i for i in left if rest * self.weights[i] / total > self.most * self.sizes[i]}
            for i in sorted(over or left):
                given[i] = self.most * self.sizes[i] if over else rest * self.weights[i] / total
            if not over:
                break
            rest -= sum(given[i] for i in sorted(over))
            left -= over
        return given


def _rows(spark, **columns) -> DataFrame:
    """A table of columns, each with its type, that the driver holds. Made of Arrow it is part of the plan; a list of
    rows would start Python workers of another kind on the executors, which stay beside those of the operators."""
    return spark.createDataFrame(pa.table([pa.array(*c) for c in columns.values()], names=list(columns)))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place by code point, null last, however many there are: ranges are counted, then numbered."""
    spark, last = sources.sparkSession, F.col("source").isNull()
    dealt = sources.repartitionByRange(last, "source").withColumn("__range", F.spark_partition_id())
    dealt = stored(dealt, work_dir(spark, "sources"))
    counts = dealt.groupBy("__range").count().orderBy("__range").collect()  # one row a partition
    befores, before = [], 0
    for row in counts:
        befores.append(before)
        before += row["count"]
    offsets = _rows(spark, __range=([row["__range"] for row in counts], pa.int32()), before=(befores, pa.int64()))
    offsets = F.broadcast(offsets)
    place = F.row_number().over(Window.partitionBy("__range").orderBy(last, "source")) - 1
    return dealt.join(offsets, "__range").select("source", "size", (F.col("before") + place).alias("place"))


def _many_targets(totals: DataFrame, weights: list[float], most: float) -> DataFrame:
    """:class:`Shares` for any number of sources: a round of sums for each time that some are at their most."""
    spark, given = totals.sparkSession, F.array(*(F.lit(float(w)) for w in weights))
    rows = _numbered(totals).withColumn("weight", F.element_at(given, (F.col("place") % len(weights) + 1).cast("int")))
    rows = stored(rows.withColumn("target", F.lit(None).cast("double")), work_dir(spark, "targets"))
    while True:
        open_, full = F.col("target").isNull(), F.lit(float(most)) * F.col("size")
        sums = rows.agg(
            F.sum("size").alias("all"), F.sum("target").alias("given"), F.sum(F.when(open_, F.col("weight"))).alias("weight")
        ).first()
        if sums["weight"] is None:
            return rows
        share = (sums["all"] - (sums["given"] or 0.0)) / sums["weight"] * F.col("weight")
        if rows.where(open_ & (share > full)).isEmpty():
            return rows.withColumn("target", F.coalesce("target", share))
        rows = stored(rows.withColumn("target", F.when(open_ & (share > full), full).otherwise(F.col("target"))), work_dir(spark, "targets"))


def _plan(docs: DataFrame, weights: list[float], most: float) -> tuple[DataFrame, bool]:
    """``source, target, source_size, epochs, budget`` of every source, and whether they are few."""
    spark = docs.sparkSession
    sums = stored(docs.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")), work_dir(spark, "totals"))
    few = sums.count() <= SOURCES
    if few:
        totals = sorted(sums.collect(), key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
        sizes = [r["size"] for r in totals]
        shares = Shares([float(weights[i % len(weights)]) for i in range(len(sizes))], sizes, most).targets()
        names = [r["source"] for r in totals]
        plan = _rows(spark, source=(names, pa.string()), target=(shares, pa.float64()), source_size=(sizes, pa.int64()))
    else:
        plan = _many_targets(sums, weights, most).select("source", "target", F.col("size").alias("source_size"))
    size = F.col("source_size")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    plan = plan.withColumn("epochs", epochs)
    return plan.withColumn("budget", F.col("target") - F.col("epochs") * size), few


def _beside(left: DataFrame, right: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Rows with that of their source, ``of``; sources are broadcast if they are few."""
    return left.join(F.broadcast(right) if few else right, left["source"].eqNullSafe(right["of"]), how)


def cuts(docs: DataFrame, weights: list[float], most: float = 3.0, seed: int = 0) -> tuple[DataFrame, bool]:
    """For each source its target and where the part of an epoch ends; and whether sources are few.

    ``docs`` has ``mark`` (a hash of the row), ``source``, ``size`` and ``weight``. Sources are weighed in order of
    their names by code point, null last, by ``weights`` repeated. One row per source; ``cut`` has the last key
    taken, how many equal rows have it and how many of these are taken.
    """
    plan, few = _plan(docs, weights, most)
    plan = stored(plan, work_dir(docs.sparkSession, "plan"))
    mean = F.greatest(F.lit(1e-300), F.lit(docs.agg(F.avg("weight")).first()[0] or 1.0))
    keyed = docs.groupBy("mark", "source", "size", "weight").agg(F.count(F.lit(1)).alias("n"))
    keyed = keyed.withColumns({"key": sample_key(seed, *map(F.col, ("mark", "size", "weight"))), "words": F.col("size") * F.col("n")})
    # keys spread like waiting times of rate 1 over the mean weight; this makes the ranges about even
    part = F.least(F.lit(RANGES - 1), F.floor((1 - F.exp(-F.col("key") * mean)) * RANGES)).cast("int")
    keyed = keyed.withColumn("part", part)
    sums = keyed.groupBy("source", "part").agg(F.sum("words").alias("words"))
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("part"))  # at most RANGES rows each
    budget = plan.select(F.col("source").alias("of"), "budget")
    known = _beside(sums.withColumn("sum", so_far), budget, few).drop("of")
    cross = (
        known.where(F.col("sum") > F.col("budget"))
        .groupBy(F.col("source").alias("of"))
        .agg(F.min(F.struct("part", (F.col("sum") - F.col("words")).alias("before"), "budget")).alias("cross"))
    )
    # only the range that holds the cut is sorted; its first row begins within the budget
    own = _beside(keyed, cross, few).where(F.col("part") == F.col("cross.part"))
    order = Window.partitionBy("source", "part").orderBy("key", "mark", "size", "weight")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    left = F.col("cross.budget") - F.col("cross.before") - before
    # of equal rows so many that the words come nearest to the budget; half a row counts as one
    fit = F.when(F.col("size") > 0, F.floor(left / F.col("size") + 0.5)).otherwise(F.col("n"))
    fit = F.least(F.col("n"), F.greatest(F.lit(0), fit)).cast("long")
    last = own.withColumns({"fit": fit, "left": left}).where("left >= 0").groupBy(F.col("source").alias("of")).agg(
        F.max(F.struct("key", "mark", "size", "n", "fit")).alias("cut")
    )
    found = _beside(plan, last, few, "left")
    return found.select("source", "target", "source_size", "epochs", "cut"), few


def sample_key(seed: int, doc_id: Column, size: Column, weight: Column) -> Column:
    """An exponential waiting time of rate ``weight``, from a hash of the row: reruns agree."""
    bits = F.xxhash64(F.lit(seed), doc_id, size).bitwiseAND(F.lit((1 << 53) - 1))
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.greatest(weight, F.lit(1e-9))


def mix(
    docs: DataFrame, weights: list[float], doc_id: str = "doc_id", text: str = "text", source: str = "source",
    quality: Column | None = None, most: float = 3.0, seed: int = 0,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``epochs`` and ``taken`` (words the mix takes) to all rows.

    The mix has as many words as the table. A null text has no words; a null source is a source; a row may lack an
    id. Rows that are equal in all columns draw one key; of those that the cut falls among, as many
    are taken as fit. ``quality`` is a positive weight, null counts as 1; by default ``prose_weight``. Columns
    of these names are replaced, others kept; they must be of types that can be grouped. An empty table stays empty.
    """
    own = {c: F.col(c) for c in docs.columns if c not in ("size", "source_size", "target", "epochs", "taken")}
    rows = docs.select(*own.values()).withColumn("size", words(text))
    weight = F.coalesce(prose_weight(text) if quality is None else quality, F.lit(1.0)).cast("double")
    mark = F.xxhash64(F.col(doc_id).cast("string"), *own.values(), *(c.isNull() for c in own.values()))
    rows = rows.withColumns({"__source": F.col(source).cast("string"), "__weight": weight, "__mark": mark})
    small = rows.select(*(F.col(f"__{c}").alias(c) for c in ("mark", "source", "weight")), "size")
    small = stored(small, work_dir(docs.sparkSession, "mix"))  # words are counted once for all statistics
    found, few = cuts(small, weights, most, seed)
    found = stored(found.withColumnRenamed("source", "of"), work_dir(docs.sparkSession, "cuts")).select(F.struct("*").alias("__cut"))
    rows = rows.join(F.broadcast(found) if few else found, F.col("__source").eqNullSafe(F.col("__cut.of")))
    key = F.struct(sample_key(seed, F.col("__mark"), F.col("size"), F.col("__weight")).alias("key"), F.col("__mark").alias("mark"), "size")
    end = F.struct(*(F.col(f"__cut.cut.{c}").alias(c) for c in ("key", "mark", "size")))
    there = F.col("__cut.cut").isNotNull()
    rows = rows.withColumns({"__taken": F.coalesce(key < end, F.lit(False)) & there, "__last": F.coalesce(key == end, F.lit(False)) & there})
    fit, n = F.col("__cut.cut.fit"), F.col("__cut.cut.n")
    rows = rows.withColumn("__taken", F.col("__taken") | (F.col("__last") & (fit == n)))

    def shown(rows):
        times = F.col("__cut.epochs") + F.col("__taken").cast("long")
        return rows.select(
            *own, "size", F.col("__cut.source_size").alias("source_size"), F.col("__cut.target").alias("target"),
            F.col("__cut.epochs").alias("epochs"), (times * F.col("size")).alias("taken"), times.alias("__times"),
        ).withColumnRenamed("__times", "times")

    if found.where("__cut.cut.fit > 0 AND __cut.cut.fit < __cut.cut.n").isEmpty():
        return shown(rows)
    # equal rows are alike, so they are counted in parts, and each part says how many of it are taken
    divided = F.col("__last") & (fit > 0) & (fit < n)
    group = [c for c in rows.columns if c not in ("__taken", "__last")]
    parts = rows.where(divided).withColumn("__part", F.spark_partition_id() % PARTS)
    parts = parts.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    so_far = F.sum("__n").over(Window.partitionBy("__source", "__mark").orderBy("__part")) - F.col("__n")  # at most PARTS rows
    parts = parts.withColumn("__fit", F.col("__cut.cut.fit") - so_far)
    again = parts.withColumn("__no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    again = again.withColumn("__taken", F.col("__no") <= F.col("__fit"))
    return shown(rows.where(~divided)).union(shown(again))
