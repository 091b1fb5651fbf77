"""I-Match fingerprints with randomised lexicons.

The lexicon is a band of inverse document frequency: terms in too many texts say nothing, terms in too
few do not survive an edit. Frequencies are counted for ``BUCKETS`` hashed terms, so the lexicon is a
bit map of fixed length however many terms there are. Of each text the distinct terms in the lexicon
are sorted and hashed, once as a whole and once for each of several random parts of the lexicon. The
parts are nested: a quarter of the lexicon, then sixteenths, and so on; the share of parts in which two
texts agree tells how alike they are, as a small part is still equal after an edit. Everything is
built of SQL functions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashed terms that document frequencies are counted for.
BUCKETS = 1 << 20
#: The band: document frequency from so many of a million texts, 2 at least, to so large a share of all.
RARE_PER_MILLION, FREQUENT = 100, 0.1
#: A text with fewer terms in the lexicon is hashed with all of its terms.
FEW_TERMS = 8
#: Random orders of the lexicon. Each is cut into 1,024 slices; a level has so many parts of so many slices.
SEEDS, SLICES, LEVELS = 2, 1_024, ((1, 256), (4, 64), (8, 16), (8, 4), (8, 1))
#: Texts in one range of neighbours, and most ranges.
RANGE, RANGES = 1_024, 4_096


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case terms, in order."""
    parts = F.filter(F.split(F.lower(text), r"[\s\p{Punct}]+"), lambda t: t != "")
    return F.sort_array(F.array_distinct(F.transform(parts, lambda t: F.xxhash64(t))))


def _literal(values: list[int]) -> Column:
    """A constant array, folded once."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def lexicon(docs: DataFrame, text: str = "text") -> list[int]:
    """The band as a bit map of BUCKETS bits in 64-bit words, from all texts."""
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bucket = F.transform(terms(own), lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)))
    counts = docs.select(F.explode(bucket).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("texts"))
    total = docs.count()
    band = F.col("texts").between(max(2, total * RARE_PER_MILLION // 1_000_000), max(2, int(total * FREQUENT)))
    bits = counts.where(band).selectExpr("cast(bucket div 64 as int) AS word", "shiftleft(1L, cast(bucket % 64 as int)) AS bit")
    words = [0] * (BUCKETS // 64)
    for row in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most BUCKETS / 64 rows
        words[row["word"]] = row["bits"]
    return words


def fingerprint(df: DataFrame, words: list[int], text: str, name: str) -> DataFrame:
    """Add ``name``: a struct of ``whole``, the hash of all lexicon terms, and ``parts``, 0 where a part has none.

    Null texts count as empty. Equal texts have equal fingerprints; so have texts of equal term sets.
    """
    bits = _literal(words)

    def known(h):
        word = F.get(bits, F.shiftrightunsigned(h.bitwiseAND(F.lit(BUCKETS - 1)), 6).cast("int"))
        return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    found = df.withColumn("__all", terms(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    found = found.withColumn("__known", F.filter("__all", known))
    found = found.withColumn("__terms", F.when(F.size("__known") < FEW_TERMS, F.col("__all")).otherwise(F.col("__known")))
    names, above = [], None
    for level, (count, width) in enumerate(LEVELS):
        parts = {}
        for seed in range(SEEDS):
            for at in range(count):
                inside = f"__{level - 1}_{seed}_{at * width // above}" if level else "__terms"
                parts[f"__{level}_{seed}_{at}"] = F.filter(inside, _slice(seed, at * width, (at + 1) * width))
        found, above, names = found.withColumns(parts), width, [*names, *parts]
    low = F.lit(0xFFFFFFFF)
    parts = F.array(*(F.when(F.size(n) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(n).bitwiseAND(low)) for n in names))
    found = found.withColumn(name, F.struct(F.xxhash64("__terms").alias("whole"), parts.alias("parts")))
    return found.drop("__all", "__known", "__terms", *names)


def _slice(seed: int, begin: int, end: int):
    at = lambda h: F.shiftrightunsigned(h, 20 + 10 * seed).bitwiseAND(F.lit(SLICES - 1))
    return lambda h: (at(h) >= begin) & (at(h) < end)


def readable(name: str) -> Column:
    """The fingerprint as text: the whole hash, then the parts, in hexadecimal."""
    parts = F.array_join(F.transform(F.col(f"{name}.parts"), lambda p: F.lower(F.hex(p))), ".")
    return F.concat_ws(":", F.lower(F.hex(F.col(f"{name}.whole"))), parts)


def likeness(one: str, other: str) -> Column:
    """Share of lexicon parts that agree, of those in which either text has a term; 1 for equal fingerprints."""
    both = F.zip_with(F.col(f"{one}.parts"), F.col(f"{other}.parts"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    told = F.size(F.filter(both, lambda p: (p["a"] != 0) | (p["b"] != 0)))
    same = F.size(F.filter(both, lambda p: (p["a"] != 0) & (p["a"] == p["b"])))
    share = F.when(told == 0, 0.0).otherwise(same / told)
    return F.when(F.col(one) == F.col(other), 1.0).otherwise(share)


def with_next(df: DataFrame, doc_id: str, columns: list[str], name: str = "next") -> DataFrame:
    """Add ``name``: ``columns`` of the next row by descending ``doc_id``; after the last comes the first.

    Rows are dealt to ranges of ids. The largest row of a range is dealt to the one above too, and the
    largest of all to the lowest, so every row meets its neighbour within its range, in one shuffle.
    Rows of one id are ordered by a hash of their columns, rows without an id come last.
    """
    total = df.count()
    ranges = max(1, min(RANGES, total // RANGE))
    shares = [i / ranges for i in range(1, ranges)]
    wanted = [F.max(doc_id).alias("most")]
    if shares:
        wanted.append(F.percentile_approx(doc_id, shares, 100 * ranges).alias("bounds"))
    found = df.agg(*wanted).first()
    most = found["most"]
    bounds = sorted(set((found["bounds"] if shares else None) or []) - {most})
    # two steps of a search: which run of bounds, then which of the run
    run = max(1, round(len(bounds) ** 0.5))
    runs = [bounds[i : i + run] for i in range(0, len(bounds), run)] or [[]]
    before = lambda array: F.size(F.filter(array, lambda b: b < F.col(doc_id)))
    at = before(_literal([r[-1] for r in runs if r]))
    nested = F.from_json(F.lit(json.dumps([*runs, []])), "array<array<bigint>>")
    own = (F.least(at * run, F.lit(len(bounds))) + before(F.get(nested, at))).cast("int")
    rows = df.withColumn("__range", own)
    copies = [F.struct(F.col("__range").alias("range"), F.lit(False).alias("copy"))]
    border = F.get(_literal(bounds), F.col("__range")) == F.col(doc_id)
    copies.append(F.when(border, F.struct((F.col("__range") + 1).alias("range"), F.lit(True).alias("copy"))))
    if most is not None:
        copies.append(F.when(F.col(doc_id) == most, F.struct(F.lit(0).alias("range"), F.lit(True).alias("copy"))))
    rows = rows.withColumn("__at", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull()))).drop("__range")
    order = Window.partitionBy("__at.range").orderBy(F.desc("__at.copy"), F.asc_nulls_first(doc_id), F.xxhash64(*columns))
    rows = rows.withColumn(name, F.lag(F.struct(*columns)).over(order))
    return rows.where(~F.col("__at.copy")).drop("__at")
