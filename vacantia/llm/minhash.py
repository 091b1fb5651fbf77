"""Near-duplicates by an inverted join of MinHash coordinates, confirmed on full shingle sets.

1. Each text becomes a set of hashed five-word shingles, a digest of the set, and a signature of
   ``COORDS`` minima. Texts with equal sets form one node and are compared once.
2. A pair at a threshold of 85 % agrees in about 85 of 100 coordinates; ``agreeing`` lies over four standard
   deviations lower. If a node's coordinate-value pairs are ordered from rare to frequent, two nodes
   that agree in so many places share one of their first ``COORDS - agreeing + 1``; only these prefixes
   are posted, so values of passages that many texts share are mostly skipped. How frequent a value is
   comes from counts over the whole corpus in a table of fixed size; any order gives the same pairs.
3. Each posting list of at least two nodes counts the coordinates in which its members agree. Long lists are cut
   into blocks, and each pair of blocks is a group of its own. A group returns no pairs, but a forest
   that holds together what agrees, and a task the stars of its forests; so a group of n near copies costs n - 1 rows.
4. The components of the forests hold every link. Full sets are computed again for their members only,
   and each component is searched for links by counting common shingles in its inverted lists; again
   large ones are cut into blocks, and again a forest comes out, now of confirmed links.
5. The components of those are the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.components import components, stars
from vacantia.llm.registry import map_batches, releasing, stored
from vacantia.session import work_dir

WORDS = 5
COORDS = 128
#: A link needs 100 * intersection >= percent * union; this is the percent of op8.
PERCENT = 85
#: Most that the chance to miss a pair at the threshold may be: 90 coordinates at 85 %.
MISS = 1e-5
#: Counters of coordinate values, and pieces they are summed in.
COUNTERS, PIECES = 1 << 20, 256
#: Bits of a filter of members for each of them, most bits of all, and most members; more are joined instead.
MEMBER_BITS, FILTER_BITS, FILTER_MEMBERS = 32, 1 << 27, 1 << 24
#: Most rows of ids, 24 bytes each, that are sent to every task.
SENT_ROWS = 1 << 18
#: Members of a posting list, and shingles of a component, in one block.
BLOCK, BLOCK_SHINGLES = 1_024, 1_000_000
#: Pairs of a task that are put together as stars.
HELD_PAIRS = 50_000
#: Most words that a worker remembers.
MEMO = 150_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xFF51AFD7ED558CCD)


def agreeing(percent: int) -> int:
    """Most coordinates that a pair at ``percent`` agrees in but for a chance of ``MISS``."""
    chance, at = 0.0, 0
    while True:
        chance += math.comb(COORDS, at) * (percent / 100) ** at * (1 - percent / 100) ** (COORDS - at)
        if chance > MISS or at == COORDS:
            return at
        at += 1


def _coefficients():
    rng = np.random.default_rng(20_240_501)
    multiply = rng.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return multiply, rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def _mixed(x):
    x = x ^ (x >> np.uint64(33))
    x = x * _STEP
    return x ^ (x >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, in order: A-Z lower-cased, words between ASCII white space."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    mixed = np.zeros(len(parts) - width + 1, np.uint64)
    for at in range(width):
        mixed = mixed * _ODD + hashes[at : at + len(mixed)]
    return np.unique(_mixed(mixed + np.uint64(width)))


def signature(own: np.ndarray) -> np.ndarray:
    multiply, add = _coefficients()
    high, least = own >> np.uint64(32), np.full(COORDS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(high), 256):
        least = np.minimum(least, ((high[at : at + 256, None] * multiply + add) >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint32)


def _digest(own: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh128_digest(own.tobytes())


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _sketches(docs: DataFrame, words: int) -> DataFrame:
    names = [("id", pa.int64()), ("size", pa.int64()), ("node", pa.binary()), ("coords", pa.binary()), ("mark", pa.int64())]
    schema = pa.schema(names)

    def sketch(batches):
        for batch in batches:
            sizes, nodes, coords = [], [], []
            for text in batch.column(1):
                own = shingles(text.as_py(), words)
                sizes.append(len(own))
                nodes.append(_digest(own) if len(own) else None)
                coords.append(signature(own).tobytes() if len(own) else None)
            yield _batch(schema, (batch.column(0), sizes, nodes, coords, batch.column(2)))
        _WORDS.clear()  # the worker outlives the task

    return docs.mapInArrow(releasing(sketch), "id long, size long, node binary, coords binary, mark long")


def _values(coords: pa.Array) -> np.ndarray:
    """Coordinate-value pairs as numbers, a row for each signature."""
    flat = np.frombuffer(b"".join(coords.to_pylist()), np.uint32).reshape(-1, COORDS)
    return (np.arange(COORDS, dtype=np.uint64) << np.uint64(32)) | flat


def _counter(values: np.ndarray) -> np.ndarray:
    return (_mixed(values * _ODD) % np.uint64(COUNTERS)).astype(np.int64)


def _frequencies(nodes: DataFrame) -> np.ndarray:
    """How many nodes have a value, summed over values that share a counter. Always COUNTERS numbers."""
    width = COUNTERS // PIECES

    def count(batches):
        counts = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            counts += np.bincount(_counter(_values(batch.column(0))).ravel(), minlength=COUNTERS).astype(np.int32)
        pieces = counts.reshape(PIECES, width)
        some = np.flatnonzero(pieces.any(axis=1))
        names = ["piece", "counts"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([pieces[i].tobytes() for i in some], pa.binary())], names=names
        )

    def add(key, parts):
        total = np.zeros(width, np.int64)
        for counts in parts["counts"]:
            total += np.frombuffer(counts.as_py(), np.int32)
        arrays = [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())]
        return pa.table(arrays, names=["piece", "counts"])

    parts = nodes.select("coords").mapInArrow(releasing(count), "piece int, counts binary")
    sums = parts.groupBy("piece").applyInArrow(add, "piece int, counts binary")
    total = np.zeros((PIECES, width), np.int64)
    for row in sums.collect():  # PIECES rows of fixed length
        total[row["piece"]] = np.frombuffer(row["counts"], np.int64)
    return total.ravel()


def _postings(nodes: DataFrame, percent: int) -> DataFrame:
    """The rarest COORDS - agreeing + 1 coordinate values of every node."""
    frequencies = nodes.sparkSession.sparkContext.broadcast(_frequencies(nodes))
    prefix = COORDS - agreeing(percent) + 1
    schema = pa.schema([("value", pa.int64()), ("node", pa.binary())])

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _values(batch.column(1))
            order = np.lexsort((values, frequencies.value[_counter(values)]), axis=1)[:, :prefix]
            kept = np.take_along_axis(values, order, axis=1).astype(np.int64)
            yield _batch(schema, (kept.ravel(), batch.column(0).take(pa.array(np.repeat(np.arange(len(kept)), prefix)))))

    return nodes.select("node", "coords").mapInArrow(releasing(post), "value long, node binary")


def _in_blocks(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Rows of a key in ``blocks`` blocks; each pair of blocks is a group: ``key, one, two``."""
    last = F.col("__blocks") - 1
    own = F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int")
    rows = rows.withColumn("__blocks", blocks.cast("int")).withColumn("__own", own)
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), last)))
    return rows.withColumns(
        {"one": F.least("__own", "__other"), "two": F.greatest("__own", "__other")}
    ).drop("__blocks", "__own", "__other")


def _by_group(batches, width: int):
    """Rows that agree in the first ``width`` columns, over batches that are sorted by them."""
    held, at = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i) for i in range(width)]
        table = np.ones(batch.num_rows, bool)
        table[1:] = False
        for key in keys:
            codes = key.dictionary_encode().indices.to_numpy()
            table[1:] |= codes[1:] != codes[:-1]
        starts = np.append(np.flatnonzero(table), batch.num_rows)
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            now = tuple(k[begin].as_py() for k in keys)
            if held and now != at:
                yield held
                held = []
            at = now
            held.append(batch.slice(begin, end - begin))
    if held:
        yield held


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _agreeing(tags: np.ndarray, sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest over rows that agree in enough coordinates and whose sizes allow a link."""
    left, found, enough = np.arange(len(tags)), [], agreeing(percent)
    while len(left) > 1:  # a component at a time, each row compared with those not reached yet
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            agree = (tags[left] == tags[at]).sum(axis=1) >= enough
            small, large = np.minimum(sizes[left], sizes[at]), np.maximum(sizes[left], sizes[at])
            near = agree & (100 * small >= percent * large)
            found += [(at, other) for other in left[near].tolist()]
            queue += left[near].tolist()
            left = left[~near]
    return found


def _candidates(nodes: DataFrame, percent: int, folder: str) -> DataFrame:
    """A forest of nodes that may be linked: ``a, b``."""
    postings = stored(_postings(nodes, percent), f"{folder}/postings")
    shared = postings.groupBy(F.col("value").alias("of")).agg(F.count("*").alias("members")).where("members > 1")
    lists = postings.join(shared, postings["value"] == shared["of"]).select("value", "node", "members")
    tag = nodes.select(F.col("node").alias("own"), "size", "tag")
    rows = lists.join(tag, lists["node"] == tag["own"]).drop("own")
    rows = _in_blocks(rows, "value", F.ceil(F.col("members") / BLOCK))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def collide(batches):
        pairs = []
        for parts in _by_group(batches, 3):
            group = pa.Table.from_batches(parts)
            if group.num_rows < 2:
                continue
            own = group["node"].to_pylist()
            tags = np.frombuffer(b"".join(group["tag"].to_pylist()), np.uint8).reshape(-1, COORDS)
            pairs += ((own[i], own[j]) for i, j in _agreeing(tags, group["size"].to_numpy(), percent))
            if len(pairs) >= HELD_PAIRS:  # what many values say of the same nodes leaves the task once
                yield _batch(schema, stars(*(pa.array(side, pa.binary()) for side in zip(*pairs))))
                pairs = []
        if pairs:
            yield _batch(schema, stars(*(pa.array(side, pa.binary()) for side in zip(*pairs))))

    keys = ["value", "one", "two"]
    rows = rows.select(*keys, "node", "size", "tag").repartition(*keys).sortWithinPartitions(*keys, "node")
    return rows.mapInArrow(releasing(collide), "a binary, b binary")


def _linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of links between sets, found by counting common shingles in inverted lists."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * common >= percent * (sizes.sum() - common) else []
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.append(0, np.cumsum(sizes))
    order = np.argsort(term, kind="stable")
    posted, starts = owner[order], np.append(0, np.cumsum(np.bincount(term)))
    unseen, left, found = np.ones(len(sets), bool), len(sets), []
    for begin in range(len(sets)):
        if not unseen[begin]:
            continue
        unseen[begin], left, queue = False, left - 1, [begin]
        while queue and left:
            at = queue.pop()
            terms = term[ends[at] : ends[at + 1]]
            lengths = starts[terms + 1] - starts[terms]
            places = np.repeat(starts[terms + 1] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
            common = np.bincount(posted[places], minlength=len(sets))
            near = np.flatnonzero(unseen & (100 * common >= percent * (sizes + sizes[at] - common)))
            unseen[near] = False
            left -= len(near)
            found += [(at, other) for other in near.tolist()]
            queue += near.tolist()
    return found


class MemberFilter:
    """Bits of hashed members in 64-bit words: 16 MB at most, whatever the corpus."""

    def __init__(self, words: np.ndarray):
        self.words, self.last = words, np.uint64(64 * len(words) - 1)

    def may_hold(self, hashes: pa.Array) -> np.ndarray:
        at = hashes.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) & self.last
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def member_filter(members: DataFrame):
    """A broadcast filter of the column ``hash``, sized by how many rows there are; None for too many."""
    count = members.count()
    if count > FILTER_MEMBERS:
        return None
    size = min(FILTER_BITS, 1 << max(16, (MEMBER_BITS * count - 1).bit_length()))
    bit = members.select(F.col("hash").bitwiseAND(F.lit(size - 1)).alias("bit"))
    word = bit.selectExpr("cast(bit div 64 as int) AS word", "shiftleft(1L, cast(bit % 64 as int)) AS bit")
    words = np.zeros(size // 64, np.int64)
    for row in word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():  # at most size / 64 rows
        words[row["word"]] = row["bits"]
    return members.sparkSession.sparkContext.broadcast(MemberFilter(words.view(np.uint64)))


def _confirmed(docs: DataFrame, groups: DataFrame, words: int, percent: int, folder: str) -> DataFrame:
    """A forest of links; ``groups`` has ``node, root, id, size``, where ``id`` is one document of the node."""
    members = groups.select(F.xxhash64("id").alias("hash"))
    bits = member_filter(members)
    if bits is None:
        docs = docs.join(groups.select(F.col("id").alias("member")).distinct(), F.col("id") == F.col("member"), "left_semi")
    schema = pa.schema([("id", pa.int64()), ("node", pa.binary()), ("shingles", pa.binary())])

    def again(batches):
        for batch in batches:
            kept = bits.value.may_hold(batch.column(2)) if bits else np.ones(batch.num_rows, bool)
            ids = batch.column(0).filter(pa.array(kept))
            sets = [shingles(t.as_py(), words) for t, k in zip(batch.column(1), kept) if k]
            yield _batch(schema, (ids, [_digest(s) if len(s) else None for s in sets], [s.tobytes() for s in sets]))
        _WORDS.clear()

    sets = docs.withColumn("hash", F.xxhash64("id")).mapInArrow(releasing(again), "id long, node binary, shingles binary")
    sets = sets.withColumnsRenamed({"id": "own_id", "node": "own"})
    sums = groups.groupBy(F.col("root").alias("of")).agg(F.sum("size").alias("shingles_of"), F.count("*").alias("members"))
    known = groups.join(sums, groups["root"] == sums["of"]).drop("of")
    rows = known.join(sets, (known["node"] == sets["own"]) & (known["id"] == sets["own_id"]))
    rows = rows.dropDuplicates(["node", "id"])  # by the keys of the join
    blocks = F.greatest(F.ceil(F.col("shingles_of") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK))
    rows = _in_blocks(rows, "root", blocks)
    link = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def search(batches):
        for parts in _by_group(batches, 3):
            group = pa.Table.from_batches(parts)
            if group.num_rows < 2:
                continue
            own = group["node"].to_pylist()
            found = _linked([np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()], percent)
            if found:
                yield _batch(link, ([own[i] for i, _ in found], [own[j] for _, j in found]))

    keys = ["root", "one", "two"]
    rows = rows.select(*keys, "node", "shingles").repartition(*keys).sortWithinPartitions(*keys, "node")
    return rows.mapInArrow(releasing(search), "a binary, b binary")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: the components of linked documents.

    Two documents are linked if 100 * common >= ``percent`` * all of their distinct ``words``-word shingles; a
    text with fewer words has its whole sequence as its only one. A null or empty text, or one of white
    space only, has none and is linked with nothing. ``component_id`` is the smallest id reachable, and
    ``kept`` tells whether that is the row's own. Rows that repeat an id are linked by their own texts.
    A row without an id is linked with nothing: its component is null and it is kept. Other columns are
    ignored; an empty table gives an empty one.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.lit(None).cast("long").alias("mark")
    )
    joined = _placed(rows, words, percent)
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exactly one row of each component, and all rows that are in none: those without an id or words.

    It is one with the smallest id; of several texts or other columns under that id, a hash of the row
    decides. Rows of other components stay, whatever ids they share.
    """
    columns = docs.columns
    mark = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
    marked = docs.withColumn("__mark", mark).withColumn("__id", F.col(doc_id).cast("long"))
    rows = marked.select(F.col("__id").alias("id"), F.col(text).cast("string").alias("text"), F.col("__mark").alias("mark"))
    placed = stored(
        _placed(rows, WORDS, percent).where("root IS NOT NULL").select("root", "id", "mark"),
        work_dir(docs.sparkSession, "one-of-each"),
    )
    equal = placed.groupBy("root", "id", "mark").agg(F.count("*").alias("times"))
    best = placed.groupBy(F.col("root").alias("of")).agg(F.min(F.struct("id", "mark")).alias("best"))
    places = equal.join(best, equal["root"] == best["of"])
    first = (F.col("id") == F.col("best.id")) & (F.col("mark") == F.col("best.mark"))
    # rows that go, and equal ones of which one stays; few beside all rows
    odd = places.where(~first | (F.col("times") > 1)).select(F.col("id").alias("__id"), F.col("mark").alias("__mark"), first.alias("__one"))
    odd = stored(odd, work_dir(docs.sparkSession, "odd-rows"))
    key = ["__id", "__mark"]
    if odd.count() <= SENT_ROWS:
        met = marked.join(F.broadcast(odd), key, "left")
        return met.where("__one IS NULL").select(columns).union(met.where("__one").dropDuplicates(key).select(columns))
    hashed = F.xxhash64(*key)
    bits = member_filter(odd.select(hashed.alias("hash")))
    rest, some = None, marked
    if bits is not None:  # texts that the filter does not hold stay where they are; the others alone are shuffled, once

        def start():
            return lambda hashes: [pa.array(bits.value.may_hold(hashes))], lambda: None

        told = map_batches(marked.withColumn("__hash", hashed), ["__hash"], {"__maybe": T.BooleanType()}, start)
        rest, some = told.where("NOT __maybe").select(columns), told.where("__maybe").drop("__hash", "__maybe")
    met = some.join(odd, key, "left").where("__one IS NULL OR __one")
    met = stored(met, work_dir(docs.sparkSession, "met-rows"))
    kept = met.where("__one IS NULL").select(columns).union(met.where("__one").dropDuplicates(key).select(columns))
    return kept if rest is None else rest.union(kept)


def _placed(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, size, mark`` of every row of ``id, text, mark`` with its component, ``root, component_id``; null in none."""
    spark = rows.sparkSession
    folder = work_dir(spark, "minhash")
    sketches = stored(_sketches(rows, words), f"{folder}/sketches")
    classes = sketches.where("size > 0 AND id IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("id"), F.max("size").alias("size"), F.first("coords").alias("coords")
    )  # copies meet once per task
    nodes = stored(_tagged(classes), f"{folder}/nodes")
    groups = components(_candidates(nodes, percent, folder))
    groups = groups.union(groups.select(F.col("root").alias("node"), "root").distinct())
    groups = groups.join(nodes.select("node", "id", "size"), "node")
    links = _confirmed(rows.select("id", "text"), stored(groups.select("node", "root", "id", "size"), f"{folder}/groups"), words, percent, folder)
    found = components(links)
    found = found.union(found.select(F.col("root").alias("node"), "root").distinct())
    placed = nodes.select("node", "id").join(found, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    of_node = placed.select("node", "root").join(least, "root").select(F.col("node").alias("own"), "root", "component_id")
    # texts without words get keys of their own, so they do not meet under null
    alone = F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary")
    key = F.when(F.col("id").isNotNull(), F.col("node"))
    key = F.coalesce(key, alone)
    every = sketches.select("id", "size", "mark", key.alias("key"))
    return every.join(of_node, every["key"] == of_node["own"], "left")


def _tagged(classes: DataFrame) -> DataFrame:
    """With the low byte of every coordinate: chance hits only add candidates."""
    schema = pa.schema(
        [("node", pa.binary()), ("id", pa.int64()), ("size", pa.int64()), ("coords", pa.binary()), ("tag", pa.binary())]
    )

    def tag(batches):
        for batch in batches:
            tags = [np.frombuffer(c.as_py(), np.uint32).astype(np.uint8).tobytes() for c in batch.column(3)]
            yield _batch(schema, (*batch.columns, tags))

    return classes.select("node", "id", "size", "coords").mapInArrow(
        releasing(tag), "node binary, id long, size long, coords binary, tag binary"
    )
