"""Texts scored by a trigram model of all training texts, kept in tries of Elias-Fano levels.

The model is an interpolation: a token's share of all tokens (0.1 added) smooths its share after one word, and
that its share after two words; what is added to a count is ``WEIGHTS`` times the smoother share. It grows with
the corpus, so no task ever holds all of it:

1. Tasks cut their documents into bundles of bounded size. Bundles send their distinct words, hashed to 64 bits, to
   shards by hash; shards count them, number them in order of frequency, and answer each bundle once.
2. With numbers and counts in hand, a bundle sends every trigram to a shard by its middle word. A middle word
   with more than a part's share of tokens is split by the word that follows, and a pair of such words that is
   still too frequent by the word before; the counts of such pairs, bounded in number, are known to all.
3. A shard counts its trigrams and builds the trie of those seen in training, in one anonymous memory map: middle words,
   the words after each, the words before each, and for each pair the words before it. A word
   after or before is a successor search within the range of its context, and the last level holds ranks among the
   words before the middle word instead of numbers. Levels carry logarithms rounded to 1/1024.
4. The trigrams of all documents are looked up there. Sums by document go back to the bundle. As logarithms are whole
   numbers of 1/1024, neither the number of shards nor the order of sums changes a score.

Two words take the same number only if their 64-bit hashes collide: three in a hundred for a billion words.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.eliasfano import EliasFano
from vacantia.llm.registry import stored
from vacantia.session import work_dir

#: Weights of the smoother share, after one word and after two.
WEIGHTS = (3_000.0, 3.0)
#: Added to every count of single tokens.
ADDED = 0.1
#: Tokens and documents of a bundle (a longer text is one by itself), trigrams of a shard, words of a shard.
BUNDLE_TOKENS, BUNDLE_DOCS, SHARD, WORD_SHARD = 1 << 20, 1 << 16, 1 << 20, 1 << 21
#: Least tokens of a word or pair that is split; at most MOST_HOT of each are, so the bound grows beyond that.
PART, MOST_HOT = 1 << 20, 1 << 20
#: Steps of a logarithm, and what is added before it is kept in 16 bits.
STEPS, OFFSET = 1_024, 24 * 1_024
START, END, FIRST = 0, 1, 2

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, by planes of bytes up to the highest in use, compressed."""
    codec, out = pa.Codec("zstd", 1), [struct.pack("<I", len(arrays))]
    for array in arrays:
        raw = np.ascontiguousarray(array).view(np.uint64)
        width = (int(raw.max()).bit_length() + 7) // 8 if len(raw) else 0
        planes = raw.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
        data = codec.compress(planes, asbytes=True) if planes else b""
        out += [struct.pack("<QBQ", len(raw), width, len(data)), data]
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    codec, (count,), at, out = pa.Codec("zstd", 1), struct.unpack_from("<I", data), 4, []
    for _ in range(count):
        size, width, length = struct.unpack_from("<QBQ", data, at)
        at += 17
        raw = np.zeros((size, 8), np.uint8)
        if length:
            planes = codec.decompress(data[at : at + length], size * width, asbytes=True)
            raw[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, size).T
        out.append(raw.view(np.int64).ravel())
        at += length
    return out


def _deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _zigzag(x: np.ndarray) -> np.ndarray:
    return (x << 1) ^ (x >> 63)


def _unzigzag(x: np.ndarray) -> np.ndarray:
    return (x >> 1) ^ -(x & 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _ODD
    return (x ^ (x >> np.uint64(32))) * _MIX >> np.uint64(16)


def _logs(x: np.ndarray) -> np.ndarray:
    return np.rint(np.log10(x) * STEPS).astype(np.int64)


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new key."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _order(*keys: np.ndarray) -> np.ndarray:
    """What sorts rows by their keys, the first one first; equal rows in any order."""
    if not len(keys[0]) or any(int(k.max()) >> 32 for k in keys):
        return np.lexsort(keys[::-1])
    whole = keys[0] << 32 | keys[1]
    order = np.argsort(whole)
    for key in keys[2:]:
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(_changes(whole[order]))
        whole = place << 32 | key
        order = np.argsort(whole)
    return order


# --- bundles -------------------------------------------------------------------------------------

BUNDLE = "bundle long, size long, tokens long, trained long, texts long, hashes binary, counts binary, body binary, rows binary"


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Bundle:
    def __init__(self, tokens: int, docs: int):
        self.most_tokens, self.most_docs = tokens, docs
        self.words, self.tokens, self.lengths, self.ids, self.held, self.size = _Words(), [], [], [], [], 0

    def add(self, doc_id, text, held) -> None:
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        self.tokens.append(np.fromiter(map(self.words.__getitem__, parts), np.int32, len(parts)))
        self.lengths.append(len(parts))
        self.ids.append(doc_id)
        self.held.append(bool(held))
        self.size += len(parts)

    def full(self) -> bool:
        return self.size >= self.most_tokens or len(self.ids) >= self.most_docs

    def row(self, number: int) -> dict:
        import xxhash

        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        tokens = place[np.concatenate(self.tokens)]
        lengths, held = np.array(self.lengths, np.int64), np.array(self.held)
        trained = ~np.repeat(held, lengths)
        counts = np.bincount(tokens[trained], minlength=len(order))
        ids, none = np.array([i or 0 for i in self.ids], np.int64), np.array([i is None for i in self.ids])
        return {
            "bundle": number, "size": len(order), "tokens": len(tokens) + len(lengths),
            "trained": int(trained.sum() + (~held).sum()), "texts": int((~held).sum()),
            "hashes": pack(_deltas(hashes[order])), "counts": pack(counts), "body": pack(tokens, lengths),
            "rows": pack(_zigzag(ids), none.astype(np.int64), held.astype(np.int64)),
        }


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in text.split(", "))])


def _bundles(docs: DataFrame) -> DataFrame:
    limits = BUNDLE_TOKENS, BUNDLE_DOCS

    def cut(batches):
        number, bundle, schema = TaskContext.get().partitionId() << 32, _Bundle(*limits), _schema(BUNDLE)
        for batch in batches:
            for doc_id, text, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                bundle.add(doc_id, text.as_py(), held)
                if bundle.full():
                    yield pa.RecordBatch.from_pylist([bundle.row(number)], schema=schema)
                    number, bundle = number + 1, _Bundle(*limits)
        if bundle.ids:
            yield pa.RecordBatch.from_pylist([bundle.row(number)], schema=schema)

    return docs.mapInArrow(cut, BUNDLE)


# --- words ---------------------------------------------------------------------------------------

ANSWER = "bundle long, shard long, data binary, known long, hot binary"


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By ranges of hashes, so words in order of their hashes are in order of their shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _counted(bundles: DataFrame, shards: int, part: int) -> DataFrame:
    """For every bundle and shard the numbers and counts of its words; once a shard, what it holds in all."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.cumsum(unpack(row["hashes"])[0].view(np.uint64), dtype=np.uint64), unpack(row["counts"])[0]
                shard, made = _word_shard(hashes, shards), []
                edges = np.append(np.flatnonzero(_changes(shard)), len(shard))
                for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    data = pack(_deltas(hashes[begin:end]), counts[begin:end])
                    made.append({"shard": int(shard[begin]), "bundle": row["bundle"], "data": data})
                for at in range(0, len(made), 64):
                    yield pa.RecordBatch.from_pylist(made[at : at + 64], schema=_schema("shard long, bundle long, data binary"))

    def answer(key, rows):
        shard, schema = key[0].as_py(), _schema(ANSWER)
        cells = [unpack(d.as_py()) for d in rows["data"]]
        hashes = np.concatenate([np.cumsum(c[0].view(np.uint64), dtype=np.uint64) for c in cells])
        every, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([c[1] for c in cells])).astype(np.int64)
        rank = np.empty(len(every), np.int64)
        rank[np.lexsort((every, -total))] = np.arange(len(every))
        number = FIRST + rank * shards + shard  # in about the order of frequency over all shards
        hot = total >= part
        out, begin = [], 0
        for bundle, cell in zip(rows["bundle"].to_pylist(), cells):
            own = at[begin : begin + len(cell[0])]
            begin += len(cell[0])
            out.append({"bundle": bundle, "shard": shard, "data": pack(number[own], total[own]), "known": 0, "hot": None})
        out[0] |= {"known": int((total > 0).sum()), "hot": pack(every[hot].view(np.int64), number[hot], total[hot])}
        return pa.Table.from_pylist(out, schema=schema)

    asked = bundles.select("bundle", "hashes", "counts").mapInArrow(ask, "shard long, bundle long, data binary")
    return asked.groupBy("shard").applyInArrow(answer, ANSWER)


class _Hot:
    """Words and pairs that are split over shards: at most MOST_HOT of each."""

    def __init__(self, hashes, numbers, counts, part: int):
        order = np.argsort(numbers)
        self.hashes, self.numbers, self.counts, self.part = hashes[order], numbers[order], counts[order], part
        self.pairs, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def at(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        return place, self.numbers[place] == numbers

    def pair_times(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Training occurrences of pairs that are split, 0 of all others."""
        times = np.zeros(len(one), np.int64)
        if not len(self.pairs):
            return times
        (a, hot_a), (b, hot_b) = self.at(one), self.at(two)
        some = np.flatnonzero(hot_a & hot_b)
        asked = a[some] * len(self.numbers) + b[some]
        place = np.minimum(np.searchsorted(self.pairs, asked), len(self.pairs) - 1)
        times[some] = np.where(self.pairs[place] == asked, self.times[place], 0)
        return times


def _hot_pairs(bundles: DataFrame, hot: _Hot) -> None:
    """Count the pairs of hot words in training texts; those that are hot themselves are kept."""
    if not len(hot.numbers):
        return
    given, width = bundles.sparkSession.sparkContext.broadcast(hot), len(hot.numbers)

    def count(batches):
        hot = given.value
        order = np.argsort(hot.hashes)
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.cumsum(unpack(row["hashes"])[0].view(np.uint64), dtype=np.uint64)
                place = np.minimum(np.searchsorted(hot.hashes[order], hashes), width - 1)
                own = np.where(hot.hashes[order][place] == hashes, order[place], -1)
                tokens, lengths = unpack(row["body"])
                held = unpack(row["rows"])[2].astype(bool)
                words, texts = np.where(np.repeat(held, lengths), -1, own[tokens] if len(tokens) else -1), np.repeat(np.arange(len(lengths)), lengths)
                both = np.flatnonzero((words[:-1] >= 0) & (words[1:] >= 0) & (texts[:-1] == texts[1:]))
                pairs, times = np.unique(words[both] * width + words[both + 1], return_counts=True)
                start = np.flatnonzero(hot.numbers == START)
                if len(start) and len(lengths):  # texts that begin with a hot word
                    first = np.cumsum(lengths) - lengths
                    first = words[first[(lengths > 0) & ~held]]
                    more, n = np.unique(start[0] * width + first[first >= 0], return_counts=True)
                    pairs, times = np.concatenate([pairs, more]), np.concatenate([times, n])
                yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(times, pa.int64())], names=["pair", "n"])

    found = bundles.select("hashes", "body", "rows").mapInArrow(count, "pair long, n long")
    found = found.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= hot.part).orderBy("pair").collect()
    hot.pairs = np.array([r["pair"] for r in found], np.int64)  # at most tokens / part, which is at most MOST_HOT
    hot.times = np.array([r["n"] for r in found], np.int64)


# --- trigrams ------------------------------------------------------------------------------------

CELL = "shard long, bundle long, data binary"


def _cells(bundle: dict, answers: list[dict], total: dict, hot: _Hot) -> list[dict]:
    """A bundle's trigrams by shard, and a row of what is known of its documents without them."""
    known = [unpack(a["data"]) for a in sorted(answers, key=lambda a: a["shard"])] or [[np.empty(0, np.int64)] * 2]
    number, count = (np.concatenate([k[i] for k in known]) for i in (0, 1))  # in order of hashes
    tokens, lengths = unpack(bundle["body"])
    ids, none, held = unpack(bundle["rows"])
    texts = len(lengths)
    doc = np.repeat(np.arange(texts), lengths + 1)
    inside = np.arange(len(tokens)) + np.repeat(np.arange(texts), lengths)
    first = np.cumsum(lengths + 1) - (lengths + 1)
    after, times = np.full(len(doc), END, np.int64), np.full(len(doc), total["texts"], np.int64)
    after[inside], times[inside] = number[tokens], count[tokens]
    middle, before, context = np.roll(after, 1), None, np.roll(times, 1)
    middle[first], context[first] = START, total["texts"]
    before = np.roll(middle, 1)
    before[first] = START

    share = (times + ADDED) / (total["trained"] + ADDED * (total["known"] + 1))
    base = np.bincount(doc, weights=np.log10(share), minlength=texts)
    known = np.bincount(doc, weights=times > 0, minlength=texts).astype(np.int64)
    begun = np.full(texts, -_logs(np.array([total["texts"] + total["weights"][1]]))[0], np.int64)
    data = pack(ids, none, held, lengths + 1, known, _zigzag(begun), base.view(np.int64))
    out = [{"shard": -1 - bundle["bundle"], "bundle": bundle["bundle"], "data": data}]

    parts = 1 + context // hot.part
    key = _mixed(middle) + _mixed(after) % parts.astype(np.uint64)
    pair = hot.pair_times(middle, after)
    key = _mixed(key) + np.where(pair > 0, _mixed(before) % (1 + pair // hot.part).astype(np.uint64), np.uint64(0))
    to = (_mixed(key) % np.uint64(total["shards"])).astype(np.int64)
    order = _order(to, middle, after)
    to, middle, after, before = to[order], middle[order], after[order], before[order]
    times, context, doc = times[order], context[order], doc[order] * 2 + (held[doc[order]] == 0)
    edges = np.append(np.flatnonzero(_changes(to)), len(to))
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = slice(begin, end)
        words, at, place = np.unique(np.concatenate([middle[own], after[own]]), return_index=True, return_inverse=True)
        counts = np.concatenate([context[own], times[own]])[at]
        data = pack(_deltas(place[: end - begin]), place[end - begin :], before[own], doc[own], _deltas(words), counts)
        out.append({"shard": int(to[begin]), "bundle": bundle["bundle"], "data": data})
    return out


class _Map:
    """One anonymous memory map for the levels of a trie."""

    def __init__(self, size: int):
        self.map, self.at = mmap.mmap(-1, max(size, 1)), 0

    def keep(self, array: np.ndarray) -> np.ndarray:
        begin = -(-self.at // 8) * 8
        if begin + array.nbytes > len(self.map):
            return array  # the estimate was too small
        self.at = begin + array.nbytes
        place = np.frombuffer(self.map, array.dtype, len(array), begin)
        place[:] = array
        return place


class _Level:
    """Numbers by parent, in order within each: the ends of the ranges, and the numbers, made monotone over all ranges."""

    def __init__(self, parents: int, parent: np.ndarray, value: np.ndarray, keep):
        ends = np.searchsorted(parent, np.arange(parents), side="right")
        self.ends = EliasFano(ends, keep)
        last = np.where(np.diff(ends, prepend=0) > 0, value[np.maximum(ends - 1, 0)] if len(value) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)])  # every range goes on from the last number of the one before
        self.values = EliasFano(value + base[parent], keep)

    def find(self, parent: np.ndarray, value: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of each value among those of its parent, whether it is there, and where the range begins.

        Parents that are ``there`` come in order.
        """
        place, begins, met = np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64), np.zeros(len(parent), bool)
        some = np.flatnonzero(there)
        if not len(some) or not self.values.size:
            return place, met, begins
        new = _changes(parent[some])  # they come in order
        ranges, at = parent[some][new], np.cumsum(new) - 1
        both = self.ends.get(np.concatenate([np.maximum(ranges - 1, 0), ranges]))
        end, begin = both[len(ranges) :], np.where(ranges > 0, both[: len(ranges)], 0)
        base = np.where(begin > 0, self.values.get(np.maximum(begin - 1, 0)), 0)
        place[some], met[some] = self.values.successor(value[some] + base[at], begin[at], end[at])
        begins[some] = begin[at]
        return place, met, begins


class _Trie:
    """Training trigrams of a shard: middle word, word after it, word before it.

    ``pairs`` has middle, after, times, how often the middle word occurs and the share of the word after it among all
    tokens; ``grams`` the pair's place, the word before and its times. Both are sorted, and have only what was seen.
    """

    def __init__(self, weights, middle, after, times, contexts, shares, pair, before, count):
        self.weights = weights
        keep = _Map(16 * (2 * len(middle) + 3 * len(pair)) + (1 << 16)).keep
        first = _changes(middle)
        context = np.cumsum(first) - 1
        self.middles = EliasFano(middle[first], keep)
        self.after = _Level(int(first.sum()), context, after, keep)
        share = (times + weights[0] * shares) / (contexts + weights[0])
        self.rest = keep((_logs(weights[1] * share) + OFFSET).astype(np.uint16))
        self.given = keep((_logs(times + weights[1]) + OFFSET).astype(np.uint16))
        of = context[pair]
        order = _order(of, before)
        new = _changes(of[order], before[order])
        self.before = _Level(int(first.sum()), of[order][new], before[order][new], keep)
        place = np.empty(len(pair), np.int64)
        place[order] = np.cumsum(new) - 1
        begins = np.searchsorted(of[order][new], np.arange(int(first.sum())))
        rank = place - begins[of] if len(pair) else place
        self.grams = _Level(len(middle), pair, rank, keep)
        self.logs = keep((_logs(count + weights[1] * share[pair]) + OFFSET).astype(np.uint16))

    def look_up(self, middle, after, before, unseen):
        """For sorted trigrams the logarithm of the numerator and of what follows it; ``unseen`` for pairs not in training."""
        first = _changes(middle)
        at, met = self.middles.successor(middle[first], np.zeros(int(first.sum()), np.int64), np.full(int(first.sum()), self.middles.size))
        own = np.cumsum(first) - 1
        context, known = at[own], met[own]
        new = _changes(middle, after)
        two = np.cumsum(new) - 1
        pair, pair_met, _ = self.after.find(context[new], after[new], known[new])
        order = _order(middle, before)
        fresh = _changes(middle[order], before[order])
        some = order[fresh]
        place, place_met, begin = self.before.find(context[some], before[some], known[some])
        back = np.empty(len(middle), np.int64)
        back[order] = np.cumsum(fresh) - 1
        pair, pair_met = pair[two], pair_met[two]
        gram, gram_met, _ = self.grams.find(pair, (place - begin)[back], pair_met & place_met[back])
        value = unseen.copy()
        value[pair_met] = self.rest[pair[pair_met]].astype(np.int64) - OFFSET
        value[gram_met] = self.logs[gram[gram_met]].astype(np.int64) - OFFSET
        given = np.full(len(middle), _logs(np.array([self.weights[1]]))[0], np.int64)
        given[pair_met] = self.given[pair[pair_met]].astype(np.int64) - OFFSET
        return value, given


def _scored(cells: list[list[np.ndarray]], total: dict, hot: _Hot) -> list[bytes]:
    """The sums of each cell's documents: numerators of their trigrams, less what the next token is divided by."""
    cell = np.repeat(np.arange(len(cells)), [len(c[0]) for c in cells])
    own = [np.cumsum(c[4]) for c in cells]
    middle = np.concatenate([w[np.cumsum(c[0])] for w, c in zip(own, cells)])
    after = np.concatenate([w[c[1]] for w, c in zip(own, cells)])
    before, doc = (np.concatenate([c[i] for c in cells]) for i in (2, 3))
    words, at = np.unique(np.concatenate(own), return_index=True)
    counts, many = np.concatenate([c[5] for c in cells])[at], len(cells)
    cells.clear()
    del own, at
    order = _order(middle, after, before)
    middle, after, before, cell, doc = middle[order], after[order], before[order], cell[order], doc[order]
    del order
    new = _changes(middle, after, before)
    gram = np.cumsum(new) - 1
    times = np.bincount(gram, weights=doc & 1).astype(np.int64)
    middle, after, before = middle[new], after[new], before[new]
    first = _changes(middle, after)
    pair = np.cumsum(first) - 1
    of_pair = np.bincount(pair, weights=times).astype(np.int64)
    split = hot.pair_times(middle[first], after[first])
    of_pair = np.where(split > 0, split, of_pair)
    contexts = counts[np.searchsorted(words, middle[first])]
    shares = (counts[np.searchsorted(words, after[first])] + ADDED) / (total["trained"] + ADDED * (total["known"] + 1))
    seen, seen_gram = of_pair > 0, times > 0
    renamed = np.cumsum(seen) - 1
    weights = total["weights"]
    trie = _Trie(
        weights, middle[first][seen], after[first][seen], of_pair[seen], contexts[seen], shares[seen],
        renamed[pair[seen_gram]], before[seen_gram], times[seen_gram],
    )
    unseen = _logs(weights[1] * weights[0] * shares / (contexts + weights[0]))[pair]
    value, given = trie.look_up(middle, after, before, unseen)
    value = value - np.where(after == END, 0, given)
    width = int(doc.max()) + 2 >> 1
    key = cell * width + (doc >> 1)
    every, at = np.unique(key, return_inverse=True)
    sums = np.bincount(at, weights=value[gram]).astype(np.int64)
    edges = np.searchsorted(every, np.arange(many + 1) * width)
    return [
        pack(_deltas(every[b:e] - i * width), _zigzag(sums[b:e])) for i, (b, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist()))
    ]


SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, scored by the model of those that are not ``held_out`` (null counts as held out).

    Tokens are the words between ASCII white space, A-Z lower-cased, and one end of text; a null text has only
    that. ``n_known`` counts tokens seen in training, ``base_score`` is by single tokens, ``score`` by the trigram model,
    both logarithms to base 10 of the whole text. Rows that repeat an id are documents of their own, and
    a row may lack one. Without training documents all known counts are 0 and every token has share 1. Other
    columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    folder = work_dir(spark, "lm")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(True)).alias("held"),
    )
    bundles = stored(_bundles(rows), f"{folder}/bundles")
    sums = bundles.agg(*(F.sum(n).alias(n) for n in ("size", "tokens", "trained", "texts"))).first().asDict()
    total = {n: v or 0 for n, v in sums.items()}
    total |= {"shards": 1 + total["tokens"] // SHARD, "word_shards": 1 + total["size"] // WORD_SHARD, "weights": WEIGHTS}
    part = max(PART, total["trained"] // MOST_HOT + 1)
    answers = stored(_counted(bundles, total["word_shards"], part), f"{folder}/words")
    total["known"] = (answers.agg(F.sum("known")).first()[0] or 0) + (total["texts"] > 0)
    found = [unpack(r["hot"]) for r in answers.where("hot IS NOT NULL").select("hot").toLocalIterator()]
    found.append([np.array(x) for x in ([0], [START], [total["texts"]])] if total["texts"] >= part else [np.empty(0, np.int64)] * 3)
    hashes, numbers, counts = (np.concatenate([f[i] for f in found]) for i in range(3))
    hot = _Hot(hashes.view(np.uint64), numbers, counts, part)
    _hot_pairs(bundles, hot)
    known = spark.sparkContext.broadcast((total, hot))

    def ask(key, left, right):
        made = [c for b in left.to_pylist() for c in _cells(b, right.to_pylist(), *known.value)]
        return pa.Table.from_pylist(made, schema=_schema(CELL))

    def look_up(key, rows):
        shard, bundles = key[0].as_py(), rows["bundle"].to_pylist()
        if shard < 0:  # documents on their way
            return pa.table([rows["bundle"], pa.array([True] * len(bundles)), rows["data"]], names=["bundle", "base", "data"])
        data = _scored([unpack(d.as_py()) for d in rows["data"]], *known.value)
        return pa.table([rows["bundle"], pa.array([False] * len(bundles)), pa.array(data, pa.binary())], names=["bundle", "base", "data"])

    def join(key, rows):
        parts = [(b, unpack(d.as_py())) for b, d in zip(rows["base"].to_pylist(), rows["data"])]
        ids, none, held, tokens, seen, begun, base = next(d for b, d in parts if b)
        score = _unzigzag(begun)
        for is_base, data in parts:
            if not is_base:
                score[np.cumsum(data[0])] += _unzigzag(data[1])
        columns = [
            pa.array(_unzigzag(ids), mask=none.astype(bool)), pa.array(held.astype(bool)), pa.array(tokens), pa.array(seen),
            pa.array(np.full(len(ids), known.value[0]["trained"])), pa.array(base.view(np.float64)), pa.array(score / STEPS),
        ]
        return pa.Table.from_arrays(columns, names=[f.split()[0] for f in SCORE.split(", ")])

    asked = bundles.select("bundle", "body", "rows").groupBy("bundle").cogroup(
        answers.select("bundle", "shard", "data").groupBy("bundle")
    )
    cells = asked.applyInArrow(ask, CELL)
    looked = cells.groupBy("shard").applyInArrow(look_up, "bundle long, base boolean, data binary")
    return looked.groupBy("bundle").applyInArrow(join, SCORE)
