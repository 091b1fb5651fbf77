"""Byte-level BPE: encode text to token ids and decode ids to bytes.

A text is cut by a pattern and each cut piece is encoded on its own. Bytes are read as Latin-1
characters, so an Aho-Corasick automaton over the whole vocabulary finds, in one pass, the longest
token that starts at every byte. A walk takes the longest token, then the next shorter one that is a
prefix of it, and steps back where nothing fits. Two tokens may be neighbours only if merging their
joined bytes gives back just these two; the answer is remembered. The merges of a piece never cross
the border of two such tokens, so the sequence found is exactly the one the merges make, and a byte
position that failed once need never be tried again, which keeps the walk linear.
"""

from __future__ import annotations

import base64
import struct
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.registry import map_batches

#: Most pieces, and most token pairs, in one generation of what a worker remembers; it keeps two.
MEMO = 200_000
#: Longer pieces are encoded but not remembered.
MEMO_CHARS = 40
#: Above every rank.
NONE = 1 << 60
#: Stands for the token before the first one of a piece.
BEGIN = 1 << 63

_CODECS = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines) if t}


class Codec:
    """One vocabulary in one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        import regex

        self.memo = memo
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.size = [len(t or b"") for t in self.tokens]
        self.shorter_of, self.fits, self.pieces = {}, _Fits(self), _Pieces(self)

    @cached_property
    def automaton(self):
        """Of all tokens as Latin-1 text; only encoding needs it."""
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            found.add_word(token.decode("latin-1"), rank)
        found.make_automaton()
        return found

    def forget(self) -> None:
        """Give back what was remembered: a worker outlives the task, and goes on to other stages."""
        self.shorter_of.clear()
        for memo in (self.fits, self.pieces):
            memo.clear()
            memo.old = {}

    def stays(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of these bytes, lowest rank first, end at the border of the two and nowhere else."""
        ranks, data, border = self.ranks, left + right, len(left)
        parts = [data[i : i + 1] for i in range(len(data))]
        order = [ranks.get(data[i : i + 2], NONE) for i in range(len(data) - 1)]
        while order and (rank := min(order)) < NONE:
            at = order.index(rank)
            if at == border - 1:
                return False
            border -= at < border
            parts[at] += parts.pop(at + 1)
            del order[at]
            if at:
                order[at - 1] = ranks.get(parts[at - 1] + parts[at], NONE)
            if at < len(order):
                order[at] = ranks.get(parts[at] + parts[at + 1], NONE)
        return len(parts) == (2 if left else 1)

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        found = self.shorter_of.get(token, -1)
        if found == -1:
            data = self.tokens[token]
            prefixes = (self.ranks.get(data[:k]) for k in range(len(data) - 1, 0, -1))
            found = self.shorter_of[token] = next((r for r in prefixes if r is not None), None)
        return found

    def piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size, length = self.size, len(data)
        longest = [None] * length
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end - size[token] + 1] = token  # longer ones end later
        open_at = bytearray(b"\1") * (length + 1)
        fits = self.fits
        found, at, token, last = [], 0, longest[0], BEGIN
        while at < length:
            while token is not None:
                end = at + size[token]
                if open_at[end] and fits[last | token]:
                    break
                token = self.shorter(token)
            if token is None:
                if not found:
                    raise ValueError("the vocabulary lacks a byte of the text")
                open_at[at] = 0
                token = found.pop()
                at -= size[token]
                last = found[-1] << 32 if found else BEGIN
                token = self.shorter(token)
            else:
                found.append(token)
                last, at = token << 32, end
                token = longest[at] if at < length else None
        return found

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))


class _Memo(dict):
    """Remembers answers in two generations: a full one becomes the old one, and what is used again moves on."""

    def __init__(self, codec: Codec):
        self.codec, self.old = codec, {}

    def __missing__(self, key):
        answer = self.old.get(key)
        if answer is None:
            answer = self.work_out(key)
        if len(self) >= self.codec.memo:
            self.old = dict(self)
            self.clear()
        self[key] = answer
        return answer


class _Pieces(_Memo):
    """Piece of text to packed ids."""

    def work_out(self, piece: str) -> bytes:
        ids = self.codec.piece(piece.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) <= MEMO_CHARS else self.work_out(piece)


class _Fits(_Memo):
    """Whether the right token, in the low half of the key, may follow the left one or begin a piece."""

    def work_out(self, key: int) -> bool:
        tokens, left, right = self.codec.tokens, key >> 32, key & 0xFFFFFFFF
        return self.codec.stays(b"" if key >= BEGIN else tokens[left], tokens[right])


def codec(path: str, pattern: str, memo: int = MEMO) -> Codec:
    """The codec of a rank file, built once in a worker."""
    if (path, pattern, memo) not in _CODECS:
        _CODECS[path, pattern, memo] = Codec(read_ranks(path), pattern, memo)
    return _CODECS[path, pattern, memo]


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None,
    keep: list[str] | None = None, memo: int = MEMO, exact: str | None = None,
) -> DataFrame:
    """Add ``ids``: the tokens of the whole text as packed little-endian unsigned 32-bit integers.

    ``decoded`` names one more column, for the bytes that these ids decode to, made in the same pass, and ``exact``
    one for whether these bytes are exactly those of the text, which spares sending both back to compare them;
    ``keep`` names the columns to keep, all by default. A null text counts as empty and gives no bytes;
    texts of any length are encoded whole; repeated rows give equal ids; an empty table stays empty.
    Columns of the new names are replaced. ``path`` is a rank file that every executor can open. ``memo`` bounds
    what a worker remembers; it costs time and changes no result.
    """

    def start():
        own = codec(path, pattern, memo)

        def work(texts):
            packed = [own.encode(t.as_py() or "") for t in texts]
            columns = [pa.array(packed, pa.binary())]
            if decoded is not None:
                columns.append(pa.array([own.decode(i) for i in packed], pa.binary()))
            if exact is not None:
                same = [own.decode(i) == (t.as_py() or "").encode("utf-8") for i, t in zip(packed, texts)]
                columns.append(pa.array(same, pa.bool_()))
            return columns

        return work, own.forget

    outputs = {ids: T.BinaryType(), decoded: T.BinaryType(), exact: T.BooleanType()}
    return map_batches(df, [text], {n: t for n, t in outputs.items() if n is not None}, start, keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Add ``data``: the bytes that packed token ids stand for; null ids count as none."""

    def start():
        own = codec(path, pattern)
        return lambda packed: [pa.array([own.decode(i.as_py() or b"") for i in packed], pa.binary())], own.forget

    return map_batches(df, [ids], {data: T.BinaryType()}, start)


def token_count(ids: str = "ids"):
    return (F.octet_length(F.col(ids)) / 4).cast("long")

