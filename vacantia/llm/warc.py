"""WARC archives with a two-level capture index.

Archives are ordinary files of gzip members, one record each, written by Spark's own committed text
writer: a row is a member without its last byte, which is always zero, and the zero is the line end.
Payloads are compressed where the pages lie; only then do rows meet by digest to learn which of equal
payloads is the response, so no page is shuffled uncompressed.

The index is built by reading the archives back. Captures are sorted by reversed-host key over all
files and packed into compressed blocks, again one gzip member each. A sparse directory holds the
first key of every block; blocks grow with the corpus so that it has at most ``DIRECTORY`` rows, each
key cut to ``FENCE`` characters, and can be sent to every task. A lookup searches the directory by
bisection, reads the blocks that can hold a key, and then reads byte ranges of the archives.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.registry import stored

#: Most blocks, so most rows of the directory.
DIRECTORY = 65_536
#: Fewest captures in a block.
BLOCK = 256
#: Characters of a key that the directory keeps.
FENCE = 512
#: Most records in one archive file; files are read as streams, so no task holds a whole one.
FILE_RECORDS = 2_000
#: Captures that indexing sends on at once.
CAPTURES = 4_096
#: Bytes read at once where ranges are neighbours.
WINDOW = 4 << 20
#: Smallest payload that may be replaced by a reference.
REVISIT_BYTES = 100

#: Bytes of a stream that are given to the decompressor at once.
STEP = 1 << 16
#: A gzip member without content.
EMPTY = zlib.compressobj(6, zlib.DEFLATED, 31).flush()

CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
)


def url_key(url: Column) -> Column:
    """Host parts from last to first, then the path: ``com,example,www)/a?b``. A null address gives ``-``.

    An address is first written as records write it, so that it and its record give one key.
    """
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", ""))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    parts = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    key = F.when(authority == "", url).otherwise(parts)
    return F.coalesce(key, F.lit("-"))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:{digest}'.encode()).digest()[:16], version=5)}>"


def _header_text(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def _member(record: bytes) -> bytes:
    """A gzip member short of its last byte, the top byte of a length: zero below 16 MB. For longer
    records an empty member follows, whose last byte is zero too."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = packer.compress(record) + packer.flush()
    return (data + EMPTY if data[-1] else data)[:-1]


def _record(kind, page_id, url, digest, size, refers_to, payload: bytes, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _header_text(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", size),
        ("X-Page-ID", page_id),
    ]
    if kind == "revisit":
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields += [
            ("WARC-Profile", profile),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("X-Refers-To-Page-ID", refers_to),
        ]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of ``page_id, url, html`` under ``folder``.

    Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, those with the smallest
    page_id are responses and the others revisit it. A null html is an empty payload; a null url
    leaves the target out; a row without page_id is never the smallest while another has one. Repeated
    rows each give a record. Other columns are ignored; an empty table gives no archive.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})

    @F.arrow_udf("binary")
    def response(ids: pa.Array, urls: pa.Array, digests: pa.Array, payloads: pa.Array) -> pa.Array:
        made = []
        for i, u, d, p in zip(ids, urls, digests, payloads):
            data = p.as_py()
            made.append(
                _member(_record("response", i.as_py(), u.as_py(), d.as_py(), len(data), None, data, date))
            )
        return pa.array(made, pa.binary())

    @F.arrow_udf("binary")
    def revisit(ids: pa.Array, urls: pa.Array, digests: pa.Array, sizes: pa.Array, refers: pa.Array) -> pa.Array:
        values = zip(*(x.to_pylist() for x in (ids, urls, digests, sizes, refers)))
        made = [
            None if r is None else _member(_record("revisit", i, u, d, n, r, b"", date))
            for i, u, d, n, r in values
        ]
        return pa.array(made, pa.binary())

    large = F.col("size") >= REVISIT_BYTES
    firsts = (
        rows.where(large).groupBy(F.col("digest").alias("shared")).agg(F.min("page_id").alias("first"))
    )  # one row per digest and task meets, however many copies there are
    # small payloads get keys of their own, so they do not meet under one
    own_key = F.when(large, F.col("digest")).otherwise(F.concat(F.lit("#"), F.xxhash64("page_id", "url")))
    members = rows.select(
        "page_id", "url", "digest", "size", own_key.alias("meet"),
        response("page_id", "url", "digest", "payload").alias("member"),
    )
    known = members.join(firsts, members["meet"] == firsts["shared"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    known = known.withColumn("refers_to", refers)
    again = revisit("page_id", "url", "digest", "size", "refers_to")
    value = F.coalesce(again, F.col("member")).cast("string")
    known.select(value.alias("value")).write.mode("overwrite").option("maxRecordsPerFile", FILE_RECORDS).text(
        folder, lineSep="\0"
    )


def _members(stream):
    """Offset, length and content of every record in a binary stream, of which one record is held at a time."""
    at, rest = 0, stream.read(STEP)
    while rest:
        begin, parts, unpacker = at, [], zlib.decompressobj(31)
        while True:
            if not rest:
                raise ValueError("an archive ends within a record")
            parts.append(unpacker.decompress(rest))
            at += len(rest)
            if unpacker.eof:
                break
            rest = stream.read(STEP)
        rest = unpacker.unused_data
        at -= len(rest)
        while len(rest) < len(EMPTY) and (more := stream.read(STEP)):
            rest += more
        if rest[: len(EMPTY)] == EMPTY:
            at, rest = at + len(EMPTY), rest[len(EMPTY) :]
        yield begin, at - begin, b"".join(parts)
        rest = rest or stream.read(STEP)


def _parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _files(spark, folder: str) -> DataFrame:
    """Names of the files of a folder; their content is not read."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").load(folder).where("length > 0").select(name.alias("file"))


def scan(spark, folder: str) -> DataFrame:
    """Captures of all archives: where each record lies, and its address. A task holds one record of a file at a time."""

    def walk(batches):
        ranges = _Ranges(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                with ranges.stream(file) as stream:
                    for offset, length, record in _members(stream):
                        fields, _ = _parse(record)
                        uri = fields.get("WARC-Target-URI")
                        rows.append((uri, _number(fields.get("X-Page-ID")), file, offset, length))
                        if len(rows) == CAPTURES:
                            yield table(rows)
                            rows = []
                yield table(rows)

    def table(rows):
        columns = zip(*rows) if rows else ([],) * 5
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["url", "page_id", "file", "offset", "length"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    found = _files(spark, folder).mapInArrow(
        walk, "url string, page_id long, file string, offset long, length long"
    )
    return found.select(url_key(F.col("url")).alias("key"), "page_id", "file", "offset", "length")


def build_index(spark, archives: str, index: str) -> None:
    """Index the archives of a folder: sorted compressed blocks, and the sparse directory of them."""
    captures = stored(scan(spark, archives), f"{index}/captures")
    total = captures.count()
    per_block = max(BLOCK, -(-total // DIRECTORY))
    shards = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * per_block))))

    def pack(batches):
        held = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append("\t".join("" if v is None else str(v) for v in row))
                if len(held) == per_block:
                    yield _block(held)
                    held = []
        if held:
            yield _block(held)

    def _block(lines):
        return pa.RecordBatch.from_arrays([pa.array([_member("\n".join(lines).encode())], pa.binary())], names=["b"])

    order = ["key", "page_id", "file", "offset"]
    blocks = captures.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(pack, "b binary")
    blocks.select(F.col("b").cast("string").alias("value")).write.mode("overwrite").text(
        f"{index}/blocks", lineSep="\0"
    )

    def fences(batches):
        ranges = _Ranges(f"{index}/blocks")
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with ranges.stream(file) as stream:
                    rows = [
                        (lines[: lines.index(b"\t")].decode()[:FENCE], file, offset, length)
                        for offset, length, lines in _members(stream)
                    ]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["fence", "file", "offset", "length"])

    directory = _files(spark, f"{index}/blocks").mapInArrow(
        fences, "fence string, file string, offset long, length long"
    )
    directory.write.mode("overwrite").parquet(f"{index}/directory")


class _Ranges:
    """Byte ranges of the files in a folder, on any file system that Arrow knows."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))
        self.name = self.file = None
        self.begin, self.held = 0, b""

    def stream(self, name: str):
        """A whole file, to be read from its start."""
        return self.fs.open_input_stream(f"{self.folder}/{name}", buffer_size=STEP)

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.file, self.name, self.held = self.fs.open_input_file(f"{self.folder}/{name}"), name, b""
        if not self.begin <= offset or offset + length > self.begin + len(self.held):
            self.begin, self.held = offset, self.file.read_at(max(length, WINDOW), offset)
        return self.held[offset - self.begin : offset - self.begin + length]


def lookup(keys: DataFrame, index: str) -> DataFrame:
    """Captures of each distinct ``key``; a key without captures gives no row."""
    spark = keys.sparkSession
    directory = spark.read.parquet(f"{index}/directory").collect()  # at most DIRECTORY rows and one per shard
    directory.sort(key=lambda r: (r["fence"].encode(), r["file"], r["offset"]))
    fences = [r["fence"].encode() for r in directory]
    places = [(r["file"], r["offset"], r["length"]) for r in directory]
    shared = spark.sparkContext.broadcast((fences, places))

    def search(batches):
        first, _ = shared.value
        for batch in batches:
            found, blocks = [], []
            for key in batch.column(0).to_pylist():
                low = bisect_left(first, key[:FENCE].encode()) - 1
                for block in range(max(0, low), bisect_right(first, key[:FENCE].encode())):
                    found.append(key)
                    blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(blocks, pa.int64())], names=["key", "block"])

    def read(batches):
        _, place = shared.value
        ranges, held, keys_of, lines = _Ranges(f"{index}/blocks"), None, [], []
        for batch in batches:
            rows = []
            for key, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != held:
                    text = next(_members(io.BytesIO(ranges.read(*place[block]))))[2]
                    lines = [line.split(b"\t") for line in text.split(b"\n")]
                    held, keys_of = block, [line[0] for line in lines]
                wanted = key.encode()
                for at in range(bisect_left(keys_of, wanted), bisect_right(keys_of, wanted)):
                    _, page, file, offset, length = lines[at]
                    rows.append((key, int(page) if page else None, file.decode(), int(offset), int(length)))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else ([],) * 5
            names = ["key", "page_id", "file", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    wanted = keys.select("key").where("key is not null").distinct()
    at = wanted.mapInArrow(search, "key string, block long")
    return at.repartition("block").sortWithinPartitions("block", "key").mapInArrow(read, CAPTURE)


def read_records(captures: DataFrame, archives: str, payload: bool = True) -> DataFrame:
    """The records of captures, read by byte range; ``payload`` is null for revisits.

    Digest and length are those of the full payload: measured for a response, and compared with its
    header, and taken from the header of a revisit.
    """
    schema = RECORD + (", payload binary" if payload else "")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches):
        ranges = _Ranges(archives)
        for batch in batches:
            rows, held = [], 0
            for place in zip(*(c.to_pylist() for c in batch.columns)):
                record = next(_members(io.BytesIO(ranges.read(*place))))[2]
                fields, data = _parse(record)
                size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].partition(":")[2]
                if fields["WARC-Type"] == "response" and (len(data), hashlib.sha256(data).hexdigest()) != (size, digest):
                    raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
                rows.append(
                    (
                        _number(fields.get("X-Page-ID")), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                        _number(fields.get("X-Refers-To-Page-ID")), size, digest,
                        data if fields["WARC-Type"] == "response" else None,
                    )[: len(names)]
                )
                held += len(data)
                if payload and held > WINDOW:
                    yield table(rows)
                    rows, held = [], 0
            yield table(rows)

    def table(rows):
        columns = zip(*rows) if rows else ([],) * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    near = captures.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, schema)
