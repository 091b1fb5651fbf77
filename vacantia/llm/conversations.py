"""Repair of conversation structure by Knuth's lightest derivation.

The rows of a conversation, in order of turn, are to be edited at least cost until the initials of their roles
read ``(s?(ua)+)?``. What has been put out so far is one of four states. An item ``(i, state)`` says that the rows
from the i-th on can be finished from that state; a deduction puts one edit before a finished item. Its weight, cost
and then audit (the initials of the edits), grows with the item's, so items leave the agenda in order of their
lightest weight, and each is final when it leaves it.

1. What decides is small: the order of a row, the initial of its role, its first fault. These rows are dealt out by
   ranges of conversation and turn, so a conversation of any length is spread over tasks, and cut into
   chunks of at most ``CHUNK`` rows. Rows that repeat an earlier one of their conversation are found by an aggregate.
2. A conversation that lies in one chunk is repaired there. Of any other, each chunk gives the least costs
   from every state to every state; chained from the end they tell each chunk what finishing costs after it. With
   these as axioms, each chunk derives its part of the audit from all four states, and the parts are
   put together from the first on. Parts end in the edit of a row and no audit is reached in two ways, so
   the least part is part of the least audit.
3. Texts move once, to be read beside their conversation's audit in order, as a stream that holds one row.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.registry import stored
from vacantia.session import work_dir

#: Most rows of a chunk.
CHUNK = 1_024
# --- fixed values: costs of the edits, and white space ----------------------------------------------
RETYPE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
SPACE = " \t\n\x0b\f\r"

#: States: nothing put out, a system row, a user's row last, an assistant's row last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: By what is put out: pairs of the state before and after.
STEPS = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
#: What it takes to finish after the last row: insertions only.
FINISH = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
INITIALS = "?sua"


def derive(codes: bytes, finish: dict[int, int], goals=(START,), audited: bool = True) -> dict[int, tuple]:
    """``state: (cost, audit, state after)`` of the lightest derivation of every goal ``(0, state)``.

    ``codes`` has a byte for each row, its place in INITIALS and four times its fault. ``finish`` gives
    the axioms, what the items after the last row weigh. Without ``audited`` only costs are told apart.
    """
    rows = len(codes)
    agenda = [(cost, "", rows, state, state) for state, cost in finish.items()]
    heapq.heapify(agenda)
    final, found, wanted = set(), {}, set(goals)
    while agenda and wanted:
        cost, audit, at, state, after = heapq.heappop(agenda)
        if (at, state) in final:
            continue
        final.add((at, state))
        if not at and state in wanted:
            wanted.remove(state)
            found[state] = (cost, audit, after)

        def deduce(price, letter, place, before):
            if (place, before) not in final:
                heapq.heappush(agenda, (cost + price, letter + audit if audited else "", place, before, after))

        if at < rows:
            for put in "ua":
                for before, then in STEPS[put]:
                    if then == state:
                        deduce(INSERT, "I", at, before)
        if at:
            initial, fault = INITIALS[codes[at - 1] & 3], codes[at - 1] >> 2
            deduce(DELETE, "D", at - 1, state)
            if fault not in (BLANK, DUPLICATE):
                more = UNFINISHED if fault == TRUNCATED else 0
                for before, then in STEPS.get(initial, ()):
                    if then == state:
                        deduce(more, "K", at - 1, before)
                for put in "ua":
                    for before, then in STEPS[put]:
                        if then == state:
                            deduce(RETYPE + more, "R", at - 1, before)
    return found


def costs(codes: bytes) -> list[int]:
    """Least costs from every state to every state, row by row; -1 where there is no way."""
    out = [[-1] * 4 for _ in STATES]
    for after in STATES:
        for before, (cost, *_) in derive(codes, {after: 0}, STATES, audited=False).items():
            out[before][after] = cost
    return [c for row in out for c in row]


def keyed(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, mark``: nulls are one space, but a null turn stays; ``mark`` is a digest of the row."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        text("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")
    )
    return rows.withColumn("mark", F.md5(F.concat_ws("\u0000", "role", "text").cast("binary")))


ORDER = ["conv", "turn", "role", "mark"]

_CHUNK = pa.schema(
    [
        ("conv", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("codes", pa.binary()),
        ("costs", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string()), ("from_turn", pa.int64()),
        ("to_turn", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ]
)
_CHUNK_TYPE = (
    "conv string, part int, seq int, whole boolean, codes binary, costs array<long>, first string, last string, "
    "from_turn long, to_turn long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)
RESULT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_RESULT = pa.schema(
    [("conv", pa.string()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]
)


def _chunk(conv, part, seq, turns: list, codes: bytes) -> dict:
    known = [t for t in turns if t is not None]
    initials = [INITIALS[c & 3] for c in codes]
    count = lambda fault: sum(c >> 2 == fault for c in codes)
    return {
        "conv": conv, "part": part, "seq": seq, "whole": False, "codes": codes, "costs": None,
        "first": initials[0], "last": initials[-1],
        "from_turn": known[0] if known else None, "to_turn": known[-1] if known else None, "turns": len(set(known)),
        "blank": count(BLANK), "duplicate": count(DUPLICATE), "truncated": count(TRUNCATED),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "cost": None, "audit": None,
    }


def _chunks(batches, most: int):
    """Chunks of sorted rows; a conversation that may go on in another task, or is long, keeps its codes."""
    part, made = TaskContext.get().partitionId(), []
    conv, turns, codes, seq, edge = None, [], bytearray(), 0, True

    def close(last: bool):
        nonlocal turns, codes
        chunk = _chunk(conv, part, seq, turns, bytes(codes))
        if last and not edge and not seq:
            cost, audit, after = derive(chunk["codes"], FINISH)[START]
            chunk |= {"whole": True, "codes": None, "cost": cost, "audit": audit + "I" * (FINISH[after] // INSERT)}
        else:
            chunk["costs"] = costs(chunk["codes"])
        turns, codes = [], bytearray()
        made.append(chunk)

    for batch in batches:
        for own, turn, code in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if codes and own != conv:
                close(True)
                edge, seq = False, 0
            elif len(codes) == most:
                close(False)
                seq += 1
            conv = own
            turns.append(turn)
            codes.append(code)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_CHUNK)
            made.clear()
    if codes:
        edge = True  # it may go on in the next task
        close(True)
        yield pa.RecordBatch.from_pylist(made, schema=_CHUNK)


def _finishes(key, rows):
    """What finishing costs after each chunk of a conversation, chained from its end."""
    chunks = sorted(rows.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    after, out = [FINISH[s] for s in STATES], []
    for chunk in reversed(chunks):
        out.append({"conv": chunk["conv"], "part": chunk["part"], "seq": chunk["seq"], "finish": after})
        way = [chunk["costs"][4 * s : 4 * s + 4] for s in STATES]
        after = [min(c + a for c, a in zip(way[s], after) if c >= 0 and a >= 0) if any(c >= 0 and a >= 0 for c, a in zip(way[s], after)) else -1 for s in STATES]
    schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("finish", pa.list_(pa.int64()))])
    return pa.Table.from_pylist(out, schema=schema)


def _parts(batches):
    """Each chunk's part of the audit from every state, and the state after it."""
    for batch in batches:
        kept = [n for n in batch.schema.names if n not in ("codes", "finish")]
        parts = []
        for codes, finish in zip(batch.column("codes").to_pylist(), batch.column("finish").to_pylist()):
            found = derive(codes, {s: c for s, c in zip(STATES, finish) if c >= 0}, STATES)
            parts.append([{"cost": f[0], "audit": f[1], "after": f[2]} if (f := found.get(s)) else None for s in STATES])
        part = pa.array(parts, pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("after", pa.int32())])))
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), part], names=[*kept, "parts"])


def _joined(key, rows):
    """The audit of a conversation from its parts, and its counts across chunks."""
    chunks = sorted(rows.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    state, audit = START, []
    for chunk in chunks:
        audit.append(chunk["parts"][state]["audit"])
        state = chunk["parts"][state]["after"]
    total = {n: sum(c[n] for c in chunks) for n in ("blank", "duplicate", "truncated", "illegal")}
    total["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(chunks, chunks[1:]))
    known = [c for c in chunks if c["turns"]]
    distinct = sum(c["turns"] for c in known) - sum(a["to_turn"] == b["from_turn"] for a, b in zip(known, known[1:]))
    gaps = known[-1]["to_turn"] - known[0]["from_turn"] + 1 - distinct if known else 0
    row = {"conv": chunks[0]["conv"], "gaps": gaps, **total, "cost": chunks[0]["parts"][START]["cost"]}
    return pa.Table.from_pylist([row | {"audit": "".join(audit) + "I" * (FINISH[state] // INSERT)}], schema=_RESULT)


def audits(conversations: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation that has rows.

    Rows are ordered by turn, null first, then by role and a digest of the text; equal rows are alike, so their
    order does not matter. A null role or text counts as one space, so that text is blank, and so does a
    null ``conv_id``, whose rows form one conversation. A role is known by its first letter, s, u or a; others can
    only be retyped or deleted. Other columns are ignored; an empty table gives an empty one.
    """
    spark = conversations.sparkSession
    folder = work_dir(spark, "conversations")
    inner = F.rtrim("text", F.lit(SPACE))
    initial = F.greatest(F.lit(0), F.instr(F.lit(INITIALS[1:]), F.substring("role", 1, 1)))
    initial = F.when(F.col("role") == "", 0).otherwise(initial)
    fault = F.when(inner == "", BLANK).when(~F.substring(inner, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    rows = keyed(conversations).select(*ORDER, initial.alias("initial"), fault.alias("fault"), F.xxhash64(F.monotonically_increasing_id()).alias("spread"))
    rows = stored(rows, f"{folder}/rows")  # without texts
    first = rows.groupBy(F.col("conv").alias("of"), F.col("mark").alias("marked")).agg(
        F.min(F.struct("turn", "spread")).alias("first"), F.count("*").alias("times")
    )
    first = first.where("times > 1").drop("times")
    met = rows.join(first, (rows["conv"] == first["of"]) & (rows["mark"] == first["marked"]), "left")
    repeated = F.col("first").isNotNull() & (F.col("first") != F.struct("turn", "spread"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.coalesce(repeated, F.lit(False)), DUPLICATE).otherwise(F.col("fault"))
    coded = met.select(*ORDER, "spread", (F.col("initial") + 4 * fault).cast("int").alias("code"))
    order = [*ORDER, "spread"]
    dealt = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "code")
    most = CHUNK
    chunks = stored(dealt.mapInArrow(lambda batches: _chunks(batches, most), _CHUNK_TYPE), f"{folder}/chunks")
    names = [n.split()[0] for n in RESULT.split(", ")]
    gaps = F.when(F.col("turns") > 0, F.col("to_turn") - F.col("from_turn") + 1 - F.col("turns")).otherwise(0)
    whole = chunks.where("whole").withColumn("gaps", gaps.cast("long")).select(names)
    long = chunks.where("NOT whole")
    ends = long.select("conv", "part", "seq", "costs").groupBy("conv").applyInArrow(
        _finishes, "conv string, part int, seq int, finish array<long>"
    )
    counts = ["first", "last", "from_turn", "to_turn", "turns", "blank", "duplicate", "truncated", "illegal"]
    asked = long.select("conv", "part", "seq", *counts, "codes").join(ends, ["conv", "part", "seq"])
    kinds = [f"{n} {long.schema[n].dataType.simpleString()}" for n in ["conv", "part", "seq", *counts]]
    parts = asked.mapInArrow(_parts, ", ".join([*kinds, "parts array<struct<cost: long, audit: string, after: int>>"]))
    return stored(whole.union(parts.groupBy("conv").applyInArrow(_joined, RESULT).select(names)), f"{folder}/audits")


class _Replay:
    """Walks through the rows of one conversation by its audit: what comes out, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _put(self, initial: str) -> str:
        self.state = next(then for before, then in STEPS[initial] if before == self.state)
        return {"s": "system", "u": "user", "a": "assistant"}[initial]

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put("a" if self.state == USER else "u"), ""

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._put(role[0])
            yield role, text
        elif edit == "R":
            yield self._put("a" if self.state == USER else "u"), text


def _replayed(conversations: DataFrame, found: DataFrame, schema: pa.Schema, kind: str, each) -> DataFrame:
    """Rows that ``each`` makes of a conversation's rows as they come out, read in order as a stream."""
    rows = keyed(conversations).select(*ORDER, "text", F.lit(None).cast("string").alias("audit"))
    heads = found.select("conv", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("mark"), F.lit(None).cast("string").alias("text"), "audit")
    both = rows.union(heads).withColumn("is_row", F.col("audit").isNull())
    both = both.repartition("conv").sortWithinPartitions("conv", "is_row", "turn", "role", "mark")

    def run(batches):
        walk, out, conv = None, [], None
        for batch in batches:
            for own, role, text, audit in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if audit is not None:
                    if walk:
                        out += each.end(conv, walk)
                    walk, conv = _Replay(audit), own
                    each.begin()
                else:
                    out += each.rows(conv, walk.row(role, text))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)
            out = []
        if walk:
            out += each.end(conv, walk)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

    return both.select("conv", "role", "text", "audit").mapInArrow(run, kind)


class _Digest:
    def begin(self):
        self.hash, self.some = hashlib.sha256(), False

    def rows(self, conv, made):
        for role, text in made:
            self.hash.update(("\n" if self.some else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.some = True
        return []

    def end(self, conv, walk):
        self.rows(conv, walk.inserted())
        return [(conv, self.hash.hexdigest())]


class _Rows:
    def begin(self):
        self.count = 0

    def rows(self, conv, made):
        out = []
        for role, text in made:
            out.append((conv, self.count, role, text))
            self.count += 1
        return out

    def end(self, conv, walk):
        return self.rows(conv, walk.inserted())


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, position, role, text``: the repaired conversations, of the rows and their :func:`audits`."""
    schema = pa.schema([("conv", pa.string()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    return _replayed(conversations, found, schema, "conv string, position long, role string, text string", _Rows())


def digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: of ``role:text`` of each repaired conversation, joined by line feeds."""
    schema = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    return _replayed(conversations, found, schema, "conv string, repaired_sha256 string", _Digest())


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated and retyped by a hash of conversation and turn; all nulls but turns are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate"))
    rows = rows.where("fate <> 0").withColumn("text", F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))
    times = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", "role", "text", times.alias("time")).drop("time")


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Every ``conv_id`` of ``conversations`` with what it takes to repair ``rows``, its rows after damage; zeros if there are none."""
    found = audits(rows)
    found = found.join(digests(rows, found), "conv")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    ids = ids.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    met = ids.join(found, "conv", "left")
    nothing = {n: F.coalesce(n, F.lit(0).cast("long")) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing |= {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return met.withColumns(nothing).select("conv_id", *nothing)
