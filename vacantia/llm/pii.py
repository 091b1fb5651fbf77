"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton finds at-signs, schemes, plus signs, digits and words that
announce an identifier. From each anchor a small parser expands to both sides and checks what it got.
A parser never looks at a character twice from two anchors of its kind, so a text costs linear time.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` have exact definitions (see the parsers), each
leftmost and non-overlapping within its kind. Added by the cues: ``login``, an address with user
information before its host, and ``account``, the value given after a word like ``password`` or
``iban`` with ``=``, ``:`` or ``#`` between.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vacantia.llm.registry import map_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "account")
#: Words that announce an identifier, in these three spellings: lower, title and upper case.
CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "account", "acct", "iban", "ssn", "passport")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
SCHEME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
THREE_PARTS = re.compile(r"\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+")
USER_HOST = re.compile(r"[^\s/?#@:]+(?::[^\s/?#@]*)?@[A-Za-z0-9.-]+")
VALUE = re.compile(r"\s{0,2}[=:#]\s{0,2}[\"']?([A-Za-z0-9][A-Za-z0-9_-]{7,})")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@cache
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for cue in CUES:
        for spelt in (cue, cue.title(), cue.upper()):
            found.add_word(spelt, ("cue", len(spelt)))
    for mark in ("@", "://", "+", *"0123456789"):
        found.add_word(mark, ("digit" if mark.isdigit() else mark, len(mark)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (exclusive) of everything found, by kind and then place."""
    email_end = at_sign = run_end = ip_end = chain_end = login_end = account_end = 0
    found = []
    for last, (anchor, width) in _anchors().iter(text):
        start, end = last - width + 1, last + 1
        if anchor == "digit":
            if start >= run_end:
                run_end = DIGITS.match(text, start).end()
                # four numbers between dots, none above 255
                if start >= ip_end and (m := THREE_PARTS.match(text, run_end)):
                    ip_end = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in (text[start:run_end], *m.groups())):
                        found.append(("ip", start, ip_end))
            if start >= chain_end and (m := CHAIN.match(text, start)):
                # digits with at most one space or hyphen between: 16 to 19 of them, valid by Luhn's rule
                chain_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", start, chain_end))
        elif anchor == "@":
            before = text[max(at_sign, email_end) : start]
            begin = start - len(before) + len(before.rstrip(LOCAL))
            at_sign = end
            if begin < start and (m := DOMAIN.match(text, end)):
                email_end = m.end()
                found.append(("email", begin, email_end))
        elif anchor == "+":
            if m := DIALLED.match(text, start):
                number = m[0].rstrip(" ().-")
                if len(number) >= 4 and 8 <= sum(c.isdigit() for c in number) <= 15:
                    found.append(("phone", start, start + len(number)))
        elif anchor == "://":
            before = text[max(login_end, start - 32) : start]
            begin = start - len(before) + len(before.rstrip(SCHEME))
            if begin < start and text[begin].isalpha() and (m := USER_HOST.match(text, end)):
                login_end = m.end()
                found.append(("login", begin, login_end))
        elif not (start and text[start - 1].isalnum()) and (m := VALUE.match(text, end)):
            if m.start(1) >= account_end and any(c.isdigit() for c in m[1]):
                account_end = m.end(1)
                found.append(("account", m.start(1), account_end))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by the kind of its first one."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += (text[at:start], f"[{kind.upper()}]")
        at = max(at, end)
    return "".join((*parts, text[at:]))


def find(df: DataFrame, text: str = "text", spans: str = "spans", keep: list[str] | None = None) -> DataFrame:
    """Add ``spans``: kind, start and end of personal data in the whole text, in code points.

    A null or empty text has none. The columns ``keep`` are kept, all by default; one already named
    ``spans`` is replaced. Repeated rows are found alike, and an empty table stays empty.
    """

    def start():
        def work(texts):
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t.as_py() or "")] for t in texts]
            return [pa.array(rows, _SPANS)]

        return work, lambda: None

    return map_batches(df, [text], {spans: SPANS}, start, keep)


def mask(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace personal data in ``text`` by the names of its kinds; a null text stays null."""

    def start():
        def work(texts):
            values = (t.as_py() for t in texts)
            return [pa.array([None if t is None else masked(t, find_spans(t)) for t in values], pa.string())]

        return work, lambda: None

    return map_batches(df, [text], {text: T.StringType()}, start).select(df.columns)
