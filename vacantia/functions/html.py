"""HTML as an array of nodes per row, and selectors over that array.

A page is parsed once per row, next to its row, so no selector needs a shuffle. Nodes are numbered
in document order; ``last`` is the number of the last node inside, hence "inside" is a range test.
Text is a node with tag ``#text``.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.entities import name2codepoint

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Ship this module's functions with the job instead of expecting them on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = (
    "array<struct<no:int,parent:int,last:int,nth:int,tag:string,"
    "id:string,class:string,href:string,text:string>>"
)
TEXT = "#text"

# --- fixed values: HTML element rules -----------------------------------------------------------
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
RAW_TEXT = {"script", "style"}
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"td", "th", "tr", "p"},
    "tbody": {"td", "th", "tr", "thead", "tbody"},
    **{t: {"p"} for t in (
        "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
        "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
        "section", "table", "ul")},
}
# From weak to strong: an end tag does not close an open element that is stronger. Others are weakest.
STRENGTH = (("div",), ("td", "th"), ("tr",), ("thead", "tbody", "tfoot"), ("table",), ("head", "body"), ("html",))
RANK = {tag: rank for rank, tags in enumerate(STRENGTH, start=1) for tag in tags}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*'){0,2000}+)>"
    r"|<[!?/][^>]*>",
    re.S,
)
# A start tag whose quotes do not close, or with more quotes than any tag has, ends at the next ">".
UNQUOTED = re.compile(r"<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>[^>]*)>")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


ENTITY = re.compile(r"&(?:#[xX]([0-9a-fA-F]+);?|#([0-9]+);?|([a-zA-Z][a-zA-Z0-9]*);)")


def _entity(match):
    hexadecimal, decimal, name = match.groups()
    if name:
        code = 39 if name == "apos" else name2codepoint.get(name)
        return match[0] if code is None else chr(code)
    digits = (hexadecimal or decimal).lstrip("0") or "0"
    if len(digits) > 7:
        return ""
    code = int(digits, 16 if hexadecimal else 10)
    control = code < 32 and code not in (9, 10, 13)
    return "" if control or code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def decoded(text):
    """Text with HTML 4 entities decoded. A name must end in ``;`` to count, a number need not."""
    return ENTITY.sub(_entity, text) if "&" in text else text


NO_ATTRIBUTES = (None, None, None)


def _attributes(text):
    found = {}
    for name, value in ATTRIBUTE.findall(text):
        name = name.lower()
        if name in ("id", "class", "href") and name not in found:
            found[name] = decoded(value[1:-1] if value[:1] in "\"'" else value)
    return found


def _next_token(page: str, at: int, last_end: int):
    """The next tag or comment; ``<`` signs that begin none are text, as is all that no ``>`` follows."""
    while (at := page.find("<", at)) >= 0:
        token = TOKEN.match(page, at) if at < last_end or page.startswith("<!--", at) else None
        if token is None and at < last_end:
            token = UNQUOTED.match(page, at)
        if token or at > last_end:
            return token
        at += 1
    return None


class _Open:
    """The open elements, and where the topmost of every tag and of every strength is."""

    def __init__(self):
        self.stack, self.of_tag, self.of_rank = [], {}, [[] for _ in range(len(STRENGTH) + 1)]

    def push(self, no: int, tag: str) -> None:
        self.of_tag.setdefault(tag, []).append(len(self.stack))
        if tag in RANK:
            self.of_rank[RANK[tag]].append(len(self.stack))
        self.stack.append((no, tag))

    def pop(self) -> int:
        no, tag = self.stack.pop()
        self.of_tag[tag].pop()
        if tag in RANK:
            self.of_rank[RANK[tag]].pop()
        return no

    def closed_by(self, tag: str) -> int:
        """How many elements an end tag closes."""
        if self.stack and self.stack[-1][1] == tag:
            return 1
        if not self.of_tag.get(tag):
            return 0
        place = self.of_tag[tag][-1]
        stronger = self.of_rank[RANK.get(tag, 0) + 1 :]
        return 0 if any(p and p[-1] > place for p in stronger) else len(self.stack) - place


def parse(page: str) -> list[list]:
    """Nodes of one page, as rows in the order of the ``NODES`` fields. Takes time linear in the page."""
    nodes, opened, siblings = [], _Open(), {}
    stack, last_end = opened.stack, page.rfind(">")

    def add(tag, attrs, text):
        parent = stack[-1][0] if stack else -1
        nth = siblings[parent, tag] = siblings.get((parent, tag), 0) + 1
        no = len(nodes)
        found = (attrs.get("id"), attrs.get("class"), attrs.get("href")) if attrs else NO_ATTRIBUTES
        nodes.append([no, parent, no, nth, tag, *found, text])
        return no

    def close():
        nodes[opened.pop()][2] = len(nodes) - 1

    def add_text(text, joined):
        if not text:
            return
        if joined and nodes[-1][4] == TEXT:
            nodes[-1][8].append(text)
        else:
            add(TEXT, {}, [text])

    at, joined = 0, False
    while True:
        token = _next_token(page, at, last_end)
        stop = token.start() if token else len(page)
        if stop > at:
            add_text(decoded(page[at:stop]), joined)
            joined = bool(nodes)
        if token is None:
            break
        at, kind = token.end(), token.lastgroup
        if kind == "attrs":
            joined = False
            tag, attrs = token["start"].lower(), token["attrs"]
            ended = ENDED_BY.get(tag, ())
            while ended and stack and stack[-1][1] in ended:
                close()
            no = add(tag, _attributes(attrs) if attrs else {}, None)
            if tag in RAW_TEXT:
                end = re.compile(f"</{tag}", re.I).search(page, at)
                stop = end.start() if end else len(page)
                opened.push(no, tag)
                add_text(page[at:stop], False)
                close()
                tail = page.find(">", stop)
                at = tail + 1 if end and tail >= 0 else len(page)
            elif tag not in VOID and not (attrs and SELF_CLOSED.search(attrs)):
                opened.push(no, tag)
        elif kind == "end":
            count = opened.closed_by(token["end"].lower())
            if count:
                joined = False
            for _ in range(count):
                close()
        else:
            joined = False
    while stack:
        close()
    for node in nodes:
        if node[8] is not None:
            node[8] = "".join(node[8])
    return nodes


NAMES = ["no", "parent", "last", "nth", "tag", "id", "class", "href", "text"]
#: Nodes, and characters of pages, that are held as Python objects before they go on as Arrow.
CHUNK, CHUNK_CHARS = 10_000, 1 << 20


def _as_array(pages: list[list[list]]) -> pa.Array:
    offsets = [0]
    for found in pages:
        offsets.append(offsets[-1] + len(found))
    columns = list(zip(*(row for found in pages for row in found))) or [()] * len(NAMES)
    arrays = [pa.array(c, pa.int32() if i < 4 else pa.string()) for i, c in enumerate(columns)]
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, names=NAMES)
    )


def _parse_batch(pages: pa.Array) -> Iterator[pa.Array]:
    """Parse a batch. Nodes go on every ``CHUNK`` nodes or ``CHUNK_CHARS`` characters, so a batch's are never held together."""
    pending, size, chars = [], 0, 0
    for page in pages:
        text = page.as_py()
        found = parse(text) if text else []
        pending.append(found)
        size, chars = size + len(found), chars + len(text or "")
        if size >= CHUNK or chars >= CHUNK_CHARS or len(pending) >= CHUNK:
            yield _as_array(pending)
            pending, size, chars = [], 0, 0
    if pending:
        yield _as_array(pending)


def nodes(page: Column) -> Column:
    """The nodes of an HTML text; give them a name before they are used more than once.

    Spark takes them for nondeterministic, so a filter on what is made of them (an explode infers one) stays
    above and does not parse every page a second time in a worker of its own.
    """

    @F.arrow_udf(NODES)
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield from _parse_batch(pages)

    return parsed.asNondeterministic()(page)


def has_class(name: str):
    """Class attribute equal to ``name``."""
    return lambda n: F.coalesce(n["class"] == name, F.lit(False))


def class_contains(part: str):
    """Class attribute holding ``part`` anywhere."""
    return lambda n: F.coalesce(n["class"].contains(part), F.lit(False))


def class_other_than(name: str):
    """Class attribute set, and not ``name``."""
    return lambda n: F.coalesce(n["class"] != name, F.lit(False))


def has_id(name: str):
    return lambda n: F.coalesce(n["id"] == name, F.lit(False))


def tagged(tag: str, *tests):
    def test(n):
        result = n["tag"] == tag
        for t in tests:
            result = result & t(n)
        return result

    return test


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once per array element inside ``use``."""
    return F.get(F.transform(F.array(value), use), 0)


def select(nodes: Column, test) -> Column:
    return F.filter(nodes, test)


def below(nodes: Column, anchor: Column) -> Column:
    """Everything inside one node: a run of the array, since nodes are in document order."""
    return F.slice(nodes, anchor["no"] + 2, anchor["last"] - anchor["no"])


def inside(nodes: Column, anchors: Column, test) -> Column:
    """Nodes at any depth below one of the anchors: only what lies below them is looked at."""
    outer = _once(
        anchors,
        lambda found: F.filter(
            found, lambda a: ~F.exists(found, lambda b: (a["no"] > b["no"]) & (a["no"] <= b["last"]))
        ),
    )
    return F.flatten(F.transform(outer, lambda a: F.filter(below(nodes, a), test)))


def children(nodes: Column, anchors: Column, tag: str, nth: int | None = None) -> Column:
    """Direct children with a tag, or only the ``nth`` of that tag."""

    def test(n, anchor):
        hit = (n["parent"] == anchor["no"]) & (n["tag"] == tag)
        return hit if nth is None else hit & (n["nth"] == nth)

    found = F.transform(anchors, lambda a: F.filter(below(nodes, a), lambda n: test(n, a)))
    return F.array_sort(F.flatten(found))  # nested anchors: back to document order


def _joined(texts: Column, separator: str) -> Column:
    return F.array_join(F.transform(texts, lambda n: n["text"]), separator)


def is_text(n: Column) -> Column:
    return n["tag"] == TEXT


def text_of(nodes: Column, anchors: Column, separator: str = "") -> Column:
    """Text below any of the anchors, in document order."""
    return _joined(inside(nodes, anchors, is_text), separator)


def text_below(nodes: Column, anchor: Column, separator: str = "") -> Column:
    """Text below one node."""
    return _joined(F.filter(below(nodes, anchor), is_text), separator)


def text_of_first(nodes: Column, anchors: Column) -> Column:
    """Text below the first of the anchors, NULL where there is none."""
    return _once(F.get(anchors, 0), lambda a: text_below(nodes, a))


def first_href(anchors: Column) -> Column:
    return F.get(F.filter(F.transform(anchors, lambda a: a["href"]), lambda h: h.isNotNull()), 0)


def visible_text(nodes: Column, separator: str = "") -> Column:
    """All text of a page but scripts and style sheets."""
    hidden = F.filter(nodes, lambda n: n["tag"].isin("script", "style"))
    return _joined(
        _once(
            hidden,
            lambda found: F.filter(
                nodes,
                lambda n: is_text(n) & ~F.exists(found, lambda h: n["parent"] == h["no"]),
            ),
        ),
        separator,
    )


def tag_texts(nodes: Column, tag: str) -> Column:
    """Text of every element with a tag, one array element each."""
    return F.transform(F.filter(nodes, tagged(tag)), lambda a: text_below(nodes, a))
