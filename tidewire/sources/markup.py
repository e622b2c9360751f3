"""The items of a feed file as the elements that stand directly in them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewire.storage import importable

ITEMS = ("item", "entry")
#: Elements that only group others of an item.
GROUPS = ("media:group",)
#: Namespaces and the prefix that stands for each, whatever a file calls it.
PREFIXES = {
    "http://www.w3.org/2005/atom": "", "http://purl.org/rss/1.0/": "", "http://my.netscape.com/rdf/simple/0.9/": "", "http://purl.org/rss/1.0/modules/content/": "content",
    "http://purl.org/dc/elements/1.1/": "dc", "http://purl.org/dc/terms/": "dcterms", "http://search.yahoo.com/mrss/": "media", "http://search.yahoo.com/mrss": "media", "http://arxiv.org/schemas/atom": "arxiv",
}
PROLOG = re.compile(rb"^\s*<\?xml[^>]*?\bencoding\s*=\s*[\"']([A-Za-z0-9._-]+)")
#: Names of encodings that are often given for a larger one.
LARGER = {"gb2312": "gb18030", "gbk": "gb18030"}
ELEMENT = "struct<name:string,text:string,attrs:map<string,string>>"
_COMMENT = re.compile(r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?(?:-->|$)")
_CDATA = re.compile(r"(?s)<!\[CDATA\[(.*?)(?:\]\]>|$)")
_FRAGMENT = re.compile(r"(?is)<(item|entry)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|(?=<\1\b)|$)")


def as_text(b: bytes) -> str:
    """Content in the encoding that its byte order mark or its prolog names, else in UTF-8."""
    named = PROLOG.match(b[:200])
    kind = "utf-16" if b[:2] in (b"\xff\xfe", b"\xfe\xff") else named[1].decode().lower() if named else "utf-8"
    try:
        return b.decode(LARGER.get(kind, kind), "replace")
    except LookupError:  # no encoding of that name
        return b.decode("utf-8", "replace")


class _Reader:
    """Collects items from the events of a parser. An element directly in an item is (name, text,
    attributes); what stands deeper is markup in that text."""

    def __init__(self, known: dict[str, str]) -> None:
        self.items: list[list[tuple[str, str, dict]]] = []
        self.path: list[str] = []
        self.depth: int | None = None  # of the item that is open
        self.own: list[str] | None = None
        self.known = dict(known)

    def _name(self, name: str) -> str:
        prefix, _, local = name.lower().rpartition(":")
        prefix = self.known.get(prefix, prefix)
        return f"{prefix}:{local}" if prefix else local

    def start(self, name: str, attrs: dict[str, str]) -> None:
        for k, uri in attrs.items():
            if k.startswith("xmlns") and (uri or "").lower() in PREFIXES:
                self.known[k[6:].lower()] = PREFIXES[uri.lower()]
        name = self._name(name)
        self.path.append(name)
        attrs = {k.lower(): v or "" for k, v in attrs.items() if not k.startswith("xmlns")}
        if self.depth is None:
            if name in ITEMS:
                self.depth = len(self.path)
                self.items.append([])
        elif self.own is not None:
            self.own.append(f"<{name.rpartition(':')[2]}{''.join(f' {k}=\"{escape(v)}\"' for k, v in attrs.items())}>")
        elif name not in GROUPS:
            self.own = []
            self.items[-1].append((name, "", attrs))

    def end(self, name: str) -> None:
        name = self._name(name)
        if name not in self.path:  # closes what was never opened
            return
        while self.path.pop() != name:
            self._left()
        self._left(name)

    def _left(self, name: str | None = None) -> None:
        """An element has ended, after which `path` holds those around it."""
        if self.depth is None:
            return
        level = len(self.path) + 1 - self.depth - sum(p in GROUPS for p in self.path[self.depth :])
        if level <= 0:
            self._close()
            self.depth = None
        elif level == 1:
            self._close()
        elif name and self.own is not None:
            self.own.append(f"</{name.rpartition(':')[2]}>")

    def _close(self) -> None:
        if self.own is not None:
            last, _, attrs = self.items[-1][-1]
            self.items[-1][-1] = (last, "".join(self.own).strip(), attrs)
            self.own = None

    def text(self, data: str) -> None:
        if self.own is not None:
            self.own.append(data if self._plain() else escape(data, quote=False))

    def _plain(self) -> bool:
        return len(self.path) - self.depth - sum(p in GROUPS for p in self.path[self.depth :]) <= 1


def _strict(text: str, known: dict[str, str]) -> tuple[_Reader, str | None]:
    """What a parser of well-formed XML finds, and its complaint. `known` are prefixes from around."""
    reader, parser = _Reader(known), expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = reader.start, reader.end, reader.text
    try:
        parser.Parse(text, True)
    except expat.ExpatError as e:
        return reader, str(e)[:200]
    return reader, None


class _Lenient(HTMLParser):
    """Reads what is no XML: stray `<` and `&`, names of HTML entities, elements left open."""

    def __init__(self, reader: _Reader):
        super().__init__(convert_charrefs=True)
        self.handle_data, self.handle_endtag = reader.text, reader.end
        self.handle_starttag = lambda tag, attrs: reader.start(tag, dict(attrs))
        self.handle_startendtag = lambda tag, attrs: (reader.start(tag, dict(attrs)), reader.end(tag))

    def set_cdata_mode(self, *args, **kw) -> None:
        """No element of a feed holds raw text."""


def _recovered(fragment: str, known: dict[str, str]) -> list:
    reader = _Reader(known)
    lenient = _Lenient(reader)
    lenient.feed(_CDATA.sub(lambda m: escape(m[1], quote=False), fragment))
    lenient.close()
    while reader.path:
        reader.end(reader.path[-1])
    return reader.items[:1]


def items_of(text: str) -> tuple[list, str | None]:
    """(items, complaint) of a feed. Where the whole is no XML, each item is read by itself, and only
    those that are no XML either are read leniently, so one that is broken costs no other."""
    reader, fault = _strict(text, {})
    if fault is None:
        return reader.items, None
    out = []
    for m in _FRAGMENT.finditer(_COMMENT.sub(lambda m: m[1] or "", text)):
        own, broken = _strict(m[0], reader.known)
        out += own.items if broken is None else _recovered(m[0], reader.known)
    return out, fault


def read_items(files: DataFrame) -> DataFrame:
    """(source_id, items, fault) of (source_id, content): an array of items, each an array of its
    elements, and why the file is no XML, null if it is. Content that is null or empty has no items.
    A file is in memory while it is read, MAX_BYTES at most."""
    importable(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.struct([("name", pa.string()), ("text", pa.string()), ("attrs", pa.map_(pa.string(), pa.string()))])))
        for batch in batches:
            for source, content in zip(batch.column("source_id"), batch.column("content")):
                found, fault = items_of(as_text(content.as_py())) if content.is_valid else ([], None)
                rows = [[{"name": n, "text": t, "attrs": list(a.items())} for n, t, a in item] for item in found]
                yield pa.record_batch([pa.array([source.as_py()], pa.string()), pa.array([rows], kind), pa.array([fault], pa.string())], ["source_id", "items", "fault"])

    return files.select("source_id", "content").mapInArrow(read, f"source_id string, items array<array<{ELEMENT}>>, fault string")
