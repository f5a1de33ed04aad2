"""XML texts as node tables.

Each text is read once, with a stack of its open elements. Beside its own
columns a node carries what the stack knows when it closes: its place in
preorder (subtree_end), its characters in the document's text stream
(start_char, end_char), the tags of its children in order (children), once each
(kids) and of all nodes below it, the ways down to its first children (below,
such as mediaobject/imageobject: the first imageobject of the first
mediaobject), whether text stands in it other than white space (loose), and the
tags of earlier nodes with its identifier (id_before). Rules about the inside
of an element need no join.

Two readers feed the stack: expat, which stops at the first error, and with
recover=True a tokenizer of our own, which closes, drops or opens elements and
goes on; recovery_log tells what it did.

A plan that reads only some columns or tags of the nodes says so to walk_xml,
as Spark cannot tell the reader; together reads equal texts once.

A text is read by one task. Where few files hold many texts, repartition the
table, best before a column with the text is made.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODES = (
    "doc_id string, node_id int, parent_id int, ord int, tag string, attrs map<string,string>, text string, tail string, line int, subtree_end int, path array<string>, error string,"
    " nth int, parent_line int, start_char bigint, end_char bigint, kids array<string>, descendants array<string>, below array<string>, id_before array<string>, children array<string>, loose boolean"
)
_TYPES = {
    "node_id": pa.int32(), "parent_id": pa.int32(), "ord": pa.int32(), "tag": pa.string(), "attrs": pa.map_(pa.string(), pa.string()), "text": pa.string(), "tail": pa.string(), "line": pa.int32(), "subtree_end": pa.int32(), "path": pa.list_(pa.string()),
    "nth": pa.int32(), "parent_line": pa.int32(), "start_char": pa.int64(), "end_char": pa.int64(), "kids": pa.list_(pa.string()), "descendants": pa.list_(pa.string()), "below": pa.list_(pa.string()), "id_before": pa.list_(pa.string()), "children": pa.list_(pa.string()), "loose": pa.bool_(),
}
_OWN = list(_TYPES)
_DDL = {c.split()[0]: c for c in re.split(r",\s*(?![^<>]*>)", NODES)}
_TAG, _TEXT, _TAIL, _LINE, _LAST, _STOP, _KIDS, _INSIDE, _BELOW, _CHILDREN, _LOOSE = map(_OWN.index, ("tag", "text", "tail", "line", "subtree_end", "end_char", "kids", "descendants", "below", "children", "loose"))
#: Steps of the ways in below; rows of a batch; documents, characters and nodes by documents that are looked through for equal texts at once.
STEPS, ROWS, DOCUMENTS, CHARS, CELLS = 3, 50_000, 1 << 16, 1 << 25, 1 << 21
BLANK = " \t\n\r"
LOG = "doc_id string, seq int, line int, problem string, subject string, action string"


class _Open:
    """An open element: its children's tags, their numbers and first nodes by tag, the tags below it, and the way to it."""

    __slots__ = ("children", "counts", "first", "inside", "path")

    def __init__(self, path: tuple[str, ...]) -> None:
        self.children: list[str] = []
        self.counts: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.inside: set[str] = set()
        self.path = path


class Nodes:
    """Rows of nodes in preorder, filled by start, end and data."""

    def __init__(self) -> None:
        self.rows: list[list] = []
        self.stack: list[int] = []
        self.chars = 0
        self._open = [_Open(())]
        self._ids: dict[str, set[str]] = {}  # the tags of the nodes with an identifier
        self._closed: int | None = None  # the node whose tail is read

    def start(self, tag: str, attributes: list[tuple[str, str]], line: int) -> None:
        n, around, before = len(self.rows), self._open[-1], ()
        parent = self.stack[-1] if self.stack else None
        nth = around.counts[tag] = around.counts.get(tag, 0) + 1
        around.first.setdefault(tag, n)
        ident = next((v for k, v in attributes if k == "id"), "")
        if ident:
            tags = self._ids.setdefault(ident, set())
            before = tuple(sorted(tags))
            tags.add(tag)
        # in the order of _OWN
        self.rows.append([n, parent, len(around.children), tag, attributes, None, None, line, n, around.path, nth, None if parent is None else self.rows[parent][_LINE], self.chars, self.chars, (), (), (), before, (), False])
        around.children.append(tag)
        self.stack.append(n)
        self._open.append(_Open((*around.path, tag)))
        self._closed = None

    def end(self) -> None:
        n, own = self.stack.pop(), self._open.pop()
        row = self.rows[n]
        row[_LAST], row[_STOP] = len(self.rows) - 1, self.chars
        if own.first:
            own.inside.update(own.first)
            ways = list(own.first)
            for tag, child in own.first.items():
                ways += [f"{tag}/{w}" for w in self.rows[child][_BELOW] if w.count("/") < STEPS - 1]
            row[_KIDS], row[_INSIDE], row[_BELOW], row[_CHILDREN] = tuple(own.first), tuple(sorted(own.inside)), tuple(ways), own.children
            self._open[-1].inside |= own.inside
        self._closed = n

    def data(self, text: str) -> None:
        if not self.stack:
            return
        top = self.rows[self.stack[-1]]
        row, at = (top, _TEXT) if self._closed is None else (self.rows[self._closed], _TAIL)
        if row[at] is None:
            row[at] = []
        row[at].append(text)
        top[_LOOSE] = top[_LOOSE] or bool(text.strip(BLANK))
        self.chars += len(text)

    def finish(self) -> dict[str, list]:
        columns = {c: list(values) for c, values in zip(_OWN, zip(*self.rows, strict=True), strict=True)} if self.rows else {c: [] for c in _OWN}
        for c in ("text", "tail"):
            columns[c] = [None if pieces is None else "".join(pieces) or None for pieces in columns[c]]
        return columns


def _local(name: str) -> str:
    return name.rpartition("}")[2].rpartition(":")[2]


def strict(xml: str | bytes | None) -> tuple[Nodes, str | None]:
    """Nodes and the parser's error, if it stopped. Comments and processing instructions are no nodes; entities stay unresolved."""
    nodes = Nodes()
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    parser.UseForeignDTD(False)
    parser.StartElementHandler = lambda name, attributes: nodes.start(name.rpartition("}")[2], [(k.rpartition("}")[2], v) for k, v in attributes.items()], parser.CurrentLineNumber)
    parser.EndElementHandler = lambda _: nodes.end()
    parser.CharacterDataHandler = nodes.data
    try:
        parser.Parse(xml if xml is not None else "", True)
    except expat.ExpatError as e:
        return nodes, str(e)
    return nodes, None


# ---- the recovering reader

_NAME = r"[^\s<>/=\"'&;!?]+"
_OPEN, _CLOSE = re.compile(rf"<({_NAME})"), re.compile(rf"</\s*({_NAME})?[^<>]*(>?)")
_ATTRIBUTE = re.compile(rf"\s*({_NAME})(?:\s*=\s*(?:\"([^\"<]*)\"|'([^'<]*)'|([^\s<>\"']+)))?")
_REFERENCE = re.compile(r"&(?:#(\d+)|#x([0-9A-Fa-f]+)|([^\s&;<]+));|&")
_REST = re.compile(r"[^<>]*?(/?)(>|(?=<)|\Z)")
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
# The entities that need no declaration.
_KNOWN = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


class _Recovery:
    """Reads a text to its end, whatever is wrong with it, and writes down what was mended."""

    def __init__(self, xml: str) -> None:
        self.xml = xml.replace("\r\n", "\n").replace("\r", "\n")
        self.nodes, self.log = Nodes(), []
        self.line, self._counted = 1, 0
        self.open: list[str] = []

    def note(self, at: int, problem: str, subject: str, action: str) -> None:
        self.log.append((self.line_at(at), problem, subject, action))

    def line_at(self, at: int) -> int:
        if at > self._counted:
            self.line += self.xml.count("\n", self._counted, at)
            self._counted = at
        return self.line

    def decoded(self, text: str, at: int) -> str:
        if "&" in text:
            text = _REFERENCE.sub(lambda m: self._reference(m, at), text)
        if _ILLEGAL.search(text):
            self.note(at, "illegal character", "", "dropped")
            text = _ILLEGAL.sub("", text)
        return text

    def _reference(self, m: re.Match, at: int) -> str:
        decimal, hexadecimal, name = m.groups()
        if name:
            return _KNOWN.get(name, m[0])  # others stay unresolved
        if decimal or hexadecimal:
            code = int(decimal or hexadecimal, 10 if decimal else 16) if len(decimal or hexadecimal) < 9 else -1
            if code in (9, 10, 13) or 32 <= code < 0xD800 or 0xE000 <= code < 0xFFFE or 0x10000 <= code < 0x110000:
                return chr(code)
            self.note(at, "illegal character", m[0], "dropped")
            return ""
        self.note(at, "stray ampersand", "", "kept as text")
        return "&"

    def text(self, start: int, stop: int, literal: bool = False) -> None:
        if start < stop:
            piece = self.xml[start:stop]
            if self.open:
                self.nodes.data(_ILLEGAL.sub("", piece) if literal else self.decoded(piece, start))
            elif piece.strip(" \t\n\ufeff"):
                self.note(start, "text outside the root", "", "dropped")

    def run(self) -> None:
        xml, at, size = self.xml, 0, len(self.xml)
        while at < size:
            lt = xml.find("<", at)
            self.text(at, lt if lt >= 0 else size)
            if lt < 0:
                break
            at = self.markup(lt)
        for tag in reversed(self.open):
            self.note(size, "end tag is missing", tag, "closed at the end")
            self.nodes.end()
        self.open.clear()

    def markup(self, at: int) -> int:
        """Reads what begins with a '<'; returns where to go on."""
        xml = self.xml
        for begin, finish, what in (("<!--", "-->", "comment"), ("<![CDATA[", "]]>", "CDATA section"), ("<?", "?>", "processing instruction")):
            if xml.startswith(begin, at):
                stop = xml.find(finish, at + len(begin))
                if stop < 0:
                    self.note(at, f"{what} does not end", "", "kept as text" if what == "CDATA section" else "dropped")
                    stop = len(xml)
                if what == "CDATA section":
                    self.text(at + len(begin), stop, literal=True)
                return min(len(xml), stop + len(finish))
        if xml.startswith("<!", at):
            return self.declaration(at)
        if xml.startswith("</", at):
            return self.closing(at)
        return self.opening(at)

    def declaration(self, at: int) -> int:
        stop, subset = self.xml.find(">", at), self.xml.find("[", at)
        if 0 <= subset < stop:
            stop = self.xml.find("]", subset)
            stop = self.xml.find(">", stop) if stop >= 0 else -1
        if stop < 0:
            self.note(at, "declaration does not end", "", "dropped")
            return len(self.xml)
        return stop + 1

    def closing(self, at: int) -> int:
        m = _CLOSE.match(self.xml, at)
        tag = _local(m[1] or "")
        if not m[2]:
            self.note(at, "tag does not end", tag, "ended there")
        if tag in self.open:
            while self.open[-1] != tag:
                self.note(at, "end tag is missing", self.open.pop(), "closed")
                self.nodes.end()
            self.open.pop()
            self.nodes.end()
        else:
            self.note(at, "end tag without a start", tag, "dropped")
        return m.end()

    def opening(self, at: int) -> int:
        xml = self.xml
        m = _OPEN.match(xml, at)
        if not m:
            self.note(at, "stray <", "", "kept as text" if self.open else "dropped")
            if self.open:
                self.nodes.data("<")
            return at + 1
        tag, stop = _local(m[1]), m.end()
        attributes: dict[str, str] = {}
        while a := _ATTRIBUTE.match(xml, stop):
            name, value = a[1], next((v for v in a.groups()[1:] if v is not None), None)
            if value is None:
                self.note(at, "attribute without a value", name, "dropped")
            elif a[4] is not None:
                self.note(at, "attribute without quotes", name, "kept")
            if name in attributes:
                self.note(at, "attribute is repeated", name, "dropped")
            elif value is not None and not name.startswith("xmlns"):
                attributes[name] = self.decoded(re.sub(r"\s", " ", value), at)
            stop = a.end()
        rest = _REST.match(xml, stop)
        if rest[0].strip(" \t\n/>"):
            self.note(at, "tag holds something else", tag, "dropped")
        if not rest[2]:
            self.note(at, "tag does not end", tag, "ended there")
        if not self.open and self.nodes.rows:
            self.note(at, "element after the root", tag, "dropped")
            return self.skipped(rest.end(), tag, bool(rest[1]))
        self.nodes.start(tag, [(_local(k), v) for k, v in attributes.items()], self.line_at(at))
        if rest[1]:
            self.nodes.end()
        else:
            self.open.append(tag)
        return rest.end()

    def skipped(self, at: int, tag: str, empty: bool) -> int:
        """Past an element that is dropped with all that is in it."""
        depth = 0 if empty else 1
        tags = re.compile(rf"<(/?)(?:{_NAME}:)?{re.escape(tag)}(?=[\s/>])[^<>]*?(/?)>")
        while depth and (m := tags.search(self.xml, at)):
            depth += -1 if m[1] else 0 if m[2] else 1
            at = m.end()
        return len(self.xml) if depth else at


def recovered(xml: str | None) -> tuple[Nodes, str | None, list[tuple]]:
    """Nodes, an error only where there is no element at all, and (line, problem, subject, action) of what was mended."""
    reader = _Recovery(xml or "")
    reader.run()
    return reader.nodes, None if reader.nodes.rows else "no element found", reader.log


def parse(xml: str | bytes | None, recover: bool = False) -> tuple[list[dict], str | None]:
    """Nodes as dicts, and the error."""
    nodes, error = recovered(xml)[:2] if recover else strict(xml)
    columns = nodes.finish()
    lists = {k: v if _TYPES[k] != _TYPES["path"] else [list(x) for x in v] for k, v in columns.items()}
    return [dict(zip(lists, row, strict=True)) for row in zip(*lists.values(), strict=True)], error


# ---- tables

# A document type of the text's own may declare entities and attributes, which only the strict reader knows.
_DECLARES = re.compile("<!(?:ENTITY|ATTLIST)")


def _read(xml: str | None, recover: bool) -> tuple[Nodes, str | None]:
    """Nodes and the error. What the strict reader reads to its end needs no mending: both readers give the same nodes."""
    if not recover:
        return strict(xml)
    if xml and not _DECLARES.search(xml):
        nodes, error = strict(xml)
        if error is None:
            return nodes, None
    return recovered(xml)[:2]


def _texts(documents: DataFrame, id_col: str, xml_col: str, *more: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("string").alias("doc_id"), F.col(xml_col).alias("xml"), *more)


class _Held:
    """What has been read and not yet been given: nodes by text, and the documents of each text."""

    def __init__(self, columns: list[str]) -> None:
        self.nodes: dict[str, list] = {c: [] for c in columns if c in _TYPES}
        self.errors: list[str | None] = []
        self.place: list[int] = []  # of each node, its text
        self.documents: list[list[str]] = []  # of each text
        self.sizes: list[int] = []
        self.carried: list[tuple] = []
        self.seen: dict[tuple, int] = {}
        self.n_documents = self.chars = self.cells = 0

    def full(self) -> bool:
        return len(self.place) >= ROWS or self.n_documents >= DOCUMENTS or self.chars >= CHARS or self.cells >= CELLS

    def batch(self, columns: list[str], kinds: dict[str, pa.DataType], together: bool) -> pa.RecordBatch:
        place = pa.array(self.place, pa.int32())
        docs = pa.array(self.documents, pa.list_(pa.string())) if together else pa.array([d[0] for d in self.documents], pa.string())
        arrays = {"doc_id": docs.take(place), "error": pa.array(self.errors, pa.string())} | {c: pa.array(values, _TYPES[c]) for c, values in self.nodes.items()}
        arrays |= {c: pa.array([x[k] for x in self.carried], kind).take(place) for k, (c, kind) in enumerate(kinds.items())}
        return pa.record_batch([arrays[c] for c in columns], columns)


def walk_xml(documents: DataFrame, id_col: str = "doc_id", xml_col: str = "xml", recover: bool = False, columns: list[str] | None = None, tags: list[str] | None = None, carried: list[str] | None = None, together: bool = False) -> DataFrame:
    """The nodes of each XML text; a text that doesn't parse gives one row with its error and no node.

    columns: those of the nodes to give (doc_id and error too, if named),
    instead of all; tags: the nodes to give, beside the root; carried: columns
    of documents that every node gets, plain values. together: texts that meet
    in a task and are equal, as are their carried columns, are read and given
    once, and doc_id is the array of their documents, to be exploded at the end.
    """
    wanted, chosen, more = columns or list(_DDL), None if tags is None else frozenset(tags), carried or []
    schema = [("doc_id array<string>" if together and c == "doc_id" else _DDL[c]) for c in wanted] + [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in more]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names, kinds = _Held(wanted), [*wanted, *more], {}
        for batch in batches:
            kinds = {c: batch.column(k + 2).type for k, c in enumerate(more)}
            for doc, *key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = tuple(key)
                at = held.seen.get(key) if together else None
                held.n_documents += 1
                if at is not None:
                    held.documents[at].append(doc)
                else:
                    at = len(held.documents)
                    held.documents.append([doc])
                    held.carried.append(key[1:])
                    if together:
                        held.seen[key] = at
                        held.chars += len(key[0] or "")
                    nodes, error = _read(key[0], recover)
                    read = nodes.finish() if not error else {c: [None] for c in _OWN}
                    kept = range(len(read["tag"])) if chosen is None else [n for n, tag in enumerate(read["tag"]) if not n or tag in chosen]
                    for c, values in held.nodes.items():
                        values += read[c] if chosen is None else [read[c][n] for n in kept]
                    held.place += [at] * len(kept)
                    held.errors += [error] * len(kept)
                    held.sizes.append(len(kept))
                held.cells += held.sizes[at]
                if held.full():
                    yield held.batch(names, kinds, together)
                    held = _Held(wanted)
        if held.place:
            yield held.batch(names, kinds, together)

    return _texts(documents, id_col, xml_col, *more).mapInArrow(walk, ", ".join(schema))


def recovery_log(documents: DataFrame, id_col: str = "doc_id", xml_col: str = "xml") -> DataFrame:
    """(doc_id, seq, line, problem, subject, action): what the recovering reader met in each text, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, i, *entry) for doc, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, entry in enumerate(recovered(xml)[2])]
            if rows:
                doc, seq, line, problem, subject, action = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(doc, pa.string()), pa.array(seq, pa.int32()), pa.array(line, pa.int32()), *(pa.array(x, pa.string()) for x in (problem, subject, action))], [c.split()[0] for c in LOG.split(", ")])

    return _texts(documents, id_col, xml_col).mapInArrow(run, LOG)


#: Elements whose white space counts, even where they hold no text of their own.
TEXT_HOLDERS = ("para", "title", "entry")


def pretty(xml: str) -> str:
    """The root element with its elements on lines of their own, by two spaces a level; an element that holds text stays as it is."""
    root = ElementTree.fromstring(xml)

    def indent(e, pad: str) -> None:
        if e.tag not in TEXT_HOLDERS and len(e) and not (e.text or "").strip() and not any((c.tail or "").strip() for c in e):
            e.text = pad + "  "
            for c in e:
                c.tail = pad + "  "
                indent(c, pad + "  ")
            e[-1].tail = pad

    indent(root, "\n")
    return ElementTree.tostring(root, encoding="unicode")


def indented(documents: DataFrame, id_col: str = "doc_id", xml_col: str = "xml") -> DataFrame:
    """(doc_id, well_formed, error, pretty): whether each text parses, and its elements indented; text with content keeps its white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    out.append({"doc_id": doc, "well_formed": True, "error": None, "pretty": pretty(xml or "")})
                except ElementTree.ParseError as e:
                    out.append({"doc_id": doc, "well_formed": False, "error": str(e), "pretty": None})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.string()), ("well_formed", pa.bool_()), ("error", pa.string()), ("pretty", pa.string())]))

    return _texts(documents, id_col, xml_col).mapInArrow(run, "doc_id string, well_formed boolean, error string, pretty string")


def tag_scan(pages: DataFrame, tags: str = "h1|p|li") -> DataFrame:
    """(page_id, host, i, tag, text): the elements of some tags of HTML pages in order, without Python."""
    pattern = rf"(?i)<({tags})(?:\s[^>]*)?>([^<]*)"
    names, texts = (F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(pattern), F.lit(g)) for g in (1, 2))
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host")
    return pages.select("page_id", host, F.posexplode(F.arrays_zip(names.alias("tag"), texts.alias("text"))).alias("i", "t")).select("page_id", "host", "i", F.lower("t.tag").alias("tag"), "t.text")
