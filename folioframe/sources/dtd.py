"""Document type definitions as tables of rules.

A definition is read on the driver: it is a parameter of fixed size, like a
schema. Parameter entities, modules and marked sections are resolved, and each
content model becomes an automaton over its positions (the places of names in
the model): the sets of positions that may follow one another, made
deterministic. The rules are rows that plans join to nodes by tag.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

RULES = "tag string, kind string, steps map<string,int>, ends array<int>, allowed array<string>, needed array<string>, choices map<string,array<string>>"
_TOKEN = re.compile(r"<!--.*?-->|<\?.*?\?>|<!\[|\]\]>|<!ENTITY\s+%\s+(?P<pe>[\w.:-]+)\s+(?P<source>.*?)>|<!(?P<kind>ELEMENT|ATTLIST|ENTITY|NOTATION)\b(?P<body>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|%(?P<ref>[\w.:-]+);", re.S)
_QUOTED = re.compile(r"\"([^\"]*)\"|'([^']*)'")
_MODEL = re.compile(r"#PCDATA|[\w.:-]+|[(),|?*+]")
_ATTRIBUTE = re.compile(r"([\w.:-]+)\s+(\([^)]*\)|NOTATION\s*\([^)]*\)|[A-Z]+)\s+(#REQUIRED|#IMPLIED|(?:#FIXED\s+)?(?:\"[^\"]*\"|'[^']*'))", re.S)


@dataclass
class Element:
    """What an element may hold. kind: empty, any, mixed or children."""

    kind: str = "any"
    steps: dict[str, int] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)
    allowed: list[str] = field(default_factory=list)
    needed: list[str] = field(default_factory=list)
    choices: dict[str, list[str]] = field(default_factory=dict)


class Definition:
    """The elements of a definition. modules: texts of the files that it refers to, by their names; others count as empty."""

    def __init__(self, text: str, modules: Mapping[str, str] | None = None) -> None:
        self.modules = modules or {}
        self.entities: dict[str, str] = {}
        self.elements: dict[str, Element] = {}
        self._models: set[str] = set()
        self._read(text, ())

    def expanded(self, text: str, inside: tuple[str, ...] = ()) -> str:
        """text with its parameter entities, which may not hold themselves."""

        def value(m: re.Match) -> str:
            name = m[1]
            if name in inside:
                raise ValueError(f"parameter entity {name} holds itself")
            return f" {self.expanded(self.entities.get(name, ''), (*inside, name))} "

        return re.sub(r"%([\w.:-]+);", value, text)

    def _read(self, text: str, inside: tuple[str, ...]) -> None:
        at = 0
        while m := _TOKEN.search(text, at):
            at = m.end()
            if m["pe"]:
                self._entity(m["pe"], m["source"])
            elif m["ref"]:
                if m["ref"] in inside:
                    raise ValueError(f"parameter entity {m['ref']} holds itself")
                self._read(self.entities.get(m["ref"], ""), (*inside, m["ref"]))
            elif m[0] == "<![":
                at = self._section(text, at, inside)
            elif m["kind"] == "ELEMENT":
                self._element(self.expanded(m["body"]))
            elif m["kind"] == "ATTLIST":
                self._attributes(self.expanded(m["body"]))

    def _entity(self, name: str, source: str) -> None:
        """The first declaration counts."""
        quoted = [a or b for a, b in _QUOTED.findall(source)]
        external = source.lstrip().startswith(("SYSTEM", "PUBLIC"))
        value = self.modules.get(quoted[-1].rpartition("/")[2], "") if external and quoted else quoted[0] if quoted else ""
        self.entities.setdefault(name, value)

    def _section(self, text: str, at: int, inside: tuple[str, ...]) -> int:
        """A marked section; returns where the text goes on."""
        begin, depth = text.index("[", at) + 1, 1
        stop = begin
        while depth:
            m = re.compile(r"<!\[|\]\]>").search(text, stop)
            if not m:
                raise ValueError("a marked section does not end")
            depth += 1 if m[0] == "<![" else -1
            stop = m.end()
        if self.expanded(text[at : begin - 1]).strip() == "INCLUDE":
            self._read(text[begin : stop - 3], inside)
        return stop

    def _names(self, body: str) -> tuple[list[str], str]:
        """The names that a declaration is about, and the rest of it."""
        body = body.strip()
        if body.startswith("("):
            names, _, rest = body[1:].partition(")")
            return re.findall(r"[\w.:-]+", names), rest.strip()
        name, _, rest = body.partition(next((c for c in body if c.isspace()), " "))
        return [name], rest.strip()

    def _element(self, body: str) -> None:
        names, model = self._names(body)
        for name in names:
            if name in self._models:
                continue  # the first declaration counts
            self._models.add(name)
            e = self.elements.setdefault(name, Element())
            if model in ("EMPTY", "ANY"):
                e.kind = model.lower()
            elif "#PCDATA" in model:
                e.kind, e.allowed = "mixed", sorted(set(re.findall(r"[\w.:-]+", model.replace("#PCDATA", ""))))
            else:
                e.kind = "children"
                e.steps, e.ends = automaton(model)

    def _attributes(self, body: str) -> None:
        names, rest = self._names(body)
        for name in names:
            e = self.elements.setdefault(name, Element())
            for attribute, kind, default in _ATTRIBUTE.findall(rest):
                if default == "#REQUIRED" and attribute not in e.needed:
                    e.needed.append(attribute)
                if kind.startswith("("):
                    e.choices.setdefault(attribute, re.findall(r"[\w.:-]+", kind))


def automaton(model: str) -> tuple[dict[str, int], list[int]]:
    """A content model's steps, 'state tag' to state from state 0, and the states in which it may end."""
    tokens = _MODEL.findall(model)
    tags: list[str] = []
    follow: list[set[int]] = []
    at = 0

    def particle() -> tuple[bool, set[int], set[int]]:
        """(may be empty, first positions, last positions) of what begins at the next token."""
        nonlocal at
        if at >= len(tokens):
            raise ValueError(f"content model {model!r} ends too early")
        token = tokens[at]
        at += 1
        if token == "(":
            parts, sign = [particle()], ""
            while at < len(tokens) and tokens[at] in ",|":
                sign = tokens[at]
                at += 1
                parts.append(particle())
            if at >= len(tokens) or tokens[at] != ")":
                raise ValueError(f"content model {model!r} does not close")
            at += 1
            out = parts[0]
            for part in parts[1:]:
                if sign == "|":
                    out = (out[0] or part[0], out[1] | part[1], out[2] | part[2])
                else:
                    for p in out[2]:
                        follow[p] |= part[1]
                    out = (out[0] and part[0], out[1] | part[1] if out[0] else out[1], out[2] | part[2] if part[0] else part[2])
        else:
            tags.append(token)
            follow.append(set())
            out = (False, {len(tags) - 1}, {len(tags) - 1})
        if at < len(tokens) and tokens[at] in "?*+":
            if tokens[at] in "*+":
                for p in out[2]:
                    follow[p] |= out[1]
            out = (out[0] or tokens[at] in "?*", out[1], out[2])
            at += 1
        return out

    empty, first, last = particle()
    states: dict[frozenset, int] = {frozenset([-1]): 0}
    steps, todo = {}, [frozenset([-1])]
    for state in todo:  # grows
        after = set().union(*(first if p < 0 else follow[p] for p in state))
        for tag in sorted({tags[p] for p in after}):
            to = frozenset(p for p in after if tags[p] == tag)
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            steps[f"{states[state]} {tag}"] = states[to]
    return steps, [n for state, n in states.items() if state & last or (n == 0 and empty)]


def rules(spark: SparkSession, definition: Definition) -> DataFrame:
    """A row for each declared element, with its automaton, its mixed content and its attributes."""
    rows = [(tag, e.kind, e.steps, e.ends, e.allowed, e.needed, e.choices) for tag, e in sorted(definition.elements.items())]
    return spark.createDataFrame(rows, RULES)
