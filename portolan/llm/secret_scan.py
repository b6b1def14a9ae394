"""Secrets by patterns and by assignment-aware lexing.

Three patterns give the base spans. Beside them, lines of source or
configuration are lexed into pairs of a target name and its value: a literal,
a sum of literals and names, a name, or a call with literals in it; a literal
may begin on the next line or run over several. Names are resolved through the
text's other assignments (constant propagation), and each literal is scored
by the names that it reaches and by its own look; a literal over the
threshold gives a span of kind ``literal`` where no base span lies.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import text_or_empty

# The base kinds, in the order that breaks ties.
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run starts where no run is under way, so runs of 24 and more are just
# the leftmost runs that are long enough.
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

THRESHOLD = 4

_QUOTED = r'"(?:[^"\\\n]|\\.)*"|' + r"'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
_TRIPLED = r'(?s:"{3}(?:[^\\]|\\.)*?"{3}|' + r"'{3}(?:[^\\]|\\.)*?'{3})"
_LITERAL = rf"(?:[bBfFrRuUL]{{1,2}}|u8|[@$]{{1,2}})?(?:{_TRIPLED}|{_QUOTED})"
_NAME = r"[A-Za-z_$][A-Za-z0-9_$.\-]*"
_TERM = rf"(?:{_LITERAL}|\$\{{{_NAME}\}}|[^\s,;{{}}()\[\]<>\"'`+]+)"
_TARGET = re.compile(
    rf"""(?<![A-Za-z0-9_$.\-])["']?(?P<name>{_NAME})["']?\]?
    (?:[ \t]*:[ \t]*[A-Za-z_][\w.\[\]]*(?=[ \t]*=[^=]))?   # a type
    [ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*""", re.X)
# A value: in the target's line; a literal in parentheses, or in the next
# line where it isn't a target itself; any term after a line continuation or
# the mark of a block; a literal of several lines.
_HERE = re.compile(rf"(?P<value>{_TERM}(?:[ \t]*\+[ \t]*{_TERM})*)")
_BELOW = re.compile(
    rf"(?:(?:\([ \t]*(?:\r?\n[ \t]*)?|\r?\n[ \t]*)(?P<value>{_LITERAL}(?:\s*\+\s*{_LITERAL})*)(?![ \t]*[:=])"
    rf"|(?:\\\r?\n[ \t]*|[|>][+-]?[ \t]*\r?\n[ \t]+)(?P<term>{_TERM}))")
_BLOCK = re.compile(rf"(?P<value>[A-Za-z]{{0,2}}{_TRIPLED})")
_PART = re.compile(_TERM)
_OPEN = re.compile(r"""[^"'`]*?("{3}|'{3}|["'`])""")
_CALL_PART = re.compile(rf"{_LITERAL}|[(){{}};]")
# A call by such a name looks its first argument up.
_LOOKUP = re.compile(
    r"(?:\b|_|(?<=[a-z])(?=[A-Z]))(?i:get|env|prop|setting|config|param|option|read|load|find|lookup|fetch)[A-Za-z]*\Z")
_KEY = re.compile(r"[A-Za-z][\w.:/\-]*\Z")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_FIRST = re.compile(r"\s*\Z")
_WORDS_ONLY = re.compile(r"[A-Za-z_.\-]*\Z")
_IS_NAME = re.compile(rf"\$?\{{?({_NAME})\}}?\Z")

# How much a target name's words say; pairs of words count where both occur.
_NAME_SCORES = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "pass": 2, "secret": 3, "token": 3, "credential": 3,
    "credentials": 3, "apikey": 3, "bearer": 2, "auth": 2, "authorization": 2, "salt": 1, "signature": 1, "key": 1,
}
_PAIR_SCORES = {("api", "key"): 3, ("private", "key"): 3, ("access", "key"): 3, ("secret", "key"): 3,
                ("encryption", "key"): 3, ("signing", "key"): 3, ("auth", "key"): 3, ("connection", "string"): 2}
# Words that count inside glued names, and what only looks like one of them.
_GLUED = {"password": 3, "passwd": 3, "passphrase": 3, "secret": 3, "token": 3, "credential": 3, "apikey": 3, "accesskey": 3,
          "privatekey": 3, "authkey": 3, "signingkey": 3, "encryptionkey": 3}
_GLUED_ENDS = {"pwd": 3, "pass": 2}
_NO_GLUE = re.compile(r"tokeni[sz]|secretar|passwordless|bypass|compass|trespass|surpass|encompass|underpass|overpass")
_DUMMIES = ("example", "changeme", "change_me", "placeholder", "dummy", "sample", "todo", "redacted", "your", "xxxx",
            "****", "none", "null", "true", "false", "undefined", "environ", "getenv")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    names: tuple[str, ...] = ()
    score: float = 0.0


def name_score(name: str) -> int:
    """How strongly a target name says that its value is secret, from 0."""
    words = [w.lower() for w in _WORD.findall(name)]
    both = set(words)
    return max([0, *(_NAME_SCORES.get(w) or _glued_score(w) for w in words),
                *(score for pair, score in _PAIR_SCORES.items() if both.issuperset(pair))])


def _glued_score(word: str) -> int:
    if len(word) < 5 or _NO_GLUE.search(word):
        return 0
    return max([0, *(score for part, score in _GLUED.items() if part in word),
                *(score for part, score in _GLUED_ENDS.items() if word.endswith(part))])


def literal_score(value: str, spaces: bool = False) -> float:
    """How much a literal looks like a secret: length, variety of characters
    and kinds of them; placeholders and prose count against it. ``spaces``:
    white space counts against it, but doesn't fail it."""
    low = value.lower()
    spaced = any(c.isspace() for c in value)
    if len(value) < 6 or any(d in low for d in _DUMMIES) or (spaced and not spaces):
        return -3.0
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum((any(c.islower() for c in value), any(c.isupper() for c in value), any(c.isdigit() for c in value),
                 any(not c.isalnum() for c in value)))
    return (entropy >= 2.5) + (entropy >= 3.5) + (kinds >= 2) + (n >= 16) - (kinds == 1 and n < 12) - spaced


def _lex(text: str, calls: dict) -> Iterator[tuple[str, list[tuple[str, int, int]], int | None]]:
    """(name, [(term, start, end), ...], where the call that is assigned
    opens) for each assignment, in order. Adds to ``calls``."""
    start, done = 0, 0
    while start <= len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        if text.find("=", start, end) >= 0 or text.find(":", start, end) >= 0:
            done = max(done, start)
            while done < end and (m := _TARGET.search(text, done, end)):
                at = done = m.end()
                v = _BLOCK.match(text, at) or _BELOW.match(text, at) or _HERE.match(text, at, end)
                if not v:
                    continue
                group = "value" if v["value"] is not None else "term"
                shift = v.start(group)
                terms = [(p[0], shift + p.start(), shift + p.end()) for p in _PART.finditer(v[group])]
                # Assignments in a literal of several lines are lexed too.
                done = v.end() if "\n" not in terms[0][0] else at + len(_OPEN.match(terms[0][0])[0])
                called = v.end() if text.startswith("(", v.end()) and _IS_NAME.match(terms[-1][0]) else None
                if called is not None and called not in calls:
                    _add_calls(text, called, calls)
                yield m["name"], terms, called
        start = end + 1


def _add_calls(text: str, at: int, calls: dict) -> None:
    """Where a call's parentheses open -> its own literals, and where the
    calls inside it open: for the call at ``at``, as far as a brace or
    semicolon, and all inside."""
    opened = []
    for m in _CALL_PART.finditer(text, at):
        if m[0] == "(":
            if opened:
                calls[opened[-1]][1].append(m.start())
            calls[m.start()] = [], []
            opened.append(m.start())
        elif m[0] == ")":
            opened.pop()
            if not opened:
                return
        elif m[0] in "{};":
            return
        else:
            where = opened[-1]
            looked_up = (not any(calls[where]) and _FIRST.match(text, where + 1, m.start()) and _KEY.match(_bare(m[0], 0, 0)[0])
                         and _LOOKUP.search(text[max(0, where - 40):where]))
            if not looked_up:
                calls[where][0].append((m[0], m.start(), m.end()))


def _bare(term: str, start: int, end: int) -> tuple[str, int, int]:
    """A literal without prefix, quotes and, in triple quotes, outer white
    space."""
    opened = _OPEN.match(term)
    start, end, term = start + opened.end(), end - len(opened[1]), term[opened.end():len(term) - len(opened[1])]
    if len(opened[1]) == 3:
        start, end = start + len(term) - len(term.lstrip()), end - (len(term) - len(term.rstrip()))
    return term.strip() if len(opened[1]) == 3 else term, start, max(start, end)


def lexed_spans(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """Literals that sensitive names reach, directly or through constants."""
    literals: dict[tuple[int, int], str] = {}
    reach: dict[tuple[int, int], str] = {}  # literal -> the strongest name that reaches it
    holds: dict[str | int, set[tuple[int, int]]] = defaultdict(set)  # name or call -> its literals
    uses: dict[str | int, set[str | int]] = defaultdict(set)  # name or call -> names and calls it was assigned
    direct = set()  # literals that are assigned, not just in a call
    calls: dict[int, tuple[list[tuple[str, int, int]], list[int]]] = {}
    for name, terms, called in _lex(text, calls):
        if called is not None:
            uses[name].add(called)
        for term, start, end in terms:
            quoted = _OPEN.match(term)
            ref = None if quoted else _IS_NAME.match(term)
            if quoted:
                term, start, end = _bare(term, start, end)
            direct.add((start, end))
            if ref and ref[1] != name:
                uses[name].add(ref[1])
            literals[start, end] = term
            holds[name].add((start, end))
    scores = {name: name_score(name) for name in holds}
    for where, (found, inside) in calls.items():
        uses[where].update(inside)
        holds[where] = set()
        for term in found:
            term, start, end = _bare(*term)
            if not (name_score(term) and _WORDS_ONLY.match(term)):  # a name that is looked up
                literals[start, end] = term
                holds[where].add((start, end))
    # The strongest names go first, and what one has reached isn't walked
    # again: each name and call is visited once.
    seen: set[str | int] = set()
    for name in sorted((name for name, score in scores.items() if score), key=lambda name: (-scores[name], name)):
        todo = [name] if name not in seen else []
        seen.add(name)
        while todo:
            for span in holds[now := todo.pop()]:
                reach.setdefault(span, name)
            new = [to for to in uses.get(now, ()) if to not in seen and to in holds]
            todo.extend(new)
            seen.update(new)
    out = []
    for (start, end), name in reach.items():
        value = literals[start, end]
        if value in holds:  # a name that was resolved instead
            continue
        score = scores[name] + literal_score(value, spaces=scores[name] >= 3 and (start, end) in direct)
        if score >= threshold:
            out.append(Span("literal", start, end, (name,), score))
    return out


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text by start, then kind. Offsets are code points."""
    base = [Span("assign", m.start(), m.end(), (m[1],)) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    base += [Span("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    base += [Span("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    taken = sorted((s.start, s.end) for s in base)
    starts = [a for a, _ in taken]
    ends = list(accumulate((b for _, b in taken), max))  # the furthest end so far
    added = []
    for span in lexed_spans(text, threshold):
        before = bisect_left(starts, span.end)
        if not before or ends[before - 1] <= span.start:
            added.append(span)
    return sorted(base + added, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                             ("names", pa.list_(pa.string())), ("score", pa.float64())]))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, spans`` for every row: spans is an array of ``kind, start,
    end, names, score``, by start and then kind; names holds the strongest
    target name that reaches a literal.

    Whole texts are read in tasks; no row moves. Null text counts as empty
    and has no spans; null ids and repeated rows come back as they are; an
    empty table gives no rows. Other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find(x, threshold)] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        work, "doc_id long, spans array<struct<kind:string,start:long,end:long,names:array<string>,score:double>>")
