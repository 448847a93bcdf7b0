"""Secret scans by assignment-aware lexing.

Base patterns run over every text. On top, lines that hold an assignment sign are lexed into names,
literals and operators; a small pass turns them into name-literal pairs: ``name = "a" + "b"`` (scored as one
literal, a span for each part), ``"name": value``, ``NAME: value``, ``name => value``, ``--name=value``,
``names["name"] = value``, ``setName("value")``. A sign at the end of a line takes its value from the next
line; each line of a text in three quotes, and of a block under ``name: |``, is a literal of its name. A name bound to another name
takes over its literals (constant propagation through the whole text, forward references included).
A literal is scored by how sensitive the names are that it reaches and by its own shape; the literals
that score high enough are added as spans of the kind ``literal``. Base spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: Kinds in the order that breaks ties of start.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Weights of the words of a target name; a name's weight is that of its strongest word or word pair.
SENSITIVE = {
    "password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "secret": 4, "token": 3, "apikey": 4, "credential": 3,
    "credentials": 3, "auth": 2, "authorization": 3, "bearer": 3, "private": 2, "key": 1, "api key": 4, "access key": 4,
    "secret key": 4, "private key": 4, "signing key": 4, "encryption key": 4, "client secret": 4, "pin": 1, "salt": 2,
    "cookie": 1, "session": 1, "webhook": 1, "dsn": 2,
}
#: Literals that stand for a value and are none.
PLACEHOLDERS = frozenset("changeme example placeholder password secret token none null true false undefined todo xxx test your".split())
#: A literal whose name weight and shape weight add up to this is a finding.
THRESHOLD = 6

#: Strings by their quote; one that isn't closed on its line is none.
STRINGS = {'"': r'"(?:[^"\\\n]|\\.)*"', "'": r"'(?:[^'\\\n]|\\.)*'", "`": r"`[^`\n]*`"}
REST = (
    r"""|(?P<quote>["'`])|(?P<sign>:=|=>|==|!=|<=|>=|[:=])|(?P<plus>\+|\.\.)"""
    r"""|(?P<word>[A-Za-z_$@][\w$.-]*|[^\s"'`:=+,;(){}\[\]<>]+)|(?P<end>[,;(){}\[\]<>])"""
)
#: By the quotes that may open a string: one that stays open makes all later ones of its kind on the line stay so.
TOKENS = {q: re.compile("(?P<string>" + ("|".join(STRINGS[x] for x in q) or "(?!)") + ")" + REST) for q in ("\"'`", "\"'", "\"`", "'`", '"', "'", "`", "")}
#: What a value of several lines starts with: three quotes, or the mark of a block at the end of its line.
TRIPLE = re.compile(r"""[=:(]\s*[A-Za-z]{0,2}(\"\"\"|''')""")
BLOCK = re.compile(r"""^([ \t]*)(?:- )?["']?([A-Za-z_$@][\w$.-]*)["']?[ \t]*:[ \t]*[|>][+-]?\d?[ \t]*$""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
NAME = re.compile(r"[A-Za-z_$@-][\w$.-]*")


def name_weight(name: str) -> int:
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    pairs = [f"{a} {b}" for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0) for p in [*parts, *pairs, "".join(parts)]), default=0)


def shape_weight(literal: str) -> int:
    """0 to 4: length, mixed classes and entropy; negative for what can't be a secret."""
    bare = literal.strip()
    if len(bare) < 6 or PLACEHOLDERS.issuperset(bare.lower().strip("<>{}$%_*.-").split()) or len(set(bare)) < 4 or re.search(r"\s.*\s", bare):
        return -9
    counts = Counter(bare)
    entropy = -sum(c / len(bare) * math.log2(c / len(bare)) for c in counts.values())
    classes = sum(bool(re.search(p, bare)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    return (len(bare) >= 8) + (classes >= 2) + (classes >= 3) + (entropy >= 3)


SIGN = re.compile("[=:]")
SETTER = re.compile(r"(?:set|with|use|add)_?([A-Za-z]\w*)")
#: The parts of a literal: each one's start and end, and their texts.
Literal = tuple[list[tuple[int, int]], list[str]]


def lexed_pairs(text: str) -> tuple[dict[str, list[Literal]], dict[str, set[str]]]:
    """Name-literal pairs and name-name bindings of all lines that hold ``:`` or ``=``, or follow such a sign."""
    literals: dict[str, list[Literal]] = {}
    refs: dict[str, set[str]] = {}
    at, open_name, taken = 0, None, 0
    while True:
        if open_name is None:
            sign = SIGN.search(text, at)
            if sign is None:
                return literals, refs
            start = max(text.rfind("\n", at, sign.start()) + 1, at)
            end = text.find("\n", sign.start())
        else:  # the value of the last sign is on this line
            start, end = at + 1, text.find("\n", at + 1)
            if start >= len(text):
                return literals, refs
        end = len(text) if end < 0 else end
        if start >= taken:
            taken, opened = _value_lines(text, start, end, literals, open_name)
            if opened:  # what follows the quotes is lexed as a line of its own
                _lex_line(text, start, opened - 3, literals, refs, open_name)
                at, open_name = opened, None
                continue
        open_name = _lex_line(text, start, end, literals, refs, open_name)
        at = end


def _lines_of(text: str, start: int, end: int, name: str, literals: dict[str, list[Literal]]) -> None:
    """Each line between ``start`` and ``end`` as a literal of ``name``, without the blanks around it."""
    for m in re.compile(r"[^\s](?:[^\n]*[^\s])?").finditer(text, start, end):
        literals.setdefault(name, []).append(([m.span()], [m.group()]))


def _value_lines(text: str, start: int, end: int, literals: dict[str, list[Literal]], target: str | None) -> tuple[int, int]:
    """Takes a value of several lines that starts on this line: where it ends, and where its quotes have opened.

    Each line of it is a literal of its name: a text in three quotes, or the deeper lines under ``name: |``.
    """
    line = text[start:end]
    if line.rstrip().endswith(("|", ">", "+", "-", *"123456789")) and (block := BLOCK.match(line)):
        at = end
        while at < len(text):
            stop = text.find("\n", at + 1)
            stop = len(text) if stop < 0 else stop
            deeper = text[at + 1 : stop]
            if deeper.strip() and len(deeper) - len(deeper.lstrip()) <= len(block[1]):
                break
            at = stop
        _lines_of(text, end, at, block[2], literals)
        return at, 0
    if '"""' not in line and "'''" not in line or not (opened := TRIPLE.search(text, start, end)):
        return start, 0
    names = NAME.findall(text, start, opened.start())
    close = text.find(opened[1], opened.end())
    name = names[-1] if names else target
    if close < 0 or name is None:  # it stays open, so it is no value
        return start, 0
    setter = SETTER.fullmatch(name.rpartition(".")[2]) if text[opened.start()] == "(" else None
    _lines_of(text, opened.end(), close, setter[1] if setter else name, literals)
    return close, opened.end()


def _lex_line(text: str, start: int, end: int, literals: dict, refs: dict, target: str | None = None) -> str | None:
    """Lexes one line; ``target`` waits for a value. The name that waits for one at its end."""
    name, value_next, before, joining = None, target is not None, "", False
    quotes, at = "\"'`", start
    while m := TOKENS[quotes].search(text, at, end):
        kind, word, at = m.lastgroup, m.group(), m.end()
        if kind == "quote":
            quotes = quotes.replace(word, "")
            continue
        if kind == "sign":
            value_next, joining = False, False
            if word in (":", "=", ":=", "=>") and name and before in ("word", "string", "]"):
                target, value_next = name, True
        elif kind == "plus":
            joining = value_next = target is not None and before in ("string", "word")
        elif kind in ("string", "word"):
            inner = word[1:-1] if kind == "string" else word
            if value_next:
                low = inner.lower()
                if kind == "string" or not NAME.fullmatch(word) or any(c.isdigit() for c in word):
                    shift = 1 if kind == "string" else 0
                    span, found = (m.start() + shift, m.end() - shift), literals.setdefault(target, [])
                    if joining and kind == "string" and found:
                        spans, parts = found[-1]
                        spans.append(span)
                        parts.append(inner)
                    else:
                        found.append(([span], [inner]))
                if kind == "word" and NAME.fullmatch(word):
                    refs.setdefault(target, set()).add(word.strip("$"))
                value_next = kind == "word" and low in ("bearer", "basic", "new", "const", "str", "string", "final")
            joining = False
            name = inner.strip("$-") if NAME.fullmatch(inner) else None
        else:
            setter = SETTER.fullmatch(name.rpartition(".")[2]) if word == "(" and before == "word" and name else None
            value_next = setter is not None
            if setter:
                target = setter[1]
            elif word in ",;{}":
                target = None
            if word == "]" and before == "string":
                before = "]"
                continue
        before = kind
    return target if value_next and before == "sign" else None


def literal_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name with a high enough score."""
    literals, refs = lexed_pairs(text)
    if not literals:
        return []
    reach = {n: w for n in {*literals, *refs} if (w := name_weight(n))}
    todo = list(reach)
    while todo:  # weights only rise and are bounded, so this ends
        n = todo.pop()
        for source in refs.get(n, ()):
            if reach.get(source, 0) < reach[n] and (source in literals or source in refs):
                reach[source] = reach[n]
                todo.append(source)
    return sorted({p for n, found in literals.items() for spans, parts in found if n in reach and reach[n] + shape_weight("".join(parts)) >= THRESHOLD for p in spans})


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], int, int, int]:
    """All spans (start, rank of kind, end) sorted, and the counts of the base kinds."""
    if not text:
        return [], 0, 0, 0
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    n_assign = len(found)
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    n_access = len(found) - n_assign
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    n_hex = len(found) - n_assign - n_access
    if ":" in text or "=" in text:
        found += [(a, 3, b) for a, b in literal_spans(text)]
    return sorted(found), n_assign, n_access, n_hex


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal for each row of ``docs`` (doc_id, text).

    Positions are code points, ends exclusive. A null or empty text has no spans, and the digest of an
    empty string. Repeated rows give repeated results; null ids pass through; other columns are ignored.
    One pass over the texts, no shuffle; a row's cost is linear in its length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        empty = hashlib.sha256(b"").hexdigest()
        for b in batches:
            rows = []
            for text in b["text"]:
                found, *counts = scan(text)
                base = joined([x for x in found if x[1] < 3])
                rows.append((*counts, hashlib.sha256(base.encode()).hexdigest() if base else empty, joined(found), len(found) - sum(counts)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"])
            out.insert(0, "doc_id", b["doc_id"].array)
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")
