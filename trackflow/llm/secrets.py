"""Secret scans: fixed patterns, and literals that assignments give to sensitive names.

The text is lexed for assignments of source code and configuration files (``name = literal``,
``"name": literal``, ``name := literal``, ``name => literal``). Literals may be quoted strings,
glued strings, bare values, or names of earlier constants, whose literals they then stand for. A
literal is scored by the words of the names it reaches and by its own form; literals above the
threshold are added as kind ``named`` unless a span of the fixed patterns already covers them.

Defined results: a null text is empty and has no spans; positions count code points. Rows are
mapped one to one; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import per_text

THRESHOLD = 2.0
MASK = "[secret]"

# Fixed patterns and least lengths of the base kinds, in the order in which they are listed.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "named")

# Fixed words: what makes a name sensitive, alone or in pairs, and what marks a placeholder.
SENSITIVE = {"password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "credential"}
SENSITIVE_PAIRS = {
    ("api", "key"), ("access", "key"), ("private", "key"), ("signing", "key"),
    ("encryption", "key"), ("account", "key"), ("auth", "key"), ("db", "pass"),
}
PLACEHOLDER = re.compile(r"(?i)example|change_?me|placeholder|dummy|your[-_ ]|xxxx|\*\*\*|[<>{}$%]")

NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
TARGET = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])({NAME})["']?\]?[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*(?=\S)"""
)
LITERAL = re.compile(
    r'"((?:[^"\\\n]|\\.)*)"'
    r"|'((?:[^'\\\n]|\\.)*)'"
    r"|([A-Za-z0-9_+/.=~!@#^&\-]+)"
)
GLUE = re.compile(r"[ \t]*(?:\+|\.\.)?[ \t]*(?=[\"'])|[ \t]*(?:\+|\.\.)[ \t]*(?=[A-Za-z_])")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = [
        ("assign", m.start(), m.end())
        for m in ASSIGN.finditer(text)
        if len(m[2]) >= ASSIGN_LEAST
    ]
    found += [
        ("access", m.start(), m.end())
        for m in ACCESS.finditer(text)
        if len(m[0]) >= ACCESS_LEAST
    ]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def sensitive(name: str) -> bool:
    words = [part.lower() for part in PARTS.findall(name)]
    singular = [w[:-1] if w.endswith("s") and w[:-1] in SENSITIVE else w for w in words]
    return any(w in SENSITIVE for w in singular) or any(
        pair in SENSITIVE_PAIRS for pair in zip(words, words[1:], strict=False)
    )


def assignments(text: str) -> list[tuple[str, list[tuple[int, int, bool]], list[str]]]:
    """Each target's name, the literals given to it (start, end, quoted), and names it takes up."""
    found = []
    for target in TARGET.finditer(text):
        at, literals, names = target.end(), [], []
        while piece := LITERAL.match(text, at):
            group = piece.lastindex or 0
            if group == 3:
                if re.fullmatch(NAME, piece[3]):
                    names.append(piece[3])
                literals.append((*piece.span(3), False))
            else:
                literals.append((*piece.span(group), True))
            at = piece.end()
            if not (glue := GLUE.match(text, at)):
                break
            at = glue.end()
        if literals:
            found.append((target[1], literals, names))
    return found


def score(value: str, quoted: bool) -> float:
    """How much a literal given to a sensitive name looks like a secret."""
    if len(value) < (6 if quoted else 8) or PLACEHOLDER.search(value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = [str.isdigit, str.islower, str.isupper, lambda c: not c.isalnum()]
    kinds = sum(any(map(test, value)) for test in classes)
    points = 1.0 + 0.5 * (len(value) >= 12) + 0.5 * (bits >= 3.0) + 0.5 * (kinds >= 2)
    points += 0.5 * (kinds >= 3) + 0.5 * quoted
    return points - (1.0 if not any(map(str.isdigit, value)) else 0.0) - 2.0 * (" " in value)


def named_spans(text: str) -> list[Span]:
    """Literals of sensitive names, also where a constant carries them there."""
    if "=" not in text and ":" not in text:
        return []
    # Each assignment is a step with its literals and the steps that its names stood for then. A
    # step is followed once, so chains and diamonds of constants cost what their text does.
    literals_of: list[list[tuple[int, int, bool]]] = []
    steps_of: list[list[int]] = []
    latest: dict[str, int] = {}
    followed: set[int] = set()
    found: set[Span] = set()
    for name, literals, names in assignments(text):
        literals_of.append([x for x in literals if text[x[0] : x[1]] not in latest])
        steps_of.append([latest[used] for used in names if used in latest])
        latest[name] = len(steps_of) - 1
        wait = [latest[name]] if sensitive(name) else []
        while wait:
            step = wait.pop()
            if step in followed:
                continue
            followed.add(step)
            wait += steps_of[step]
            found |= {
                ("named", start, end)
                for start, end, quoted in literals_of[step]
                if score(text[start:end], quoted) >= THRESHOLD
            }
    return list(found)


def spans_of(text: str) -> list[Span]:
    """All spans by start, then kind as listed; the added ones only where no base span covers."""
    base = base_spans(text)
    starts = sorted(start for _, start, _ in base)
    furthest = list(accumulate((end for _, _, end in sorted(base, key=lambda x: x[1])), max))

    def covered(start: int, end: int) -> bool:
        before = bisect_right(starts, start)
        return before > 0 and furthest[before - 1] >= end

    added = [span for span in named_spans(text) if not covered(*span[1:])]
    return sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: an array of kind, start and end (exclusive)."""
    schema = "spans array<struct<kind: string, start: long, end: long>>"
    names = ("kind", "start", "end")
    return per_text(
        docs,
        schema,
        lambda text: [([dict(zip(names, span, strict=True)) for span in spans_of(text)],)],
    )


def mask(text: str) -> str:
    """The text with every run of overlapping spans replaced by a mask."""
    out, at, end = [], 0, -1
    for _, start, stop in spans_of(text):
        if start >= end:
            out += [text[max(at, end) : start] if end >= 0 else text[at:start], MASK]
        end = max(end, stop)
        at = end
    return "".join([*out, text[at:]])


def masked(text: Column) -> Column:
    """The texts with their secrets masked; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(mask, na_action="ignore")

    return run(text)
