"""Strings that every match of a regex must contain, and an index of them by trigrams.

``required`` reads a pattern from left to right and keeps the longest run of plain characters that no quantifier makes optional; of
alternatives it needs one string each. What it does not know for certain it gives up on: then the pattern has no strings and must be
tried on every text, which is slower and never wrong."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 3
#: Strings looked for in a text before a regex is tried on it.
NEEDED = 3
_ZERO_WIDTH, _CLASSES = "bBAzZG", "dDsSwWhHvVRX"


class _Unknown(Exception):
    """Syntax whose meaning for the strings is not worth knowing."""


def _better(a: frozenset[str] | None, b: frozenset[str] | None) -> frozenset[str] | None:
    """Of two sets of strings, of each of which one must occur, that with the longer shortest string."""
    if not a or not b:
        return a or b
    return max(a, b, key=lambda s: (min(map(len, s)), -len(s)))


def _best(needs: list[frozenset[str]]) -> frozenset[str] | None:
    return reduce(_better, needs, None)


class _Reader:
    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def alternatives(self) -> list[frozenset[str]]:
        """Sets of strings, of each of which one must occur."""
        found = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            found.append(self.sequence())
        if len(found) == 1:
            return found[0]
        best = [_best(own) for own in found]
        return [] if None in best else [frozenset().union(*best)]  # type: ignore[arg-type]

    def sequence(self) -> list[frozenset[str]]:
        needs, run = [], ""
        while self.peek() not in ("", "|", ")"):
            kind, value = self.atom()
            least, more = self.quantifier()
            if kind == "zero":
                continue
            if kind == "letter" and least > 0:
                run += value
                if not more:
                    continue
            needs += [frozenset([run])] if run else []
            run = ""
            if kind == "group" and least > 0:
                needs += value
        return needs + ([frozenset([run])] if run else [])

    def atom(self) -> tuple[str, object]:
        c = self.p[self.i]
        self.i += 1
        if c == "\\":
            c = self.peek()
            self.i += 1
            if c and c in _ZERO_WIDTH:
                return "zero", None
            if c and c in _CLASSES:
                return "any", None
            if not c or c.isalnum():
                raise _Unknown
            return "letter", c
        if c == "[":
            self.skip_class()
            return "any", None
        if c == "(":
            return self.group()
        if c in "^$":
            return "zero", None
        if c == ".":
            return "any", None
        if c in "*+?{":
            raise _Unknown
        return "letter", c

    def skip_class(self) -> None:
        depth = 1
        if self.peek() == "^":
            self.i += 1
        if self.peek() == "]":
            raise _Unknown
        while depth:
            c = self.peek()
            if not c:
                raise _Unknown
            self.i += 2 if c == "\\" else 1
            depth += (c == "[") - (c == "]")

    def group(self) -> tuple[str, object]:
        looks = False
        if self.peek() == "?":
            rest = self.p[self.i :]
            for mark, look in (("?:", False), ("?>", False), ("?=", True), ("?!", True), ("?<=", True), ("?<!", True)):
                if rest.startswith(mark):
                    self.i, looks = self.i + len(mark), look
                    break
            else:
                if not rest.startswith("?<") or ">" not in rest:
                    raise _Unknown
                self.i += rest.index(">") + 1
        inside = self.alternatives()
        if self.peek() != ")":
            raise _Unknown
        self.i += 1
        return ("any", None) if looks else ("group", inside)

    def quantifier(self) -> tuple[int, bool]:
        """Least number of times, and whether it may be more than one."""
        c, least, more = self.peek(), 1, False
        if c and c in "*?+":
            least, more = (1 if c == "+" else 0), True
            self.i += 1
        elif c == "{":
            stop = self.p.find("}", self.i)
            low = self.p[self.i + 1 : stop].split(",")[0]
            if stop < 0 or not low.isdigit():
                raise _Unknown
            least, more, self.i = int(low), True, stop + 1
        else:
            return least, more
        if self.peek() in ("?", "+") and self.peek():
            self.i += 1
        return least, more


def all_required(pattern: str) -> list[frozenset[str]]:
    """Sets of strings, of each of which every match of the pattern contains one; none where that is not known."""
    reader = _Reader(pattern)
    try:
        found = reader.alternatives()
        return found if reader.i == len(pattern) else []
    except _Unknown:
        return []


def required(pattern: str) -> frozenset[str] | None:
    """Strings one of which every match of the pattern contains, the longest such; None where that is not known."""
    return _best(all_required(pattern))


def certain(pattern: str) -> list[str]:
    """``NEEDED`` strings (some may be empty) that every match of the pattern contains, the longest first."""
    found = sorted({s for own in all_required(pattern) if len(own) == 1 for s in own}, key=lambda s: (-len(s), s))
    return (found + [""] * NEEDED)[:NEEDED]


def chosen_grams(patterns: Sequence[str]) -> list[list[str] | None]:
    """Per pattern the trigrams one of which a text must have to match, of each string the one that the fewest others share; None for patterns
    without strings of that length."""
    needs = [required(p) for p in patterns]
    grams = [{s[k : k + GRAM] for s in n for k in range(len(s) - GRAM + 1)} if n else set() for n in needs]
    shared = Counter(g for own in grams for g in own)
    out: list[list[str] | None] = []
    for n in needs:
        if not n or min(map(len, n)) < GRAM:
            out.append(None)
        else:
            out.append(sorted({min((s[k : k + GRAM] for k in range(len(s) - GRAM + 1)), key=lambda g: (shared[g], g)) for s in n}))
    return out


def text_grams(text: Column) -> Column:
    """Distinct trigrams of a text."""
    starts = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM))))
