"""The regex cascade for a table of many patterns: literals first, regexes for candidates only.

Most patterns cannot match a text that lacks certain letters. From the parse of each pattern follows a set of
literals of which every match holds at least one; the literals of all patterns make one automaton, which reads a
text once, however many patterns there are. Only patterns that are found that way, and the few without such a
set, are tried as regexes, in order of priority until the first match. The result is that of trying all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Patterns of a table at most: it is a dimension that every task holds.
MAX_PATTERNS = 200_000
# fixed values: letters outside ASCII that fold to an ASCII one when case is ignored
_FOLDED = str.maketrans({"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"})


def folded(text: str) -> str:
    return text.translate(_FOLDED).lower()


def _usable(char: str) -> bool:
    """Letters whose case folding is the same everywhere: ASCII, and scripts without case."""
    return char.isascii() or char.lower() == char.upper() == char


def _best(*sets: frozenset[str] | None) -> frozenset[str] | None:
    """The most selective of several sets that are all required: the longest shortest literal, then the fewest."""
    known = [s for s in sets if s]
    return max(known, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _required(parsed) -> frozenset[str] | None:
    """Literals of which a match of a parsed sequence holds at least one; None where nothing is sure."""
    found, run = [], ""
    for kind, value in [*parsed, (None, None)]:
        name = str(kind)
        if name == "LITERAL" and _usable(chr(value)):
            run += folded(chr(value))
            continue
        if run:
            found.append(frozenset([run]))
            run = ""
        if name == "SUBPATTERN":
            found.append(_required(value[-1]))
        elif name == "ATOMIC_GROUP":
            found.append(_required(value))
        elif name == "BRANCH":
            sets = [_required(x) for x in value[1]]
            found.append(frozenset().union(*sets) if all(sets) else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            found.append(_required(value[2]))
    return _best(*found)


def required_literals(pattern: str, ignore_case: bool = False) -> frozenset[str] | None:
    """Folded literals of which every match holds at least one, or None."""
    return _required(re._parser.parse(pattern, re.IGNORECASE if ignore_case else 0))


class PatternTable:
    """Patterns (pattern, ignore_case, ...) in order of priority."""

    def __init__(self, patterns: list[tuple]):
        import ahocorasick
        self.compiled = [re.compile(p[0], re.IGNORECASE if p[1] else 0) for p in patterns]
        self.always, by_literal = [], {}
        for number, (pattern, ignore_case, *_) in enumerate(patterns):
            literals = required_literals(pattern, ignore_case)
            for literal in literals or ():
                by_literal.setdefault(literal, []).append(number)
            if not literals:
                self.always.append(number)
        self.automaton = ahocorasick.Automaton()
        for literal, numbers in by_literal.items():
            self.automaton.add_word(literal, numbers)
        if by_literal:
            self.automaton.make_automaton()
        self.has_literals = bool(by_literal)

    def candidates(self, text: str) -> list[int]:
        hit = set(self.always)
        if self.has_literals:
            seen = set()
            for _, numbers in self.automaton.iter(folded(text)):
                if id(numbers) not in seen:  # a literal that occurs often is taken once
                    seen.add(id(numbers))
                    hit.update(numbers)
        return sorted(hit)

    def first(self, text: str) -> int | None:
        for number in self.candidates(text):
            if self.compiled[number].search(text):
                return number
        return None


def classify_by_table(messages: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """Add ``rule_no, label, tier, matched`` of the first pattern found; none gives ``unknown`` and ``?``.

    ``patterns(priority, pattern, ignore_case, label, tier)`` holds Python regexes, the least priority first, of
    equal ones that with the lesser pattern. ``rule_no`` counts from 0. Null texts match nothing.
    """
    rows = patterns.orderBy("priority", "pattern").limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns; a table of patterns is a dimension")
    shared = messages.sparkSession.sparkContext.broadcast([(r["pattern"], r["ignore_case"], r["label"], r["tier"]) for r in rows])

    @F.arrow_udf("rule_no int, label string, tier string")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        listed = shared.value
        table = PatternTable(listed)
        for batch in batches:
            found = [None if t is None else table.first(t) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays([
                pa.array(found, pa.int32()), pa.array(["unknown" if n is None else listed[n][2] for n in found], pa.string()),
                pa.array(["?" if n is None else listed[n][3] for n in found], pa.string())], ["rule_no", "label", "tier"])

    marked = messages.withColumn("_found", classify(F.col(text)))
    kept = [c for c in messages.columns if c not in ("rule_no", "label", "tier", "matched")]
    return marked.select(*[F.col(f"`{c}`") for c in kept], "_found.rule_no", "_found.label", "_found.tier", F.col("_found.rule_no").isNotNull().alias("matched"))
