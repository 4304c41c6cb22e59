"""Secret scan: fixed patterns, and values in a credential's place that would be costly to guess.

The guess cost of a value is the cheapest way to cut it into words, dates, repeats, keyboard walks
and brute-force characters, found by dynamic programming over whole values in time linear in their
length. Costs are decimal logarithms of the number of guesses.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import Column, functions as F

# fixed patterns: what counts as a base secret; a kind's matches do not overlap
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, as those of [0-9a-f]+ with 16 characters or more
KINDS = ("assign", "access", "hex", "costly")

#: A credential's place: a name, a separator, and a quoted or bare value. Word characters and hyphens may stand around the
#: credential word; the short words end where letters end or capitals begin, so that "author" and "bypass" are none. A run of
#: name characters is tried at its start only and never given back, so matching is linear.
CONTEXT = re.compile(
    r"(?a:(?<![\w-])(?=[\w-]*?(?:(?i:pass(?:word|wd|phrase|code)|secret(?!ar)|token(?!i[sz])|credential|(?:api|access|auth|private)[_\x20-]?key)"
    r"|(?:(?<![A-Za-z])(?i:pass|pwd|auth)|(?<=[a-z])(?:Pass|Pwd|Auth))(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z]))))"
    r"(?:[\w-]++\x20(?=(?i:key)(?![A-Za-z])))?[\w-]++)"
    r"[\"']?\x20{0,3}(?:=>|:=|=|:)\x20{0,3}(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'<>,;]+))")
MIN_VALUE = 8
#: Decimal logarithm of the guesses from which a value counts as secret: that of ``MIN_VALUE`` characters without a pattern.
MIN_COST = 8.0

#: Stands for a value that is filled in elsewhere.
PLACEHOLDER = re.compile(r"(?a:\$\{[^{}]*\}|\$\([^()]*\)|\$[A-Z_][A-Z0-9_]*|\{\{[^{}]*\}\}|\{[\w.]*\}|<[^<>]*>|%\w+%|\[[\w -]+\])")

# fixed values: common password words, the most common first
WORDS = """
password 123456 qwerty letmein welcome admin monkey dragon football baseball iloveyou master sunshine princess shadow login
abc123 trustno1 superman batman hello freedom whatever michael jordan hunter soccer killer george secret pass test user root
guest default changeme example sample dummy token key access service database server system manager demo temp public private
summer winter spring autumn monday friday love money house computer internet company office home family dog cat blue green red
black white orange purple silver gold star angel baby happy lucky magic power ranger tiger eagle lion wolf bear horse fish
coffee cookie pepper ginger banana apple cherry flower rainbow diamond crystal thunder storm phoenix knight king queen prince
correct staple battery the and for you not with this that from your have are was will one two three my new old big
""".split()
#: Letters of a vocabulary's word or part of a word, at least: shorter ones are as cheap letter by letter.
MIN_WORD = 4
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("013457@$!", "oieastasi")

BRUTE = 1.0                 # ten guesses a character
PART = math.log10(2)        # each recognised part doubles the guesses: where it starts
CASE = math.log10(2)        # some letters are upper case
SWAPPED = math.log10(4)     # digits or signs stand for letters
TURN = math.log10(5)        # neighbours of a key
DAY = math.log10(365)
LONGEST_BLOCK = 8           # of a repeated block


def ranked_words(model_path: str) -> tuple[str, ...]:
    """``WORDS``, then the lower-case words and parts of words of a public BPE vocabulary in the order of their merges, which
    follows their frequency. The list is as long as the vocabulary at most, whatever the corpus, and copies in the corpus do not move it."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = (sp.id_to_piece(k).removeprefix("▁") for k in range(sp.vocab_size()))
    return tuple(dict.fromkeys([*WORDS, *(p for p in pieces if len(p) >= MIN_WORD and p.isalpha() and p.islower())]))


def _neighbours() -> dict[str, frozenset[str]]:
    place = {c: (r, k) for r, row in enumerate(KEYBOARD) for k, c in enumerate(row)}
    near = lambda a, b: a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1
    return {c: frozenset(x for x, b in place.items() if near(a, b)) for c, a in place.items()}


NEIGHBOURS = _neighbours()
DATE = re.compile(r"(?a)(?:(\d{4})([-/. ]?)(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/. ]?)(\d{1,2})\6(\d{4}|\d{2})|(19\d\d|20\d\d))")


class GuessCost:
    """Guess cost with a ranked list of words (the first is guessed first)."""

    def __init__(self, words: Iterable[str] = WORDS):
        self.cost: dict[str, float] = {}
        for rank, word in enumerate(words, 1):
            self.cost.setdefault(word.lower(), math.log10(rank + 1))
        self.longest = max(map(len, self.cost), default=0)

    def _words(self, value: str) -> Iterator[tuple[int, int, float]]:
        plain = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        swapped = plain.translate(LEET)
        for text, extra in ((plain, 0.0),) if swapped == plain else ((plain, 0.0), (swapped, SWAPPED)):
            for k in range(len(text)):
                for end in range(k + 2, min(k + self.longest, len(text)) + 1):
                    if (cost := self.cost.get(text[k:end])) is not None:
                        yield k, end, cost + extra + (CASE if value[k:end] != value[k:end].lower() else 0)

    @staticmethod
    def _dates(value: str) -> Iterator[tuple[int, int, float]]:
        for k in range(len(value)):
            if value[k].isdigit() and (m := DATE.match(value, k)):
                if m[9]:
                    yield k, m.end(), math.log10(max(20, abs(int(m[9]) - 2000)))
                    continue
                year, sep, parts = (m[1], m[2], (m[3], m[4])) if m[1] else (m[8], m[6], (m[5], m[7]))
                a, b = map(int, parts)
                if 1 <= min(a, b) <= 12 and 1 <= max(a, b) <= 31:
                    span = 100 if len(year) == 2 else max(20, abs(int(year) - 2000))
                    yield k, m.end(), DAY + math.log10(span) + (math.log10(4) if sep else 0)

    @staticmethod
    def _repeats(value: str) -> Iterator[tuple[int, int, float]]:
        n = len(value)
        for size in range(1, min(LONGEST_BLOCK, n // 2) + 1):
            same = 0
            for k in range(n - size - 1, -1, -1):
                same = same + 1 if value[k] == value[k + size] else 0
                times = 1 + same // size
                if times >= (3 if size == 1 else 2):
                    yield k, k + size * times, BRUTE * size + math.log10(times)

    @staticmethod
    def _walks(value: str) -> Iterator[tuple[int, int, float]]:
        lower, end = value.lower(), len(value)
        if len(lower) != end:
            return
        turns = 0
        for k in range(end - 2, -1, -1):
            if lower[k + 1] not in NEIGHBOURS.get(lower[k], ()):
                end, turns = k + 1, 0
                continue
            straight = k + 2 < end and any(lower[k:k + 3] in row or lower[k:k + 3][::-1] in row for row in KEYBOARD)
            turns += not straight
            if end - k >= 3:
                yield k, end, math.log10(len(NEIGHBOURS)) + turns * TURN + math.log10(end - k)

    def __call__(self, value: str) -> float:
        """The least cost over all ways to cut the whole value."""
        ends: dict[int, list[tuple[int, float]]] = {}
        for parts in (self._words(value), self._dates(value), self._repeats(value), self._walks(value)):
            for start, end, cost in parts:
                ends.setdefault(start, []).append((end, cost + PART))
        least = [0.0] + [math.inf] * len(value)
        for k in range(len(value)):
            if least[k] + BRUTE < least[k + 1]:
                least[k + 1] = least[k] + BRUTE
            for end, cost in ends.get(k, ()):
                if least[k] + cost < least[end]:
                    least[end] = least[k] + cost
        return least[-1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind; each kind's matches do not overlap."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def costly_spans(text: str, base: list[tuple[int, int, str]], cost: GuessCost, min_cost: float) -> list[tuple[int, int, str]]:
    """Values in a credential's place, outside the base spans and no placeholders, whose guess cost is ``min_cost`` or more."""
    out = []
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        if end - start < MIN_VALUE or any(a <= start and end <= b for a, b, _ in base) or PLACEHOLDER.fullmatch(text, start, end):
            continue
        if cost(text[start:end]) >= min_cost:
            out.append((start, end, "costly"))
    return out


def scan(text: Column, words: Iterable[str] = WORDS, min_cost: float = MIN_COST) -> Column:
    """Array of structs (start int, end int, kind string, cost double) of each whole text.

    Offsets are code points, the end is exclusive; spans come by start, then by kind in the order of
    ``KINDS``. ``words`` come in the order they are guessed in (see ``ranked_words``). ``cost`` is the guess cost of an assigned or costly value, null for the other kinds.
    Null and empty texts have none. Every row is scanned by itself.
    """
    words = tuple(words)

    @F.pandas_udf("array<struct<start:int,end:int,kind:string,cost:double>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cost = GuessCost(words)
        for texts in batches:
            yield pd.Series([_scan(t or "", cost, min_cost) for t in texts], dtype=object)
    return found(text)


def _scan(text: str, cost: GuessCost, min_cost: float) -> list[dict]:
    base = base_spans(text)
    spans = sorted(base + costly_spans(text, base, cost, min_cost), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    out = []
    for start, end, kind in spans:
        value = ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end] if kind == "costly" else None
        out.append({"start": start, "end": end, "kind": kind, "cost": value and cost(value)})
    return out


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every run of overlapping spans replaced by ``mask``; null stays null."""
    state = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda s, x: F.struct(
        F.when(x.start >= s["at"], F.concat(s.done, F.substring(text, s["at"] + 1, x.start - s["at"]), F.lit(mask))).otherwise(s.done).alias("done"),
        F.greatest(s["at"], x.end).alias("at"))
    done = F.aggregate(spans, state, step, lambda s: F.concat(s.done, F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
