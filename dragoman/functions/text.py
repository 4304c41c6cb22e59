"""String helpers that follow Python's notion of whitespace, tokens and regex anchors.

Everything is a built-in column expression, so it stays in the JVM and in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: the code points Python's str.strip() and str.split() treat as whitespace
WHITESPACE_POINTS = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE = "".join(map(chr, WHITESPACE_POINTS))
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def py_strip(text: Column) -> Column:
    """``str.strip()``: Spark's ``trim`` removes only U+0020."""
    return F.btrim(text, F.lit(WHITESPACE))


def py_tokens(text: Column, first: int | None = None) -> Column:
    """``str.split()`` as an array, empty pieces dropped.

    With ``first``, that many leading tokens are right and what follows may be cut wrongly: a long text is not read to its end.
    """
    limit = -1 if first is None else first + 2  # an empty piece at the start, and the rest
    return F.filter(F.split(text, f"[{WS_CLASS}]+", limit), lambda piece: piece != "")


def token_count(text: Column) -> Column:
    """``len(text.split())`` without building the array.

    A class of many ranges is tried range by range at every character; the ranges most characters fall in come first, alone.
    """
    return F.regexp_count(text, F.lit(rf"[!-~[\xa1-\u167f\u3001-\x{{10ffff}}[^{WS_CLASS}]]]+"))


def java_pattern(pattern: str, ignore_case: bool) -> str:
    """Flags and classes that make Java match what Python's ``re.search`` matches.

    ``(?d)`` limits ``.`` and ``$`` to the line feed, ``(?iu)`` folds case beyond ASCII,
    and ``\\s`` is spelled out because Java's covers ASCII only.
    """
    body = pattern.replace(r"\s", WS_CLASS) if r"[^a-zA-Z0-9\s]" in pattern else pattern.replace(r"\s", f"[{WS_CLASS}]")
    return ("(?diu)" if ignore_case else "(?d)") + body


def fold_case(text: Column) -> Column:
    """Lower case in which a lower-case ASCII pattern finds what it finds ignoring case.

    The four letters outside ASCII that fold to an ASCII one are mapped first.
    """
    return F.lower(F.translate(text, "\u017f\u0131\u0130\u212a", "siik"))


def folds(pattern: str) -> bool:
    """Whether a pattern may run on folded text: lower-case ASCII, no class escapes."""
    return pattern.isascii() and pattern == pattern.lower() and "\\" not in pattern


def contains_any(folded: Column, pattern: str) -> Column:
    """Search a pattern that ``folds`` in folded text.

    Alternatives that are plain words are looked up as substrings, which is many times
    faster than an alternation in the regex engine; the others stay one regex.
    """
    alternatives, depth = [""], 0
    for char in pattern:
        depth += (char == "(") - (char == ")")
        if char == "|" and depth == 0:
            alternatives.append("")
        else:
            alternatives[-1] += char
    if "[" in pattern:  # a bar or bracket inside a class is no syntax; leave such a pattern whole
        return folded.rlike(java_pattern(pattern, False))
    plain = [a for a in alternatives if not set(a) & set(".^$*+?{}()")]
    hits = [folded.contains(a) for a in plain]
    rest = [a for a in alternatives if a not in plain]
    if rest:
        hits.append(folded.rlike(java_pattern("|".join(rest), False)))
    found = hits[0]
    for hit in hits[1:]:
        found = found | hit
    return found


def distinct_chars(text: Column) -> Column:
    """Distinct code points of a string."""
    return F.array_distinct(F.split(text, ""))


def char_ratio(text: Column, char_class: str) -> Column:
    """Share of characters inside ``char_class``; null for the empty string."""
    kept = F.length(F.regexp_replace(text, f"[^{char_class}]", ""))
    return kept / F.when(F.length(text) > 0, F.length(text))


def percent(part: Column, whole: Column) -> Column:
    """Percent with one place, 0 when the whole is 0."""
    return F.round(part / F.greatest(whole, F.lit(1)) * 100, 1)


def hash_bucket(key: Column, seed: str = "42", modulo: int = 100) -> Column:
    """Reproducible draw in ``[0, modulo)`` from an id: md5, first eight hex digits."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % modulo).cast("int")


def utc_day(ts: Column) -> Column:
    """``YYYY-MM-DD`` of a timestamp (session zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 second resolution with a trailing Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def thousands(number: Column) -> Column:
    """Integer with comma separators."""
    return F.format_number(number, 0)
