"""Chat formatting with typed content parts, in column expressions.

A visitor maps each part of a message to its written form: texts are escaped, images, audio and documents
become placeholders, and each placeholder has an attachment with its reference and the number of tokens it
expands to. Control strings inside texts and roles get a backslash behind their bracket, one more than they
had, so the formatted text holds control strings only where the template put them and can be read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman.functions.plan import bind_once
from dragoman.llm.common import col

TURN, BODY, END, PART = "<s>[INST]", "[/INST]", "</s>", "[PART]"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
#: Placeholder of an attachment of any other type; it counts one token.
OTHER = "[FILE]"
#: Stands for an empty text while a body is read back; never written.
EMPTY = "[/PART]"
TEXT = "text"
PARTS = "array<struct<type string, text string, ref string, width int, height int, seconds double, pages int>>"
#: Tokens of an attachment: image patches of so many pixels a side, audio frames a second, tokens of a page.
PATCH, FRAMES_A_SECOND, TOKENS_A_PAGE = 14, 25, 256

_NAMES = "s|INST|PART|IMG|AUDIO|DOC|FILE"
_BARE = rf"([<\[]\\*)(/?(?:{_NAMES})[>\]])"
_ESCAPED = rf"([<\[]\\*)\\(/?(?:{_NAMES})[>\]])"
_TURNS = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"


def escaped(text: Column) -> Column:
    """``text`` without control strings; ``unescaped`` gives it back. Null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BARE, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def text_parts(text: Column) -> Column:
    """A message of one text part."""
    return F.array(F.struct(
        F.lit(TEXT).alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _by_type(part: Column, visits: dict[str, Column], other: Column) -> Column:
    """Dispatch on the type of a part; a null part is an empty text."""
    chain = F.when(part.isNull(), visits[TEXT])
    return reduce(lambda c, kind: c.when(part["type"] == kind, visits[kind]), visits, chain).otherwise(other)


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment expands to; at least 1, also where its sizes are null or negative."""
    patches = lambda side: F.ceil(F.greatest(side, F.lit(1)) / PATCH)
    counts = {TEXT: F.lit(0).cast("long"), "image": patches(part["width"]) * patches(part["height"]),
              "audio": F.ceil(part["seconds"] * FRAMES_A_SECOND), "document": part["pages"].cast("long") * TOKENS_A_PAGE}
    least = F.when(part.isNull() | (part["type"] == TEXT), 0).otherwise(1)
    return F.greatest(F.coalesce(_by_type(part, counts, F.lit(1).cast("long")), least.cast("long")), least.cast("long"))


def _is_text(part: Column) -> Column:
    return part.isNull() | F.coalesce(part["type"] == TEXT, F.lit(False))


def _pieces(parts: Column) -> Column:
    """Per part: the separator before it, its written form, whether it is text, and its attachment."""
    def visit(part: Column, i: Column) -> Column:
        written = _by_type(part, {TEXT: escaped(part["text"]), **{k: F.lit(v) for k, v in PLACEHOLDERS.items()}}, F.lit(OTHER))
        joins = (i > 0) & _is_text(part) & _is_text(F.get(parts, i - 1))
        return F.struct(F.when(joins, PART).otherwise("").alias("before"), written.alias("written"), _is_text(part).alias("text"),
                        F.struct(part["type"].alias("type"), part["ref"].alias("ref"), expanded_tokens(part).alias("tokens")).alias("attachment"))
    return F.transform(F.coalesce(parts, F.array().cast(PARTS)), visit)


def formatted(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
              loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: (conv_id, formatted, loss_mask, attachments, attachment_tokens).

    ``messages`` has one row per message with its content ``parts`` (type ``PARTS``). Messages go by turn,
    nulls first, and of one turn by role and written text; repeated rows are repeated turns. Null roles,
    parts and texts are empty, null conversation ids are one conversation. ``loss_mask`` has the spans
    (start, end) of the text parts of ``loss_role`` in bytes of the UTF-8 form, in order; separators and
    placeholders stay outside. The k-th placeholder belongs to the k-th attachment (type, ref, tokens).
    An empty table gives no rows; other columns are not read. A conversation is one value, so it must fit
    into a string of Spark; nothing else grows with it faster than its length.
    """
    rows = messages.select(col(conv).alias("conv_id"), col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                           col(parts).alias("parts"))
    rows = bind_once(rows, {"pieces": _pieces(F.col("parts"))}, drop=("parts",))
    rows = bind_once(rows, {"head": F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)),
                            "body": F.array_join(F.transform("pieces", lambda p: F.concat(p.before, p.written)), "")})
    rows = rows.withColumn("size", (F.octet_length("head") + F.octet_length("body") + len(END)).cast("long"))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")))

    sizes = F.transform("pieces", lambda p: F.octet_length(p.before) + F.octet_length(p.written))
    ahead = lambda i: F.aggregate(F.slice("sizes", 1, i), F.lit(0).cast("long"), lambda a, x: a + x)
    def span(p: Column, i: Column) -> Column:
        start = F.col("start") + F.octet_length("head") + ahead(i) + F.octet_length(p.before)
        return F.struct(start.alias("start"), (start + F.octet_length(p.written)).alias("end"), p.text.alias("text"))
    rows = bind_once(rows, {"sizes": sizes})
    spans = F.transform(F.filter(F.transform("pieces", span), lambda s: s.text), lambda s: F.struct(s.start, s.end))
    attached = F.transform(F.filter("pieces", lambda p: ~p.text), lambda p: p.attachment)
    turns = rows.select("conv_id", F.struct(
        "start", F.concat("head", "body", F.lit(END)).alias("written"),
        F.when(F.col("role") == loss_role, spans).otherwise(F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
        attached.alias("attached")).alias("t"))
    whole = bind_once(turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")), {"turns": F.col("t")}, drop=("t",))
    return bind_once(whole, {
        "formatted": F.array_join(F.transform("turns", lambda t: t.written), ""),
        "loss_mask": F.flatten(F.transform("turns", lambda t: t.spans)),
        "attachments": F.flatten(F.transform("turns", lambda t: t.attached)),
        "attachment_tokens": F.aggregate(F.flatten(F.transform("turns", lambda t: t.attached)), F.lit(0).cast("long"), lambda a, x: a + x.tokens),
    }, drop=("turns",))


def turns(formatted_text: Column) -> Column:
    """Array of (role, body) of a formatted text; the role is unescaped, the body is as written."""
    return F.arrays_zip(F.transform(F.regexp_extract_all(formatted_text, F.lit(_TURNS), F.lit(1)), unescaped).alias("role"),
                        F.regexp_extract_all(formatted_text, F.lit(_TURNS), F.lit(2)).alias("body"))


def body_parts(body: Column) -> Column:
    """Array of (type, text) of a body, in order: texts unescaped, attachments with a null text.

    An empty body is one empty text; an empty text beside a placeholder is not kept.
    """
    media = "|".join(k.replace("[", r"\[").replace("]", r"\]") for k in [*PLACEHOLDERS.values(), OTHER, PART, EMPTY])
    # a text is empty between two separators, and between a separator and the body's end
    marked = F.when(body == "", EMPTY).otherwise(F.regexp_replace(body, r"(?<=\[PART\])(?=\[PART\]|\z)|^(?=\[PART\])", EMPTY))
    cut = F.filter(F.split(marked, f"(?={media})|(?<={media})"), lambda x: (x != "") & (x != PART))
    named = lambda x: reduce(lambda c, k: c.when(x == PLACEHOLDERS[k], k), PLACEHOLDERS, F.when(x == OTHER, "other")).otherwise(TEXT)
    return F.transform(cut, lambda x: F.struct(
        named(x).alias("type"), F.when(x == EMPTY, "").when(named(x) == TEXT, unescaped(x)).alias("text")))


def masked_texts(formatted_bytes: Column, mask: Column) -> Column:
    """The unescaped text of each span of a loss mask; ``formatted_bytes`` is a stored column of UTF-8 bytes."""
    return F.transform(mask, lambda m: unescaped(F.decode(F.substr(formatted_bytes, (m.start + 1).cast("int"), (m.end - m.start).cast("int")), "UTF-8")))


def read_back(chats: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted_chars) from ``formatted`` and ``loss_mask`` alone.

    A turn is (role, text): its text parts unescaped, end to end, without attachments.
    """
    bound = bind_once(chats.select("conv_id", "loss_mask", "formatted"), {
        "bytes": F.encode("formatted", "UTF-8"), "found": turns(F.col("formatted")), "formatted_chars": F.length("formatted").cast("long")}, drop=("formatted",))
    return bound.select(
        "conv_id", "formatted_chars", masked_texts(F.col("bytes"), F.col("loss_mask")).alias("loss_texts"),
        F.transform("found", lambda t: F.struct(t.role.alias("role"), F.array_join(F.transform(
            F.filter(body_parts(t.body), lambda p: p.type == TEXT), lambda p: p.text), "").alias("text"))).alias("turns"))
