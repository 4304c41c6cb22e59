"""Tokenizer statistics and word-level encoding as Spark jobs."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dragoman import dims
from dragoman.functions.arrays import fixed_length
from dragoman.functions.text import py_tokens

# fixed value: the pre-token pattern of byte-level tokenizers
PRETOKEN = (r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself when visible Latin-1, else the next free point from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def byte_level_tokens(text: Column) -> Column:
    """Pre-tokens of a text as an array; a leading space is added as the trainer does, not to an empty text."""
    prefixed = F.when(text.startswith(" ") | (text == ""), text).otherwise(F.concat(F.lit(" "), text))
    return F.regexp_extract_all(prefixed, F.lit(PRETOKEN), F.lit(0))


def pretoken_patterns(spark: SparkSession) -> tuple[str, str]:
    """``PRETOKEN`` for Python's ``re``, and the spaces before which a text may be cut without cutting a pre-token.

    Java's classes are read off a string of all code points in order, so that both engines mean the same characters.
    No pre-token goes on over a space that is followed by no other white space, nor depends on what is before it.
    """
    points = "".join(chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF)
    classes = [F.regexp_extract_all("points", F.lit(f"(?U){c}+"), F.lit(0)) for c in (r"\p{L}", r"\p{N}", r"\s")]
    runs = spark.createDataFrame(pa.table({"points": [points]})).select(*classes).collect()[0]
    letter, number, space = ("".join(f"{re.escape(x[0])}-{re.escape(x[-1])}" for x in found) for found in runs)
    return (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+",
            f" (?=[^{space}])")


def byte_symbols(token: Column) -> Column:
    """Symbols of a pre-token: one printable character per UTF-8 byte."""
    table = F.array(*[F.lit(c) for c in byte_alphabet()])
    pairs = F.regexp_extract_all(F.hex(F.encode(token, "UTF-8")), F.lit(".."), F.lit(0))
    return F.transform(pairs, lambda h: F.get(table, F.conv(h, 16, 10).cast("int")))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for text in batch.column(0).to_pylist():
            counts.update((text or "").split())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def word_counts(texts: DataFrame, text: str = "text", byte_level: bool = False, min_count: int = 2) -> DataFrame:
    """Pre-token frequencies, counted batch by batch before the shuffle, so frequent words do not skew."""
    if byte_level:
        words = texts.select(F.explode(byte_level_tokens(F.col(text))).alias("word"))
        counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    else:  # str.split() is the definition of these words
        counts = texts.select(F.col(text)).mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def pair_counts(words: DataFrame) -> DataFrame:
    """Frequency of adjacent symbol pairs over ``words(symbols, n)``."""
    pairs = F.expr("transform(sequence(1, size(symbols) - 1), i -> struct(symbols[i - 1] as left, symbols[i] as right))")
    return (words.filter(F.size("symbols") > 1).select("n", F.explode(pairs).alias("p"))
            .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(F.sum("n").alias("freq")))


def word_vocabulary(counts: DataFrame, size: int = dims.VOCAB_SIZE) -> DataFrame:
    """Ids of the most frequent words behind the special tokens: a top-k, then numbering at most ``size`` rows."""
    first = len(dims.SPECIAL_TOKENS)
    top = counts.orderBy(F.desc("n"), "word").limit(size - first)
    return top.select("word", (F.row_number().over(Window.orderBy(F.desc("n"), "word")) + first - 1).alias("token_id"))


def encode_words(texts: DataFrame, vocabulary: DataFrame, row_id: str, text: str = "text",
                 max_len: int = dims.MAX_TOKENS) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of fixed length from a word vocabulary.

    Only the words that fit ``max_len`` are cut off a text; the rest is dropped by the model's length anyway.
    The vocabulary has at most its fixed size; every task looks up a batch of words in it at once, so there
    is no row per word and nothing is shuffled. Null and empty texts have no words.
    """
    pad, unk, cls, sep = (dims.SPECIAL_TOKENS.index(t) for t in ("[PAD]", "[UNK]", "[CLS]", "[SEP]"))
    known = vocabulary.select("word", F.col("token_id").cast("int")).toArrow().combine_chunks()
    shared = texts.sparkSession.sparkContext.broadcast((known.column(0).combine_chunks(), known.column(1).combine_chunks()))

    @F.arrow_udf("array<int>")
    def look_up(words: pa.Array) -> pa.Array:
        spelled, numbers = shared.value
        found = pc.index_in(words.flatten().cast(spelled.type), value_set=spelled)
        ids = pc.fill_null(numbers.take(found), unk)
        borders = np.r_[0, np.cumsum(words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        return pa.ListArray.from_arrays(pa.array(borders, pa.int32()), ids)

    first = F.slice(py_tokens(F.col(text), max_len - 2), 1, max_len - 2)
    looked_up = texts.select(row_id, look_up(first).alias("_ids"))
    padded, mask = fixed_length(F.col("_ids"), max_len, cls, sep, pad)
    return looked_up.select(row_id, padded.alias("input_ids"), mask.alias("attention_mask"))
