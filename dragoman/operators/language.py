"""Language detection from character-bigram profiles, and iso to resource class.

The profile is a fixed-size table (languages x buckets), learned by counting, so scoring
never joins against something that grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from dragoman import dims
from dragoman.functions.text import py_strip
from dragoman.session import bound_batches

BUCKETS = 4096
MIN_DISTANCE = 0.1
#: Bytes of texts turned into numbers at once, which take about fifty times as much.
PART_BYTES = 1 << 20
# fixed values: scripts that decide on their own
SCRIPTS = [("ar", "\u0600-\u06ff"), ("hi", "\u0900-\u097f"), ("zh", "\u4e00-\u9fff")]


def _parts(texts: pa.Array, size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Rows [first, last) of neighbouring texts of about ``size`` bytes together; a longer text is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        begun = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, begun + size, "right")))
        yield first, last
        first = last


def _buckets(texts: pa.Array, size: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, buckets of the adjacent character pairs of some texts end to end, pairs of each of them).

    What is held at once is bounded by ``size``, whatever the batch: a longer text comes in pieces.
    """
    for first, last in _parts(texts, size):
        known = [t or "" for t in texts.slice(first, last - first).to_pylist()]
        pieces = [known] if last - first > 1 else [[known[0][k:k + size + 1]] for k in range(0, max(len(known[0]) - 1, 1), size)]
        for piece in pieces:  # pieces of a text share a character, so that no pair is lost
            points = np.frombuffer("".join(piece).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            lengths = np.array([len(t) for t in piece], np.int64)
            pairs = (points[:-1] * 31 + points[1:]) % BUCKETS
            inside = np.ones(len(points), bool)
            inside[np.cumsum(lengths)[lengths > 0] - 1] = False  # the last character has no successor
            yield first, pairs[inside[:-1]] if len(points) else pairs, np.maximum(lengths - 1, 0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang = batch.column("lang").dictionary_encode("encode")
        number = lang.indices.to_numpy().astype(np.int64)
        for first, pairs, sizes in _buckets(batch.column("text")):
            key = np.repeat(number[first:first + len(sizes)], sizes) * BUCKETS + pairs
            seen, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(seen // BUCKETS)).cast(pa.string()), pa.array(seen % BUCKETS, pa.int32()), pa.array(n, pa.int64())],
                                             ["lang", "bucket", "n"])


def bigram_counts(texts: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Counts per language and bucket; at most languages x buckets rows, counted batch by batch before the shuffle."""
    bound_batches(texts.sparkSession)
    rows = texts.select(F.col(lang).cast("string").alias("lang"), F.lower(text).alias("text"))
    return rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def language_profile(counts: DataFrame) -> DataFrame:
    """Per language the smoothed log shares of all buckets: ``(lang, total, logp array)``.

    A language has at most ``BUCKETS`` counts, so the arrays are bounded.
    """
    per = counts.groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("bucket").cast("int"), "n"))).alias("seen"), F.sum("n").alias("total"))
    logp = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.log(
        (F.coalesce(F.try_element_at("seen", b), F.lit(0)) + 1) / (F.col("total") + BUCKETS)))
    return per.select("lang", "total", logp.alias("logp"))


def with_language_scores(texts: DataFrame, profile: DataFrame, text: str = "text") -> DataFrame:
    """Add ``lang_scores``: (language, mean log likelihood), best first.

    The whole profile, languages x buckets numbers, travels with the task: a batch of texts gathers its
    log shares and sums them by text. No row per character, no join, no shuffle.
    """
    bound_batches(texts.sparkSession)
    rows = profile.orderBy("lang").collect()
    shared = texts.sparkSession.sparkContext.broadcast(([r["lang"] for r in rows], np.array([r["logp"] for r in rows]).reshape(len(rows), BUCKETS)))

    @F.arrow_udf("array<struct<lang:string,score:double>>")
    def scores(batch: pa.Array) -> pa.Array:
        langs, logp = shared.value
        found, total = np.zeros((len(langs), len(batch))), np.zeros(len(batch), np.int64)
        for first, pairs, sizes in _buckets(batch):
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            total[first + filled] += sizes[filled]
            for known, likelihood in zip(logp, found):
                if len(starts):
                    likelihood[first + filled] += np.add.reduceat(known[pairs], starts)
        found /= np.maximum(total, 1)
        best = np.argsort(-found, axis=0, kind="stable").T.ravel()  # ties go by language
        at = np.repeat(np.arange(len(batch)), len(langs))
        ranked = pa.StructArray.from_arrays([pa.array(langs, pa.string()).take(pa.array(best)), pa.array(found[best, at])], ["lang", "score"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * len(langs), pa.int32()), ranked)

    return texts.withColumn("lang_scores", scores(F.lower(text)))


def detect_language(texts: DataFrame, profile: DataFrame, text: str = "text", sharpness: float = 20.0) -> DataFrame:
    """Add ``language_iso`` and ``language_confidence``.

    Fewer than three characters once stripped, or the best two closer than the minimum
    relative distance: ``en`` with 0.0. A text that is mostly of one script needs no profile.
    """
    stripped = texts.withColumn("_s", F.coalesce(py_strip(F.col(text)), F.lit("")))
    letters = F.length(F.regexp_replace("_s", r"[^\p{L}\p{M}]", ""))
    script = None
    for iso, chars in SCRIPTS:
        share = F.length(F.regexp_replace("_s", f"[^{chars}]", "")) * 2 > letters
        script = F.when(share, iso) if script is None else script.when(share, iso)
    script = F.when(F.col("_s").rlike(f"[{''.join(chars for _, chars in SCRIPTS)}]"), script)  # most texts have no such character
    scored = with_language_scores(stripped, profile, "_s").withColumns({"_short": F.length("_s") < 3, "_script": script})
    best = F.get("lang_scores", F.lit(0))
    weighed = scored.withColumn("_w", F.transform("lang_scores", lambda s: F.exp((s["score"] - best["score"]) * sharpness)))
    total = F.aggregate("_w", F.lit(0.0), lambda acc, x: acc + x)
    first = F.get("_w", F.lit(0)) / total
    second = F.coalesce(F.get("_w", F.lit(1)), F.lit(0.0)) / total
    clear = first - second >= MIN_DISTANCE
    return weighed.withColumns({
        "language_iso": F.when(F.col("_short"), "en").when(F.col("_script").isNotNull(), F.col("_script"))
        .when(clear, best["lang"]).otherwise("en"),
        "language_confidence": F.when(F.col("_short"), 0.0).when(F.col("_script").isNotNull(), 1.0)
        .when(clear, F.round(first, 4)).otherwise(0.0),
    }).drop("_s", "_short", "_script", "_w", "lang_scores")


def iso_to_resource(rows: DataFrame, iso: str = "language_iso", languages: DataFrame | None = None) -> DataFrame:
    """Add ``resource_class`` of the iso code, the default for unknown codes."""
    languages = dims.dim_language(rows.sparkSession) if languages is None else languages
    lookup = languages.select(F.col("iso").alias(iso), F.col("resource_class").alias("_rc"))
    return rows.join(F.broadcast(lookup), iso, "left").withColumn(
        "resource_class", F.coalesce("_rc", F.lit(dims.DEFAULT_RESOURCE))).drop("_rc")
