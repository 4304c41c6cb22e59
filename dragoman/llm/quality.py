"""Quality rules on distributions: how far a text's characters and common words lie from its language's.

References are histograms of character classes and of common words, gathered from the whole corpus for
each language. A text is compared by the Jensen-Shannon distance (base 2: 0 to 1), if it is long enough
for a histogram to mean something. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.functions.plan import bind_once
from dragoman.llm.common import bound_batches, col, through_table

#: What most characters of a text are; the classes are counted in what this leaves.
PLAIN = r"[a-z\u00DF-\u00F6\u00F8-\u00FF\x20\x09-\x0D]+"
#: Classes of the other characters, in Java's regular expressions. The bins of a histogram are PLAIN, these, and the rest.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "point": r"\p{P}", "sign": r"\p{S}"}
#: A word is common if it makes up this part of a language's words: at most 1 / COMMON words of each.
COMMON = 0.005
#: Slots that words are hashed to where they are not counted one by one.
SLOTS = 1 << 15
#: Part of the texts that words are guessed from, and words guessed at most. A poor guess costs a pass, never a word.
GUESSED_FROM, GUESSED = 1 / 32, 2000
#: Common words of all languages that are looked up as constants; with more, every word of a text is counted first.
MAX_CONSTANTS = 10_000
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.24
MAX_WORD_DISTANCE = 0.45


def words_of(text: Column) -> Column:
    spaced = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\f\r":  # a split at one plain character needs no regular expression
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")


def unplain(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, "")


def class_counts(chars: Column, rest: Column) -> Column:
    """Counts of the bins from the number of characters and what is left without the plain ones."""
    found = [F.regexp_count(rest, F.lit(p)) for p in CLASSES.values()]
    other = F.length(rest) - sum(found[1:], found[0])
    return F.transform(F.array(chars - F.length(rest), *found, other), lambda n: n.cast("long"))


def repeated_words(words: Column) -> tuple[dict[str, Column], Column]:
    """Words in windows of three that occur twice or more, by position: (columns to bind first, the count)."""
    at = lambda k: F.get(words, k)
    windows = F.when(F.size(words) >= 4, F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda k: F.xxhash64(at(k), at(k + 1), at(k + 2)))).otherwise(
        F.array().cast("array<bigint>"))
    h = F.col("_windows")
    # most texts repeat no window; only the others are sorted
    ranked = F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("k"))))).otherwise(
        F.array().cast("array<struct<h:bigint,k:int>>"))
    r = F.col("_ranked")
    same = lambda x, k: F.coalesce(F.get(r, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(r, k + 1)["h"] == x["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(r, same), lambda x: x["k"]))
    p = F.col("_places")
    gaps = F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(3)))
    count = F.when(F.size(p) > 0, F.aggregate(gaps, F.lit(3), lambda s, g: s + g)).otherwise(0).cast("long")
    return {"_windows": windows, "_ranked": ranked, "_places": places}, count


def _term(p: Column, q: Column) -> Column:
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Histograms of the corpus: (lang, classes, words, shares), a row per language and one of a null lang for all rows.

    ``classes`` are the shares of the bins, ``words`` the common words in order and ``shares`` theirs. Rows without a
    lang count for the whole corpus only. Counts cover all rows and whole texts; an empty corpus gives no rows.

    One pass counts the words guessed to be common one by one, and all others by slot. A common word's slot holds at
    least its share, so only words of such slots, if there are any, are counted in a second pass.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(col(lang_col).alias("lang"), col(text_col).alias("text")).filter("text is not null")
    bins = [f"c{k}" for k in range(len(CLASSES) + 2)]
    classes = bind_once(rows, {"rest": unplain(F.col("text"))})
    classes = bind_once(classes.select("lang", F.length("text").alias("chars"), "rest"), {"c": class_counts(F.col("chars"), F.col("rest"))})
    found = through_table(classes.groupBy("lang").agg(*[F.sum(F.col("c")[k]).alias(b) for k, b in enumerate(bins)]), "classes")

    words_in = lambda df: df.select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    guessed = _guessed(words_in(rows.sample(GUESSED_FROM, seed=5)))
    is_guess = F.col("word").isin(guessed) if guessed else F.lit(False)
    words = words_in(rows).withColumn("slot", F.when(~is_guess, F.pmod(F.hash("word"), F.lit(SLOTS))))
    counts = through_table(words.groupBy("lang", F.when(is_guess, F.col("word")).alias("word"), "slot").agg(F.count(F.lit(1)).alias("n")), "words")
    sizes = through_table(counts.groupBy("lang").agg(F.sum("n").alias("size")), "sizes")
    size = sizes.agg(F.sum("size")).first()[0]
    slots = counts.filter("slot is not null")
    heavy = _of_language(slots, sizes).filter(F.col("n") >= COMMON * F.col("size")).select("slot").union(
        slots.groupBy("slot").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON * F.lit(size)).select("slot")).distinct()
    heavy = through_table(heavy, "slots")
    known = counts.filter("word is not null").select("lang", "word", "n")
    if not heavy.isEmpty():
        second = words.join(F.broadcast(heavy), "slot", "left_semi")  # SLOTS rows at most
        known = through_table(known.unionByName(second.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))), "words")

    def shares(per_word: DataFrame) -> DataFrame:
        common = per_word.filter(F.col("n") >= COMMON * F.col("size")).select("lang", F.struct("word", (F.col("n") / F.col("size")).alias("q")).alias("w"))
        listed = common.groupBy("lang").agg(F.array_sort(F.collect_list("w")).alias("w"))  # 1 / COMMON words at most
        return listed.select("lang", F.transform("w", lambda w: w.word).alias("words"), F.transform("w", lambda w: w.q).alias("shares"))

    def histograms(per_class: DataFrame, per_word: DataFrame) -> DataFrame:
        chars = F.greatest(sum((F.col(b) for b in bins[1:]), F.col(bins[0])), F.lit(1))
        shaped = per_class.select("lang", F.array(*[F.col(b) / chars for b in bins]).alias("classes"))
        listed = shares(per_word).withColumnRenamed("lang", "_lang")
        return shaped.join(listed, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
            "lang", "classes", F.coalesce("words", F.array().cast("array<string>")).alias("words"), F.coalesce("shares", F.array().cast("array<double>")).alias("shares"))

    none = F.lit(None).cast("string").alias("lang")
    own = histograms(found.filter("lang is not null"), _of_language(known.filter("lang is not null"), sizes))
    pooled = histograms(found.agg(*[F.sum(b).alias(b) for b in bins]).filter(f"{bins[0]} is not null").select(none, *bins),
                        known.groupBy("word").agg(F.sum("n").alias("n")).select(none, "word", "n", F.lit(size).alias("size")))
    return through_table(own.unionByName(pooled), "references")


def _of_language(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    return counts.join(sizes, "lang")


def _guessed(words: DataFrame) -> list[str]:
    """Words that make up half of COMMON or more of a language's drawn words, those with the greatest shares first."""
    counts = through_table(words.filter("lang is not null").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "guesses")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("size"))
    top = _of_language(counts, sizes).withColumn("part", F.col("n") / F.col("size")).filter(F.col("part") >= COMMON / 2).groupBy("word").agg(F.max("part").alias("part"))
    return [r["word"] for r in top.orderBy(F.desc("part"), "word").limit(GUESSED).collect()]


def judged(docs: DataFrame, refs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance,
    word_distance, base_failed, kept.

    Null and empty texts have no word and fail. Texts under ``MIN_WORDS`` words have null distances. A row is compared with
    its language's row of ``refs`` (``references``), or without one with that of a null lang; without either (an empty
    corpus) it is not judged by distance. Every row is judged by itself, repeated or not.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    df = docs.select(col(id_col).alias("doc_id"), text.alias("text"), col(lang_col).alias("lang"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = bind_once(df, {"words": words_of(F.col("text")), "lines": lines, "chars": F.length("text"), "rest": unplain(F.col("text"))}, drop=("text",))
    bound, repeats = repeated_words(F.col("words"))
    # words common in any language, as constants where they are few; the others of a row's language are told apart later
    any_common = refs.select(F.explode("words").alias("word")).distinct().limit(MAX_CONSTANTS + 1).collect()
    is_common = (lambda w: w.isin([r["word"] for r in any_common])) if len(any_common) <= MAX_CONSTANTS else (lambda w: F.lit(True))
    common = F.sort_array(F.filter("words", is_common)) if any_common else F.array().cast("array<string>")
    df = bind_once(df, {
        "n_words": F.size("words").cast("long"), "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "classes": class_counts(F.col("chars"), F.col("rest")), "n_symbols": F.regexp_count("rest", F.lit(r"[#*$%&|<>]")).cast("long"), "common": common, "_windows": bound["_windows"]},
        drop=("words", "lines", "chars", "rest"))
    s = F.col("common")
    starts = F.filter(F.transform(s, lambda w, k: F.when(F.coalesce(F.get(s, k - 1) != w, F.lit(True)), k)), lambda k: k.isNotNull())
    df = bind_once(df, {"_ranked": bound["_ranked"], "starts": starts}, drop=("_windows",))
    k, n = F.col("starts"), F.greatest(F.col("n_words"), F.lit(1))
    runs = F.transform(k, lambda x, i: F.struct(((F.coalesce(F.get(k, i + 1), F.size("common")) - x) / n).alias("p"), F.get(s, x).alias("w")))
    df = bind_once(df, {"_places": bound["_places"], "runs": runs}, drop=("_ranked", "starts", "common"))
    parts = ("classes", "words", "shares")
    pooled = refs.filter("lang is null").select(F.struct(*parts)).scalar()
    own = refs.filter("lang is not null").select(F.col("lang").alias("_lang"), F.struct(*parts).alias("_own"))
    df = bind_once(df.join(own, F.col("lang") == F.col("_lang"), "left"), {"ref": F.coalesce("_own", pooled)}, drop=("_own", "_lang", "lang"))
    listed = lambda name, kind: F.coalesce(F.col(f"ref.{name}"), F.array().cast(f"array<{kind}>"))
    df = bind_once(df, {"ref_words": listed("words", "string"), "ref_shares": listed("shares", "double"), "ref_classes": F.col("ref.classes")}, drop=("ref",))
    runs = F.transform("runs", lambda r: F.struct(r["p"].alias("p"), F.get("ref_shares", F.array_position("ref_words", r["w"]).cast("int") - 1).alias("q")))
    df = bind_once(df, {"runs2": F.filter(runs, lambda r: r["q"].isNotNull()), "n_repeat_words": repeats}, drop=("_places", "runs"))
    # bins with none of the text's words add half their share each; what is no common word is one bin more
    q_all = F.aggregate("ref_shares", F.lit(0.0), lambda a, q: a + q)
    seen = F.aggregate("runs2", F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q")),
                       lambda a, r: F.struct((a["d"] + _term(r["p"], r["q"])).alias("d"), (a["p"] + r["p"]).alias("p"), (a["q"] + r["q"]).alias("q")))
    df = bind_once(df, {"seen": seen, "q_all": q_all}, drop=("runs2", "ref_words", "ref_shares"))
    divergence = F.col("seen.d") + (F.col("q_all") - F.col("seen.q")) / 2 + _term(1 - F.col("seen.p"), 1 - F.col("q_all"))
    size = F.greatest(F.aggregate("classes", F.lit(0).cast("long"), lambda a, n: a + n), F.lit(1))
    class_divergence = sum((_term(F.col("classes")[k] / size, F.col("ref_classes")[k]) for k in range(len(CLASSES) + 2)), F.lit(0.0))
    long_enough = F.col("n_words") >= MIN_WORDS
    root = lambda x: F.when(long_enough, F.sqrt(F.greatest(x, F.lit(0.0))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    word_distance = F.when(F.col("q_all") > 0, root(divergence))
    df = df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", root(class_divergence).alias("class_distance"),
                   word_distance.alias("word_distance"), failed.alias("base_failed"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance) | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return df.withColumn("kept", ~F.col("base_failed") & ~far)
