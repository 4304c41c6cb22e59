"""What a Python worker holds at once does not grow with a batch or a text."""

import tracemalloc

import numpy as np
import pyarrow as pa

from dragoman.operators import language


def batch(texts, langs=None):
    return pa.RecordBatch.from_arrays([pa.array(langs or ["en"] * len(texts), pa.string()), pa.array(texts, pa.string())], ["lang", "text"])


def counted(parts):
    out = {}
    for part in parts:
        for lang, bucket, n in zip(*(part.column(c).to_pylist() for c in ("lang", "bucket", "n"))):
            out[lang, bucket] = out.get((lang, bucket), 0) + n
    return out


def plain(texts, langs):
    out = {}
    for text, lang in zip(texts, langs):
        for a, b in zip(text or "", (text or "")[1:]):
            key = lang, (ord(a) * 31 + ord(b)) % language.BUCKETS
            out[key] = out.get(key, 0) + 1
    return out


def test_bigrams_in_parts_equal_a_plain_count():
    rng = np.random.default_rng(2)
    texts = ["".join(chr(c) for c in rng.integers(97, 123, n)) + "é你😀" * (n % 3) for n in [0, 1, 2, 9, 10, 11, 500, 3, 0, 64, 63, 65, 129, 1]] + [None, "", "x"]
    langs = ["en", None, "de"] * 5 + ["en", "de"]
    for size in (1, 7, 64, 1 << 20):
        found = {}
        for first, pairs, sizes in language._buckets(pa.array(texts), size):
            assert len(pairs) == sizes.sum() and len(pairs) <= max(size, 1) + 1
            for key in zip(np.repeat(np.array(langs, object)[first:first + len(sizes)], sizes), pairs.tolist()):
                found[key] = found.get(key, 0) + 1
        assert found == plain(texts, langs)
    assert counted(language._count(iter([batch(texts, langs)]))) == plain(texts, langs)


def test_memory_of_a_large_batch_and_of_a_long_text_is_bounded():
    for texts in (["lorem ipsum dolor " * 500] * 4000, ["lorem ipsum dolor " * 2_000_000]):  # 36 MB each; 360 MB of numbers before
        rows = batch(texts)
        tracemalloc.start()
        total = sum(counted(language._count(iter([rows]))).values())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert total == sum(len(t) - 1 for t in texts) and peak < 150 << 20


def test_scores_of_a_text_in_pieces(spark):
    rows = [(1, "the cat sat on the mat " * 30_000), (2, "die Katze saß auf der Matte " * 30_000), (3, "the cat"), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "id int, text string")
    profile = language.language_profile(language.bigram_counts(spark.createDataFrame([("the cat sat on the mat", "en"), ("die Katze saß auf der Matte", "de")], "text string, lang string")))
    short = spark.createDataFrame([(1, "the cat sat on the mat " * 3), (2, "die Katze saß auf der Matte " * 3)], "id int, text string")
    got = {r.id: r.language_iso for r in language.detect_language(docs, profile).collect()}
    assert got == {1: "en", 2: "de", 3: "en", 4: "en", 5: "en"}
    assert {r.id: r.language_iso for r in language.detect_language(short, profile).collect()} == {1: "en", 2: "de"}
