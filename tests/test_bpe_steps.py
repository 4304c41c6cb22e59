"""BPE at size: what a window takes, how its results are found, what a worker keeps of its words."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from dragoman import dims
from dragoman.operators import bpe, tokens


def test_a_window_takes_few_bytes_a_symbol():
    rng = np.random.default_rng(1)
    pieces = [rng.integers(0, 20, 5).astype(np.int32) for _ in range(40_000)]
    tracemalloc.start()
    window = bpe.Window(pieces, [1000 + i for i in range(len(pieces))])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert sum(len(p) for p in window.results()) == 200_000
    assert held < 200_000 * 60  # lists of Python numbers took three times as much


def test_pieces_of_one_number_get_another_seed(monkeypatch):
    symbols, length = np.array([1, 2, 3, 4, 5], np.int32), np.array([2, 3])
    numbers = bpe._hashes
    monkeypatch.setattr(bpe, "_hashes", lambda s, first, n, seed: numbers(s, first, n, seed) if seed > 1 else np.zeros(len(n), np.uint64))
    seed, found, starts, sizes, merged = bpe._result_table(symbols, length, np.array([9, 3, 8], np.int32), np.array([1, 2]))
    assert seed > 1 and len(set(found.tolist())) == 2
    got = {merged[a:a + n].tobytes(): h for a, n, h in zip(starts, sizes, found)}
    want = numbers(symbols, np.array([0, 2]), length, seed).tolist()
    assert got == {np.array([9], np.int32).tobytes(): want[0], np.array([3, 8], np.int32).tobytes(): want[1]}


def test_words_are_kept_from_task_to_task():
    pattern = bpe.re.compile(r" ?[a-z]+")
    letters = bpe.byte_alphabet()
    vocabulary = {t: i for i, t in enumerate([*dims.SPECIAL_TOKENS, *letters, "ab"])}
    first = bpe._kept_parts("one", ([("a", "b")], vocabulary), pattern)
    assert np.frombuffer(first["ab"], np.int32).tolist() == [vocabulary[letters[32]], vocabulary["ab"]]
    assert bpe._kept_parts("one", ([("a", "b")], vocabulary), pattern) is first and "ab" in first
    assert "x" * bpe.KEPT_CHARS not in first and first["x" * bpe.KEPT_CHARS] and "x" * bpe.KEPT_CHARS not in first
    assert bpe._kept_parts("two", ([], vocabulary), pattern) is not first and list(bpe._LAST) == ["two"]


def test_searched_and_queued_merges_are_equal():
    rng = random.Random(4)
    merges = [("a", "b"), ("b", "a"), ("ab", "ab"), ("a", "a"), ("aa", "b"), ("ab", "a"), ("abab", "b")]
    vocabulary = {t: i for i, t in enumerate([*dims.SPECIAL_TOKENS, "a", "b", *dict.fromkeys(x + y for x, y in merges)])}
    coder = bpe.Coder(merges, vocabulary)
    for _ in range(500):
        symbol = [rng.choice((vocabulary["a"], vocabulary["b"], -1)) for _ in range(rng.randrange(0, 40))]
        assert coder._by_search(list(symbol)) == coder._by_queue(list(symbol))


ODD = ["", " ", "  ", "a  b", "a \n b", "\n", " x", "  x y ", "a  b", "a   b", "x  y", "x  y", "\x1c a \x1d", "it's we'll 'd", "你好 été  12½ x", "a\tb\r\n c", "𝒳 𐍈𝟙 \U0001f600!", "ᥐ ༠ ࠀ"]


def test_parts_give_the_pretokens_of_java(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab1'! \n  é\x1c\x85s") for _ in range(30)) for _ in range(200)]
    token, cut = map(bpe.re.compile, tokens.pretoken_patterns(spark))
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", tokens.byte_level_tokens(F.col("text")).alias("want")).collect()
    for r in rows:
        assert [w for p in (bpe._parts(cut, r["text"]) if r["text"] else []) for w in token.findall(" " + p)] == r["want"]


@pytest.mark.parametrize("bad", [[250], []])
def test_decoding_of_odd_ids(spark, bad):
    known = {t: i for i, t in enumerate([*dims.SPECIAL_TOKENS, *bpe.byte_alphabet()])}
    ids = [[5 + b for b in " né".encode()], [0, 5 + 0xC3, 5 + 65, 1], [], None, [5 + b for b in bad]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, ids array<int>").coalesce(1)
    got = [r["t"] for r in df.select("i", bpe.bpe_decode(F.col("ids"), known).alias("t")).orderBy("i").collect()]
    assert got == [" né", "�A", "", "", bytes(bad).decode("utf-8", "replace")]
