"""BPE: equal to the library at every window size, exact greedy merging by brute force, encoding, decoding."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dragoman import dims
from dragoman.operators import bpe
from dragoman.plans import views

LINES = ["the other thing  isn't there", "he's here,\nand they're\tthere 12 times", "été naïve 你好 the theme", "aaaa aaa aaaaa the",
         "  leading space", "mississippi missed the ship's shipping"] * 3


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(LINES)), "doc_id int, text string")


def library(texts, folder, size=dims.VOCAB_SIZE):
    lib = pytest.importorskip("tokenizers")
    from tokenizers import models, pre_tokenizers, trainers
    path = folder / "texts.txt"
    path.write_text("".join(t + "\n" for t in texts), encoding="utf-8", newline="")
    other = lib.Tokenizer(models.BPE(unk_token="[UNK]"))
    other.pre_tokenizer = pre_tokenizers.ByteLevel()
    other.train([str(path)], trainers.BpeTrainer(vocab_size=size, special_tokens=dims.SPECIAL_TOKENS, min_frequency=2, show_progress=False))
    return other


@pytest.mark.parametrize("window_symbols, n", [(1_000_000, 60), (60, 60), (1, 12)])
def test_training_and_encoding_equal_the_library(spark, corpus, tmp_path, window_symbols, n):
    merges, vocabulary = bpe.bpe_train(corpus, merges=n, window_symbols=window_symbols)
    mine = bpe.vocabulary_map(vocabulary)
    other = library(LINES, tmp_path, len(mine))
    assert other.get_vocab() == mine and len(merges) == n
    unseen = spark.createDataFrame([(100, "Ωmega the ZZ"), (101, ""), (102, None)], "doc_id int, text string")
    for r in bpe.bpe_encode(corpus.union(unseen), merges, mine).collect():
        assert r["ids"] == other.encode(r["text"] or "").ids
        assert r["doc_id"] != 100 or mine["[UNK]"] in r["ids"]


def test_documents_are_trained_to_the_end(spark, sf_dir, tmp_path):
    """All windows of the default bound, and of one that needs many, equal the library's full vocabulary."""
    docs = views.documents(spark, sf_dir)
    other = library([r["text"] or "" for r in docs.select("text").collect()], tmp_path)
    for bound in (bpe.WINDOW_SYMBOLS, 20_000):
        merges, vocabulary = bpe.bpe_train(docs, window_symbols=bound)
        mine = bpe.vocabulary_map(vocabulary)
        assert mine == other.get_vocab() and len(mine) > 10_000
    for r in bpe.bpe_encode(docs.limit(50), merges, mine).collect():
        assert r["ids"] == other.encode(r["text"]).ids


def greedy(words, tokens, size, min_frequency=2):
    """Merge the most frequent pair of all, counted anew each time."""
    words, tokens, merges = dict(words), list(tokens), []
    while len(tokens) < size:
        count = Counter()
        for w, n in words.items():
            for pair in zip(w, w[1:]):
                count[pair] += n
        if not count:
            break
        pair, n = min(count.items(), key=lambda x: (-x[1], x[0]))
        if n < min_frequency:
            break
        spelled = tokens[pair[0]] + tokens[pair[1]]
        new = tokens.index(spelled) if spelled in tokens else len(tokens)
        tokens += [spelled] if new == len(tokens) else []
        merges.append(pair)
        merged = Counter()
        for w, m in words.items():
            out, i = [], 0
            while i < len(w):
                if w[i:i + 2] == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            merged[tuple(out)] += m
        words = merged
    return merges, tokens


@pytest.mark.parametrize("window_symbols", [1_000_000, 100, 40])
def test_equals_greedy_merging_with_ties_and_spelled_special_tokens(spark, monkeypatch, window_symbols):
    """Few letters, many ties, and texts that spell tokens which have small ids already."""
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(8)) for _ in range(8)]
    texts += ["a PAD b MASK UNK ab", "x[PAD]y [PAD] ab", "x[PAD]z"]
    specials = ["PAD", "UNK", "CLS", "SEP", "MASK"]  # without brackets, which the pre-tokens cut off
    monkeypatch.setattr(dims, "SPECIAL_TOKENS", specials)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counted = {r["word"]: r["n"] for r in bpe.byte_words(df).collect()}
    letters = bpe.byte_alphabet()
    alphabet = sorted({letters[b] for w in counted for b in w.encode()})
    start = [*specials, *alphabet]
    merges, tokens = greedy({tuple(start.index(letters[b]) for b in w.encode()): n for w, n in counted.items()}, start, 400)
    got, vocabulary = bpe.bpe_train(df, vocab_size=400, window_symbols=window_symbols)
    assert got == [(tokens[a], tokens[b]) for a, b in merges]
    assert bpe.vocabulary_map(vocabulary) == {t: i for i, t in enumerate(tokens)}
    assert {a + b for a, b in got} & set(specials) == {"PAD"}


def test_long_words_and_odd_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("xyz") for _ in range(20_000))
    df = spark.createDataFrame([(1, long), (2, long), (3, "a" * 5001), (4, None), (5, ""), (6, "\n\n"), (7, "x\r\n y\u00a0z")], "doc_id int, text string")
    merges, vocabulary = bpe.bpe_train(df, vocab_size=300)
    small, small_vocabulary = bpe.bpe_train(df, vocab_size=300, window_symbols=500)
    known = bpe.vocabulary_map(vocabulary)
    assert small == merges and bpe.vocabulary_map(small_vocabulary) == known
    encoded = bpe.bpe_encode(df, merges, known)
    for r in encoded.select("text", "ids", bpe.bpe_decode(F.col("ids"), known).alias("back")).collect():
        text = r["text"] or ""
        assert r["back"] == (text if text.startswith(" ") or not text else " " + text)
        assert known["[UNK]"] not in r["ids"]


def test_empty_corpus(spark):
    merges, vocabulary = bpe.bpe_train(spark.createDataFrame([], "text string"))
    assert merges == [] and sorted(bpe.vocabulary_map(vocabulary)) == sorted(dims.SPECIAL_TOKENS)


def test_byte_alphabet_is_a_bijection():
    alphabet = bpe.byte_alphabet()
    assert len(set(alphabet)) == 256 and alphabet[ord("A")] == "A" and alphabet[32] == "Ġ" and alphabet[10] == "Ċ"


def test_a_run_of_one_symbol_merges_from_the_left(spark):
    words = spark.createDataFrame([([7] * k, k) for k in range(2, 8)] + [([7, 8, 7, 7, 8, 7, 7, 7], 9)], "symbols array<int>, n long")
    got = {r["n"]: r["symbols"] for r in words.coalesce(1).mapInArrow(bpe._replace_one(7, 7, 9), "symbols array<int>, n long").collect()}
    assert got == {3: [9, 7], 4: [9, 9], 5: [9, 9, 7], 6: [9, 9, 9], 7: [9, 9, 9, 7], 9: [7, 8, 9, 8, 9, 7]}
    window = bpe.Window([np.array([7] * 5)], [3])
    window.merge((7, 7), 9)
    assert [x.tolist() for x in window.results()] == [[9, 9, 7]]
    assert {p: n for p, n in window.count.items() if n} == {(9, 9): 3, (9, 7): 3}
