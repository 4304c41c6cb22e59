"""Toxicity: folding, matching and scoring against a plain search, learned exceptions; kept words of long texts."""

import math
import random

import public_tokenizers
import pytest
from dragoman.llm import pieces, toxicity


def test_numbers_stay_numbers():
    assert toxicity.folded_words("455 1337 room 455, 2013 $455 4$5 b4d @ss") == "455 1337 room 455 2013 455 4 5 bad ass".split()
    matcher = toxicity.Matcher(toxicity.Lexicon({" ass ": 3.0}))
    assert matcher.measures("room 455 on page 455") == (0.0, 5, 0) and matcher.measures("room a55")[2] == 1


def brute_measures(lexicon, text):
    """Each word's heaviest entry, by comparing it with every entry; phrases spare their words."""
    words = toxicity.folded_words(text)
    weights = []
    for word in words:
        fits = [w for e, w in lexicon.weights.items() if (word == e.strip() if e.endswith(" ") else word.startswith(e.strip()))]
        weights.append(max(fits, default=0.0))
    for phrase in lexicon.exceptions:
        parts = toxicity.folded_words(phrase)
        for k in range(len(words) - len(parts) + 1):
            if words[k:k + len(parts)] == parts:
                for j in range(k, k + len(parts)):
                    weights[j] = 0.0
    return sum(weights), len(words), sum(w > 0 for w in weights)


def test_matching_and_scoring_equal_a_plain_search():
    rng = random.Random(9)
    lexicon = toxicity.Lexicon({" idio": 2.0, " idiot ": 3.5, " trash ": 2.5, " tras": 1.0, " scum ": 4.0, " 455 ": 1.5},
                               ("trash can", "pond scum", "can trash can", "idiot proof"), (-1.5, 0.9, 0.4))
    matcher = toxicity.Matcher(lexicon)
    parts = ["idiot", "1d10t", "idiotic", "trash", "TR4SH", "trashy", "can", "pond", "scum", "ѕcum", "proof", "455", "a", "$cüm", "你", "-", "x_y", "0", ""]
    for _ in range(4000):
        text = rng.choice([" ", ", ", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        weight, words, hits = brute_measures(lexicon, text)
        assert matcher.measures(text) == (pytest.approx(weight), words, hits), text
        plain = 1 / (1 + math.exp(-(-1.5 + 0.9 * math.log(1 + weight) + 0.4 * math.log(1 + 100 * weight / max(words, 1)))))
        assert matcher.score(weight, words) == pytest.approx(plain)


def test_exceptions_are_learned(spark):
    rows, labels = [], []
    for k in range(1600):
        toxic = k % 4 == 0
        rows.append((k, f"you vermin number{k} go away" if toxic else f"a vermin control service number{k}" if k % 100 == 1 else f"a calm day number{k}"))
        labels.append((k, int(toxic)))
    lexicon = toxicity.fit(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(e.strip() and "vermin".startswith(e.strip()) for e in lexicon.weights) and "vermin control" in lexicon.exceptions
    matcher = toxicity.Matcher(lexicon)
    assert matcher.measures("our vermin control team")[2] == 0 and matcher.measures("you vermin")[2] >= 1


def test_long_words_are_not_kept():
    coder = pieces.Pieces(pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    text = "你好" * 3000 + " short"
    assert coder.decode(coder.encode(text)) == text and all(len(w) < pieces.KEPT_CHARS for w in coder.words)
