"""What a Python worker holds: one operator's tables at a time, and bounded blocks while it scores."""

import gc
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from dragoman.llm import pieces, ppm

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def model_of(texts, order=ppm.ORDER):
    counts = Counter()
    for keys, _ in ppm.blocks(texts, order):
        counts.update(keys.tolist())
    keys = np.array(sorted(counts))
    return ppm.Model(order, ["x"], [keys], [np.array([counts[k] for k in keys], float)])


def alive(kind):
    gc.collect()
    return sum(isinstance(x, kind) for x in gc.get_objects())


@pytest.fixture
def plain_udfs(monkeypatch):
    """An operator's column becomes the function that its workers run."""
    for module in (pieces, ppm):
        monkeypatch.setattr(module.F, "pandas_udf", lambda schema: lambda function: lambda text: function)


def test_a_worker_lets_the_coder_go_when_it_scores_languages(spark, plain_udfs):
    text = pd.Series(["the cat sat on the mat", None])
    encode = pieces.round_trip(spark, None, MODEL)
    score = ppm.identify(spark, None, model_of(["the cat sat on the mat"]))
    first = [x for got in encode(iter([text])) for x in got["ids"]]
    assert alive(pieces.Pieces) == 1
    bits = [x for got in score(iter([text])) for x in got["bits_per_byte"]]
    assert alive(pieces.Pieces) == 0 and alive(ppm.Scorer) == 1
    assert [x for got in score(iter([text])) for x in got["bits_per_byte"]] == bits and alive(ppm.Scorer) == 1
    assert [x for got in encode(iter([text])) for x in got["ids"]] == first
    assert alive(pieces.Pieces) == 1 and alive(ppm.Scorer) == 0


def test_counting_for_a_model_lets_the_coder_go(spark, monkeypatch):
    docs, seen = spark.createDataFrame([("a cat", "en")], "text string, lang string"), []
    own = type(docs).mapInArrow

    def noted(self, function, schema):
        seen.append(function)
        return own(self, function, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    ppm.train(spark, docs)
    pieces.coder_of(pieces.model_bytes(MODEL))
    assert alive(pieces.Pieces) == 1 and list(seen[0](iter([]))) == [] and alive(pieces.Pieces) == 0


def test_scoring_many_texts_takes_a_bounded_block():
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefgh ", k=4000)) for _ in range(1000)]
    scorer = ppm.Scorer(model_of(texts[:20]))
    tracemalloc.start()
    together = scorer.code_lengths(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 40 << 20, peak
    assert (together == np.concatenate([scorer.code_lengths([t]) for t in texts])).all()


def test_a_text_of_several_blocks_is_scored_whole():
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcd é", k=(ppm.BLOCK_BYTES * 5) // 4)), "abc", "", None, "".join(rng.choices("abcd", k=ppm.SCORED_BYTES))]
    scorer = ppm.Scorer(model_of([texts[0][:50_000]]))
    got = scorer.code_lengths(texts)[:, 0]
    assert got == pytest.approx([sum(scorer.trees[0].bits(k).sum() for k, _ in ppm.blocks([t], scorer.order, size=1000)) for t in texts], rel=1e-5)


def test_results_are_handed_on_in_parts(spark, plain_udfs, monkeypatch):
    monkeypatch.setattr(pieces, "PART_CHARS", 50, raising=False)
    rng = random.Random(8)
    texts = [None, "", *("".join(rng.choices("abc é", k=rng.randint(0, 30))) for _ in range(40)), "a long text " * 20, "b"]
    encode = pieces.round_trip(spark, None, MODEL)
    got = list(encode(iter([pd.Series(texts, dtype=object), pd.Series([], dtype=object)])))
    assert len(got) > 10 and all(len(x) == 1 or sum(map(len, x["decoded"])) <= 50 for x in got)
    coder = pieces.coder_of(pieces.model_bytes(MODEL))
    assert [x for part in got for x in part["ids"]] == [coder.encode(t) for t in texts]
    assert [x for part in got for x in part["decoded"]] == [t or "" for t in texts]
