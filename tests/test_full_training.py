"""The training queries run their operators at full size."""

import inspect

import pytest

from dragoman import dims
from dragoman.operators import bpe, models
import __spark_entry__  # noqa: F401  registers the queries
from dragoman.plans.registry import QUERIES


class Reached(Exception):
    pass


def caught(monkeypatch, module, name):
    signature, seen = inspect.signature(getattr(module, name)), {}

    def stop(*args, **named):
        bound = signature.bind(*args, **named)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise Reached
    monkeypatch.setattr(module, name, stop)
    return seen


@pytest.mark.parametrize("name", ["n1_bpe_train", "n2_bpe_encode"])
def test_merges_are_not_capped(spark, sf_dir, monkeypatch, name):
    seen = caught(monkeypatch, bpe, "bpe_train")
    with pytest.raises(Reached):
        QUERIES[name](spark, sf_dir)
    assert seen["merges"] is None and seen["vocab_size"] == dims.VOCAB_SIZE == 32000


@pytest.mark.parametrize("name", ["n4_train_two_head", "n5_score_two_head", "n9_evaluate_split"])
def test_heads_are_trained_at_full_width(spark, sf_dir, monkeypatch, name):
    seen = caught(monkeypatch, models, "train_two_head")
    with pytest.raises(Reached):
        QUERIES[name](spark, sf_dir)
    assert (seen["word_features"], seen["char_features"], seen["max_iter"]) == (1 << 14, 1 << 14, 30)
