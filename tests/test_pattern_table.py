"""The pattern table: equal to the chain, to trying every pattern, and sound literals."""

import random
import re

import pytest
from pyspark.sql import functions as F

from dragoman import dims
from dragoman.operators import cascade, pattern_table
from dragoman.plans import views

SCHEMA = "priority int, pattern string, ignore_case boolean, label string, tier string"


def test_equals_the_chain_on_the_fixed_patterns(spark, sf_dir):
    table = spark.createDataFrame([(k, *p) for k, p in enumerate(dims.PATTERNS)], SCHEMA)
    docs = views.documents(spark, sf_dir).select(F.col("doc_id").alias("msg_id"), "text")
    messages = views.utterances(spark, sf_dir).select("msg_id", "text").unionByName(docs)
    got = pattern_table.classify_by_table(messages, table)
    want = cascade.regex_classify(messages).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def drawn_pattern(rng):
    word = lambda: "".join(rng.choice("abks") for _ in range(rng.randrange(1, 4)))
    forms = [lambda: word(), lambda: f"{word()}|{word()}", lambda: f"({word()}|{word()}){{1,2}}{word()}", lambda: f"{word()}.*{word()}", lambda: f"^{word()}",
             lambda: f"[ab]+{word()}?", lambda: f"(?:{word()})*", lambda: rf"\b{word()}\b", lambda: f"(?={word()})a", lambda: f"(?!{word()}).{word()}", lambda: f"{word()}(?i:{word()})",
             lambda: "(?>ab|a)k", lambda: r"(a)\1", lambda: "é+k", lambda: "[^a]s"]
    return rng.choice(forms)()


def test_equals_trying_every_pattern(spark):
    rng = random.Random(6)
    patterns = [(k // 2, drawn_pattern(rng), rng.random() < 0.5, f"l{k}", "1") for k in range(300)]
    texts = ["".join(rng.choice("abksABKSſKıİé \n") for _ in range(rng.randrange(14))) for _ in range(500)] + [None, ""]
    for n in (3, 40, 300):
        some = sorted(patterns[:n], key=lambda p: (p[0], p[1]))
        want = {}
        for t in texts:
            hits = (k for k, p in enumerate(some) if t is not None and re.search(p[1], t, re.IGNORECASE if p[2] else 0))
            want[t] = next(hits, None)
        got = pattern_table.classify_by_table(spark.createDataFrame([(t, 5) for t in texts], "text string, tier int"), spark.createDataFrame(some, SCHEMA)).collect()
        assert {r["text"]: r["rule_no"] for r in got} == want
        assert all(r["matched"] == (r["rule_no"] is not None) and r["label"] == ("unknown" if r["rule_no"] is None else some[r["rule_no"]][3]) for r in got)


@pytest.mark.parametrize("pattern, ignore_case, want", [
    ("ignore.*instructions|reveal.*prompt", True, {"instructions", "reveal"}), ("(write|create).{0,20}(python|sql)", True, {"write", "create"}),
    ("log.?out", True, {"log"}), ("a*", False, None), ("x|y*", False, None), ("[ab]c", False, {"c"}), ("(?:ab)+c", False, {"ab"}), ("Straße", True, {"stra"}), ("天气", False, {"天气"})])
def test_required_literals(pattern, ignore_case, want):
    got = pattern_table.required_literals(pattern, ignore_case)
    assert got == (None if want is None else frozenset(want))


def test_thousands_of_patterns_try_few(spark):
    table = pattern_table.PatternTable([(rf"\bword{k}x\b", True, "", "") for k in range(5000)])
    assert table.candidates("a Word77x and word4999x") == [77, 4999] and table.first("a WORD77X") == 77 and table.first("nothing") is None


def test_a_table_that_is_no_dimension_is_refused(spark, monkeypatch):
    monkeypatch.setattr(pattern_table, "MAX_PATTERNS", 2)
    table = spark.createDataFrame([(k, "a", True, "l", "1") for k in range(3)], SCHEMA)
    with pytest.raises(ValueError):
        pattern_table.classify_by_table(table.select(F.col("pattern").alias("text")), table)
