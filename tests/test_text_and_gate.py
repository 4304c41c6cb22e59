import random
import re

from pyspark.sql import functions as F

from dragoman import dims
from dragoman.functions.text import WHITESPACE, java_pattern, percent, py_strip, py_tokens, token_count
from dragoman.operators import cascade, gate
from dragoman.plans import views
from tests.benchmark_cases import CASES

ALPHABET = ["a", "b", "e", "z", "q", "w", "s", "d", "1", "!", "é", "你", "ي", "ж", "カ", " ", "\n", "\xa0", "\x1c", "　", "ſ", "K", "İ", "ı", "😀"]


def random_texts(n=400, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 12))) for _ in range(n)] + [
        rng.choice("abqz") * rng.randint(1, 9) for _ in range(40)]


def test_strip_and_tokens_follow_python(spark):
    texts = [*random_texts(), WHITESPACE + "x y" + WHITESPACE, WHITESPACE]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", py_strip(F.col("t")).alias("s"), py_tokens(F.col("t")).alias("w"),
                     token_count(F.col("t")).alias("n")).collect()
    for r in rows:
        text = texts[r["i"]]
        assert r["s"] == text.strip()
        assert r["w"] == text.split()
        assert r["n"] == len(text.split())


def expected_gate(text):
    """The six rules, told in Python."""
    t = text.strip()
    latin = "".join(c for c in t.lower() if "a" <= c <= "z")
    ranges = [(0x600, 0x6FF), (0x900, 0x97F), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF), (0x400, 0x4FF), (0x370, 0x3FF)]
    known = any(c.isascii() and c.isalnum() or any(a <= ord(c) <= b for a, b in ranges) for c in t)
    if not t:
        return "empty"
    if len(t) == 1:
        return "one_char"
    if not known:
        return "no_alphanumeric"
    if len(t) >= 5 and set(t) == {t[0]} and t[0] != "\n":
        return "repeat"
    if len(latin) > 6 and sum(c in "aeiou" for c in latin) / len(latin) < 0.05:
        return "mash"
    if len(latin) >= 6 and len(set(latin)) >= 4 and any(set(latin) <= set(row) for row in gate.KEYBOARD_ROWS):
        return "keyboard_row"
    return None


def test_gate_follows_the_rules_on_random_texts(spark):
    rng = random.Random(3)
    texts = random_texts() + ["".join(rng.choice(rng.choice(gate.KEYBOARD_ROWS + ["aeiou", "bcdfg"])) for _ in range(rng.randint(5, 10)))
                              for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", gate.noise_rule(F.col("t")).alias("rule")).collect():
        assert r["rule"] == expected_gate(texts[r["i"]]), repr(texts[r["i"]])


def test_gate_and_cascade_on_the_templates(spark, sf_dir):
    expected = {21: "empty", 22: "empty", 23: "one_char", 24: "no_alphanumeric", 25: "no_alphanumeric", 26: "repeat",
                27: "mash", 28: "keyboard_row", 29: "keyboard_row", 30: "no_alphanumeric"}
    labels = {21: "unknown", 22: "unknown", 23: "unknown", 24: "unknown", 25: "noise_gibberish", 26: "unknown",
              27: "noise_gibberish", 28: "noise_gibberish", 29: "unknown", 30: "unknown", 31: "unknown",
              32: "factoid_dynamic", 33: "document_structured", 34: "noise_gibberish", 35: "greeting_open"}
    rows = cascade.regex_classify(gate.gate_noise(views.utterances(spark, sf_dir))).select("k", "gate_rule", "label").distinct().collect()
    assert {r["k"] for r in rows} == set(range(36))
    for r in rows:
        assert r["gate_rule"] == expected.get(r["k"])
        assert r["label"] == labels.get(r["k"], views.EXPECTED[r["k"]])


def test_words_from_one_keyboard_row_are_noise_and_accents_alone_too(spark):
    df = spark.createDataFrame([("typewriter",), ("property",), ("éé",), ("カナ",)], "t string")
    assert [r[0] for r in df.select(gate.noise_rule(F.col("t"))).collect()] == [
        "keyboard_row", "keyboard_row", "no_alphanumeric", "no_alphanumeric"]


def test_cascade_agrees_with_python_regex(spark):
    rng = random.Random(11)
    pieces = ["write", "python", "report", "how do i", "ignore", "instructions", "\n", " ", "today", "vs ", "fix", "bug", "BYE",
              "hello", "!", "ſql query", "İnstructIons", "dRaft RepORT", "K", "thanK", "WRİTE", "fıx", "what time", "x" * 12, "go to ", "turn on", "log-out", "　", "###"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(600)] + [c[0] for c in CASES]
    compiled = [(re.compile(p, re.I if ic else 0), label) for p, ic, label, _ in dims.PATTERNS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in cascade.regex_classify(df).collect():
        want = next((label for p, label in compiled if p.search(texts[r["i"]])), "unknown")
        assert r["label"] == want, repr(texts[r["i"]])


def test_benchmark_of_the_fifty_cases(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES, 1)], "case int, text string, want string, want_tier string, category string")
    rows = cascade.regex_classify(df).collect()
    matched = [r for r in rows if r["matched"]]
    assert (len(matched), sum(r["label"] == r["want"] for r in matched)) == (22, 18)
    assert sorted(r["case"] for r in matched if r["label"] != r["want"]) == [5, 12, 19, 49]


def test_user_patterns_and_size_limit(spark):
    custom = spark.createDataFrame([(2, "b", False, "second", "1"), (1, "a", True, "first", "2")],
                                   "priority int, pattern string, ignore_case boolean, label string, tier string")
    rows = cascade.regex_classify(spark.createDataFrame([("xAb",), ("b",), ("c",)], "text string"), patterns=custom).collect()
    assert [(r["label"], r["tier"], r["matched"]) for r in rows] == [("first", "2", True), ("second", "1", True), ("unknown", "?", False)]


def test_classify_with_gate_strips_and_keeps_every_row(spark):
    df = spark.createDataFrame([(1, " hello\n"), (2, "zzzzzz"), (3, None)], "id int, text string")

    def model(rows):
        return rows.withColumns({"intent_class_id": F.lit(3), "intent_class_label": F.lit("greeting_open"),
                                 "resource_class": F.lit("hr_global"), "confidence": F.lit(0.5), "source": F.lit("model")})

    rows = {r["id"]: r for r in gate.classify_with_gate(df, model).collect()}
    assert rows[1]["text"] == "hello" and rows[1]["source"] == "model"
    assert rows[2]["source"] == rows[3]["source"] == "regex_gate" and rows[3]["confidence"] == 1.0


def test_small_helpers(spark):
    row = spark.range(1).select(percent(F.lit(1), F.lit(3)).alias("p"), percent(F.lit(0), F.lit(0)).alias("z")).first()
    assert (row["p"], row["z"]) == (33.3, 0.0)
    assert java_pattern("a", True).startswith("(?diu)")
