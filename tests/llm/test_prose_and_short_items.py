"""Secrets left out of ordinary prose and placeholders; benchmark items too short for the q-gram bound."""

import random
import re
import string

import public_tokenizers
import pytest
from dragoman.llm import decontaminate, secrets

COST = secrets.GuessCost(secrets.ranked_words(public_tokenizers.path("piece_bpe_32k.model")))


def costly(text):
    return [text[s["start"]:s["end"]] for s in secrets._scan(text, COST, secrets.MIN_COST) if s["kind"] == "costly"]


@pytest.mark.parametrize("text", [
    "Secret: everything about him was known.", "Her secret: yesterday she left.", "The password: remember it!", "token: undefined", "Password: generated",
    "password: documentation", "secret = unbelievable", "The secret: friendship", "token: authentication", "credential: certificate", "auth: required"])
def test_prose_has_no_costly_value(text):
    assert costly(text) == []


@pytest.mark.parametrize("value", ["${DB_PASS_WORD}", "$(cat /run/x7q9z)", "$DB_PASS_X9Q7", "{{ vault.x9q7z2 }}", "{config.x9q7z2}", "<your-x9q7z2-here>", "%DB_X9Q7Z2%", "[insert x9q7z2]"])
def test_placeholders_are_no_secrets(value):
    assert costly(f'password = "{value}"') == [] and COST(value) >= secrets.MIN_COST


def test_random_values_are_found():
    rng = random.Random(4)
    for size, least in ((8, 0.97), (12, 0.999), (20, 1.0)):
        values = ["".join(rng.choice(string.ascii_letters + string.digits + "#!?%&") for _ in range(size)) + "#" for _ in range(2000)]
        assert sum(costly(f'passphrase: "{v}"') == [v] for v in values) >= least * len(values)


def brute_short(items, text):
    points, places = decontaminate.normalised(text)
    plain, out = decontaminate.string_of(points), []
    for item_id, item in items:
        want = decontaminate.string_of(decontaminate.trimmed(item))
        hit = want and re.search((r"(?<![^\W_])" if want[0].isalnum() else "") + re.escape(want) + (r"(?![^\W_])" if want[-1].isalnum() else ""), plain)
        if hit:
            out.append((item_id, int(places[hit.start()]), int(places[hit.end() - 1]) + 1, 0))
    return sorted(out)


def test_short_items_equal_a_plain_search():
    rng = random.Random(5)
    items = [(1, "What is  the capital of Peru?"), (2, "peru"), (3, "of Peru"), (4, " Of PERU "), (5, ""), (6, "?!"), (7, "é a"), (8, "aa aa")]
    index = decontaminate.Index(items, decontaminate.Q, decontaminate.EDIT_RATE)
    parts = ["What is the capital", "of", "Peru", "peru", "Peruvian", "?", "?!", " ", "  ", "\n", "é", "a", "aa", "x", "²", "😀"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 9)))
        assert sorted(index.search(text)) == brute_short(items, text), text


def test_short_and_long_items_together(spark):
    long = "a question of the benchmark that is long enough for the bound on shared grams"
    items = spark.createDataFrame([(1, "What is the capital of Peru?"), (2, long), (3, "in no text"), (4, None), (None, "the capital")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Q: what is the\ncapital of Peru? Lima."), (2, f"x {long} y"), (3, "nothing"), (4, None), (1, "again, What is the capital of Peru?")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.edits) for r in decontaminate.leaks(spark, docs, items).collect())
    assert got == [(1, 1, 3, 31, 0), (1, 1, 7, 35, 0), (2, 2, 2, 2 + len(long), 0)]
