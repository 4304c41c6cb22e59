"""Prefixed credential names, and the rows a language is learned from."""

import time

import corpus_pipeline
import pytest
from dragoman.llm import ppm, secrets


def costly(text):
    return [text[s["start"]:s["end"]] for s in secrets._scan(text, secrets.GuessCost(), secrets.MIN_COST) if s["kind"] == "costly"]


@pytest.mark.parametrize("name", ["aws_secret_access_key = ", "DB_PASSWORD=", "client_secret: ", "secret_key = ", "x-api-key: ", "the api key: ", "DB_PASS=", "dbPass => ", "password_old = ", "password = ", "config: password="])
def test_names_around_a_credential_word(name):
    for value in ("wJalr#UtnFEMI!K7MDENG", "q7#Zk!2w"):  # the second has MIN_VALUE characters
        assert costly(f'{name}"{value}"\n') == [value]


def test_other_names_and_long_runs():
    for text in ("author: q7#Zk!2wX", "bypass = q7#Zk!2wX", "tokenizer: q7#Zk!2wX", "key: q7#Zk!2wX", "password: password", "password = q7#Zk!2"):
        assert costly(text) == []
    start = time.time()
    for text in ("password" * 50000, "a_" * 200000, "pass-" * 80000, "pass " * 80000):
        assert costly(text) == []
    assert time.time() - start < 5


def test_much_copied_texts_are_learned(spark, sf_dir, monkeypatch):
    rows = [(1000 * k + n, f"{word} " * 12, f"l{k}", "s", 1) for k, word in enumerate(["eins", "два", "trois", "τέσσερα", "cinque", "шесть"]) for n in range(1000)]
    docs, seen, train = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), [], ppm.train
    monkeypatch.setattr(ppm, "train", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    assert corpus_pipeline.identify_language(spark, docs, sf_dir).count() == 6000
    assert seen[0].languages == [f"l{k}" for k in range(6)]
