"""Language ID, tokens, secrets, toxicity, quality and licences: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from dragoman.llm import licenses, pieces, ppm, quality, secrets, toxicity
from dragoman.llm.queries import ORACLES, QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.01"


# ---- language

def brute_bits(trained: list[bytes], order: int, data: bytes) -> float:
    """PPM with escape C and exclusion, from the definition."""
    follow = {}
    for text in trained:
        text = b"\n" * order + text
        for k in range(order, len(text)):
            for n in range(order + 1):
                follow.setdefault(text[k - n:k], Counter())[text[k]] += 1
    data, bits = b"\n" * order + data, 0.0
    for k in range(order, len(data)):
        excluded = set()
        for n in range(order, -1, -1):
            counts = follow.get(data[k - n:k])
            if counts is None:
                continue
            left = {s: c for s, c in counts.items() if s not in excluded}
            whole = sum(left.values()) + len(left)
            if data[k] in left:
                bits -= np.log2(left[data[k]] / whole)
                break
            if left:
                bits -= np.log2(len(left) / whole)
            excluded |= set(counts)
        else:
            bits += np.log2(256 - len(excluded))
    return bits


def test_code_lengths_equal_the_definition():
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcde ") for _ in range(80)) for _ in range(6)]
    counts = Counter()
    for keys, _ in ppm.blocks([t.decode() for t in texts], 3):
        counts.update(keys.tolist())
    keys = np.array(sorted(counts))
    scorer = ppm.Scorer(ppm.Model(3, ["x"], [keys], [np.array([counts[k] for k in keys], float)]))
    samples = ["abcabc", "zzz", "ab zq", "e", "dé", texts[0].decode()]
    got = scorer.code_lengths(samples)[:, 0]
    assert got == pytest.approx([brute_bits(texts, 3, s.encode()) for s in samples], rel=1e-5)


def test_language_held_out_and_odd_rows(spark, odd_docs, no_docs):
    got = QUERIES["op3_language_id"](spark, SMALL).filter("held_out").join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.filter("lang = lang_pred").count() >= 0.98 * got.count()
    model = ppm.train(spark, odd_docs)
    rows = odd_docs.select("doc_id", ppm.identify(spark, F.col("text"), model).alias("g")).select("doc_id", "g.*").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 8 and all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1, 2, 3, 6))
    assert by_id[5].lang_pred == "de" and by_id[4].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows)
    empty = ppm.train(spark, no_docs)
    assert {r[0].lang_pred for r in odd_docs.select(ppm.identify(spark, F.col("text"), empty)).collect()} == {"und"}
    assert no_docs.select(ppm.identify(spark, F.col("text"), model)).collect() == []


# ---- pieces

def test_prefix_tables_equal_the_library():
    coder, library = pieces.Pieces(pieces.model_bytes(MODEL)), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng, parts = random.Random(5), ["a", "the", "th", " ", "  ", "\n", "é", "▁", "日本", "😀", "ing", "<s>", "\0", "x" * 30, " " * 20]
    vocabulary = list(coder.id)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 5))) for _ in range(4000)]
    for text in texts:
        want = library.encode(text, add_bos=True, add_eos=True)
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want and coder.decode(ids) == library.decode(want)


def test_pieces_of_odd_rows(spark, odd_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in odd_docs.select("text", pieces.round_trip(spark, F.col("text"), MODEL).alias("g")).collect():
        assert np.frombuffer(r.g.ids, "<u4").tolist() == library.encode(r.text or "", add_bos=True, add_eos=True) and r.g.decoded == (r.text or "")


# ---- secrets

def brute_base(text):
    found = [(m.start(), m.end(), 0) for m in re.finditer(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[1]) >= 12]
    found += [(*m.span(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(*m.span(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16], key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_definition():
    rng = random.Random(6)
    parts = ["token", "Password", "api_key", "ſecret", "secret", "=", ":", " ", "\"", "AKIA", "ABCD1234", "0123456789abcdef", "x", "deadbeef", "é", "\n", "value-1234_56"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(12))
        assert [(a, b, secrets.KINDS.index(k)) for a, b, k in secrets.base_spans(text)] == brute_base(text)


def test_guess_costs_and_spans(spark, odd_docs):
    cost = secrets.GuessCost()
    random_value, worst = cost("kV9#xQ2!mZ7p"), cost("k" * 12)
    for easy in ("password2019", "qwertyuiop12", "abcabcabcabc", "12.03.1999aa", "P@ssw0rdabc1", "zxcvbnmzxcvbnm"):
        assert cost(easy) < secrets.MIN_COST < random_value
    assert worst < 3 and cost("") == 0 and cost("x" * 20000) < 7
    # dynamic programming against all ways to cut a short value
    value = "love1qaz"
    parts = [p for f in (cost._words, cost._dates, cost._repeats, cost._walks) for p in f(value)] + [(k, k + 1, secrets.BRUTE - secrets.PART) for k in range(len(value))]
    def least(at):
        return 0 if at == len(value) else min(c + secrets.PART + least(e) for s, e, c in parts if s == at)
    assert cost(value) == pytest.approx(least(0))
    text = 'passphrase: "kV9#xQ2!mZ7p" and pwd = password2019; token = "abcdefghij12"'
    rows = spark.createDataFrame([(text,), (None,)], "text string").select("text", secrets.scan(F.col("text")).alias("s"))
    got = rows.select("s", secrets.redact(F.col("text"), F.col("s")).alias("r")).collect()
    assert [s.kind for s in got[0].s] == ["costly", "assign"] and got[0].r == 'passphrase: "[SECRET]" and pwd = password2019; [SECRET]"'
    assert got[1].s == [] and got[1].r is None
    assert [r[0] for r in odd_docs.select(F.size(secrets.scan(F.col("text")))).collect()] == [0] * 8


def test_secret_query_digest(spark):
    for r in QUERIES["op2_secret_scan"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, b, k in brute_base(r.text or ""))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


# ---- toxicity

def test_folding_and_exceptions():
    m = toxicity.Matcher(toxicity.Lexicon({" idiot": 3.0, " trash ": 2.0}))
    assert m.measures("You 1d10t!") == m.measures("you ІDІOT") == m.measures("you ídïôt") and m.measures("idiotic me")[2] == 1
    assert m.measures("trash")[2] == 1 and m.measures("trash can")[2] == 0 and m.measures("trashy")[2] == 0
    assert m.measures(None) == (0.0, 0, 0) and m.measures("")[1] == 0


def test_toxicity_held_out_and_odd_rows(spark, odd_docs, no_docs):
    got = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out")
    assert got.filter("predicted = toxic").count() >= 0.96 * got.count()
    nothing = toxicity.fit(spark, no_docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = [r[0] for r in odd_docs.select(toxicity.measures(spark, F.col("text"), nothing)).collect()]
    assert len(rows) == 8 and all(0 <= r.score < 0.5 for r in rows)


# ---- quality and licences

def test_base_rules_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.judged(docs, quality.references(docs)).collect():
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        count = Counter(zip(words, words[1:], words[2:]))
        covered = {x for k in range(len(words) - 2) if count[tuple(words[k:k + 3])] > 1 for x in (k, k + 1, k + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


REFERENCES = "lang string, classes array<double>, words array<string>, shares array<double>"


def brute_references(rows):
    """Shares of classes and of common words per lang and for all, from the definition."""
    import unicodedata
    classes, words = {}, {}
    for lang, text in rows:
        for key in {lang, None}:
            seen, count = classes.setdefault(key, [0] * 6), words.setdefault(key, Counter())
            count.update(re.findall(r"[^\x20\x09-\x0D]+", text))
            for c in text:
                kind = unicodedata.category(c)
                plain = "a" <= c <= "z" or c in " \t\n\x0b\f\r" or "\u00df" <= c <= "\u00f6" or "\u00f8" <= c <= "\u00ff"
                seen[0 if plain else 1 if kind == "Lu" else 2 if kind == "Nd" else 3 if kind[0] == "P" else 4 if kind[0] == "S" else 5] += 1
    out = {}
    for key, seen in classes.items():
        size = sum(words[key].values())
        common = sorted(w for w, n in words[key].items() if n >= quality.COMMON * size)
        out[key] = [c / max(sum(seen), 1) for c in seen], common, [words[key][w] / size for w in common]
    return out


@pytest.mark.parametrize("guessed_from, guessed", [(1 / 32, 2000), (1.0, 3), (1e-9, 2000)])
def test_references_equal_brute_force(spark, monkeypatch, guessed_from, guessed):
    """60 languages, an empty one, rows without one; good guesses, too few, none."""
    monkeypatch.setattr(quality, "GUESSED_FROM", guessed_from)
    monkeypatch.setattr(quality, "GUESSED", guessed)
    rng = random.Random(12)
    rows = [(f"l{k % 60}", " ".join(rng.choice(["der", "die", f"w{k % 60}", f"x{rng.randrange(900)}", "A1", "%é"]) for _ in range(60))) for k in range(300)]
    rows += [("", "only here\n"), (None, "Zz no lang ٣"), (None, ""), ("empty", "")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)] + [(999, "l1", None)], "doc_id long, lang string, text string").repartition(4)
    want = brute_references(rows)
    got = {r.lang: r for r in quality.references(docs).collect()}
    assert got.keys() == want.keys() and len(got) == 63
    for lang, (classes, words, shares) in want.items():
        assert got[lang].classes == pytest.approx(classes) and got[lang].words == words and got[lang].shares == pytest.approx(shares)


def test_distances_equal_the_definition(spark):
    text = "the cat the dog THE 12 %% " * 12
    classes = [0.7, 0.1, 0.05, 0.05, 0.05, 0.05]
    refs = spark.createDataFrame([(None, classes, ["of", "the"], [0.2, 0.5]), ("xx", [1.0] + [0.0] * 5, ["a"], [1.0])], REFERENCES)
    r = quality.judged(spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string"), refs).first()
    def distance(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        part = lambda x: sum(a * np.log2(a / c) for a, c in zip(x, m) if a > 0)
        return np.sqrt((part(p) + part(q)) / 2)
    n = len(text)
    chars = [n - (3 + 2 + 2) * 12, 3 * 12, 2 * 12, 2 * 12, 0, 0]
    assert r.class_distance == pytest.approx(distance([c / n for c in chars], classes))
    assert r.word_distance == pytest.approx(distance([24 / 84, 0, 60 / 84], [0.5, 0.2, 0.3]))


def test_units_near_a_licence_template_hold_an_anchor():
    templates = [licenses.template_bigrams(t) for _, t in licenses.TEMPLATES]
    for min_dice in (0.5, 0.8, 0.95):
        anchors = {" ".join(pair) for pair in licenses.anchor_bigrams(templates, min_dice)}
        for bigrams in templates:
            others = [x for x in bigrams if x not in anchors]  # the most that a unit without an anchor shares
            low = max(licenses.size_bounds(len(bigrams), min_dice)[0], len(others))
            assert 2 * len(others) / (low + len(bigrams)) < min_dice


def test_quality_and_licences_of_odd_rows(spark, odd_docs, no_docs):
    rows = quality.judged(odd_docs, quality.references(odd_docs)).collect()
    assert len(rows) == 8 and not any(r.kept for r in rows)
    none = quality.references(no_docs)
    assert none.collect() == [] and quality.judged(no_docs, none).collect() == [] and len(quality.judged(odd_docs, none).collect()) == 8
    assert licenses.found_licenses(odd_docs).collect() == [] and licenses.found_licenses(no_docs).collect() == []
    docs = spark.createDataFrame([(1, "a\nreleased UNDER the mit  license\nb"), (1, "Released under the MIT License"), (2, "Released under the law of the land here")], "doc_id long, text string")
    assert sorted((r.doc_id, r.line_no, r.license, r.dice) for r in licenses.found_licenses(docs).collect()) == [
        (1, -1, "MIT", 0.8), (1, 0, "MIT", 1.0), (1, 1, "MIT", 1.0)]  # the whole text of the first row shares 4 bigrams: 8 / (6 + 4)


def test_sql_twins(spark):
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    for name, sql in ORACLES.items():
        want = con.sql(sql)
        got = [tuple(r) for r in QUERIES[name](spark, SMALL).select(*want.columns).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want.fetchall())), name


