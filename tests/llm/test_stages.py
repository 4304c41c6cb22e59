"""The pipeline's stages go through their operators, score a text once, and keep frequent words."""

import random

import corpus_pipeline
import public_tokenizers
from dragoman.llm import neardup, pieces, simhash, similar

from tests.llm.test_near import brute, grams, words


def test_near_dedup_links_fingerprints_through_the_simhash_operator(spark, sf_dir, monkeypatch):
    rng, searched, search = random.Random(8), [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints, radius: searched.append(radius) or search(prints, radius))
    base = words(rng, 400)
    docs = spark.createDataFrame([(k, " ".join(base[:400 - k])) for k in range(6)] + [(9, " ".join(words(rng, 300)))], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9] and searched == [2]


def test_close_fingerprints_are_compared_without_a_common_band(spark):
    """Texts that no band has in common: only the fingerprints propose their pairs, and the exact similarity decides."""
    rng, texts = random.Random(4), []
    for _ in range(10):
        base = words(rng, 500)
        texts += [" ".join(base), " ".join([*base, "end"])]
    prints = [simhash.fingerprint_of(t, 5) for t in texts]
    sets = [sorted({hash(g) for g in grams(t)}) for t in texts]
    contents = spark.createDataFrame([(k, [1000 + k], [p]) for k, p in enumerate(prints)], "content long, keys array<long>, prints array<long>").localCheckpoint()
    table = spark.createDataFrame(list(enumerate(sets)), "content long, grams array<long>")
    found = similar.components(similar.in_shared_buckets(neardup.proposed(contents)).localCheckpoint(), table, 0.8).collect()
    named = {r.node: r.component for r in found}
    near = [k for k in range(20) if (prints[k] ^ prints[k ^ 1]).bit_count() <= 2]
    label = brute([set(s) for s in sets])
    assert len(near) >= 10 and all(named[k] == label[k] == k & ~1 for k in near)


def test_language_stage_scores_each_text_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = corpus_pipeline.identify_language(spark, docs, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_frequent_words_outlive_the_cache(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 20)
    coder, encoded = pieces.Pieces(pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))), []
    pack = coder.words.encode
    coder.words.encode = lambda word: encoded.append(word) or pack(word)
    for k in range(60):
        coder.encode(f"the rare{k} cat")
    assert encoded.count("the") == encoded.count("cat") == 1 and len(encoded) == 62
    assert len(coder.words) + len(coder.words.before) <= 20 + 3
