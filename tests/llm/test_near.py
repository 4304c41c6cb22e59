"""Near duplicates by exact Jaccard similarity against brute force over all pairs."""

import random

import corpus_pipeline
import numpy as np
from dragoman.llm import neardup, paragraphs, similar, simhash


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def grams(text):
    w = text.lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)}


def brute(sets, similarity=0.8):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_stage_drops_texts_of_similarity_0_8_however_far_their_fingerprints(spark, sf_dir, odd_docs, no_docs):
    rng, texts = random.Random(3), []
    for _ in range(12):
        base = words(rng, 300)
        for changes in (0, 1, 4, 6, 12):
            text = list(base)
            for at in rng.sample(range(5, 295), changes):
                text[at] = "changed"
            texts.append(" ".join(text).upper() if changes == 1 else "\n ".join(text))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    label = brute([grams(t) for t in texts])
    far = [(simhash.fingerprint_of(texts[k], 5) ^ simhash.fingerprint_of(texts[x], 5)).bit_count() for k, x in enumerate(label)]
    assert max(far) > 2
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()} == set(label)
    assert neardup.keep_one(no_docs).collect() == []
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6]


def test_large_buckets_lose_no_pair(spark):
    rng = np.random.default_rng(5)
    core, sets = np.arange(100), []
    for k in range(90):  # a family of about 0.6, with one true partner each
        own = np.r_[rng.choice(core, 75, replace=False), 1000 + 100 * k + np.arange(25)]
        sets += [set(own.tolist()), set(own[2:].tolist()) | {-k - 1}]
    order = rng.permutation(len(sets))
    sets = [sets[k] for k in order]
    label = brute(sets)
    table = spark.createDataFrame([(k, [int(x) for x in s]) for k, s in enumerate(sets)], "content long, grams array<long>")
    members = table.selectExpr("7L as key", "content").union(table.selectExpr("content % 5 as key", "content"))
    for block in (8, 256):
        got = {r.node: r.component for r in similar.components(similar.in_shared_buckets(members), table, 0.8, block=block).collect()}
        assert [got.get(k, k) for k in range(len(sets))] == label
    assert len(set(label)) == 90


def test_paragraphs_of_a_large_family_find_their_partners(spark):
    rng = random.Random(11)
    template, texts = words(rng, 120), []
    for _ in range(60):  # about 0.7 from each other
        own = list(template)
        for at in rng.sample(range(5, 115), 2):
            own[at] = words(rng, 1)[0] + "x"
        twin = list(own)
        for at in rng.sample(range(5, 115), 2):
            twin[at] = words(rng, 1)[0] + "y"
        texts += [" ".join(own), " ".join(twin)]
    label = brute([grams(t) for t in texts])
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    whole = [r for r in paragraphs.duplicates(spark, docs).collect() if r.end - r.start == len(texts[r.doc_id])]
    assert {(r.doc_id, r.kept_doc_id) for r in whole} == {(k, x) for k, x in enumerate(label) if x != k}
    assert len(whole) > 40
