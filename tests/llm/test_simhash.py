"""SimHash and BK-trees against brute force."""

import numpy as np
import pytest
import xxhash

from dragoman.llm import simhash
from dragoman.llm.graph import connected_components

SCHEMA = "doc_id long, text string, fingerprint string, fp int"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\v", " ").replace("\f", " ")
             .replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, radius):
    label = list(range(len(fps)))
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_and_components_match_brute_force(spark):
    base = " ".join(f"w{k}" for k in range(400))
    texts = [None, "", " \n", "One", "one", "one two", "A b C", "a B c", base, base, base + " tail", base.replace("w7 ", "x "),
             base.replace("w90 ", "x y "), "Ünï cödé wörds Ä", "ünï cödé wörds Ä", "x " * 70000, "x " * 70001]
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)] + [(8, base, "clash", 1)]
    got = [tuple(r) for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    fps = [brute_fingerprint(t) for t in texts]
    parts = brute_components(fps, 2)
    want = [(k, f"{fps[k]:016x}", parts[k]) for k in range(len(texts))]
    assert sorted(got) == sorted(want + [want[8]])


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_dense_shards_are_split_without_losing_a_link(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 6)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            fps.add(int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    component = {r.node: r.component for r in connected_components(simhash.links(df, radius, shard_rows=16)).collect()}
    brute = brute_components(fps, radius)
    assert [component.get(f, f) for f in fps] == [fps[k] for k in brute]


def test_keep_one_keeps_columns_rows_without_id_and_one_of_each_group(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(3, text, "a", 0), (3, text, "b", 0), (5, text, "c", 0), (9, "other words here", "d", 0), (None, text, "e", 0), (None, None, "f", 0)]
    got = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "fingerprint", "fp"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 3), (False, 9), (True, 0), (True, 0)]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}
