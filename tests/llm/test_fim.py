"""Fill-in-middle: a brute-force version, exact round trips, odd rows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dragoman.llm import fim
from dragoman.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.01"


def brute(text, key, cut_percent=90, spm_percent=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256((key or "").encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= cut_percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def run(spark, rows, **named):
    df = spark.createDataFrame(rows, "id string, text string")
    got = df.select("id", "text", fim.transform(F.col("text"), F.col("id"), **named).alias("g"))
    return got.select("id", "text", "g.*", fim.restore(F.col("g.output"), F.col("g.form")).alias("restored")).collect()


def texts(n):
    rng = random.Random(7)
    alphabet = "abzAZ @[`{é–你好😀́\n\r\t<P>SM019 "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_equals_brute_force_and_restores(spark):
    rows = [(f"1:{k}", t) for k, t in enumerate(texts(600))]
    rows += [("a", None), (None, None), (None, "null key"), ("b", ""), ("c", "<"), ("d", "<P"), ("e", "x<P>y"), ("f", "<S>"), ("g", "a<M"), ("h", "<<P"), ("i", "S>"),
             ("j", "one word " * 30000), ("k", "你" * 50000), ("l", "z" * 100000), ("e", "x<P>y")]
    forms = set()
    for r in run(spark, rows):
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(r["text"], r["id"]), r["id"]
        assert r["restored"] == (r["text"] or "")
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_rates_are_parameters(spark):
    rows = [(str(k), "some ordinary text") for k in range(200)]
    assert {r["form"] for r in run(spark, rows, cut_percent=0)} == {"plain"}
    assert {r["form"] for r in run(spark, rows, cut_percent=100, spm_percent=100)} == {"spm"}
    assert {r["form"] for r in run(spark, rows, cut_percent=100, spm_percent=0)} == {"psm"}


def test_blocks_and_slices(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK_BYTES", 16)
    array = pa.array(["skipped", "", None, "abc def", "é" * 40, "x", "", "tail"])[1:]
    got = []
    for rows, block in fim.blocks(array):
        assert rows.stop - rows.start == 1 or len(block.data) <= 16
        got += [bytes(block.data[a:b]).decode() for a, b in zip(block.starts, block.ends)]
    assert got == ["", "", "abc def", "é" * 40, "x", "", "tail"]
    assert list(fim.blocks(pa.array([], pa.string()))) == []


def test_markers_never_span_two_texts():
    data = np.frombuffer(b"a<P>b<S>", np.uint8)
    block = fim.Block(data, np.array([0, 2, 5, 8]))  # "a<", "P>b", "<S>"
    assert block.marked().tolist() == [False, False, True]


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs, tmp_path):
    for docs, n in ((odd_docs, 8), (no_docs, 0)):
        docs.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        rows = QUERIES["op12_fill_in_middle"](spark, f"{tmp_path}/{n}").collect()
        assert len(rows) == n
        want = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect()}
        assert {r["restored_sha256"] for r in rows} == want


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(f"SELECT * FROM ({ORACLES['op12_fill_in_middle']}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, SMALL).orderBy("doc_id").collect()] == want
