"""Chat formatting: brute force by turns, reversible escapes, typed parts, odd rows."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from dragoman.llm import chat
from dragoman.llm.queries import ORACLES, QUERIES

SCHEMA = f"conv_id long, turn long, role string, parts {chat.PARTS}"
SMALL = "/root/testdata/sf0.01"


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_escapes_are_reversible_and_hide_controls(spark):
    rng = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[PART]", "[IMG]", "<", "[", "\\", ">", "]", "/", "s", "INST", "a", "\n", "é", "$1", "\\2"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(800)] + ["<\\s>", "<\\\\s>", "[\\/INST]", "[[INST]]"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("<s>", "</s>", "[INST]", "[/INST]", "[PART]", "[IMG]", "[AUDIO]", "[DOC]", "[FILE]"))


def test_typed_parts_become_placeholders_with_attachments(spark):
    rows = [
        (1, 1, "assistant", [part(text="It is "), part(text="a <s>cat"), part("image", ref="b.png", width=1, height=1), part(text="done")]),
        (1, 0, "user", [part("image", ref="a.png", width=28, height=15), part(text="What is [IMG]?"), part("audio", ref="a.wav", seconds=1.5),
                        part("document", ref="a.pdf", pages=3), part("video", ref="a.mp4"), part(None, ref="?"), None]),
        (2, None, None, None), (2, 0, "assistant", []), (2, 1, "assistant", [part("image"), part("audio", seconds=-1.0), part("document", pages=None), part(text=None)]),
    ]
    chats = chat.formatted(spark.createDataFrame(rows, SCHEMA))
    got = {r["conv_id"]: r for r in chats.collect()}
    one, two = got[1], got[2]
    assert one["formatted"] == ("<s>[INST]user[/INST][IMG]What is [\\IMG]?[AUDIO][DOC][FILE][FILE]</s>"
                                "<s>[INST]assistant[/INST]It is [PART]a <\\s>cat[IMG]done</s>")
    assert [tuple(a) for a in one["attachments"]] == [
        ("image", "a.png", 4), ("audio", "a.wav", 38), ("document", "a.pdf", 768), ("video", "a.mp4", 1), (None, "?", 1), ("image", "b.png", 1)]
    assert one["attachment_tokens"] == 4 + 38 + 768 + 1 + 1 + 1
    written = one["formatted"].encode()
    assert [written[s["start"]:s["end"]].decode() for s in one["loss_mask"]] == ["It is ", "a <\\s>cat", "done"]
    assert two["formatted"] == "<s>[INST][/INST]</s><s>[INST]assistant[/INST]</s><s>[INST]assistant[/INST][IMG][AUDIO][DOC]</s>"
    assert [a["tokens"] for a in two["attachments"]] == [1, 1, 1]
    back = {r["conv_id"]: r for r in chat.read_back(chats).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", "What is [IMG]?"), ("assistant", "It is a <s>catdone")]
    assert back[1]["loss_texts"] == ["It is ", "a <s>cat", "done"]


def test_parts_are_read_back_one_by_one(spark):
    bodies = [[part(text="a"), part(text="b")], [part(text=""), part(text="")], [part("image"), part(text="x"), part("image")], [part(text="")],
              [part("audio"), part("audio")], [part(text="a"), part(text=""), part(text="b")]]
    chats = chat.formatted(spark.createDataFrame([(k, 0, "user", b) for k, b in enumerate(bodies)], SCHEMA))
    got = {r["conv_id"]: [tuple(p) for p in r["p"]] for r in chats.select(
        "conv_id", chat.body_parts(chat.turns(F.col("formatted"))[0]["body"]).alias("p")).collect()}
    for k, body in enumerate(bodies):
        assert got[k] == [(p[0], p[1] if p[0] == "text" else None) for p in body], k


def brute(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    def digest(t):
        return hashlib.sha256(t.encode()).hexdigest()
    for conv, turns in out.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), digest(loss))
    return out


def test_odd_rows_equal_brute_force(spark, tmp_path):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, "assistant", None), (None, 3, None, "x"), (None, None, "assistant", "né 你好 😀 <s>"),
            (2, 0, "assistant", "[/INST]</s>" * 3), (2, 1, "assistant", ""), (2, 2, "[INST]", "<\\s>"), (3, 5, "assistant", "long text. " * 40000), (3, 4, "user", "\n")]
    rows += [(4, k, "assistant" if k % 2 else "user", f"turn {k} é") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(1)).withColumn("parts", F.lit("x"))
    df.write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in QUERIES["op13_chat_format"](spark, f"{tmp_path}/a").collect()}
    said = "</s>[INST] ok [/INST]"
    assert got == brute([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
    df.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert [r["conv_id"] for r in QUERIES["op13_chat_format"](spark, f"{tmp_path}/b").collect()] == [-1]


def test_the_main_path_has_no_python(spark, sf_dir):
    plan = QUERIES["op13_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    want = con.execute(f"SELECT * FROM ({ORACLES['op13_chat_format']}) ORDER BY conv_id").fetchall()
    assert [tuple(r) for r in QUERIES["op13_chat_format"](spark, SMALL).orderBy("conv_id").collect()] == want
