"""Conversation repair: exhaustive edits, plain string DP, cut conversations, hash collisions, odd rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dragoman.llm import audit
from dragoman.llm.queries import QUERIES

WELL_FORMED = re.compile("(s?(ua)+)?")
BLANK = re.compile("[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"


def exhaustive(initials, faults, most=2):
    """The least (cost, audit) over all edit strings with up to ``most`` inserts in a gap."""
    found = []

    def gap(k, cost, letters, written):
        for n in range(most + 1):
            for roles in {0: [""], 1: ["u", "a"], 2: ["uu", "ua", "au", "aa"]}[n]:
                row(k, cost + 2 * n, letters + "I" * n, written + roles)

    def row(k, cost, letters, written):
        if not re.fullmatch("(s?(ua)*u?)?", written):
            return
        if k == len(initials):
            if WELL_FORMED.fullmatch(written):
                found.append((cost, letters))
            return
        gap(k + 1, cost + 3, letters + "D", written)
        if faults[k] in (audit.BLANK, audit.DUPLICATE):
            return
        extra = faults[k] == audit.CUT_SHORT
        gap(k + 1, cost + extra, letters + "K", written + (initials[k] or "?"))
        for r in "ua":
            gap(k + 1, cost + extra + 2, letters + "R", written + r)

    gap(0, 0, "", "")
    return min(found)


def test_equals_all_edit_strings():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randrange(5)
        initials = [rng.choice(["s", "u", "a", "u", "a", "t", ""]) for _ in range(n)]
        faults = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]
        assert audit.cheapest(initials, faults) == exhaustive(initials, faults), (initials, faults)


def plain(initials, faults):
    """The same DP over whole strings."""
    best = {"": (0, "")}
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    for initial, fault in zip(initials, faults):
        offers = {}
        for place, (cost, letters) in best.items():
            offers.setdefault(place, []).append((cost + 3, letters + "D"))
            if fault in (audit.BLANK, audit.DUPLICATE):
                continue
            cost += fault == audit.CUT_SHORT
            if place == "" and initial == "s":
                offers.setdefault("s", []).append((cost, letters + "K"))
            for inserts in range(3):
                at = place
                for _ in range(inserts):
                    at = step[at]
                to = step[at]
                offers.setdefault(to, []).append((cost + 2 * inserts + 2 * (to != initial), letters + "I" * inserts + ("K" if to == initial else "R")))
        best = {p: min(x) for p, x in offers.items()}
    return min((c + 2 * len(t), x + t) for p, (c, x) in best.items() for t in [{"": "", "s": "II", "u": "I", "a": ""}[p]])


def drawn(rng, n, roles=("s", "u", "a", "t")):
    return [rng.choice(roles) for _ in range(n)], [rng.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(n)]


def test_equals_the_plain_dp_on_long_conversations():
    rng = random.Random(6)
    for n in [30] * 60 + [400] * 5 + [3000]:
        for roles in (("u", "a"), ("u",), ("s", "u", "a", "t"), ("t",)):
            initials, faults = drawn(rng, n, roles)
            assert audit.cheapest(initials, faults) == plain(initials, faults)


def test_colliding_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(audit, "PRIME", 3)
    rng = random.Random(7)
    for _ in range(60):
        initials, faults = drawn(rng, 40)
        assert audit.cheapest(initials, faults) == plain(initials, faults)


def test_pieces_joined_equal_the_whole():
    rng = random.Random(8)
    for _ in range(60):
        initials, faults = drawn(rng, rng.randrange(1, 60))
        size = rng.randrange(1, 9)
        costs, ranks, strings = [], [], []
        for k in range(0, len(initials), size):
            for entry in range(4):
                trail, best = audit.solved(initials[k:k + size], faults[k:k + size], entry)
                found = [trail.string(b[1]) if b else None for b in best]
                order = sorted(x for x in found if x is not None)
                if entry == 0:
                    costs.append([]), ranks.append([]), strings.append([])
                costs[-1] += [b and b[0] for b in best]
                ranks[-1] += [order.index(x) if x is not None else None for x in found]
                strings[-1] += found
        way = audit.joined_places(costs, ranks)
        tail = audit.TAIL[way[-1][1]]
        got = sum(w[2] for w in way) + 2 * len(tail), "".join(s[e * 4 + x] for s, (e, x, _) in zip(strings, way)) + tail
        assert got == plain(initials, faults)


def brute(rows):
    """op11's rows from its contract."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = convs.setdefault(conv, [])
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        row = (turn is not None, turn or 0, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
        kept += [] if h == 0 else [row, row] if h == 3 else [row]
    out = {}
    for conv, kept in convs.items():
        kept.sort()
        seen, faults = set(), []
        for _, _, role, text in kept:
            core = text.strip(" \t\n\x0b\x0c\r")
            faults.append(audit.BLANK if not BLANK.search(text) else audit.DUPLICATE if (role, text) in seen else audit.OK if core[-1] in ".!?" else audit.CUT_SHORT)
            seen.add((role, text))
        initials = [r[:1] for _, _, r, _ in kept]
        cost, letters = plain(initials, faults)
        turns = {t for known, t, _, _ in kept if known}
        lines, at, last = [], 0, ""
        for c in letters:
            role = "assistant" if last == "u" else "user"
            if c == "I":
                lines.append(f"{role}:")
            elif c == "K":
                lines.append(f"{kept[at][2]}:{kept[at][3]}")
            elif c == "R":
                lines.append(f"{role}:{kept[at][3]}")
            last = lines[-1][0] if c != "D" else last
            at += c != "I"
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(audit.BLANK), faults.count(audit.DUPLICATE), faults.count(audit.CUT_SHORT),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def drawn_rows():
    rng = random.Random(9)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", "Why?", " \t\n", "", None, "Fine!  ", "a b", "ok. ", "x" * 20000 + "."]
    rows = [(conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for conv in [*range(40), None] for _ in range(rng.randrange(1, 14))]
    rows += [(100, k, "assistant" if k % 2 else "user", f"turn {k}.") for k in range(300)]
    rows += [(101, 7, "user", "same.")] * 90 + [(102, None, "assistant", f"t{k % 5}") for k in range(50)]
    return rows


def measures(rows):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


@pytest.mark.parametrize("piece_rows", [4096, 16, 1])
def test_query_equals_its_contract(spark, tmp_path, monkeypatch, piece_rows):
    rows = drawn_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("fault", F.lit("x")).withColumn("piece", F.lit(None).cast("int"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    whole = audit.repaired
    monkeypatch.setattr(audit, "repaired", lambda m: whole(m, piece_rows=piece_rows))
    got = QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()
    want = brute(rows)
    assert len(got) == len(want) and measures(got) == want


def test_empty_table_and_dropped_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/a").count() == 0
    gone = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(f"{tmp_path}/b/conversations.parquet")
    got = measures(QUERIES["op11_conversation_repair"](spark, f"{tmp_path}/b").collect())
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_whole_small_table_equals_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert measures(QUERIES["op11_conversation_repair"](spark, path).collect()) == brute(rows)
