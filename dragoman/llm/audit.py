"""Conversation structure repair by a persistent audit DP.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. The DP goes row by row over the four
places in that pattern and keeps, for each, the cheapest edits so far and of these the ASCII-least string of
their initials. Edit strings share their prefixes as linked nodes; a node knows its ancestors at powers of two
and a rolling hash of its string, so two tied strings are compared by a search for their longest common prefix.
An equality of hashes is verified by walking to the node that both share.

A string fixes the place it ends at, and inserts stand right before a row (or at the very end), so of two tied
strings over the same rows none is a prefix of the other. Hence pieces of a long conversation can be solved by
themselves, from every place they may start at: costs and the order of the strings are enough to join them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from dragoman.llm.common import bound_batches, col, through_table

#: Rows of one piece at most; conversations with more rows are cut.
PIECE_ROWS = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
PLACES = 4
#: Costs; keeping a row is free, unless it is truncated.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Inserts that end a conversation from each place, and what they cost.
TAIL = ("", "II", "I", "")
#: Places a row may be put at, by (place, initial).
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
BASE, PRIME = 911_382_323, (1 << 61) - 1
SPACES = " \t\n\x0b\f\r"
OK, BLANK, DUPLICATE, CUT_SHORT = range(4)
_ROW = "array<struct<role: string, text: string>>"
SCHEMA = f"conv_id {{}}, piece long, pieces long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired {_ROW}"


class Trail:
    """Strings as nodes that share their prefixes; node 0 is the empty string."""

    def __init__(self):
        self.letter, self.hash, self.depth, self.up = [""], [0], [0], [[]]

    def add(self, node: int, letters: str) -> int:
        for c in letters:
            jumps, k = [node], 0
            while k < len(self.up[jumps[k]]):  # ancestors at 1, 2, 4, ... letters
                jumps.append(self.up[jumps[k]][k])
                k += 1
            self.letter.append(c)
            self.hash.append((self.hash[node] * BASE + ord(c)) % PRIME)
            self.depth.append(self.depth[node] + 1)
            self.up.append(jumps)
            node = len(self.up) - 1
        return node

    def lifted(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            rise = self.depth[node] - depth
            node = self.up[node][min(rise.bit_length() - 1, len(self.up[node]) - 1)]
        return node

    def string(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _same(self, a: int, b: int) -> bool:
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, depth), self.lifted(b, depth)
        if x == y or self.hash[x] == self.hash[y]:
            if self._same(x, y):
                return self.depth[a] < self.depth[b]
            return self.string(a) < self.string(b)  # a collision
        k = min(len(self.up[x]), len(self.up[y]))
        while k:
            k -= 1
            if k < len(self.up[x]) and k < len(self.up[y]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if self._same(self.up[x][0], self.up[y][0]):
            return self.letter[x] < self.letter[y]
        return self.string(a) < self.string(b)


def solved(initials: list[str], faults: list[int], entry: int) -> tuple[Trail, list[tuple[int, int] | None]]:
    """Cheapest edits of the rows from place ``entry`` to each place: (cost, node) or None."""
    trail = Trail()
    best: list[tuple[int, int] | None] = [None] * PLACES
    best[entry] = (0, 0)
    for initial, fault in zip(initials, faults):
        offers: list[list[tuple[int, int, str]]] = [[] for _ in range(PLACES)]
        extra = TRUNCATED if fault == CUT_SHORT else 0
        for place, found in enumerate(best):
            if found is None:
                continue
            cost, node = found
            offers[place].append((cost + DELETE, node, "D"))  # inserts before a deletion come later, after it: D < I
            if fault == BLANK or fault == DUPLICATE:
                continue
            if place == START and initial == "s":
                offers[SYSTEM].append((cost + extra, node, "K"))
            follows = ASSISTANT if place == USER else USER
            kept = KEPT.get((place, initial)) == follows
            offers[follows].append((cost + extra, node, "K") if kept else (cost + extra + REROLE, node, "R"))
            # an insert of the role that follows, then the row in the other role
            then = USER if follows == ASSISTANT else ASSISTANT
            kept = KEPT.get((follows, initial)) == then
            offers[then].append((cost + extra + INSERT, node, "IK") if kept else (cost + extra + INSERT + REROLE, node, "IR"))
        best = [_least(trail, x) for x in offers]
    return trail, best


def _least(trail: Trail, offers: list[tuple[int, int, str]]) -> tuple[int, int] | None:
    if not offers:
        return None
    cost = min(o[0] for o in offers)
    tied = [trail.add(node, letters) for c, node, letters in offers if c == cost]
    least = tied[0]
    for node in tied[1:]:
        if trail.less(node, least):
            least = node
    return cost, least


def cheapest(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    trail, best = solved(initials, faults, START)
    offers = [(found[0] + INSERT * len(TAIL[p]), found[1], TAIL[p]) for p, found in enumerate(best) if found is not None]
    cost, node = _least(trail, offers)
    return cost, trail.string(node)


def applied(audit: str, roles: list[str], texts: list[str], place: int = START) -> list[dict]:
    """The rows that an audit leaves."""
    out, row = [], 0
    for edit in audit:
        if edit == "I":
            place = ASSISTANT if place == USER else USER
            out.append({"role": "assistant" if place == ASSISTANT else "user", "text": ""})
            continue
        if edit == "K":
            place = KEPT[place, roles[row][:1]]
            out.append({"role": roles[row], "text": texts[row]})
        elif edit == "R":
            place = ASSISTANT if place == USER else USER
            out.append({"role": "assistant" if place == ASSISTANT else "user", "text": texts[row]})
        row += 1
    return out


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def turn_gaps(turns: list) -> int:
    numbers = {t for t in turns if t is not None}
    return min(max(numbers) - min(numbers) + 1 - len(numbers), (1 << 63) - 1) if numbers else 0


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[tuple[object, list[list]]]:
    """Rows of adjacent equal ids, as columns; at most ``limit`` rows at a time."""
    held, columns = None, None
    for batch in batches:
        lists = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for row in zip(*lists):
            if columns is None or row[0] != held or len(columns[0]) == limit:
                if columns is not None:
                    yield held, columns
                held, columns = row[0], [[] for _ in lists]
            for values, value in zip(columns, row):
                values.append(value)
    if columns is not None:
        yield held, columns


def _emit(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x["text"] or "") + 64 for x in row[-1])
        if size > 1 << 20:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _repair_whole(schema: pa.Schema):
    """One piece per conversation, from rows (conv_id, turn, role, text, fault) in order."""
    def one(conv, columns: list[list]) -> tuple:
        _, turns, roles, texts, faults = columns
        seen: set[tuple[str, str]] = set()
        for k, said in enumerate(zip(roles, texts)):
            if said in seen and faults[k] != BLANK:
                faults[k] = DUPLICATE
            seen.add(said)
        initials = [r[:1] for r in roles]
        cost, audit = cheapest(initials, faults)
        return (conv, 0, 1, turn_gaps(turns), faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_SHORT), illegal_pairs(initials),
                cost, audit, applied(audit, roles, texts))

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit((one(conv, columns) for conv, columns in _runs(batches, None)), schema)
    return repair


_TRANSFER = ("conv_id {}, part long, k long, costs array<long>, ranks array<int>, audits array<string>, first string, last string, "
             "blank long, duplicate long, truncated long, illegal long, rows " + _ROW)


def _solve_pieces(schema: pa.Schema, limit: int):
    """Every piece solved from every place, from rows (conv_id, role, text, fault) in order."""
    def one(part: int, k: int, conv, columns: list[list]) -> tuple:
        _, roles, texts, faults = columns
        initials = [r[:1] for r in roles]
        costs, ranks, audits = [], [], []
        for entry in range(PLACES):
            trail, best = solved(initials, faults, entry)
            strings = [trail.string(b[1]) if b is not None else None for b in best]
            order = sorted(x for x in strings if x is not None)
            costs += [b[0] if b is not None else None for b in best]
            ranks += [order.index(x) if x is not None else None for x in strings]
            audits += strings
        return (conv, part, k, costs, ranks, audits, initials[0], initials[-1], faults.count(BLANK), faults.count(DUPLICATE),
                faults.count(CUT_SHORT), illegal_pairs(initials), [{"role": r, "text": t} for r, t in zip(roles, texts)])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from _emit((one(part, k, conv, columns) for k, (conv, columns) in enumerate(_runs(batches, limit))), schema)
    return solve


def joined_places(costs: list[list], ranks: list[list]) -> list[tuple[int, int, int]]:
    """(entry, exit, cost) of each piece in order, on the cheapest and then ASCII-least way through all."""
    ahead = [[INSERT * len(t) for t in TAIL]]
    for table in reversed(costs):
        ahead.append([min((table[e * PLACES + x] + ahead[-1][x] for x in range(PLACES) if table[e * PLACES + x] is not None and ahead[-1][x] is not None),
                          default=None) for e in range(PLACES)])
    ahead.reverse()
    place, way = START, []
    for k, (table, rank) in enumerate(zip(costs, ranks)):
        tight = [x for x in range(PLACES) if table[place * PLACES + x] is not None and ahead[k + 1][x] is not None
                 and table[place * PLACES + x] + ahead[k + 1][x] == ahead[k][place]]
        leaves = min(tight, key=lambda x: rank[place * PLACES + x])
        way.append((place, leaves, table[place * PLACES + leaves]))
        place = leaves
    return way


_CHOICE = "conv_id {}, part long, k long, piece long, pieces long, entry int, leaves int, cost long, border long"


def _choose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The way through the pieces of one conversation; a row of some hundred bytes per PIECE_ROWS rows."""
    pdf = pdf.sort_values(["part", "k"])
    way = joined_places([_ints(x) for x in pdf["costs"]], [_ints(x) for x in pdf["ranks"]])
    firsts, lasts = pdf["first"].tolist(), pdf["last"].tolist()
    border = [0, *(illegal_pairs([a, b]) for a, b in zip(lasts, firsts[1:]))]
    return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), "part": pdf["part"].to_numpy(), "k": pdf["k"].to_numpy(), "piece": range(len(pdf)), "pieces": len(pdf),
                         "entry": [w[0] for w in way], "leaves": [w[1] for w in way], "cost": [w[2] for w in way], "border": border})


def _ints(values) -> list[int | None]:
    return [None if v is None or v != v else int(v) for v in values]


def _repair_pieces(schema: pa.Schema):
    def one(row: dict) -> tuple:
        tail = TAIL[row["leaves"]] if row["piece"] == row["pieces"] - 1 else ""
        audit = row["audits"][row["entry"] * PLACES + row["leaves"]] + tail
        return (row["conv_id"], row["piece"], row["pieces"], row["gaps"] if row["piece"] == 0 else 0, row["blank"], row["duplicate"], row["truncated"],
                row["illegal"] + row["border"], row["cost"] + INSERT * len(tail), audit,
                applied(audit, [r["role"] for r in row["rows"]], [r["text"] for r in row["rows"]], row["entry"]))

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit((one(row) for batch in batches for row in batch.to_pylist()), schema)
    return repair


def _fault(text: Column) -> Column:
    """Blank or cut short; copies are found later, among the rows of a conversation."""
    last = F.right(F.rtrim(text, F.lit(SPACES)), F.lit(1))
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), OK).otherwise(CUT_SHORT)


def _arrow_schema(df: DataFrame, ddl: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = df.schema["conv_id"].dataType.simpleString()
    empty = df.sparkSession.createDataFrame([], ddl.format(kind))
    return ddl.format(kind), to_arrow_schema(empty.schema)


def repaired(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Pieces of conversations, their faults, the edits that repair them, and the rows after repair.

    Rows of a conversation go by turn, nulls first, then by role and text; repeated rows follow each other. Null
    roles and texts are empty, null ids are one conversation. Columns: conv_id, piece (from 0), pieces (of the
    conversation), gaps (missing turn numbers, at piece 0), blank, duplicate, truncated (rows by first fault),
    illegal (adjacent initials other than su, ua, au; at the later piece), cost, audit, repaired (array of role
    and text). Sums over the pieces, and audits and rows joined in their order, are those of the conversation;
    one of ``piece_rows`` rows or fewer is one piece. An initial other than s, u, a, an empty role included,
    cannot be kept. An empty table gives no rows; other columns are not read.

    Conversations of more than ``piece_rows`` rows are sorted over all tasks by ranges of their rows, so one that
    holds a third of all rows is solved by many tasks; only the costs of its pieces meet in one.
    """
    bound_batches(messages.sparkSession)
    rows = messages.select(col(conv).alias("conv_id"), col(turn).cast("long").alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                           F.coalesce(col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("fault", _fault(F.col("text")))
    ddl, schema = _arrow_schema(rows, SCHEMA)
    long_ones = through_table(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > piece_rows)
                              .select(F.col("conv_id").alias("long_id"), F.lit(True).alias("is_long")), "long")
    if long_ones.isEmpty():
        return _whole(rows, ddl, schema)
    marked = rows.join(long_ones, F.col("conv_id").eqNullSafe(F.col("long_id")), "left").drop("long_id")
    return _whole(marked.filter(F.col("is_long").isNull()).drop("is_long"), ddl, schema).unionByName(
        _pieces(marked.filter(F.col("is_long")).drop("is_long"), ddl, schema, piece_rows))


def _whole(rows: DataFrame, ddl: str, schema: pa.Schema) -> DataFrame:
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_repair_whole(schema), ddl)


def _pieces(rows: DataFrame, ddl: str, schema: pa.Schema, piece_rows: int) -> DataFrame:
    # rows that are equal in all columns are dealt out by the draw; stored, so that it is drawn once
    rows = through_table(rows.withColumn("draw", F.rand(1)), "long_rows")
    said = ["conv_id", "role", "text"]
    first = rows.groupBy(*said).agg(F.min(F.struct("turn", "draw")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        *[F.col(c).alias(f"{c}_") for c in said], "first")
    match = F.lit(True)
    for c in said:
        match = match & F.col(c).eqNullSafe(F.col(f"{c}_"))
    later = F.col("first").isNotNull() & ~F.struct("turn", "draw").eqNullSafe(F.col("first")) & (F.col("fault") != BLANK)
    flagged = rows.join(first, match, "left").withColumn("fault", F.when(later, DUPLICATE).otherwise(F.col("fault")))
    order = ["conv_id", "turn", "role", "text", "draw"]
    dealt = flagged.select(*order, "fault").repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text", "fault")
    transfer_ddl, transfer_schema = _arrow_schema(rows, _TRANSFER)
    pieces = through_table(dealt.mapInArrow(_solve_pieces(transfer_schema, piece_rows), transfer_ddl), "pieces")
    choice_ddl, _ = _arrow_schema(rows, _CHOICE)
    choice = pieces.select("conv_id", "part", "k", "costs", "ranks", "first", "last").groupBy("conv_id").applyInPandas(_choose, choice_ddl)
    span = (F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn"))
    gaps = rows.groupBy("conv_id").agg(F.when(span.isNull(), 0).otherwise(F.least(span, F.lit((1 << 63) - 1))).cast("long").alias("gaps"))
    named = gaps.select(F.col("conv_id").alias("gap_id"), "gaps")
    chosen = choice.join(named, F.col("conv_id").eqNullSafe(F.col("gap_id"))).drop("gap_id", "conv_id")
    return pieces.drop("costs", "ranks", "first", "last").join(chosen, ["part", "k"]).mapInArrow(_repair_pieces(schema), ddl)


def digests(pieces: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired ``role:text`` lines, joined by line ends.

    One piece is digested by itself. Of a cut conversation the pieces pass one task in order, which a digest of
    the whole needs, and only the running digest is kept.
    """
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r.role, F.lit(":"), r.text)), "\n")
    rows = pieces.select("conv_id", "piece", "pieces", F.size("repaired").alias("n"), lines.alias("lines"))
    kind = pieces.schema["conv_id"].dataType.simpleString()
    alone = rows.filter("pieces = 1").select("conv_id", F.sha2("lines", 256).alias("repaired_sha256"))
    cut = rows.filter("pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return alone.unionByName(cut.mapInArrow(_digest, f"conv_id {kind}, repaired_sha256 string"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, conv, empty = None, None, True

    def done(kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if row["piece"] == 0:
                if digest is not None:
                    yield done(kind)
                digest, conv, empty = sha256(), row["conv_id"], True
            if row["n"]:
                digest.update((b"" if empty else b"\n") + row["lines"].encode())
                empty = False
    if digest is not None:
        yield done(kind)
