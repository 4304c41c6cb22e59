"""Byte-level BPE: training by windows of merges, encoding and decoding, as Spark jobs.

Training keeps the distinct-word table in Spark and looks for many merges at a time. The pairs that come first
in merge order (count, then ids) are active; the first pair after them is the window's border. The count of a
pair only falls, and a pair of merged symbols occurs no more often than the two symbols at its junction did and
has larger ids. So every merge before the border joins active pairs only: words are cut
where two neighbours are no active pair, and the distinct pieces with their counts are all that these merges
depend on. The pieces are as many as a window's bound allows, whatever the corpus; more or fewer active pairs
are chosen to meet it. The window is then merged one by one over linked symbols, with pair counts, an index from
pairs to their places and a queue kept up to date, and the result of each piece goes back into the words.
"""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, functions as F

from dragoman import dims
from dragoman.functions.plan import through_table
from dragoman.operators.tokens import byte_alphabet, byte_level_tokens, pretoken_patterns

#: Symbols of a window's distinct pieces at most; this bounds what the driver holds.
WINDOW_SYMBOLS = 2_000_000
#: Active pairs of a window at most.
WINDOW_PAIRS = 1 << 16
#: Encoded words that a worker keeps at most, and characters of a kept word at most.
KEPT_WORDS, KEPT_CHARS = 400_000, 40
#: Symbols of a word up to which the next merge is searched, not queued.
SEARCHED_SYMBOLS = 32

Merge = tuple[int, int, int]  # left, right, merged


def byte_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """Distinct byte-level pre-tokens with their counts.

    The trainer reads line by line, line ends included, so each line gets its own leading
    space. Counting combines map-side.
    """
    lines = texts.select(F.explode(F.split(F.concat(F.col(text), F.lit("\n")), r"(?<=\n)")).alias("line"))
    tokens = lines.filter(F.col("line") != "").select(F.explode(byte_level_tokens(F.col("line"))).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- words as flat arrays of symbols ---------------------------------------------------------------------

def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words end to end, and the word of each."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), lengths)


def _pairs(symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the next one, as one number, and whether both are of one word."""
    return symbols[:-1].astype(np.int64) << 32 | symbols[1:], word[:-1] == word[1:]


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(values, pa.int32()))


def _bytes(words: pa.Array) -> np.ndarray:
    return np.frombuffer("".join(words.to_pylist()).encode(), np.uint8)


def _spell(ids: np.ndarray):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column("word")).to_numpy(zero_copy_only=False).astype(np.int64)
            longer = batch.filter(pa.array(lengths > 1))
            yield pa.RecordBatch.from_arrays([_lists(ids[_bytes(longer.column("word"))], lengths[lengths > 1]), longer.column("n")], ["symbols", "n"])
    return spell


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(256, bool)
    for batch in batches:
        seen[_bytes(batch.column("word"))] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int32())], ["byte"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        symbols, word = _flat(batch.column("symbols"))
        pair, same = _pairs(symbols, word)
        pair, weight = pair[same], batch.column("n").to_numpy()[word[:-1][same]]
        order = np.argsort(pair, kind="stable")
        pair, weight = pair[order], weight[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
        freq = np.add.reduceat(weight, first) if len(pair) else weight
        yield pa.RecordBatch.from_arrays([pa.array(pair[first]), pa.array(freq)], ["pair", "freq"])


def _pieces(symbols: np.ndarray, word: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First symbol and length of each run of symbols joined by active pairs."""
    pair, same = _pairs(symbols, word)
    at = np.minimum(np.searchsorted(active, pair), len(active) - 1)
    joined = same & (active[at] == pair)
    first = np.flatnonzero(np.r_[True, ~joined][:len(symbols)])
    return first, np.diff(np.r_[first, len(symbols)])


def _cut(active: np.ndarray):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word = _flat(batch.column("symbols"))
            first, length = _pieces(symbols, word, active)
            longer = length > 1
            values = symbols[np.repeat(longer, length)].astype("<i4")
            borders = pa.py_buffer(np.r_[0, np.cumsum(length[longer]) * 4].astype(np.int32))
            pieces = pa.BinaryArray.from_buffers(pa.binary(), int(longer.sum()), [None, borders, pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([pieces, batch.column("n").take(pa.array(word[first[longer]]))], ["piece", "n"])
    return cut


def _hashes(symbols: np.ndarray, first: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number of each piece: mixed symbols times powers of an odd number by their place, summed."""
    if not len(first):
        return np.zeros(0, np.uint64)
    start = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(start, length)
    mixed = (symbols[np.repeat(first, length) + place].astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    powers = np.cumprod(np.full(length.max(), 0x94D049BB133111EB, np.uint64))
    return np.add.reduceat(mixed * powers[place], start)


def _result_table(symbols: np.ndarray, length: np.ndarray, merged: np.ndarray, after: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed, sorted numbers of the pieces, and start, size and symbols of their results. No two pieces have one number."""
    first, seed = np.cumsum(length) - length, 1
    while True:
        numbers = _hashes(symbols, first, length, seed)
        order = np.argsort(numbers)
        if not (np.diff(numbers[order]) == 0).any():
            return seed, numbers[order], (np.cumsum(after) - after)[order], after[order], merged
        seed += 1 << 32


def _replace(active: np.ndarray, results):
    """Words with every piece replaced by its merged symbols; words of one symbol go."""
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, numbers, starts, sizes, merged = results.value
        for batch in batches:
            symbols, word = _flat(batch.column("symbols"))
            first, length = _pieces(symbols, word, active)
            longer = length > 1
            wanted = _hashes(symbols, first[longer], length[longer], seed)
            at = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
            if not np.array_equal(numbers[at], wanted):
                raise ValueError("a piece without a result")
            after = length.copy()
            after[longer] = size = sizes[at]
            piece = np.repeat(longer, after)
            values = np.empty(len(piece), np.int32)
            values[piece] = merged[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            values[~piece] = symbols[first[~longer]]
            yield _shortened(values, np.bincount(word[first], after, len(batch)).astype(np.int64), batch)
    return replace


def _replace_one(left: int, right: int, new: int):
    """Words after one merge, from left to right where the pair overlaps itself."""
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, word = _flat(batch.column("symbols"))
            values = symbols.copy()
            hit = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right) & (word[:-1] == word[1:]))
            if left == right:  # of a run of hits every other one counts
                run = np.cumsum(np.r_[True, np.diff(hit) != 1]) - 1
                start = np.flatnonzero(np.r_[True, np.diff(hit) != 1])
                hit = hit[(np.arange(len(hit)) - start[run]) % 2 == 0] if len(hit) else hit
            values[hit] = new
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            yield _shortened(values[stay], np.bincount(word[stay], minlength=len(batch)), batch)
    return replace


def _shortened(values: np.ndarray, lengths: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
    keep = lengths > 1
    return pa.RecordBatch.from_arrays([_lists(values[np.repeat(keep, lengths)], lengths[keep]), batch.column("n").filter(pa.array(keep))], ["symbols", "n"])


# --- merging a window ------------------------------------------------------------------------------------

class Window:
    """Pieces as linked symbols, with the counts and the places of their pairs."""

    def __init__(self, pieces: list[np.ndarray], counts: list[int]):
        self._link(np.concatenate(pieces) if pieces else np.zeros(0, np.int32), np.array([len(p) for p in pieces], np.int64), np.array(counts, np.int64))

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> Window:
        """From pieces end to end."""
        window = cls.__new__(cls)
        window._link(symbols, lengths.astype(np.int64), counts)
        return window

    def _link(self, symbols: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Arrays of machine numbers, 20 bytes a symbol besides its place."""
        size, ends = len(symbols), np.cumsum(lengths)
        following, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
        following[ends - 1] = before[ends - lengths] = -1
        weight = np.repeat(counts.astype(np.int64), lengths)
        self.starts = ends - lengths
        self.symbol, self.next, self.prev = (array("i", x.astype(np.int32).tobytes()) for x in (symbols, following, before))
        self.weight = array("q", weight.tobytes())
        self.count: dict[tuple[int, int], int] = defaultdict(int)
        self.places: dict[tuple[int, int], array] = defaultdict(lambda: array("i"))
        at = np.flatnonzero(following >= 0).astype(np.int32)
        pair = symbols[at].astype(np.int64) << 32 | symbols[at + 1]
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if size and len(pair) else np.zeros(0, np.int64)
        freq = np.add.reduceat(weight[at], first).tolist() if len(first) else []
        for p, n, a, b in zip(pair[first].tolist(), freq, first.tolist(), [*first[1:].tolist(), len(at)]):
            self.count[p >> 32, p & 0xFFFFFFFF] = n
            self.places[p >> 32, p & 0xFFFFFFFF] = array("i", at[a:b].tobytes())
        self.queue = [(-n, pair) for pair, n in self.count.items()]
        heapq.heapify(self.queue)

    def best(self) -> tuple[int, tuple[int, int]] | None:
        """The most frequent pair, of equal ones that with the smaller ids, and its count."""
        while self.queue:
            n, pair = self.queue[0]
            now = self.count.get(pair, 0)
            if now == -n:
                return now, pair
            heapq.heappop(self.queue)
            if now > 0:
                heapq.heappush(self.queue, (-now, pair))
        return None

    def merge(self, pair: tuple[int, int], new: int) -> None:
        """Merge all occurrences from left to right."""
        symbol, following, before, weight, count, places = self.symbol, self.next, self.prev, self.weight, self.count, self.places
        left, right = pair
        grown = set()
        for i in sorted(places.pop(pair, ())):
            j = following[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # merged otherwise since
            n, p, k = weight[i], before[i], following[j]
            count[pair] -= n
            symbol[i], symbol[j], following[i] = new, -1, k
            if p >= 0:
                count[symbol[p], left] -= n
                made = symbol[p], new
                count[made] += n
                places[made].append(p)
                grown.add(made)
            if k >= 0:
                before[k] = i
                count[right, symbol[k]] -= n
                made = new, symbol[k]
                count[made] += n
                places[made].append(i)
                grown.add(made)
        for made in grown:
            if count[made] > 0:
                heapq.heappush(self.queue, (-count[made], made))

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all pieces after the merges, end to end, and how many each piece has. A merged symbol stands at its left one's place."""
        symbols = np.frombuffer(self.symbol, np.int32)
        stay = symbols >= 0
        return symbols[stay], np.add.reduceat(stay, self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)

    def results(self) -> list[np.ndarray]:
        symbols, sizes = self.merged()
        return np.split(symbols, np.cumsum(sizes)[:-1]) if len(sizes) else []


class Vocabulary:
    """Tokens by id, and the merges learned."""

    def __init__(self, tokens: list[str], size: int, most_merges: int | None):
        self.spelling, self.ids = list(tokens), {t: i for i, t in enumerate(tokens)}
        self.merges: list[tuple[str, str]] = []
        self.size, self.most = size, most_merges

    def full(self) -> bool:
        return len(self.spelling) >= self.size or (self.most is not None and len(self.merges) >= self.most)

    def learn(self, left: int, right: int) -> tuple[int, bool]:
        """Id of the merged token, and whether it is a special token."""
        a, b = self.spelling[left], self.spelling[right]
        self.merges.append((a, b))
        old = a + b in self.ids
        if not old:
            self.ids[a + b] = len(self.spelling)
            self.spelling.append(a + b)
        return self.ids[a + b], old


def merge_window(window: Window, vocabulary: Vocabulary, border: tuple[int, int, int] | None, min_frequency: int) -> None:
    """Learn the merges before ``border`` (minus count, left, right), in order.

    All symbols of one spelling come from the same merge, but a text may spell a special token. Its small id
    goes before others in ties, which the border does not foresee, so such a merge ends a bounded window.
    """
    while not vocabulary.full():
        found = window.best()
        if found is None or found[0] < min_frequency or (border is not None and (-found[0], *found[1]) >= border):
            return
        new, old = vocabulary.learn(*found[1])
        window.merge(found[1], new)
        if old and border is not None:
            return


# --- training --------------------------------------------------------------------------------------------

def _measured(df: DataFrame, purpose: str, size: Column) -> tuple[DataFrame, int]:
    """``df`` through a table, and the sum of ``size`` over its rows, taken as they are written."""
    total = Observation()
    written = through_table(df.observe(total, F.sum(size).alias("total")), purpose)
    return written, total.get["total"] or 0


def _piece_table(words: DataFrame, active: np.ndarray, bound: int) -> tuple[pa.Table | None, int]:
    """Distinct pieces and their counts, or None if they have more than ``bound`` symbols, and their symbols."""
    pieces = words.mapInArrow(_cut(active), "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces, size = _measured(pieces, "bpe_pieces", F.octet_length("piece").cast("long"))
    return pieces.toArrow() if size <= 4 * bound else None, size // 4


def bpe_train(texts: DataFrame, merges: int | None = None, text: str = "text", vocab_size: int = dims.VOCAB_SIZE,
              min_frequency: int = 2, window_symbols: int = WINDOW_SYMBOLS, window_pairs: int = WINDOW_PAIRS,
              ) -> tuple[list[tuple[str, str]], DataFrame]:
    """Learn byte-level BPE merges; returns them in order and the vocabulary ``(token_id, token)``.

    Every step merges the most frequent pair, of equal ones that with the smaller pair of ids, in the whole
    corpus; bounds on windows change the number of jobs, not the result. The driver holds a window's pieces,
    ``window_symbols`` symbols at most. The byte alphabet is what occurs in the corpus; other bytes become
    ``[UNK]`` when encoding. Null and empty texts add nothing.
    """
    spark = texts.sparkSession
    spelled = through_table(byte_words(texts.filter(F.col(text).isNotNull()), text), "bpe_words")
    letters = byte_alphabet()
    seen = [r["byte"] for r in spelled.mapInArrow(_bytes_of, "byte int").distinct().collect()]  # <= 256
    vocabulary = Vocabulary([*dims.SPECIAL_TOKENS, *sorted(letters[b] for b in seen)], vocab_size, merges)
    ids = np.array([vocabulary.ids.get(c, -1) for c in letters], np.int32)
    length = F.size("symbols").cast("long")
    words, left = _measured(spelled.mapInArrow(_spell(ids), "symbols array<int>, n long"), "bpe_symbols", length)
    active_pairs = 64
    while not vocabulary.full():
        if 2 * left <= window_symbols:  # here all pairs are active, each with an entry of its own
            rows = words.toArrow().combine_chunks()  # the rest makes one window
            lists = [c for c in rows.column("symbols").chunks] or [pa.array([], pa.list_(pa.int32()))]
            symbols, lengths = (np.concatenate([f(c).to_numpy(zero_copy_only=False) for c in lists]) for f in (pc.list_flatten, pc.list_value_length))
            merge_window(Window.of(symbols, lengths, rows.column("n").to_numpy()), vocabulary, None, min_frequency)
            break
        freq = words.mapInArrow(_count_pairs, "pair long, freq long").groupBy("pair").agg(F.sum("freq").alias("freq")).filter(F.col("freq") >= min_frequency)
        top = freq.orderBy(F.desc("freq"), "pair").limit(window_pairs + 1).collect()
        if not top:
            break
        active_pairs = min(active_pairs, window_pairs, len(top))
        table = None
        while active_pairs > 1 and table is None:
            active = np.array(sorted(r["pair"] for r in top[:active_pairs]), np.int64)
            table, used = _piece_table(words, active, window_symbols)
            if table is None:
                active_pairs //= 4 if used > 8 * window_symbols and active_pairs > 4 else 2
        if table is None:  # one pair: its merge needs no pieces
            pair = top[0]["pair"]
            new, _ = vocabulary.learn(pair >> 32, pair & 0xFFFFFFFF)
            words = words.mapInArrow(_replace_one(pair >> 32, pair & 0xFFFFFFFF, new), "symbols array<int>, n long")
            active_pairs = 2
        else:
            border = top[active_pairs] if active_pairs < len(top) else None
            border = (1 - min_frequency, -1, -1) if border is None else (-border["freq"], border["pair"] >> 32, border["pair"] & 0xFFFFFFFF)
            pieces = table.column("piece").to_pylist()
            symbols, lengths = np.frombuffer(b"".join(pieces), "<i4"), np.array([len(p) // 4 for p in pieces], np.int64)
            window = Window.of(symbols, lengths, table.column("n").to_numpy())
            merge_window(window, vocabulary, border, min_frequency)
            results = spark.sparkContext.broadcast(_result_table(symbols, lengths, *window.merged()))
            words = words.mapInArrow(_replace(active, results), "symbols array<int>, n long")
            free = window_symbols // max(used, 1)
            active_pairs *= 16 if free >= 64 else 8 if free >= 24 else 4 if free >= 8 else 2 if free >= 3 else 1
        words, left = _measured(words, "bpe_symbols", length)
    table = spark.createDataFrame(list(enumerate(vocabulary.spelling)), "token_id int, token string")
    return vocabulary.merges, table


def vocabulary_map(vocabulary: DataFrame, size: int = dims.VOCAB_SIZE) -> dict[str, int]:
    """Token to id on the driver; a vocabulary has at most its fixed size."""
    rows = vocabulary.limit(size + 1).collect()
    if len(rows) > size:
        raise ValueError(f"vocabulary of more than {size} tokens")
    return {r["token"]: r["token_id"] for r in rows}


# --- encoding --------------------------------------------------------------------------------------------

class Coder:
    """Encodes words by rank; symbols that are no token become ``[UNK]`` and merge with nothing."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int]):
        self.unknown = vocabulary["[UNK]"]
        self.byte_ids = [vocabulary.get(c, -1) for c in byte_alphabet()]
        self.ranks = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(merges)}
        self.short = {pair: rank for pair, (rank, _) in self.ranks.items()}
        self.made = [vocabulary[a + b] for a, b in merges]

    def encode(self, word: str) -> np.ndarray:
        symbol = [self.byte_ids[b] for b in word.encode()]
        symbol = self._by_search(symbol) if len(symbol) <= SEARCHED_SYMBOLS else self._by_queue(symbol)
        return np.array([self.unknown if s == -1 else s for s in symbol], np.int32)

    def _by_search(self, symbol: list[int]) -> list[int]:
        """The least rank of all neighbours, searched anew for each merge."""
        ranks, none = self.short, len(self.made)
        found = [ranks.get(pair, none) for pair in zip(symbol, symbol[1:])]
        while found and (best := min(found)) < none:
            i = found.index(best)
            symbol[i:i + 2] = [self.made[best]]
            del found[i]
            if i:
                found[i - 1] = ranks.get((symbol[i - 1], symbol[i]), none)
            if i < len(found):
                found[i] = ranks.get((symbol[i], symbol[i + 1]), none)
        return symbol

    def _by_queue(self, symbol: list[int]) -> list[int]:
        """A queue of the ranks of neighbours over linked symbols: n log n, however long the word is."""
        end = len(symbol)
        following, before, ranks = list(range(1, end + 1)), list(range(-1, end - 1)), self.ranks
        queue = []
        for i in range(end - 1):
            found = ranks.get((symbol[i], symbol[i + 1]))
            if found is not None:
                queue.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = following[i]
            if symbol[i] != left or j >= end or symbol[j] != right:
                continue
            k = following[j]
            symbol[i], symbol[j], following[i] = new, None, k
            if k < end:
                before[k] = i
                found = ranks.get((new, symbol[k]))
                if found is not None:
                    heapq.heappush(queue, (found[0], i, new, symbol[k], found[1]))
            p = before[i]
            if p >= 0:
                found = ranks.get((symbol[p], new))
                if found is not None:
                    heapq.heappush(queue, (found[0], p, symbol[p], new, found[1]))
        return [s for s in symbol if s is not None]


def _parts(cut: re.Pattern, text: str) -> list[str]:
    """Parts of a text that hold whole pre-tokens, each without the space before it; a text that has none gets one."""
    parts = cut.split(text)
    if parts[0][:1] == " ":
        parts[0] = parts[0][1:]
    elif not parts[0]:
        del parts[0]
    return parts


class Known(dict):
    """What ``make`` gives for strings, kept for short ones; the strings not met lately go."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> bytes:
        got = self.before.get(key)
        if got is None:
            got = self.make(key)
            if len(key) >= KEPT_CHARS:
                return got
        if len(self) >= KEPT_WORDS // 2:
            self.before = dict(self)
            self.clear()
        self[key] = got
        return got


#: What a worker keeps of the vocabulary it used last, for the tasks that come after.
_LAST: dict[str, Known] = {}


def _kept_parts(key: str, shared: tuple[list[tuple[str, str]], dict[str, int]], token: re.Pattern) -> Known:
    """Ids of parts, as bytes; the same store for every task of one ``key``."""
    if key not in _LAST:
        coder = Coder(*shared)
        words = Known(lambda word: coder.encode(word).tobytes())
        _LAST.clear()
        _LAST[key] = Known(lambda part: b"".join([words[w] for w in token.findall(" " + part)]))
    return _LAST[key]


def bpe_encode(texts: DataFrame, merges: list[tuple[str, str]], vocabulary: dict[str, int],
               text: str = "text") -> DataFrame:
    """Add ``ids``: BPE token ids of each text; unknown symbols become ``[UNK]``, null texts have none.

    A worker keeps the ids of short words, and of the parts between spaces, that it has met, from task to task: no row
    per word, no shuffle, no hot word. Merges and vocabulary are bounded by the vocabulary size and are broadcast.
    """
    shared = texts.sparkSession.sparkContext.broadcast((merges, vocabulary))
    patterns, key = pretoken_patterns(texts.sparkSession), uuid.uuid4().hex

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token, cut = map(re.compile, patterns)
        parts = _kept_parts(key, shared.value, token)
        for batch in batches:
            found = [b"".join([parts[p] for p in _parts(cut, t)]) if t else b"" for t in batch.to_pylist()]
            yield _lists(np.frombuffer(b"".join(found), np.int32), np.array([len(x) // 4 for x in found], np.int64))

    return texts.withColumn("ids", encode(F.col(text)))


def bpe_decode(ids: Column, vocabulary: dict[str, int]) -> Column:
    """Text of token ids, with the leading space that encoding adds; special tokens have no text, broken UTF-8 gives U+FFFD."""
    byte_of = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
    special = set(dims.SPECIAL_TOKENS)
    spelled = {i: b"" if t in special else b"".join(byte_of[c] for c in t) for t, i in vocabulary.items()}

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array([spelled.get(i, b"") for i in range(max(spelled) + 1)], pa.large_binary())
        for batch in batches:
            texts = table.take(batch.flatten())
            ends = np.cumsum(np.r_[0, pc.binary_length(texts).to_numpy(zero_copy_only=False)])
            data = memoryview(texts.buffers()[2] or b"")
            rows = ends[np.cumsum(np.r_[0, batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])].tolist()
            yield pa.array([str(data[a:b], "utf-8", "replace") for a, b in zip(rows, rows[1:])], pa.string())

    return decode(ids)
