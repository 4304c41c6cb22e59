"""Fill-in-middle transformation by displacement scatter.

The texts of a block lie end to end in one byte array. A scan marks where the units (letter runs, other
code points) start and gives each text's two cuts. The sections between cuts move as wholes, so a
difference array holds the change of displacement where a section starts, and its cumulative sum is
the displacement of every byte: one scatter writes all outputs of the block, and one gather over the
same displacements, recomputed from the markers of the outputs, reads the texts back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a marker
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])
#: Texts of one block hold so many bytes together; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def draws(key: Column) -> list[Column]:
    """Four unsigned 32-bit draws from the SHA-256 of a key; a null key draws as an empty one."""
    digest = F.sha2(F.coalesce(key, F.lit("")), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


class Block:
    """Texts end to end: ``data`` and the borders of each text in it."""

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        self.data, self.borders = data, borders
        self.starts, self.ends = borders[:-1], borders[1:]
        self.lead = (data & 0xC0) != 0x80  # first byte of a code point

    def cuts(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Units of each text, and the bytes where its prefix and its middle end."""
        letter = ((self.data | 0x20) - np.uint8(97)) < 26
        follows = np.r_[False, letter[:-1]]
        follows[self.starts[self.starts < len(self.data)]] = False
        unit = np.flatnonzero(self.lead & ~(letter & follows))
        first = np.searchsorted(unit, self.starts)
        n = np.searchsorted(unit, self.ends) - first
        unit = np.r_[unit, len(self.data)]
        at = lambda k: np.where(k < n, unit[np.minimum(first + k, len(unit) - 1)], self.ends)
        a, b = h1 % (n + 1), h2 % (n + 1)
        return n, at(np.minimum(a, b)), at(np.maximum(a, b))

    def marked(self) -> np.ndarray:
        """Whether a text holds a marker."""
        return np.diff(np.searchsorted(self.markers()[0], self.borders)) > 0

    def markers(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all markers that lie inside one text, and their letters."""
        d = self.data
        at = np.flatnonzero((d[:-2] == PREFIX[0]) & (d[2:] == PREFIX[2])) if len(d) > 2 else np.zeros(0, np.int64)
        at = at[np.isin(d[at + 1], (PREFIX[1], SUFFIX[1], MIDDLE[1]))]
        at = at[at + MARK <= self.ends[np.searchsorted(self.ends, at, "right")]]
        return at, d[at + 1]

    def code_points(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        before = np.flatnonzero(self.lead)
        return np.searchsorted(before, high) - np.searchsorted(before, low)


def displacements(borders: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Displacement of every byte, borders of the outputs, and places of their (prefix, suffix, middle) markers."""
    start, end = borders[:-1], borders[1:]
    out = np.r_[0, np.cumsum(end - start + np.where(form == PLAIN, 0, 3 * MARK))]
    prefix, middle, suffix = cut1 - start, cut2 - cut1, end - cut2
    psm = form == PSM
    to_prefix = out[:-1] + np.where(psm, MARK, suffix + 2 * MARK)
    to_suffix = out[:-1] + np.where(psm, prefix + 2 * MARK, MARK)
    to_middle = out[:-1] + prefix + suffix + 3 * MARK
    moved = np.stack([to_prefix - start, to_middle - cut1, to_suffix - cut2], axis=1)
    moved[form == PLAIN] = (out[:-1] - start)[form == PLAIN, None]
    change = np.zeros(borders[-1] + 1, np.int64)
    # sections follow each other in the input; empty ones start where the next does, so changes add up
    np.add.at(change, np.stack([start, cut1, cut2], axis=1).ravel(), np.diff(moved.ravel(), prepend=0))
    cut = form != PLAIN
    return np.cumsum(change[:-1]), out, np.stack([to_prefix, to_suffix, to_middle], axis=1)[cut] - MARK


def scatter(block: Block, cut1: np.ndarray, cut2: np.ndarray, form: np.ndarray) -> Block:
    """The outputs of all texts of a block."""
    shift, borders, marks = displacements(block.borders, cut1, cut2, form)
    data = np.empty(borders[-1], np.uint8)
    data[np.arange(len(shift)) + shift] = block.data
    for k, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        data[marks[:, k, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return Block(data, borders)


def gather(output: Block, form: np.ndarray) -> Block:
    """The texts again, from outputs and forms alone."""
    cut = np.flatnonzero(form != PLAIN)
    size = output.ends - output.starts - np.where(form == PLAIN, 0, 3 * MARK)
    borders = np.r_[0, np.cumsum(size)]
    at, letter = output.markers()
    inside = form[np.searchsorted(output.ends, at, "right")] != PLAIN
    at, letter = at[inside], letter[inside]
    # texts with a marker stay plain and markers do not overlap, so each occurs once in a cut output
    p, s, m = (at[letter == mark[1]] for mark in (PREFIX, SUFFIX, MIDDLE))
    prefix = np.where(form[cut] == PSM, s, m) - p - MARK
    suffix = np.where(form[cut] == PSM, m, p) - s - MARK
    cut1, cut2 = borders[1:].copy(), borders[1:].copy()
    cut1[cut] = borders[cut] + prefix
    cut2[cut] = borders[cut + 1] - suffix
    shift, _, _ = displacements(borders, cut1, cut2, form)
    return Block(output.data[np.arange(len(shift)) + shift], borders)


def _large(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit borders of an array of strings; null is empty."""
    array = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    borders = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[borders[0]:borders[-1]], borders - borders[0]


def blocks(texts: pa.Array) -> Iterator[tuple[slice, Block]]:
    """Rows of at most BLOCK_BYTES together, or one row."""
    data, borders = _large(texts)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(borders, borders[row] + BLOCK_BYTES, "right")) - 1)
        yield slice(row, end), Block(data[borders[row]:borders[end]], borders[row:end + 1] - borders[row])
        row = end


def _strings(parts: list[Block]) -> pa.Array:
    arrays = [pa.LargeStringArray.from_buffers(len(b.starts), pa.py_buffer(b.borders.astype(np.int64)), pa.py_buffer(b.data)) for b in parts]
    return pa.concat_arrays(arrays).cast(pa.string()) if arrays else pa.array([], pa.string())


def transform(text: Column, key: Column, cut_percent: int = 90, spm_percent: int = 20) -> Column:
    """Struct (n long, form string, prefix_chars long, middle_chars long, output string) of whole texts.

    ``n`` counts the units. Cuts and form follow from ``key``, so repeated rows with equal keys have equal
    results and order plays no part. ``cut_percent`` of the texts are cut, ``spm_percent`` of those with the
    suffix first. Empty and null texts, and texts that hold a marker, stay plain: the output is the text,
    or empty, and the counts are null.
    """
    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def fill_in_middle(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        h = [x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)]
        outputs, columns = [], []
        for rows, block in blocks(texts):
            n, cut1, cut2 = block.cuts(h[0][rows], h[1][rows])
            plain = (n == 0) | block.marked() | (h[2][rows] % 100 >= cut_percent)
            form = np.where(plain, PLAIN, np.where(h[3][rows] % 100 < spm_percent, SPM, PSM))
            outputs.append(scatter(block, cut1, cut2, form))
            columns.append((n, form, block.code_points(block.starts, cut1), block.code_points(cut1, cut2)))
        n, form, prefix, middle = (np.concatenate(x) for x in zip(*columns)) if columns else [np.zeros(0, np.int64)] * 4
        return pa.StructArray.from_arrays(
            [pa.array(n), pa.array(FORMS[form]).cast(pa.string()), pa.array(prefix, mask=form == PLAIN), pa.array(middle, mask=form == PLAIN), _strings(outputs)],
            ["n", "form", "prefix_chars", "middle_chars", "output"])
    return fill_in_middle(text, *draws(key))


def restore(output: Column, form: Column) -> Column:
    """The text of each ``output``, from it and its form ("plain", "psm" or "spm") alone; null gives an empty text."""
    @F.arrow_udf("string")
    def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        coded = np.select([np.asarray(forms.to_pylist(), object) == x for x in ("psm", "spm")], [PSM, SPM], PLAIN) if len(forms) else np.zeros(0, np.int64)
        return _strings([gather(block, coded[rows]) for rows, block in blocks(outputs)])
    return restored(output, form)
