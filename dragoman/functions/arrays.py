"""Array maths for model outputs: softmax, arg-max, smoothed loss, padding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Max-shifted softmax of an array of doubles."""
    exps = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    # the one-element wrapper binds ``exps`` once, so it is not evaluated per element
    return F.transform(F.array(exps), lambda e: F.transform(e, lambda x: x / _sum(e)))[0]


def log_softmax(logits: Column) -> Column:
    shifted = F.transform(logits, lambda x: x - F.array_max(logits))
    log_total = F.log(_sum(F.transform(shifted, lambda x: F.exp(x))))
    return F.transform(F.array(F.struct(shifted.alias("s"), log_total.alias("t"))),
                       lambda b: F.transform(b["s"], lambda x: x - b["t"]))[0]


def argmax(values: Column) -> Column:
    """0-based position of the maximum, lowest index on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def smoothed_cross_entropy(logits: Column, target: Column, smoothing: float) -> Column:
    """Cross entropy with label smoothing for a 0-based target index."""
    bound = F.array(log_softmax(logits))
    return F.transform(
        bound,
        lambda lp: -(1 - smoothing) * F.element_at(lp, target.cast("int") + 1)
        - F.lit(smoothing) / F.size(lp) * _sum(lp),
    )[0]


def top_k(values: Column, k: int) -> Column:
    """``k`` best (index, value) pairs, best first, lowest index on ties."""
    pairs = F.transform(values, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx"), x.alias("value")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda p: F.struct(p["idx"], p["value"]))


def fixed_length(ids: Column, max_len: int, cls_id: int, sep_id: int, pad_id: int) -> tuple[Column, Column]:
    """``[CLS] ids [SEP]`` cut to ``max_len`` including the specials, padded right; and its mask."""
    body = F.concat(F.array(F.lit(cls_id)), F.slice(ids, 1, max_len - 2), F.array(F.lit(sep_id)))
    used = F.least(F.size(ids) + 2, F.lit(max_len))
    padded = F.concat(body, F.array_repeat(F.lit(pad_id), F.lit(max_len) - used))
    mask = F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(max_len) - used))
    return padded, mask
