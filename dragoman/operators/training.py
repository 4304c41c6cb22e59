"""Two linear heads trained epoch by epoch, with validation after each and early stopping.

Texts become sparse rows once: words and character trigrams hashed to a fixed width and weighted by rarity. A
step sums the gradient of the label-smoothed loss over one part of the training rows: tasks add up their own
rows, and their sums meet block by block of features, so no task holds more than a block of every task. The
parameters, classes x features, are updated on the driver and broadcast for the next step. After an epoch the
validation rows are scored, and the history decides when to stop, by the rule of ``early_stopping``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dragoman import dims
from dragoman.functions.plan import through_table
from dragoman.operators import evaluate
from dragoman.operators.scoring import softmax_argmax

WORDS, TRIGRAMS = 1 << 14, 1 << 14
#: Features of one block of a gradient.
BLOCK = 256
HEADS = (("ya", 22, dims.LOSS_WEIGHT_INTENT), ("yb", 5, dims.LOSS_WEIGHT_RESOURCE))
CLASSES = sum(n for _, n, _ in HEADS)
_ROWS = "ya int, yb int, part int, idx array<int>, tf array<float>"


def counted(text: str | None, words: int, trigrams: int) -> Counter:
    """Hashed words and character trigrams of a text; null is empty."""
    low = (text or "").lower()
    found = Counter(zlib.crc32(w.encode("utf-8", "surrogatepass")) % words for w in low.split())
    found.update(words + zlib.crc32(low[k:k + 3].encode("utf-8", "surrogatepass")) % trigrams for k in range(len(low) - 2))
    return found


@dataclass(frozen=True)
class EarlyStopped:
    """Weights (classes x features, a bias column last) of the best epoch, rarity weights, and what each epoch gave."""

    weights: np.ndarray
    idf: np.ndarray
    words: int
    trigrams: int
    history: list[dict]


def _logits(weights: np.ndarray, idx: np.ndarray, values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Logits of ``n`` sparse rows given end to end."""
    out = np.repeat(weights[:, -1:], n, axis=1)
    for c in range(len(weights)):
        out[c] += np.bincount(row, weights[c, idx] * values, n)
    return out


def _sparse(batch: pa.RecordBatch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = batch.column("idx")
    idx = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    values = batch.column("tf").flatten().to_numpy() * idf[idx]
    norm = np.sqrt(np.bincount(row, values * values, len(lists)))
    return idx, values / np.maximum(norm, 1e-12)[row], row


def loss_gradient(logits: np.ndarray, target: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """Label-smoothed cross entropy of each row, and its derivative by the logits (classes x rows)."""
    shifted = logits - logits.max(axis=0)
    logp = shifted - np.log(np.exp(shifted).sum(axis=0))
    want = np.full(logits.shape, smoothing / len(logits))
    want[target, np.arange(logits.shape[1])] += 1 - smoothing
    return -(want * logp).sum(axis=0), np.exp(logp) - want


def _step(shared, width: int, smoothing: float):
    """The gradient of a task's rows, in blocks of features; block -1 holds the biases, the loss and the rows."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, idf = shared.value
        total, bias, loss, rows = np.zeros((CLASSES, width)), np.zeros(CLASSES), 0.0, 0
        for batch in batches:
            idx, values, row = _sparse(batch, idf)
            logits, first = _logits(weights, idx, values, row, len(batch)), 0
            for label, classes, weight in HEADS:
                part = slice(first, first + classes)
                losses, slope = loss_gradient(logits[part], batch.column(label).to_numpy(), smoothing)
                for c in range(classes):
                    total[first + c] += weight * np.bincount(idx, slope[c, row] * values, width)
                bias[part] += weight * slope.sum(axis=1)
                loss += weight * losses.sum()
                first += classes
            rows += len(batch)
        if rows:
            blocks = [total[:, k:k + BLOCK] for k in range(0, width, BLOCK)]
            filled = [k for k, b in enumerate(blocks) if b.any()]
            yield pa.RecordBatch.from_arrays([pa.array([-1, *filled], pa.int32()), pa.array([np.r_[bias, loss, rows], *(blocks[k].ravel() for k in filled)], pa.list_(pa.float64()))], ["block", "sums"])
    return step


def _add(block: pa.Table) -> pa.Table:
    sums = np.sum([x.values.to_numpy() for x in block.column("sums")], axis=0)
    return pa.table({"block": block.column("block")[:1], "sums": pa.array([sums], pa.list_(pa.float64()))})


def gradient(rows: DataFrame, weights: np.ndarray, idf: np.ndarray, smoothing: float = dims.LABEL_SMOOTHING) -> tuple[np.ndarray, float, int]:
    """Sums over ``rows`` of the gradient by the weights and of the loss, and the number of rows."""
    width = weights.shape[1] - 1
    shared = rows.sparkSession.sparkContext.broadcast((weights, idf))
    sums = rows.mapInArrow(_step(shared, width, smoothing), "block int, sums array<double>").groupBy("block").applyInArrow(_add, "block int, sums array<double>")
    out, loss, n = np.zeros_like(weights), 0.0, 0
    got = sums.toArrow().combine_chunks()  # one row per block: the size of the weights
    for block, listed in zip(got.column("block").to_pylist(), got.column("sums")):
        values = listed.values.to_numpy()
        if block < 0:
            out[:, -1], loss, n = values[:CLASSES], float(values[CLASSES]), int(values[CLASSES + 1])
        else:
            out[:, block * BLOCK:][:, :min(BLOCK, width - block * BLOCK)] = values.reshape(CLASSES, -1)
    shared.unpersist()
    return out, loss, n


def sparse_rows(examples: DataFrame, parts: int, words: int = WORDS, trigrams: int = TRIGRAMS) -> DataFrame:
    """Examples (text, intent_label, resource_label) as sparse rows in ``parts`` parts by a hash of their text."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(t, words, trigrams) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("ya"), batch.column("yb"), batch.column("part"), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                                              pa.array([list(f.values()) for f in found], pa.list_(pa.float32()))], ["ya", "yb", "part", "idx", "tf"])
    named = examples.select("text", F.col("intent_label").cast("int").alias("ya"), F.col("resource_label").cast("int").alias("yb"),
                            F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(parts)).cast("int").alias("part"))
    return named.mapInArrow(spread, _ROWS)


def _heads(model: EarlyStopped, batch: pa.RecordBatch) -> pa.StructArray:
    """Logits of both heads for sparse rows."""
    out, first, heads = _logits(model.weights, *_sparse(batch, model.idf), len(batch)).T, 0, []
    for _, classes, _ in HEADS:
        heads.append(pa.FixedSizeListArray.from_arrays(pa.array(out[:, first:first + classes].ravel()), classes).cast(pa.list_(pa.float64())))
        first += classes
    return pa.StructArray.from_arrays(heads, ["la", "lb"])


def _with_logits(rows: DataFrame, logits: Column) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("la", "lb")]
    return rows.withColumn("_logits", logits).select(*[F.col(f"`{c}`") for c in kept], "_logits.la", "_logits.lb")


def score(model: EarlyStopped, rows: DataFrame, text: str = "text") -> DataFrame:
    """Add logits ``la`` and ``lb``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("la array<double>, lb array<double>")
    def logits(texts: pa.Array) -> pa.Array:
        m = shared.value
        found = [counted(t, m.words, m.trigrams) for t in texts.to_pylist()]
        return _heads(m, pa.RecordBatch.from_arrays([pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.float32()))], ["idx", "tf"]))
    return _with_logits(rows, logits(F.col(text)))


def score_sparse(model: EarlyStopped, rows: DataFrame) -> DataFrame:
    """``score`` of rows whose features are counted already, as ``sparse_rows`` gives them."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("la array<double>, lb array<double>")
    def logits(idx: pa.Array, tf: pa.Array) -> pa.Array:
        return _heads(shared.value, pa.RecordBatch.from_arrays([idx, tf], ["idx", "tf"]))
    return _with_logits(rows, logits(F.col("idx"), F.col("tf")))


def measured(model: EarlyStopped, examples: DataFrame) -> dict:
    """Loss, accuracy and macro F1 of both heads on labelled rows."""
    return _figures(score(model, examples).withColumns({"ya": F.col("intent_label"), "yb": F.col("resource_label")}))


def _figures(scored: DataFrame) -> dict:
    scored = through_table(softmax_argmax(scored.select("ya", "yb", "la", "lb")), "scored")
    out = evaluate.two_head_loss(scored).first().asDict()
    for head, label in (("intent", "ya"), ("resource", "yb")):
        report = evaluate.classification_report(evaluate.confusion(scored, label, f"{head}_idx"))
        best = report.agg(F.max("accuracy"), F.max("macro_f1")).first()
        out[f"accuracy_{head}"], out[f"macro_f1_{head}"] = best[0], best[1]
    return out


def train_early_stopped(train: DataFrame, validation: DataFrame, max_epochs: int = 15, patience: int = dims.PATIENCE_MAIN, parts: int = 3, rate: float = 0.5,
                        decay: float = 1e-4, words: int = WORDS, trigrams: int = TRIGRAMS) -> EarlyStopped:
    """Train until ``patience`` epochs bring no better macro F1 of the intent head on ``validation``; its best epoch is kept.

    An epoch takes one Adam step for each of ``parts`` parts of the rows, which follow from a hash of the
    texts: the result depends neither on partitions nor on the cluster but for the order of floating-point sums.
    """
    rows = through_table(sparse_rows(train, parts, words, trigrams), "sparse")
    held = through_table(sparse_rows(validation, 1, words, trigrams), "sparse")
    width = words + trigrams
    n = rows.count()
    seen = rows.select(F.explode("idx").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("df"))
    idf = np.zeros(width)
    for r in seen.collect():  # at most a row per feature
        idf[r["f"]] = np.log((n + 1) / (r["df"] + 1)) + 0.1
    weights = np.zeros((CLASSES, width + 1))
    mean, square, step = np.zeros_like(weights), np.zeros_like(weights), 0
    history, best = [], EarlyStopped(weights.copy(), idf, words, trigrams, [])
    top, waited = 0.0, 0
    for epoch in range(1, max_epochs + 1):
        total = 0.0
        for part in range(parts):
            sums, loss, count = gradient(rows.filter(F.col("part") == part), weights, idf)
            total += loss
            if not count:
                continue
            step += 1
            slope = sums / count
            slope[:, :-1] += decay * weights[:, :-1]
            mean = 0.9 * mean + 0.1 * slope
            square = 0.999 * square + 0.001 * slope ** 2
            weights = weights - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        now = EarlyStopped(weights.copy(), idf, words, trigrams, [])
        found = _figures(score_sparse(now, held))
        history.append({"run": "main", "epoch": epoch, "train_loss": float(total / max(n, 1)), "val_loss": found["loss"], "val_acc": found["accuracy_intent"],
                        "val_f1": found["macro_f1_intent"], "val_f1_resource": found["macro_f1_resource"]})
        score_now = found["macro_f1_intent"] or 0.0
        if score_now > top:
            top, waited, best = score_now, 0, now
        else:
            waited += 1
            if waited >= patience:
                break
    return EarlyStopped(best.weights, idf, words, trigrams, history)
