"""Early-stopped training: gradients, the stopping rule on its own history, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dragoman.operators import evaluate, training
from dragoman.operators.split import stratified_split
from dragoman.plans.queries_refine import filtered

SCHEMA = "text string, intent_label int, resource_label int"


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    return stratified_split(filtered(spark, sf_dir), "example_id", "class_id").select("text", "intent_label", "resource_label", "split").persist()


@pytest.fixture(scope="module")
def model(parts):
    return training.train_early_stopped(parts.filter("split = 'train'"), parts.filter("split = 'val'"), max_epochs=12, words=1 << 10, trigrams=1 << 10)


def test_gradient_equals_differences(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("a bc de", 3, 1), ("bc bc xyz", 0, 4), ("", 21, 0), (None, 5, 2)] * 3, SCHEMA).repartition(3)
    rows = training.sparse_rows(df, 1, 64, 64).persist()
    weights, idf = rng.normal(size=(27, 129)), rng.random(128) + 0.5
    sums, loss, n = training.gradient(rows, weights, idf)
    assert n == 12 and sums.shape == weights.shape
    for c, f in [(3, 128), (0, int(np.abs(sums[0, :-1]).argmax())), (26, 128), (21, 128), (24, int(np.abs(sums[24, :-1]).argmax()))]:
        moved = weights.copy()
        moved[c, f] += 1e-5
        assert (training.gradient(rows, moved, idf)[1] - loss) / 1e-5 == pytest.approx(sums[c, f], rel=1e-3, abs=1e-4)
    scored = training.score(training.EarlyStopped(weights, idf, 64, 64, []), df.withColumns({"ya": F.col("intent_label"), "yb": F.col("resource_label")}))
    assert evaluate.two_head_loss(scored).first()["loss"] * 12 == pytest.approx(loss)


def test_history_follows_the_stopping_rule(spark, model):
    ruled = evaluate.early_stopping(spark.createDataFrame(model.history), score="val_f1").collect()
    assert len(ruled) == len(model.history)  # nothing was trained beyond the stop
    best = max(model.history, key=lambda h: (h["val_f1"], -h["epoch"]))
    assert {r["best_epoch"] for r in ruled} == {best["epoch"]}
    stop = {r["stop_epoch"] for r in ruled}
    assert stop == {None} and len(model.history) == 12 or stop == {model.history[-1]["epoch"]}
    assert model.history[-1]["train_loss"] < model.history[0]["train_loss"]


def test_kept_epoch_is_right_on_held_out_rows(parts, model):
    found = training.measured(model, parts.filter("split = 'test'"))
    assert found["accuracy_intent"] > 0.95 and found["macro_f1_intent"] > 0.9 and found["loss"] < 2
    again = training.measured(model, parts.filter("split = 'val'"))
    assert again["macro_f1_intent"] == pytest.approx(max(h["val_f1"] for h in model.history))


def test_partitions_do_not_matter_and_empty_parts_pass(spark, parts):
    some = parts.filter("split = 'val'").limit(5).persist()
    runs = [training.train_early_stopped(some.repartition(k), some, max_epochs=1, parts=12, words=64, trigrams=64) for k in (1, 5)]
    assert np.allclose(runs[0].weights, runs[1].weights) and runs[0].weights.any()
    odd = training.score(runs[0], spark.createDataFrame([(None, 1), ("", 2)], "text string, la int")).collect()
    assert [len(r["la"]) for r in odd] == [22, 22] and [len(r["lb"]) for r in odd] == [5, 5]


def test_validation_texts_are_counted_once_for_all_epochs(spark, parts, model):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text
    some = parts.filter("split = 'val'").select("text", "intent_label", "resource_label")
    trained = training.train_early_stopped(some, some.withColumn("text", seen("text")), max_epochs=2, words=64, trigrams=64)
    assert len(trained.history) == 2 and read.value == some.count()
    best = max(trained.history, key=lambda h: h["val_f1"])
    assert training.measured(trained, some)["loss"] == pytest.approx(best["val_loss"])  # counted or not, the same logits
    sparse = training.score_sparse(model, training.sparse_rows(some, 1, 1 << 10, 1 << 10)).select("la", "lb").collect()
    assert sorted(map(str, sparse)) == sorted(map(str, training.score(model, some).select("la", "lb").collect()))
