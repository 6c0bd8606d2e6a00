import tracemalloc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from imagelab.plans import head, scoring, training
from imagelab.sources import registry as rg


def clouds(spark, rows, partitions=4):
    """Three classes that no line separates: rings around the origin."""
    radius = (F.col("id") % 3 + F.rand(1) * 0.6 + 0.2).alias("radius")
    df = spark.range(0, rows, 1, partitions).select("id", radius, (F.rand(2) * 6.283).alias("turn"))
    features = F.array((F.col("radius") * F.cos("turn")).cast("float"), (F.col("radius") * F.sin("turn")).cast("float"))
    return df.select(F.col("id").alias("_row"), array_to_vector(features).alias("features"), (F.col("id") % 3).cast("int").alias("label"))


def test_gradient_equals_finite_differences():
    pick = np.random.default_rng(1)
    weights = head.initial_weights(3, 7, 4, 5)
    weights["hidden_bias"] += pick.normal(size=7)
    x, y = pick.normal(size=(11, 3)), pick.integers(0, 4, 11)
    loss, gradient = head.loss_and_gradient(weights, x, y)
    assert loss == pytest.approx(head.loss_of(weights, x, y))
    flat = head._flat(weights)
    for at in range(len(flat)):
        step = np.zeros_like(flat)
        step[at] = 1e-6
        up, down = (head.loss_of(head._shaped(flat + s, weights), x, y) for s in (step, -step))
        assert head._flat(gradient)[at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_gradient_works_on_few_rows_at_a_time():
    """Hidden values of a whole Arrow batch would go through memory for each step of the sum."""
    pick = np.random.default_rng(1)
    weights = {name: w.astype(np.float32) for name, w in head.initial_weights(5, 1024, 3, 5).items()}
    x, y = pick.normal(size=(20_000, 5)).astype(np.float32), pick.integers(0, 3, 20_000)
    tracemalloc.start()
    head.loss_and_gradient(weights, x, y)
    head.loss_of(weights, x, y)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 8 << 20


def test_adam_against_its_definition():
    adam, values = head.Adam(1, 0.1), np.array([1.0])
    mean = square = 0.0
    expected = 1.0
    for t, g in enumerate([0.5, -2.0, 1.0], 1):
        values = adam.update(values, np.array([g]))
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        expected -= 0.1 * (mean / (1 - 0.9**t)) / ((square / (1 - 0.999**t)) ** 0.5 + 1e-7)
    assert values[0] == pytest.approx(expected)


def test_partitioning_and_lanes_do_not_matter(spark, monkeypatch):
    def fitted(partitions):
        rows = clouds(spark, 3000).orderBy("_row").repartition(partitions)
        return head._flat(head.ReluHead(hidden=16, epochs=2, batches=3).fit(rows).weights)

    one = fitted(1)
    np.testing.assert_allclose(fitted(7), one, atol=1e-4)
    monkeypatch.setattr(head, "DIRECT_BYTES", 0)
    np.testing.assert_allclose(fitted(7), one, atol=1e-4)


def test_learns_saves_and_scores(spark, tmp_path):
    train = clouds(spark, 6000)
    spec = training.relu_head(hidden=64, epochs=40, batches=8, rate=0.01)
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    run = training.run_training(spec, train, clouds(spark, 900), registry, str(tmp_path / "models"))
    assert run.accuracy > 0.95
    assert registry.rows().first()["model"] == "Multilayer Perceptron (relu)"
    loaded = PipelineModel.load(run.model_path)
    assert loaded.stages[0].numFeatures == 2 and loaded.stages[0].numClasses == 3
    some = clouds(spark, 30)
    columns = "_row", "prediction", "probability"
    assert loaded.transform(some).select(*columns).collect() == run.model.transform(some).select(*columns).collect()
    row = scoring.score_features(some, loaded, ["a", "b", "c"], keep=["label"]).first()
    assert row["class_name"] == "abc"[row["label"]] and len(row["top5"]) == 3
    assert loaded.transform(some.limit(0)).count() == 0


def test_early_stopping_keeps_the_best(spark, monkeypatch):
    losses, kept = iter([5.0, 3.0, 4.0, 3.5, 1.0]), []

    def fake(rows, weights, gradient=True):
        values = head._flat(weights)
        if gradient:
            return 1, 0.0, np.ones_like(values)
        kept.append(values)
        return 1, next(losses), np.zeros(0)

    monkeypatch.setattr(head, "summed", fake)
    model = head.ReluHead(hidden=2, epochs=9, batches=1, patience=2).fit(clouds(spark, 60))
    assert len(kept) == 4  # two epochs without a smaller loss
    np.testing.assert_array_equal(head._flat(model.weights), kept[1])


def test_few_rows(spark):
    with pytest.raises(ValueError, match="no training rows"):
        head.ReluHead().fit(clouds(spark, 30).limit(0))
    model = head.ReluHead(hidden=4, epochs=2, batches=2).fit(clouds(spark, 3).drop("_row"))
    assert model.numClasses == 3
