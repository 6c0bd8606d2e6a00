import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from imagelab.operators import filters
from imagelab.operators import images as ops
from imagelab.functions.predictors import RowsRefused
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.plans import training
from imagelab.sources.images import read_labelled_images

NAMES = ["alpha", "beta", "gamma"]


@pytest.fixture(scope="module")
def labelled(spark, tree):
    return read_labelled_images(spark, str(tree), NAMES, drop_invalid=False, extensions=["png"])


def test_feature_table_keeps_every_row(labelled):
    table = ops.feature_table(labelled, ["label"], height=16, width=16)
    assert table.columns == ["label", "features", "reason"]
    assert table.count() == labelled.count() == 31
    assert {r.reason for r in filters.rejects(table).collect()} == {"undecodable"}
    assert {len(r.features) for r in filters.drop_null_features(table).collect()} == {4 * 4 * 3 + 3 * 8}


def test_rows_that_the_predictor_refuses_are_null(labelled):
    def factory():
        def predict(stack):
            if (stack[:, 0, 0, 0] == 250).any():
                raise RowsRefused("no bright red, please")
            return stack[:, 0, 0, :]

        return predict

    table = ops.feature_table(labelled, ["label"], make_predict_fn=factory, height=4, width=4, method="nearest")
    counts = {(r.label, r.reason): r["count"] for r in table.groupBy("label", "reason").count().collect()}
    assert counts[(0, "predictor: no bright red, please")] == 2 and counts[(0, None)] == 7
    assert counts[(1, None)] == 10 and counts[(2, "undecodable")] == 1


def test_a_predictor_that_fails_fails_the_job(labelled):
    def factory():
        def predict(stack):
            raise ValueError("wrong input size")

        return predict

    with pytest.raises(PySparkException, match="wrong input size"):
        ops.feature_table(labelled, ["label"], make_predict_fn=factory, height=4, width=4).collect()


def test_a_predictor_is_built_once_per_task(spark, labelled):
    def factory():
        calls = {"n": 0}

        def predict(stack):
            calls["n"] += 1
            return np.full((len(stack), 1), calls["n"], np.float32)

        return predict

    one_task = labelled.coalesce(1)
    table = ops.feature_table(one_task, ["label"], make_predict_fn=factory, height=4, width=4)
    highest = table.select(F.max(F.element_at("features", 1)).alias("m")).first().m
    assert highest > 1  # several shapes, one predictor


def test_scaling_reaches_the_predictor(labelled):
    factory = lambda: lambda stack: stack.min(axis=(1, 2))
    raw, scaled = (
        ops.feature_table(labelled, ["image.origin"], make_predict_fn=factory, height=4, width=4, scaling=s)
        for s in (None, "inception")
    )
    rows = [
        sorted(map(tuple, filters.drop_null_features(table).drop("reason").collect())) for table in (raw, scaled)
    ]
    for (name, a), (other, b) in zip(*rows, strict=True):
        assert name == other and np.allclose(np.array(a) / 127.5 - 1, b, atol=1e-6)


def test_featurizer_in_a_pipeline_saves_and_loads(labelled, tmp_path):
    featurizer = ImageFeaturizer(height=16, width=16)
    spec = training.elastic_net_regression()
    colour = filters.keep_dimensions(labelled)
    composed = training.fit_stages([featurizer], spec, colour)
    plain = Pipeline(stages=[ImageFeaturizer(height=16, width=16), LogisticRegression(maxIter=5, regParam=0.03, elasticNetParam=0.5)]).fit(colour)
    path = str(tmp_path / "model")
    composed.write().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[0].getOrDefault("height") == 16
    predictions = [
        sorted((r.o, r.prediction) for r in m.transform(colour).select(F.col("image.origin").alias("o"), "prediction").collect())
        for m in (composed, plain, loaded)
    ]
    assert predictions[0] == predictions[1] == predictions[2]
    assert len(predictions[0]) == 27  # broken images are skipped
    hits = loaded.transform(colour).filter("label = prediction").count()
    assert hits == 27


def test_featurizer_can_fail_on_broken_images(labelled):
    strict = ImageFeaturizer(height=4, width=4, handleInvalid="error")
    with pytest.raises(PySparkException):
        strict.transform(labelled).select("features").collect()


def test_filters_pass_the_featurizer_and_it_runs_once(spark, labelled):
    table = ops.feature_table(labelled, ["origin", "class_name", "label"], height=4, width=4)
    stage = ImageFeaturizer(height=4, width=4).transform(labelled)
    for frame in (table, stage):
        kept = filters.drop_null_features(frame).filter("label = 1")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
        above, below = plan.split("ArrowEvalPython")
        assert "beta" in below and "isnotnull" in above
    assert filters.drop_null_features(table).filter("class_name = 'beta'").count() == 10


def test_features_of_resized_pixels(labelled):
    featurizer = ImageFeaturizer(height=16, width=16)
    options = featurizer.embed_options()
    resized = ops.resized_table(labelled.select("image", "label", F.col("origin").alias("file")), 16, 16)
    direct = ops.feature_table(labelled.withColumn("file", F.col("origin")), ["file"], **options)
    again = ops.pixel_feature_table(resized, ["file"], **options)
    rows = [{r.file: r.features for r in t.collect()} for t in (direct, again)]
    assert rows[0] == rows[1] and len(rows[0]) == 31
