import shutil

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from imagelab.operators import classes, filters
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.plans import scoring, training
from imagelab.sources import images as src
from imagelab.sources import registry as rg
from imagelab.streaming import scoring as streaming

NAMES = ["alpha", "beta", "gamma"]

@pytest.fixture(scope="module")
def registry(spark, tree, tmp_path_factory):
    """Two models trained on the pictures and logged."""
    root = tmp_path_factory.mktemp("runs")
    colour = filters.keep_dimensions(src.read_labelled_images(spark, str(tree), NAMES))
    registry = rg.ParquetRegistry(spark, str(root / "registry"))
    registry.create()
    specs = [training.decision_tree(), training.logistic_regression()]
    featurizer = ImageFeaturizer(height=16, width=16)
    runs = training.train_on_images(colour, specs, registry, str(root / "models"), featurizer, str(root / "features"))
    assert [run.accuracy for run in runs] == [1.0, 1.0]
    return registry


@pytest.fixture(scope="module")
def everything(spark, tree):
    return src.read_images(spark, str(tree), drop_invalid=False, extensions=["png"])


def test_folder_to_names(spark, everything, registry):
    path, model = rg.find_one(rg.listing(registry.rows()), 1)
    assert model == "Logistic Regression"
    scored = scoring.score_images(everything, path)  # the model has its class names
    rows = scored.collect()
    assert len(rows) == 31  # nothing is lost
    for r in rows:
        folder = r.origin.split("/")[-2]
        if "junk" in r.origin:
            assert r.reason == "undecodable" and r.class_name is None and r.top5 is None
        elif "gray" not in r.origin:
            assert r.class_name == folder and r.reason is None
            assert r.top5[0].class_name == folder and r.top5[0].score == r.confidence
            assert len(r.top5) == 3 and 1 / 3 < r.confidence <= 1


def test_one_upload_with_a_numbered_model(spark, tree, registry):
    numbered = rg.listing(registry.rows())
    upload = src.read_images(spark, str(tree / "gamma" / "rgba.PNG"), extensions=["png"])
    for index in (1, "2"):
        row = scoring.score_images_with_registry_model(upload, numbered, index).first()
        assert row.class_name == "gamma"
    with pytest.raises(LookupError):
        scoring.score_images_with_registry_model(upload, numbered, 3, NAMES)


def test_scoring_nothing_and_vectors(spark, registry):
    path, _ = rg.find_one(rg.listing(registry.rows()), 1)
    classifier = PipelineModel(PipelineModel.load(path).stages[1:])
    bare = PipelineModel(classifier.stages[:1])
    with pytest.raises(ValueError, match="no class names"):
        scoring.score_features(src.from_vectors(spark, []), bare)
    assert scoring.score_features(src.from_vectors(spark, []), bare, NAMES).count() == 0
    with pytest.raises(ValueError, match="was trained on"):
        scoring.score_features(src.from_vectors(spark, []), classifier, ["x", "y", "z"])
    empty = src.from_vectors(spark, [])
    assert scoring.score_features(empty, classifier, NAMES).count() == 0
    one = src.from_vectors(spark, [[0.0] * (4 * 4 * 3 + 3 * 8)])
    assert scoring.score_features(one, classifier, NAMES).count() == 1
    with pytest.raises(ValueError, match="no featurizer"):
        scoring.score_images(spark.range(1), classifier, NAMES)


def test_features_are_written_once_and_rejects_kept(spark, tree, tmp_path):
    images = src.read_labelled_images(spark, str(tree), NAMES, drop_invalid=False, extensions=["png"])
    featurizer, path = ImageFeaturizer(height=16, width=16), str(tmp_path / "features")
    training.write_features(images, featurizer, path)
    features, rejects = training.read_features(spark, path)
    assert (features.count(), rejects.count()) == (28, 3)
    assert {tuple(r) for r in training.reject_counts(spark, path).collect()} == {("undecodable", 3)}
    assert training.class_names(features) == NAMES
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    for spec in (training.decision_tree(), training.logistic_regression()):
        training.train_on_features(spark, path, [spec], registry, str(tmp_path / "models"), featurizer)
    assert registry.rows().count() == 2
    plan = features.filter("_bucket < 70")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(_bucket,70)" in plan and "Python" not in plan


def test_stream_equals_batch_and_resumes(spark, tree, everything, registry, tmp_path):
    path, _ = rg.find_one(rg.listing(registry.rows()), 1)
    model = PipelineModel.load(path)
    uploads = tmp_path / "uploads"
    uploads.mkdir()
    for name in NAMES[:2]:
        shutil.copytree(tree / name, uploads / name)

    def run():
        stream = src.stream_images(spark, str(uploads), drop_invalid=False)
        scored = streaming.score_image_stream(stream, model)
        streaming.run_available(scored, str(tmp_path / "rows"), str(tmp_path / "checkpoint"))
        return spark.read.parquet(str(tmp_path / "rows"))

    assert run().count() == 21
    shutil.copytree(tree / NAMES[2], uploads / NAMES[2])
    streamed = run()
    batch = scoring.score_images(everything, model)
    tail = lambda df: sorted(
        (tuple(r.origin.split("/")[-2:]), r.class_name, r.reason, r.confidence) for r in df.collect()
    )
    assert tail(streamed) == tail(batch)


def test_running_hits(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0)]
    spark.createDataFrame(rows, "label int, prediction double").write.parquet(path)
    stream = spark.readStream.schema("label int, prediction double").parquet(path)
    hits = streaming.running_hits(stream)
    query = hits.writeStream.outputMode("complete").format("memory").queryName("hits")
    query.trigger(availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in spark.table("hits").collect()} == {(0, 2, 1), (1, 2, 2)}


def test_capped_training_set(spark, tree):
    df = src.read_labelled_images(spark, str(tree), NAMES).withColumn("origin", F.col("image.origin"))
    capped = classes.cap_per_class(df, "class_name", "origin", 4)
    assert {(r.class_name, r["count"]) for r in capped.groupBy("class_name").count().collect()} == {
        ("alpha", 4), ("beta", 4), ("gamma", 4)
    }
