from concurrent.futures import ThreadPoolExecutor
from time import sleep

import pytest
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from imagelab.plans import forest, training
from imagelab.session import materialise


@pytest.fixture(scope="module")
def rows(spark):
    """Noise and four labels, in several files; trees on it depend on every count."""
    features = F.array(*[F.rand(i).cast("float") for i in range(6)])
    made = spark.range(0, 20000, 1, 7).select(array_to_vector(features).alias("features"), (F.col("id") % 4).cast("int").alias("label"))
    return materialise(made, "noise")


def kept_during(spark, fit):
    """What `fit` gives, and whether the kept copies of forests that were seen meanwhile use the disk."""
    seen = set()
    with ThreadPoolExecutor(1) as pool:
        fitted = pool.submit(inheritable_thread_target(spark)(fit))
        while not fitted.done():
            infos = spark.sparkContext._jsc.sc().getRDDStorageInfo()
            seen |= {i.storageLevel().useDisk() for i in infos if i.name() == "bagged tree points"}
            sleep(0.01)
    return fitted.result(), seen


def trees(model):
    return model.toDebugString.split("\n", 1)[1]


OPTIONS = [{"numTrees": 40}, {"numTrees": 1}, {"numTrees": 5, "bootstrap": False, "subsamplingRate": 0.4}, {"numTrees": 5, "maxDepth": 3, "featureSubsetStrategy": "all"}]


@pytest.mark.parametrize("memory", [None, 0], ids=["kept", "drawn again"])
@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_trees_are_those_of_mllib_with_or_without_kept_rows(rows, monkeypatch, options, memory):
    if memory is not None:
        monkeypatch.setattr(forest, "free_memory", lambda spark: memory)
    plain = RandomForestClassifier(seed=42, **options).fit(rows)
    own = forest.BoundedForest(seed=42, **options).fit(rows)
    assert trees(own) == trees(plain) and own.totalNumNodes > own.getNumTrees == options["numTrees"]
    assert own.numClasses == 4 and own.featureImportances == plain.featureImportances
    assert own.transform(rows).select("prediction").collect() == plain.transform(rows).select("prediction").collect()


def test_a_forest_keeps_no_rows_on_disk(spark, rows):
    _, seen = kept_during(spark, lambda: training.random_forest(100).fitted(rows))
    assert True not in seen


def test_rows_that_do_not_fit_are_not_kept(spark, rows, monkeypatch):
    monkeypatch.setattr(forest, "free_memory", lambda spark: 20000 * 100)
    _, seen = kept_during(spark, lambda: training.random_forest(100).fitted(rows))
    assert not seen


def test_rows_without_a_fixed_order_are_kept(spark, rows):
    _, seen = kept_during(spark, lambda: training.random_forest(100).fitted(rows.repartition(3)))
    assert seen == {True}


def test_weights_and_wrong_columns(rows):
    weighted = rows.withColumn("weight", F.lit(2.0))
    options = {"numTrees": 3, "seed": 42, "weightCol": "weight"}
    assert trees(forest.BoundedForest(**options).fit(weighted)) == trees(RandomForestClassifier(**options).fit(weighted))
    with pytest.raises(Exception, match="features"):
        forest.BoundedForest().fit(rows.drop("features"))


def test_a_saved_forest_is_one_of_mllib(rows, tmp_path):
    model = training.random_forest(3).fitted(rows)
    model.write().save(str(tmp_path / "forest"))
    assert trees(RandomForestClassificationModel.load(str(tmp_path / "forest"))) == trees(model)
