import os
import time

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from imagelab import session
from catalog import standins, table
from imagelab.functions.columns import as_class
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.operators import metrics as ms
from imagelab.plans import training
from imagelab.session import materialise, scratch_of_job
from imagelab.sources import registry as rg


@pytest.fixture(scope="module")
def split(spark):
    """Three classes; two features tell them apart, one row in ten has no features."""
    near = lambda k: (F.col("id") % 3 == k).cast("float") * 4 + F.rand(7).cast("float")
    features = F.when(F.col("id") % 10 != 9, F.array(near(0), near(1)))
    df = spark.range(600).select(
        features.alias("features"), as_class((F.col("id") % 3).cast("int"), list("abc")), F.col("id").alias("key")
    )
    return training.split_rows(training.training_rows(df), "key")


def test_split_is_complete_and_written(split):
    train, test = split
    assert train.count() + test.count() == 540
    assert train.columns == ["features", "label"]
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(_bucket,70)" in plan and "md5" not in plan


def rows_of_partitions(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.fixture
def small_partitions(monkeypatch):
    monkeypatch.setattr(session, "PARTITION_ROWS", 100)


def test_training_rows_come_in_partitions_of_bounded_rows(spark, small_partitions):
    """However few bytes they take: they are kept in memory by the learners."""
    df = spark.range(0, 4000, 1, 2).select(F.array(F.lit(1.0)).alias("features"), F.lit(0).alias("label"), F.col("id").alias("key"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    train, test = training.split_rows(training.training_rows(df), "key")
    assert train.count() + test.count() == 4000
    for part in (train, test):
        assert max(rows_of_partitions(part)) <= 100 * session.ROW_SLACK
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


@pytest.fixture
def pictures(spark):
    """One task's worth of small labelled images."""
    return standins.line_pictures(table(spark, "/root/testdata/sf0.001", "lineitem").limit(1200).coalesce(1))


class Seen(training.ModelSpec):
    """Notes the rows of the partitions that it is fitted on."""

    def fitted(self, train):
        self.estimator.rows = rows_of_partitions(train)
        return super().fitted(train)


def test_feature_tables_are_read_in_partitions_of_bounded_rows(spark, pictures, small_partitions, tmp_path):
    featurizer, path, spec = ImageFeaturizer(height=4, width=4, method="nearest"), str(tmp_path / "table"), training.decision_tree()
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    training.write_features(pictures, featurizer, path)
    seen = Seen(spec.algorithm, spec.estimator)
    training.train_on_features(spark, path, [seen], registry, str(tmp_path / "models"), featurizer)
    rows = seen.estimator.rows
    assert sum(rows) > 700 and max(rows) <= 100 * session.ROW_SLACK


def test_a_pipeline_is_fitted_on_partitions_of_bounded_rows(pictures, small_partitions):
    featurizer, spec = ImageFeaturizer(height=4, width=4, method="nearest"), training.decision_tree()
    seen = Seen(spec.algorithm, spec.estimator)
    training.fit_stages([featurizer], seen, pictures)
    rows = seen.estimator.rows
    assert sum(rows) > 1000 and max(rows) <= 100 * session.ROW_SLACK


def test_small_files_still_share_partitions(spark, tmp_path):
    """A partition for each of many small files would be as bad."""
    path = str(tmp_path / "table")
    spark.range(0, 200000, 1, 1000).write.parquet(path)
    read = session.session_by_rows(spark, path).read.parquet(path)
    assert read.count() == 200000
    assert read.rdd.getNumPartitions() < 200


SPECS = {
    "logistic": lambda: training.logistic_regression(),
    "elastic": lambda: training.elastic_net_regression(),
    "tree": lambda: training.decision_tree(),
    "forest": lambda: training.random_forest(5),
    "perceptron": lambda: training.perceptron(2, 3, hidden=6, maxIter=60),
}


@pytest.mark.parametrize("make_spec", SPECS.values(), ids=SPECS)
def test_models_learn_and_both_accuracies_agree(split, make_spec):
    train, test = split
    scored = training.fit(make_spec(), train).transform(test)
    rates = ms.accuracy(scored).first()
    assert rates.rows == test.count() and rates.accuracy > 0.95
    assert rates.accuracy == pytest.approx(ms.evaluator_accuracy(scored))
    assert rates.test_error == pytest.approx(1 - rates.accuracy)


def test_defaults_of_the_specs(spark):
    get = lambda spec, name: spec.estimator.getOrDefault(name)
    assert get(training.logistic_regression(), "maxIter") == 10
    net = training.elastic_net_regression()
    assert [get(net, p) for p in ("maxIter", "regParam", "elasticNetParam")] == [5, 0.03, 0.5]
    assert get(training.decision_tree(), "maxDepth") == 5
    assert training.FOREST_SIZES == (25, 50, 100, 150)
    assert get(training.perceptron(2048, 38), "layers") == [2048, 1024, 38]
    assert training.random_forest(25).model_name == "Random Forest (trees-25)"
    assert training.decision_tree().model_name == "Decision Tree"


def test_perceptron_takes_its_width_from_the_features(split):
    train, _ = split
    model = training.fit(training.perceptron(hidden=7, rounds=1), train).stages[0]
    assert list(model.getLayers()) == [2, 7, 3]


def test_early_stopping_keeps_the_best_round(split, monkeypatch):
    """Losses fall, then rise: the third round is kept, and two worse ones end the training."""
    train, _ = split
    losses, models = iter([3.0, 2.0, 1.0, 1.5, 1.2, 0.1]), []

    def loss(scored):
        models.append(scored)
        return next(losses)

    fitted = []
    real = MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(training, "log_loss", loss)
    monkeypatch.setattr(MultilayerPerceptronClassifier, "fit", lambda self, df: fitted.append(real(self, df)) or fitted[-1])
    best = training.perceptron(hidden=4, maxIter=2, patience=2).fitted(train)
    assert len(fitted) == 5 and best is fitted[2]


def test_more_rounds_go_on_from_the_weights(split):
    train, test = split
    rates = [
        training.log_loss(training.perceptron(hidden=6, maxIter=3, rounds=n).fitted(train).transform(test)) for n in (1, 8)
    ]
    assert rates[1] < rates[0]
    assert training.log_loss(test.limit(0).withColumn("probability", F.col("features"))) is None


def test_scratch_of_a_job_goes_with_it(spark):
    with scratch_of_job(spark):
        written = materialise(spark.range(10), "numbers")
        folder = written.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder) and written.count() == 10
    assert not os.path.exists(folder)


def test_training_saves_then_logs(spark, split, tmp_path):
    train, test = split
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    registry.create()  # a second time is fine
    assert registry.rows().count() == 0
    runs = [training.run_training(training.decision_tree(), train, test, registry, str(tmp_path / "m")) for _ in range(2)]
    assert len({r.model_path for r in runs}) == 2
    assert all(r.fit_seconds > 0 and r.evaluate_seconds > 0 for r in runs)
    rows = {r.run_id: r for r in registry.rows().collect()}
    for run in runs:
        row = rows[run.run_id]
        assert row.model == row.algorithm == "Decision Tree"
        assert row.accuracy == run.accuracy and row.elapsed_time == run.fit_seconds
        assert abs(row.created_at.timestamp() - time.time()) < 600
        again = PipelineModel.load(row.model_path)
        assert ms.accuracy(again.transform(test)).first().accuracy == run.accuracy


def test_nothing_is_logged_when_saving_fails(spark, split, tmp_path):
    train, test = split
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    with pytest.raises(Exception):
        training.run_training(training.decision_tree(), train, test, registry, str(blocked))
    assert registry.rows().count() == 0


def test_an_empty_test_set_is_an_error_and_has_no_rate(spark, split, tmp_path):
    train, test = split
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    with pytest.raises(ValueError):
        training.run_training(training.decision_tree(), train, test.limit(0), registry, str(tmp_path / "m"))
    empty = spark.createDataFrame([], "label int, prediction double")
    rates = ms.accuracy(empty).first()
    assert (rates.rows, rates.accuracy, rates.test_error) == (0, None, None)


def test_sweep_logs_every_model(spark, split, tmp_path):
    train, test = split
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()

    def score(spec, train, test):
        return training.run_training(spec, train, test, registry, str(tmp_path / "m")).accuracy

    rates = training.sweep(training.random_forest, [3, 5, 7], train, test, score)
    assert [r.value for r in rates.collect()] == [3, 5, 7]
    assert registry.rows().count() == 3
    plain = training.sweep(training.random_forest, [3, 5, 7], train, test)
    assert plain.collect() == rates.collect()


def test_label_names_reach_the_model(split):
    train, _ = split
    assert train.schema["label"].metadata["ml_attr"]["vals"] == ["a", "b", "c"]


def test_class_report_against_brute_force(spark):
    pairs = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(2, 0.0)] * 4
    df = spark.createDataFrame(pairs, "label int, prediction double")
    report = {r.class_id: r for r in ms.class_report(df).collect()}
    for c in range(3):
        hits = sum(a == b == c for a, b in pairs)
        given, support = sum(b == c for _, b in pairs), sum(a == c for a, _ in pairs)
        assert report[c].support == support
        assert report[c].precision == pytest.approx(hits / given if given else 0)
        assert report[c].recall == pytest.approx(hits / support)
        assert report[c].f1 == pytest.approx(2 * hits / (given + support))


def test_auc_with_ties(spark):
    rows = [(0, [0.9, 0.1, 0.0]), (0, [0.5, 0.5, 0.0]), (1, [0.5, 0.5, 0.1]), (1, [0.2, 0.8, 0.2])]
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    areas = {r.class_id: r.auc for r in ms.one_vs_rest_auc(df).collect()}
    assert areas == {0: pytest.approx(3.5 / 4), 1: pytest.approx(3.5 / 4), 2: None}


def test_auc_against_brute_force(spark):
    import random

    pick = random.Random(4)
    rows = [(pick.randrange(4), [round(pick.random(), 2) for _ in range(4)]) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, scores array<double>").repartition(7)
    for r in ms.one_vs_rest_auc(df).collect():
        own = [s[r.class_id] for y, s in rows if y == r.class_id]
        others = [s[r.class_id] for y, s in rows if y != r.class_id]
        wins = sum((a > b) + (a == b) / 2 for a in own for b in others)
        assert r.auc == pytest.approx(wins / len(own) / len(others))
