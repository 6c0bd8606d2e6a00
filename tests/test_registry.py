import datetime
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from imagelab.sources import registry as rg


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    registry = rg.ParquetRegistry(spark, str(tmp_path_factory.mktemp("registry") / "runs"))
    registry.create()
    for algorithm, n in (("Decision Tree", 2), ("Other", 1), ("Random Forest", 3), ("Logistic Regression", 2)):
        for i in range(n):
            rg.log_run(registry, algorithm, algorithm, i / 10, 1.5, f"/models/{algorithm}/{i}")
    return registry


def test_listing_order_is_by_algorithm_then_time(registry):
    rows = rg.listing(registry.rows()).orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(1, 9))
    expected = ["Random Forest"] * 3 + ["Logistic Regression"] * 2 + ["Decision Tree"] * 2 + ["Other"]
    assert [r.model for r in rows] == expected
    assert [r.model_path[-1] for r in rows] == list("01201010")[:3] + list("01") + list("01") + ["0"]


def test_one_algorithm_is_read_alone(registry):
    plan = registry.rows().filter("algorithm = 'Random Forest'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(algorithm" in plan


def test_lookup_by_number(registry):
    numbered = rg.listing(registry.rows())
    assert rg.find_one(numbered, 1) == ("/models/Random Forest/0", "Random Forest")
    assert rg.find_one(numbered, "8") == ("/models/Other/0", "Other")
    with pytest.raises(LookupError):
        rg.find_one(numbered, 9)
    assert {r.idx for r in rg.find(numbered, [0, 2, 99]).collect()} == {2}


@pytest.mark.parametrize("value", [None, "x", "1.5", "", 0, "-1"])
def test_bad_numbers_are_refused(value):
    with pytest.raises(ValueError):
        rg.parse_index(value)


def test_json_listing(registry):
    rows = rg.listing_json(rg.listing(registry.rows())).orderBy("idx").collect()
    first = json.loads(rows[0].value)
    assert list(first) == ["idx", "created_at", "elapsed_time", "model_path", "accuracy", "model", "run_id"]
    assert first["idx"] == 1 and first["model"] == "Random Forest"


def test_credentials_do_not_show_in_prints(spark):
    registry = rg.JdbcRegistry(spark, {"url": "jdbc:x", "password": "secret"})
    assert "secret" not in repr(registry)


def test_appends_add_up(spark, registry, tmp_path):
    copy = rg.ParquetRegistry(spark, str(tmp_path / "copy"))
    copy.create()
    copy.append(registry.rows())
    copy.append(registry.rows().withColumn("run_id", F.concat("run_id", F.lit("b"))))
    assert copy.rows().count() == 16


def test_one_table_per_algorithm(spark, tmp_path):
    schema = "id int, model string, accuracy float, elapsed_time float, hdfs_path string, created_at timestamp"
    at = datetime.datetime(2024, 5, 1)
    forest = spark.createDataFrame([(i, "Random Forest", 0.5, 1.0, f"/f{i}", at) for i in (10, 9)], schema)
    tree = spark.createDataFrame([(1, "Decision Tree", 0.25, 2.0, "/t1", at)], schema)
    runs = rg.runs_of_tables({"Decision Tree": tree, "Random Forest": forest})
    numbered = rg.listing(runs)
    assert [r.model_path for r in numbered.orderBy("idx").collect()] == ["/f9", "/f10", "/t1"]
    registry = rg.ParquetRegistry(spark, str(tmp_path / "runs"))
    registry.append(runs)
    assert registry.rows().count() == 3


def test_appends_at_the_same_time(spark, tmp_path):
    registry = rg.ParquetRegistry(spark, str(tmp_path / "runs"))
    registry.create()
    with ThreadPoolExecutor(8) as pool:
        log = lambda i: rg.log_run(registry, f"a{i % 3}", "m", 0.5, 1.0, f"/m/{i}")
        ids = list(pool.map(log, range(24)))
    assert sorted(ids) == sorted(r.run_id for r in registry.rows().collect())


def test_a_run_that_cannot_be_logged_leaves_nothing(spark, tmp_path, monkeypatch):
    import os

    from imagelab.plans import training

    rows = spark.createDataFrame([([float(i % 2)], i % 2) for i in range(20)], "features array<float>, label int")
    rows = training.training_rows(rows)
    registry = rg.ParquetRegistry(spark, str(tmp_path / "registry"))
    registry.create()
    models = str(tmp_path / "models")
    kept = training.run_training(training.decision_tree(), rows, rows, registry, models)

    def fails(runs, partial=rg.ParquetRegistry.append):
        partial(registry, runs.withColumn("algorithm", F.raise_error(F.lit("disk full")).cast("string")))

    monkeypatch.setattr(rg.ParquetRegistry, "append", lambda self, runs: fails(runs))
    with pytest.raises(Exception, match="disk full"):
        training.run_training(training.decision_tree(), rows, rows, registry, models)
    monkeypatch.undo()
    assert os.listdir(f"{models}/default") == [kept.model_path.rsplit("/", 1)[1]]
    assert [r.model_path for r in registry.rows().collect()] == [kept.model_path]
    assert [n for n in os.listdir(tmp_path / "registry") if not n.startswith("append=")] == []

    # a job that was killed between saving and logging leaves a folder, which the sweep finds
    monkeypatch.setattr(training, "log_run", lambda *_: os.kill)
    lost = training.run_training(training.decision_tree(), rows, rows, registry, models)
    monkeypatch.undo()
    assert training.unlisted_models(spark, models, registry).count() == 0  # too young
    assert training.sweep_models(spark, models, registry, min_age_hours=0) == 1
    assert not os.path.exists(lost.model_path) and os.path.exists(kept.model_path)
