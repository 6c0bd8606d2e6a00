"""Fitting, saving, logging, scoring and streaming on features derived from `lineitem`."""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from catalog.standins import SQL_HELD_OUT, line_features, line_images, line_origin, line_pictures
from imagelab.functions.columns import label_from_path
from imagelab.operators.classes import hash_split, spread
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.plans import incremental, scoring, training
from imagelab.session import delete_on_exit, scratch_path
from imagelab.sources import registry as rg
from imagelab.sources.images import write_table
from imagelab.streaming import scoring as streaming
from imagelab.streaming import uploads

LINES_OF_TASK = 1_000_000
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_OWN_LABEL = f"""WITH {SQL_HELD_OUT}
SELECT label, label AS prediction, count(*) AS n FROM held_out GROUP BY label"""
SQL_OWN_FLAG = f"""WITH {SQL_HELD_OUT}
SELECT l_returnflag, l_returnflag AS class_name, count(*) AS n FROM held_out GROUP BY ALL"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return spread(lines.select(*LINE_KEYS, "l_returnflag", "l_linestatus", "l_quantity"), _parts(lines), LINE_KEYS)


def _parts(lines: DataFrame) -> int:
    """Tasks for so many lines, which are counted from the footers of their files."""
    return max(lines.sparkSession.sparkContext.defaultParallelism, lines.count() // LINES_OF_TASK)


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = training.training_rows(line_features(_lines(spark, sf_dir)))
    return training.split_rows(rows, "key")


def _fit_and_score(spark: SparkSession, sf_dir: str, spec: training.ModelSpec) -> DataFrame:
    train, test = _features(spark, sf_dir)
    return training.count_outcomes(training.fit(spec, train).transform(test))


@query(SQL_OWN_LABEL)
def lr_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, training.logistic_regression())


@query(SQL_OWN_LABEL)
def lr_elasticnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, training.elastic_net_regression())


@query(SQL_OWN_LABEL)
def dt_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, training.decision_tree())


@query(SQL_OWN_LABEL)
def rf_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_and_score(spark, sf_dir, training.random_forest(25))


@query(SQL_OWN_LABEL)
def mlp_fit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full head of 1,024 rectified units, trained by mini-batches over several epochs with early stopping."""
    rows = training.training_rows(line_features(_lines(spark, sf_dir)))
    train, test = training.split_rows(rows, "key", row_key=True)
    return training.count_outcomes(training.fit(training.relu_head(epochs=6, batches=4, patience=2), train).transform(test))


@query(SQL_OWN_LABEL)
def pipeline_featurizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featurizer and classifier in one pipeline; saved, loaded and applied to images."""
    train, test = hash_split(line_images(_lines(spark, sf_dir)), F.col("key"))
    featurizer = ImageFeaturizer(height=4, width=4, method="nearest")
    spec = training.elastic_net_regression()
    model = training.fit_stages([featurizer], spec, train)
    path = scratch_path(spark, "pipeline")
    model.write().save(path)
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    return training.count_outcomes(PipelineModel.load(path).transform(test))


@query(SQL_OWN_LABEL)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, score."""
    train, test = _features(spark, sf_dir)
    path = scratch_path(spark, "model")
    training.fit(training.decision_tree(), train).write().save(path)
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    return training.count_outcomes(PipelineModel.load(path).transform(test))


@query(f"""WITH {SQL_HELD_OUT}, sizes(num_trees) AS (VALUES (25), (50), (100), (150))
SELECT num_trees, num_trees AS saved_trees, true AS has_nodes, CAST(1.0 AS DOUBLE) AS accuracy,
       (SELECT count(*) FROM held_out) AS test_rows FROM sizes""")
def rf_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every forest is saved; trees and nodes are those of the models loaded again."""
    train, test = _features(spark, sf_dir)
    root = scratch_path(spark, "sweep")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    registry = rg.ParquetRegistry(spark, f"{root}/registry")
    registry.create()

    def saved(spec: training.ModelSpec, train: DataFrame, test: DataFrame) -> float:
        return training.run_training(spec, train, test, registry, f"{root}/models").accuracy

    training.sweep(training.random_forest, training.FOREST_SIZES, train, test, saved)
    rows = []
    for run in registry.rows().collect():  # one row per size
        forest = next(stage for stage in PipelineModel.load(run.model_path).stages if hasattr(stage, "getNumTrees"))
        size = int(run.model.rsplit("-", 1)[1].rstrip(")"))
        rows.append((size, forest.getNumTrees, forest.totalNumNodes > forest.getNumTrees, run.accuracy))
    found = spark.createDataFrame(rows, "num_trees int, saved_trees int, has_nodes boolean, accuracy double")
    return found.withColumn("test_rows", F.lit(test.count()).cast("bigint"))


@query("""
WITH d AS (SELECT l_quantity AS q, l_discount AS x, CAST(l_quantity * l_discount > 1.5 AS INTEGER) AS y FROM lineitem),
counts AS (
  SELECT 0 AS f, q AS v, count(*) AS n, sum(y) AS ones FROM d GROUP BY q
  UNION ALL SELECT 1, x, count(*), sum(y) FROM d GROUP BY x),
sides AS (
  SELECT f, v, sum(n) OVER w AS nl, sum(ones) OVER w AS yl, sum(n) OVER (PARTITION BY f) AS n, sum(ones) OVER (PARTITION BY f) AS ones
  FROM counts WINDOW w AS (PARTITION BY f ORDER BY v)),
best AS (
  SELECT f, v, yl * 2 > nl AS left_one, (ones - yl) * 2 > n - nl AS right_one FROM sides WHERE nl < n
  ORDER BY yl * (nl - yl) / nl + (ones - yl) * (n - nl - ones + yl) / (n - nl) LIMIT 1)
SELECT y AS label, CAST(CASE WHEN CASE WHEN f = 0 THEN q ELSE x END <= v THEN left_one ELSE right_one END AS INTEGER) AS prediction,
       count(*) AS n
FROM d, best GROUP BY ALL""")
def tree_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of depth 1 makes the best single split of quantity or discount."""
    lines = table(spark, sf_dir, "lineitem")
    label = (F.col("l_quantity") * F.col("l_discount") > 1.5).cast("int").alias("label")
    features = F.array(F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")).alias("features")
    rows = training.training_rows(lines.select(features, label))
    spec = training.decision_tree(maxDepth=1, maxBins=64)
    return training.count_outcomes(training.fit(spec, rows).transform(rows))


def _trained(spark: SparkSession, sf_dir: str, *specs: training.ModelSpec) -> tuple[rg.ParquetRegistry, DataFrame]:
    """A registry with one saved run per spec, and the held-out rows."""
    train, test = _features(spark, sf_dir)
    root, registry = _registry(spark)
    for spec in specs:
        training.run_training(spec, train, test, registry, f"{root}/models")
    return registry, test


@query(f"""WITH {SQL_HELD_OUT}, logged(idx, model) AS (VALUES (1, 'Logistic Regression'), (2, 'Decision Tree'))
SELECT CAST(idx AS BIGINT) AS idx, model, CAST(1.0 AS DOUBLE) AS accuracy,
       (SELECT count(*) FROM held_out) AS test_rows
FROM logged""")
def train_and_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = training.decision_tree(), training.logistic_regression()
    registry, test = _trained(spark, sf_dir, *specs)
    return rg.listing(registry.rows()).select(
        "idx", "model", "accuracy", F.lit(test.count()).cast("bigint").alias("test_rows")
    )


@query(SQL_OWN_FLAG)
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and save, then score held-out rows by model path and count the decoded names."""
    train, test = _features(spark, sf_dir)
    path = scratch_path(spark, "model")
    training.fit(training.logistic_regression(), train).write().save(path)
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    scored = scoring.score_features(test, path, keep=["l_returnflag"])
    return training.count_outcomes(scored, "l_returnflag", "class_name")


@query(SQL_OWN_FLAG)
def score_with_registry_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second model of the listing is the decision tree; it brings its class names."""
    specs = training.decision_tree(), training.logistic_regression()
    registry, test = _trained(spark, sf_dir, *specs)
    numbered = rg.listing(registry.rows())
    scored = scoring.score_with_registry_model(test, numbered, 2, keep=["l_returnflag"])
    return training.count_outcomes(scored, "l_returnflag", "class_name")


@query(SQL_OWN_FLAG)
def score_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written as a table and read back."""
    train, test = _features(spark, sf_dir)
    model = training.fit(training.decision_tree(), train)
    path = scratch_path(spark, "predictions")
    write_table(scoring.score_features(test, model, keep=["l_returnflag"]), path)
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    return training.count_outcomes(spark.read.parquet(path), "l_returnflag", "class_name")


@query("""
SELECT l_returnflag AS folder, CASE WHEN l_quantity <> 50 THEN l_returnflag END AS class_name,
       CASE WHEN l_quantity = 50 THEN 'length' END AS reason, count(*) AS n
FROM lineitem GROUP BY ALL""")
def image_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images to features, split, fit, save, log; then every image scored with model number 1."""
    pictures = line_pictures(_lines(spark, sf_dir))
    root, registry = _registry(spark)
    featurizer = ImageFeaturizer(height=8, width=6, method="bicubic")
    specs = [training.decision_tree()]
    training.train_on_images(pictures, specs, registry, f"{root}/models", featurizer, f"{root}/features")
    numbered = rg.listing(registry.rows())
    scored = scoring.score_images_with_registry_model(pictures.select("image"), numbered, 1)
    folder = label_from_path(F.col("origin")).alias("folder")
    return training.count_outcomes(scored, folder, "class_name", "reason")


def _registry(spark: SparkSession) -> tuple[str, rg.ParquetRegistry]:
    """A scratch folder and an empty registry in it."""
    root = scratch_path(spark, "runs")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    registry = rg.ParquetRegistry(spark, f"{root}/registry")
    registry.create()
    return root, registry


@query("""
WITH runs(idx, model) AS (VALUES (1, 'Logistic Regression (elastic-net)'), (2, 'Decision Tree'))
SELECT CAST(idx AS BIGINT) AS idx, model, CAST(1.0 AS DOUBLE) AS accuracy,
       (SELECT count(*) FROM lineitem WHERE l_quantity <> 50) AS features,
       (SELECT count(*) FROM lineitem WHERE l_quantity = 50) AS rejects
FROM runs""")
def features_then_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images featurised once into a table; two models trained on it without touching an image."""
    root, registry = _registry(spark)
    featurizer = ImageFeaturizer(height=4, width=4, method="nearest")
    training.write_features(line_pictures(_lines(spark, sf_dir)), featurizer, f"{root}/features")
    for spec in (training.decision_tree(), training.elastic_net_regression()):
        training.train_on_features(spark, f"{root}/features", [spec], registry, f"{root}/models", featurizer)
    features, rejects = training.read_features(spark, f"{root}/features")
    sizes = [F.lit(df.count()).cast("bigint").alias(name) for df, name in ((features, "features"), (rejects, "rejects"))]
    return rg.listing(registry.rows()).select("idx", "model", "accuracy", *sizes)


@query("SELECT true AS fit_took_time, true AS evaluation_took_time, true AS fit_time_is_logged")
def training_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clock of a run on all lines."""
    train, test = _features(spark, sf_dir)
    root, registry = _registry(spark)
    run = training.run_training(training.decision_tree(), train, test, registry, f"{root}/models")
    return registry.rows().select(
        F.lit(run.fit_seconds > 0).alias("fit_took_time"),
        F.lit(run.evaluate_seconds > 0).alias("evaluation_took_time"),
        (F.col("elapsed_time") == run.fit_seconds).alias("fit_time_is_logged"),
    )


@query(f"""WITH {SQL_HELD_OUT}
SELECT CAST(l_linenumber % 3 + 1 AS BIGINT) AS model_index,
       CASE l_linenumber % 3 WHEN 0 THEN 'Logistic Regression' WHEN 1 THEN 'Decision Tree' END AS model,
       l_returnflag, CASE WHEN l_linenumber % 3 < 2 THEN l_returnflag END AS class_name,
       CASE WHEN l_linenumber % 3 = 2 THEN 'no model number 3' END AS reason, count(*) AS n
FROM held_out GROUP BY ALL""")
def stream_score_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which every row names the model that scores it; the third number is not in the listing."""
    registry, _ = _trained(spark, sf_dir, training.decision_tree(), training.logistic_regression())
    lines = table(spark, sf_dir, "lineitem")
    stream = spark.readStream.schema(lines.schema).parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet*")
    index = (F.col("l_linenumber") % 3 + 1).alias(uploads.BY_MODEL)
    _, held_out = hash_split(line_features(stream, index), F.col("key"))
    root = scratch_path(spark, "uploads")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    scorer = uploads.ScoreByModel(registry, f"{root}/scored", keep=["l_returnflag"])
    uploads.run_available_by_model(training.training_rows(held_out), scorer, f"{root}/checkpoint")
    named = registry.rows().select(F.col("model_path").alias("_path"), "model")
    scored = scorer.predictions(spark).join(named, F.col("model_path") == F.col("_path"), "left")
    return training.count_outcomes(scored, uploads.BY_MODEL, "model", "l_returnflag", "class_name", "reason")


@query("""
SELECT l_returnflag AS class_name, CASE WHEN l_linestatus = 'F' AND l_discount <> 0.05 THEN 0 ELSE 1 END AS "commit",
       CASE WHEN l_quantity = 50 THEN 'length' END AS reason, count(*) AS n
FROM lineitem WHERE l_quantity <> 1 GROUP BY ALL""")
def features_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table after two updates: lines of one status, then all, with some changed and some removed."""
    lines = table(spark, sf_dir, "lineitem")
    # by what they are joined by, in as many parts as the other side: neither lines nor pictures are shuffled a second time
    parts = max(_parts(lines), int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = spread(lines.withColumn("origin", line_origin()), parts, ["origin"])
    pictures = line_pictures(lines).withColumn("origin", F.col("image.origin"))
    root = scratch_path(spark, "features")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    featurizer = ImageFeaturizer(height=4, width=4, method="nearest")

    def read(changes: DataFrame) -> DataFrame:
        wanted = changes.filter("change <> 'removed'").select(F.col("origin").alias("_origin"))
        return pictures.join(wanted, F.col("origin") == F.col("_origin"), "left_semi")

    def files(rows: DataFrame, later: Column) -> DataFrame:
        listed = line_pictures(rows, "l_discount").withColumn("origin", F.col("image.origin"))
        modified = F.timestamp_seconds(F.when(later, 1).otherwise(0)).alias("modified")
        return listed.select("origin", F.lit(48).cast("bigint").alias("length"), modified)

    incremental.update_features(files(lines.filter("l_linestatus = 'F'"), F.lit(False)), read, featurizer, root)
    changed = F.abs(F.col("l_discount") - 0.05) < 1e-9
    incremental.update_features(files(lines.filter("l_quantity <> 1"), changed), read, featurizer, root)
    found = incremental.current_features(spark, root)
    return training.count_outcomes(found, "class_name", "commit", "reason")


def _streamed_scores(spark: SparkSession, sf_dir: str, keep: list[str]) -> DataFrame:
    """The file as a stream of held-out rows, scored."""
    lines = table(spark, sf_dir, "lineitem")
    train, _ = _features(spark, sf_dir)
    model = training.fit(training.decision_tree(), train)
    stream = spark.readStream.schema(lines.schema).parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet*")
    _, held_out = hash_split(training.training_rows(line_features(stream)), F.col("key"))
    return streaming.score_stream(held_out, model, keep=keep)


@query(SQL_OWN_FLAG)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream scored into a table by a query that stops when it has caught up."""
    scored = _streamed_scores(spark, sf_dir, ["l_returnflag"])
    root = scratch_path(spark, "stream")
    streaming.run_available(scored, f"{root}/rows", f"{root}/checkpoint")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    return training.count_outcomes(spark.read.parquet(f"{root}/rows"), "l_returnflag", "class_name")


@query(f"""WITH {SQL_HELD_OUT}
SELECT label, count(*) AS "rows", count(*) AS hits FROM held_out GROUP BY label""")
def stream_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running rows and hits per label of a scored stream."""
    totals = streaming.running_hits(_streamed_scores(spark, sf_dir, ["label"]))
    root = scratch_path(spark, "stream")
    streaming.run_available_totals(totals, f"{root}/totals", f"{root}/checkpoint")
    delete_on_exit(spark, root.rsplit("/", 1)[0])
    return spark.read.parquet(f"{root}/totals")
