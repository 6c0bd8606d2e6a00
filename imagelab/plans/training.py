"""Train, score, save and log classifiers."""

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.functions.columns import hash_bucket
from imagelab.operators.classes import cap_bounds, within_bound
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.operators.filters import drop_null_features, rejects
from imagelab.operators.images import feature_table, pixel_feature_table
from imagelab.operators.metrics import accuracy
from imagelab.plans.forest import BoundedForest
from imagelab.plans.head import ROW_KEY, ReluHead
from imagelab.session import delete, materialise, published, scratch_of_job, session_by_rows, with_bounded_files
from imagelab.sources.registry import Registry, log_run

SEED = 42
TREE_MEMORY_MB = 512  # histogram memory of a task, twice the default: fewer passes over wide features
FOREST_SIZES = (25, 50, 100, 150)
BACKBONE_HEAD = 1024
CLASS_NAME = "_class_name"  # column of the decoded prediction


@dataclass(frozen=True)
class ModelSpec:
    """A named classifier. `variant` tells runs of one algorithm apart in the saved path."""

    algorithm: str
    estimator: Estimator
    variant: str = "default"

    @property
    def model_name(self) -> str:
        """What the registry calls a run: the algorithm, and the variant if there are several."""
        return self.algorithm if self.variant == "default" else f"{self.algorithm} ({self.variant})"

    def fitted(self, train: DataFrame):
        return self.estimator.fit(train)


def logistic_regression(**params) -> ModelSpec:
    return ModelSpec("Logistic Regression", LogisticRegression(**{"maxIter": 10, **params}))


def elastic_net_regression(**params) -> ModelSpec:
    defaults = {"maxIter": 5, "regParam": 0.03, "elasticNetParam": 0.5}
    return ModelSpec("Logistic Regression", LogisticRegression(**{**defaults, **params}), "elastic-net")


def decision_tree(**params) -> ModelSpec:
    defaults = {"maxDepth": 5, "seed": SEED, "maxMemoryInMB": TREE_MEMORY_MB}
    return ModelSpec("Decision Tree", DecisionTreeClassifier(**{**defaults, **params}))


def random_forest(trees: int, **params) -> ModelSpec:
    defaults = {"numTrees": trees, "seed": SEED, "maxMemoryInMB": TREE_MEMORY_MB}
    return ModelSpec("Random Forest", BoundedForest(**{**defaults, **params}), f"trees-{trees}")


@dataclass(frozen=True)
class EarlyStopping(ModelSpec):
    """A perceptron fitted in rounds; the one with the least loss on held-back training rows is kept.

    Each round goes on from the weights of the one before. It ends after `patience` rounds without
    a smaller loss, or after `rounds`. The layer sizes follow from the rows where they are not set:
    the width of the features, `hidden` units, and the classes of the label.
    """

    hidden: int = BACKBONE_HEAD
    rounds: int = 20
    patience: int = 5
    validation_percent: int = 20

    def fitted(self, train: DataFrame):
        estimator = self.estimator.copy()
        if not estimator.isSet(estimator.layers):
            names = class_names(train)
            classes = len(names) if names else int(train.agg(F.max("label")).first()[0]) + 1
            width = train.select(F.size(vector_to_array("features"))).first()[0]
            estimator.setLayers([width, self.hidden, classes])
        if self.rounds == 1:  # nothing to choose from
            return estimator.fit(train.select("features", "label"))
        key = F.col(ROW_KEY) if ROW_KEY in train.columns else F.xxhash64("features", "label")
        bucket = F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(100))  # the same for every partitioning
        marked = materialise(train.select("features", "label", bucket.alias("_bucket")), "rounds")
        held_back = marked.filter(f"_bucket < {self.validation_percent}").drop("_bucket")
        rows = marked.filter(f"_bucket >= {self.validation_percent}").drop("_bucket")
        best, least, waited = None, None, 0
        for _ in range(self.rounds):
            model = estimator.fit(rows)
            loss = log_loss(model.transform(held_back))
            if best is None or (loss is not None and loss < least):
                best, least, waited = model, loss, 0
            else:
                waited += 1
            if loss is None or waited >= self.patience:
                break
            estimator.setInitialWeights(model.weights)
        return best


def perceptron(features: int | None = None, classes: int | None = None, hidden: int = BACKBONE_HEAD, **params) -> EarlyStopping:
    """One hidden layer on features of a frozen network, with early stopping.

    `maxIter` is the number of iterations of a round; `rounds`, `patience` and
    `validation_percent` are those of `EarlyStopping`.
    """
    stops = {k: params.pop(k) for k in ("rounds", "patience", "validation_percent") if k in params}
    layers = {} if features is None else {"layers": [features, hidden, classes]}
    estimator = MultilayerPerceptronClassifier(**{"maxIter": 5, "seed": SEED, **layers, **params})
    return EarlyStopping("Multilayer Perceptron", estimator, hidden=hidden, **stops)


def relu_head(**params) -> ModelSpec:
    """A head of rectified units on features of a frozen network: mini-batches, Adam, early stopping."""
    return ModelSpec("Multilayer Perceptron", ReluHead(**{"seed": SEED, **params}), "relu")


def log_loss(scored: DataFrame) -> float | None:
    """Mean negative log probability of the label; None without rows."""
    own = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    return scored.agg(F.avg(-F.log(F.greatest(own, F.lit(1e-15))))).first()[0]


def class_names(df: DataFrame, label: str = "label") -> list[str]:
    """Class names that the label column carries, in the order of their ids."""
    return list(df.schema[label].metadata.get("ml_attr", {}).get("vals", []))


def training_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """Feature arrays to vectors, rows without features left out."""
    return drop_null_features(df, features).withColumn("features", array_to_vector(F.col(features)))


def split_rows(
    df: DataFrame, key: str, train_percent: int = 70, salt: str = "", row_key: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of a written copy of the feature rows, by the hash of the `key` column.

    Estimators pass over their input many times. What produced the rows (a network over all
    pixels, hashing of keys) runs once; each later pass is a parquet scan with the split as a
    pushed filter, in partitions of bounded rows, because learners keep theirs. With `row_key` a hash of the key stays, for learners that deal rows into batches.
    """
    numbered = df.withColumn("_bucket", hash_bucket(F.col(key), salt))
    if row_key:
        numbered = numbered.withColumn(ROW_KEY, F.xxhash64(key))
    written = materialise(numbered.drop(key), "features", by_rows=True)
    train = written.filter(f"_bucket < {train_percent}")
    test = written.filter(f"_bucket >= {train_percent}")
    return train.drop("_bucket"), test.drop("_bucket")


def _decoder(train: DataFrame, prediction: str = "prediction") -> list[Transformer]:
    """The stage that turns predictions into the class names of the training rows."""
    names = class_names(train)
    return [IndexToString(inputCol=prediction, outputCol=CLASS_NAME, labels=names)] if names else []


def fit(spec: ModelSpec, train: DataFrame) -> PipelineModel:
    """The classifier, followed by the decoder of its class names if the label carries them."""
    return PipelineModel(stages=[spec.fitted(train), *_decoder(train)])


def fit_stages(transformers: Sequence[Transformer], spec: ModelSpec, train: DataFrame) -> PipelineModel:
    """Fit a classifier behind transformers; the same model as a Pipeline of all stages.

    An estimator passes over its input many times. Writing the transformed rows first means
    that images are decoded and featurised once and not once per pass.
    """
    ready = train
    for stage in transformers:
        ready = stage.transform(ready)
    columns = [spec.estimator.getFeaturesCol(), spec.estimator.getLabelCol()]
    written = materialise(ready.select(*columns), "features", by_rows=True)
    return PipelineModel(stages=[*transformers, *fit(spec, written).stages])


@dataclass(frozen=True)
class TrainedRun:
    model: PipelineModel
    accuracy: float | None
    fit_seconds: float
    evaluate_seconds: float
    model_path: str
    run_id: str


def run_training(
    spec: ModelSpec,
    train: DataFrame,
    test: DataFrame,
    registry: Registry,
    model_root: str,
    before: Sequence[Transformer] = (),
) -> TrainedRun:
    """Fit, score the held-out rows, save under a new path, then log.

    `before` are the transformers that made the features. They are saved in front of the
    classifier, so that the saved model takes what they take.

    The row is logged last, so the registry never names a model that was not saved. The model
    is saved beside its path and appears there as a whole; if it cannot be logged it goes again.
    Every run has a path of its own, so no row ever points at a later model. An empty test set
    leaves nothing to log a rate for and is an error.
    """
    started = time.monotonic()
    model = fit(spec, train)
    fitted = time.monotonic()
    rate = accuracy(model.transform(test)).first()["accuracy"]
    evaluated = time.monotonic()
    if rate is None:
        raise ValueError("the test set is empty")
    path = f"{model_root.rstrip('/')}/{spec.variant}/{uuid.uuid4()}"
    model = PipelineModel(stages=[*before, *model.stages])
    spark = train.sparkSession
    with published(spark, path) as staged:
        model.write().save(staged)
    try:
        run_id = log_run(registry, spec.algorithm, spec.model_name, rate, fitted - started, path)
    except BaseException:
        delete(spark, path)
        raise
    return TrainedRun(model, rate, fitted - started, evaluated - fitted, path, run_id)


def unlisted_models(spark: SparkSession, model_root: str, registry: Registry, min_age_hours: float = 24.0) -> DataFrame:
    """(folder): saved models that no run of the registry names, from jobs that ended before they could log.

    The folders come from one listing of the metadata files, without opening any. Younger ones than
    `min_age_hours` may be on their way to the registry and are left out.
    """
    found = spark.read.format("binaryFile").load(f"{model_root.rstrip('/')}/*/*/metadata/part-*")
    old = F.col("modificationTime") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(min_age_hours * 3600)))
    folders = found.filter(old).select(F.regexp_extract("path", r"^(.*)/metadata/[^/]*$", 1).alias("folder")).distinct()
    no_scheme = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)"
    listed = registry.rows().select(F.regexp_replace("model_path", no_scheme, "").alias("_listed"))
    return folders.join(listed, F.regexp_replace("folder", no_scheme, "") == F.col("_listed"), "left_anti")


def sweep_models(spark: SparkSession, model_root: str, registry: Registry, min_age_hours: float = 24.0) -> int:
    """Delete the models that no run names; how many there were."""
    swept = 0
    for row in unlisted_models(spark, model_root, registry, min_age_hours).toLocalIterator():
        delete(spark, row["folder"])
        swept += 1
    return swept


def capped(images: DataFrame, rows_per_class: int) -> DataFrame:
    """The first files of every class by origin, as a filter on class and origin.

    The bounds, one row for each class of the list, become literals of the filter, which a scan of
    labelled images applies to its file list: the files behind the bound are never opened. With
    images read with `drop_invalid=False` finding the bounds opens no file at all; undecodable
    files count as files of their class.
    """
    keep = F.lit(False)
    bounds = cap_bounds(images, "class_name", "origin", rows_per_class)
    for r in bounds.collect():
        behind = ~within_bound(F.col("origin"), F.lit(r["no_key"]), F.lit(r["last_key"]))
        keep = keep | (F.col("class_name").eqNullSafe(F.lit(r["class"])) & behind)
    return images.filter(~keep)


def write_features(
    images: DataFrame,
    featurizer: ImageFeaturizer,
    path: str,
    rows_per_class: int | None = None,
    salt: str = "",
) -> None:
    """Decode and featurise labelled images once, into a table that training starts from.

    `images` has image (or the `pixels` of a table of resized images), origin, class_name and
    label, as `read_labelled_images` gives them with `drop_invalid=False`. The table holds the
    feature vector, label, class name, origin and split bucket of every image, or the reason why
    it has no features, in separate folders.
    """
    if "origin" not in images.columns:
        images = images.withColumn("origin", F.col("image.origin"))
    if rows_per_class is not None:
        images = capped(images, rows_per_class)
    keep, options = ["origin", "class_name", "label"], featurizer.embed_options()
    table = pixel_feature_table if "pixels" in images.columns else feature_table
    found = table(images, keep, **options)
    vector = F.when(F.col("features").isNotNull(), array_to_vector(F.coalesce("features", F.array().cast("array<float>"))))
    rows = found.select(
        *keep,
        vector.alias("features"),
        hash_bucket(F.col("origin"), salt).cast("int").alias("_bucket"),
        "reason",
        F.col("reason").isNotNull().cast("int").alias("rejected"),
    )
    with_bounded_files(rows.write.partitionBy("rejected")).parquet(path)


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, rejects) of a table of `write_features`."""
    table = spark.read.parquet(path)
    good = table.filter("rejected = 0").drop("reason", "rejected")
    return good, rejects(table.filter("rejected = 1")).select("origin", "class_name", "label", "reason")


def reject_counts(spark: SparkSession, path: str) -> DataFrame:
    """(reason, n) of the images without features."""
    return read_features(spark, path)[1].groupBy("reason").agg(F.count("*").alias("n"))


def train_on_features(
    spark: SparkSession,
    path: str,
    specs: Sequence[ModelSpec],
    registry: Registry,
    model_root: str,
    featurizer: ImageFeaturizer,
    train_percent: int = 70,
) -> list[TrainedRun]:
    """One logged run per spec on a written feature table; no image is touched.

    The split is a filter on the stored bucket that the scan applies. The saved models begin with
    the featurizer, so they score images with its settings. Learners keep their rows, so partitions
    are bounded by rows.
    """
    features, _ = read_features(session_by_rows(spark, path), path)
    rows = features.select("features", "label", "_bucket", F.xxhash64("origin").alias(ROW_KEY))
    train = rows.filter(f"_bucket < {int(train_percent)}").drop("_bucket")
    test = rows.filter(f"_bucket >= {int(train_percent)}").drop("_bucket")
    return [run_training(spec, train, test, registry, model_root, [featurizer]) for spec in specs]


def train_on_images(
    images: DataFrame,
    specs: Sequence[ModelSpec],
    registry: Registry,
    model_root: str,
    featurizer: ImageFeaturizer,
    path: str,
    train_percent: int = 70,
    rows_per_class: int | None = None,
) -> list[TrainedRun]:
    """The whole job on labelled images: features to `path`, and one logged run per spec."""
    spark = images.sparkSession
    with scratch_of_job(spark):
        write_features(images, featurizer, path, rows_per_class)
        return train_on_features(spark, path, specs, registry, model_root, featurizer, train_percent)


def sweep(
    make_spec: Callable[[int], ModelSpec],
    values: Sequence[int],
    train: DataFrame,
    test: DataFrame,
    score: Callable[[ModelSpec, DataFrame, DataFrame], float] | None = None,
    parallel: int = 2,
) -> DataFrame:
    """(value, accuracy) for each hyper-parameter value.

    All fits read the same rows, so pass written ones, such as those of `split_rows`. `parallel`
    fits are in flight at a time: one fills the gaps of the other, and each holds its own copy
    of the training rows in executor storage, forests only where it fits, so a higher number only
    pays for small inputs.
    `score` may be `run_training` with a registry bound to it, to save and log each model.
    """
    spark = train.sparkSession

    def fit_and_rate(spec: ModelSpec, train: DataFrame, test: DataFrame) -> float:
        return accuracy(fit(spec, train).transform(test)).first()["accuracy"]

    rate = score or fit_and_rate
    work = inheritable_thread_target(spark)(lambda value: rate(make_spec(value), train, test))
    with ThreadPoolExecutor(parallel) as pool:
        rates = list(pool.map(work, values))
    return spark.createDataFrame(list(zip(values, rates, strict=True)), "value int, accuracy double")


def count_outcomes(scored: DataFrame, *by: Column | str) -> DataFrame:
    """Counts of (label, prediction), or of other columns, of scored rows."""
    columns = by or (F.col("label"), F.col("prediction").cast("int").alias("prediction"))
    return scored.groupBy(*columns).agg(F.count("*").alias("n"))
