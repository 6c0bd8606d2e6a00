"""A transfer-learning head: one hidden layer of rectified units, trained by mini-batches with Adam.

Rows fall into batches by the hash of a row key, and a batch is a folder of the written rows, so one
step reads one batch and an epoch reads everything once. Each task sums loss and gradient over its Arrow
batches; the sums of tasks are added up in Spark before they reach the driver when they are many. The
driver holds the weights and the two moments of Adam, whose size is that of the network alone. Batches do
not depend on how rows are partitioned, nor do the sums, up to the order of addition.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imagelab.functions.columns import best_class
from imagelab.session import materialise, scratch_of_job, ship_package

Weights = dict[str, np.ndarray]
ORDER = ("hidden", "hidden_bias", "output", "output_bias")
DIRECT_BYTES = 64 << 20  # sums of all tasks up to this size go to the driver as they are
LANES = 16  # beyond, they are added up in so many groups first
SLICE = 128  # rows in work at a time
ROW_KEY = "_row"  # column with a number for each row, if the rows have one


def initial_weights(width: int, hidden: int, classes: int, seed: int) -> Weights:
    pick = np.random.default_rng(seed)
    return {
        "hidden": pick.normal(0.0, math.sqrt(2.0 / max(1, width)), (width, hidden)),
        "hidden_bias": np.zeros(hidden),
        "output": pick.normal(0.0, math.sqrt(1.0 / hidden), (hidden, classes)),
        "output_bias": np.zeros(classes),
    }


def probabilities(weights: Weights, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hidden activations, class probabilities) of each row."""
    active = np.maximum(x @ weights["hidden"] + weights["hidden_bias"], 0.0)
    return active, _softmax(active @ weights["output"] + weights["output_bias"])


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _slices(rows: int) -> Iterator[slice]:
    return (slice(start, start + SLICE) for start in range(0, rows, SLICE))


def _loss(shares: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(np.maximum(shares[np.arange(len(y)), y], 1e-15)).sum(dtype=np.float64))


def loss_of(weights: Weights, x: np.ndarray, y: np.ndarray) -> float:
    """Sum of the negative log probabilities of the labels."""
    return sum(_loss(probabilities(weights, x[s])[1], y[s]) for s in _slices(len(y)))


def loss_and_gradient(weights: Weights, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Sums over the rows of the loss and of its derivative by each weight.

    A slice of rows at a time, whose hidden values stay in the cache of a core, with a line for each
    hidden unit: the thin products are several times faster this way round. The bias is one more input.
    """
    inner = np.ascontiguousarray(np.vstack([weights["hidden"], weights["hidden_bias"]]).T)
    outer, bias = weights["output"], weights["output_bias"]
    loss, hidden, output, output_bias = 0.0, np.zeros(inner.shape), np.zeros(outer.shape), np.zeros(bias.shape)
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    space = [np.empty(len(inner) * SLICE, t) for t in (inner.dtype, bool, inner.dtype)]  # used again by each slice
    for s in _slices(len(y)):
        rows = len(y[s])
        active, on, back = (b[: len(inner) * rows].reshape(len(inner), rows) for b in space)
        np.matmul(inner, x[s].T, out=active)
        np.greater(active, 0, out=on)
        active *= on
        wrong = _softmax(active.T @ outer + bias)
        loss += _loss(wrong, y[s])
        wrong[np.arange(len(wrong)), y[s]] -= 1.0
        output += active @ wrong
        output_bias += wrong.sum(axis=0)
        np.matmul(outer, wrong.T, out=back)
        back *= on
        hidden += back @ x[s]
    return loss, {"hidden": hidden[:, :-1].T, "hidden_bias": hidden[:, -1], "output": output, "output_bias": output_bias}


def _flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in ORDER])


def _shaped(values: np.ndarray, like: Weights) -> Weights:
    ends = np.cumsum([like[name].size for name in ORDER])
    return {name: part.reshape(like[name].shape) for name, part in zip(ORDER, np.split(values, ends[:-1]))}


class Adam:
    """Adaptive moments with bias correction."""

    def __init__(self, size: int, rate: float, first: float = 0.9, second: float = 0.999, floor: float = 1e-7):
        self.rate, self.first, self.second, self.floor = rate, first, second, floor
        self.mean, self.square, self.step = np.zeros(size), np.zeros(size), 0

    def update(self, values: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean = self.first * self.mean + (1 - self.first) * gradient
        self.square = self.second * self.square + (1 - self.second) * gradient**2
        mean, square = self.mean / (1 - self.first**self.step), self.square / (1 - self.second**self.step)
        return values - self.rate * mean / (np.sqrt(square) + self.floor)


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    values = batch.column("features").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return values.reshape(batch.num_rows, -1), batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)


def summed(rows: DataFrame, weights: Weights, gradient: bool = True) -> tuple[int, float, np.ndarray]:
    """(rows, loss, flat gradient) summed over (features array<float>, label); without `gradient` an empty one."""
    spark = rows.sparkSession
    small = {name: values.astype(np.float32) for name, values in weights.items()}
    sent = spark.sparkContext.broadcast(small)  # the network, whose size the caller chooses
    size = sum(values.size for values in weights.values()) if gradient else 0

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, loss, total = 0, 0.0, np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch)
                if gradient:
                    more, parts = loss_and_gradient(sent.value, x, y)
                    total += _flat(parts)
                else:
                    more = loss_of(sent.value, x, y)
                many, loss = many + len(y), loss + more
        if many:
            columns = [pa.array([many], pa.int64()), pa.array([loss]), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["many", "loss", "total"])

    def added(table: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(t.as_py()) for t in table.column("total")), np.zeros(size))
        many, loss = (sum(table.column(c).to_pylist()) for c in ("many", "loss"))
        return pa.table({"many": pa.array([many], pa.int64()), "loss": pa.array([float(loss)]), "total": pa.array([total.tobytes()], pa.binary())})

    schema = "many bigint, loss double, total binary"
    parts = rows.select("features", "label").mapInArrow(of_task, schema)
    if parts.rdd.getNumPartitions() * size * 8 > DIRECT_BYTES:
        lane = F.pmod(F.spark_partition_id(), F.lit(LANES))
        parts = parts.withColumn("lane", lane).groupBy("lane").applyInArrow(lambda t: added(t.drop_columns(["lane"])), schema)
    found = parts.collect()  # a row for each task or lane, of the size of the network
    sent.unpersist()
    total = sum((np.frombuffer(bytes(r["total"])) for r in found), np.zeros(size))
    return sum(r["many"] for r in found), float(sum(r["loss"] for r in found)), total


class _HeadParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    hidden = Param(Params._dummy(), "hidden", "hidden units", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes over the training rows at most", TypeConverters.toInt)
    batches = Param(Params._dummy(), "batches", "steps in an epoch", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "step size", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "epochs without a smaller loss after which training ends", TypeConverters.toInt)
    validationPercent = Param(Params._dummy(), "validationPercent", "share of rows held back for that loss", TypeConverters.toInt)


class ReluHead(Estimator, _HeadParams):
    """Fits a `ReluHeadModel`. The weights with the least loss on the held-back rows are kept."""

    def __init__(self, **params):
        super().__init__()
        self._setDefault(hidden=1024, epochs=20, batches=8, rate=1e-3, patience=5, validationPercent=20, seed=42)
        self._set(**params)

    def _fit(self, train: DataFrame) -> "ReluHeadModel":
        get = self.getOrDefault
        spark = train.sparkSession
        ship_package(spark)
        label = get("labelCol")
        names = train.schema[label].metadata.get("ml_attr", {}).get("vals", [])
        array = vector_to_array(get("featuresCol"), "float32")
        # rows without a key of their own go by their values: equal rows then share a batch
        key = F.col(ROW_KEY) if ROW_KEY in train.columns else F.xxhash64(array, label)
        dealt = F.pmod(F.xxhash64(F.lit(get("seed")), key), F.lit(100 * get("batches")))
        held_back = F.pmod(dealt, F.lit(100)) < get("validationPercent")
        batch = F.when(held_back, F.lit(-1)).otherwise(F.floor(dealt / 100)).cast("int")
        with scratch_of_job(spark):
            flat = train.select(array.alias("features"), F.col(label).cast("int").alias("label"), batch.alias("batch"))
            rows = materialise(flat, "batches", by=["batch"])
            size = rows.agg(F.max("label").alias("top"), F.max(F.size("features")).alias("width")).first()
            if size["width"] is None:
                raise ValueError("there are no training rows")
            weights = initial_weights(size["width"], get("hidden"), len(names) or size["top"] + 1, get("seed"))
            return self._copyValues(ReluHeadModel(self._trained(rows, weights)))

    def _trained(self, rows: DataFrame, weights: Weights) -> Weights:
        get = self.getOrDefault
        values = _flat(weights)
        adam, pick = Adam(len(values), get("rate")), np.random.default_rng(get("seed"))
        best, least, waited = values, math.inf, 0
        for _ in range(get("epochs")):
            seen, lost = 0, 0.0
            for batch in pick.permutation(get("batches")).tolist():
                many, loss, gradient = summed(rows.filter(F.col("batch") == batch), _shaped(values, weights))
                seen, lost = seen + many, lost + loss
                if many:
                    values = adam.update(values, gradient / many)
            held, loss, _ = summed(rows.filter("batch = -1"), _shaped(values, weights), gradient=False)
            mean = loss / held if held else lost / max(1, seen)  # too few rows to hold some back
            if mean < least:
                best, least, waited = values, mean, 0
            else:
                waited += 1
            if waited >= get("patience"):
                break
        return _shaped(best, weights)


class ReluHeadModel(Model, _HeadParams, MLReadable, MLWritable):
    """Class probabilities and the best class by a hidden layer of rectified units."""

    def __init__(self, weights: Weights | None = None):
        super().__init__()
        self.weights = weights or {}

    @property
    def numFeatures(self) -> int:
        return self.weights["hidden"].shape[0]

    @property
    def numClasses(self) -> int:
        return len(self.weights["output_bias"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        weights, width = {name: values.astype(np.float32) for name, values in self.weights.items()}, self.numFeatures
        classes = self.numClasses

        @F.arrow_udf("array<double>")
        def shares(features: pa.Array) -> pa.Array:
            x = features.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(features), width)
            found = np.concatenate([np.empty((0, classes), np.float32), *(probabilities(weights, x[s])[1] for s in _slices(len(x)))])
            flat = pa.array(found.astype(np.float64).ravel())
            return pa.ListArray.from_arrays(pa.array(np.arange(len(features) + 1, dtype=np.int32) * found.shape[1]), flat)

        scored = dataset.withColumn("_shares", shares(vector_to_array(self.getFeaturesCol(), "float32")))
        vector, best = array_to_vector("_shares"), best_class(F.col("_shares")).cast("double")
        return scored.withColumns({self.getProbabilityCol(): vector, self.getPredictionCol(): best}).drop("_shares")

    def write(self) -> "_HeadWriter":
        return _HeadWriter(self)

    @classmethod
    def read(cls) -> "_HeadReader":
        return _HeadReader()


class _HeadWriter(MLWriter):
    def __init__(self, model: ReluHeadModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(name, list(w.shape), w.ravel().tolist()) for name, w in self.model.weights.items()]
        frame = self.sparkSession.createDataFrame(rows, "name string, shape array<int>, weights array<double>")
        frame.coalesce(1).write.parquet(f"{path}/weights")


class _HeadReader(MLReader):
    def load(self, path: str) -> ReluHeadModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/weights").collect()  # four arrays
        model = ReluHeadModel({r["name"]: np.array(r["weights"]).reshape(r["shape"]) for r in rows})
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
