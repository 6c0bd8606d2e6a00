"""Uploads that name the model they want, and uploads that replace earlier ones."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from imagelab.operators.classes import union_frames
from imagelab.plans.scoring import score_features, score_images
from imagelab.session import exists, make_folder, materialise, published, scratch_of_job
from imagelab.sources.manifest import CHANGED, REMOVED, Manifest
from imagelab.sources.registry import Registry, find, listing

OUTCOME = {
    "prediction": "int", "class_name": "string", "confidence": "double", "top5": "array<struct<class_name:string,score:double>>",
    "reason": "string",
}
BY_MODEL = "model_index"  # the column with the number of the wanted model
MODELS_KEPT = 32  # loaded models between batches


@dataclass
class ScoreByModel:
    """Scores the rows of a batch, each with the model that has its number in the registry listing.

    The numbers of a batch are resolved once, against one listing, and written down: a batch that is
    done again after a failure uses the same models, however the listing has grown. The rows of each
    model are scored by themselves, and all predictions of a batch appear as one folder of its number,
    so a repeated batch replaces its first try and never doubles it. Rows whose number is not in
    the listing, or null, keep their place, with a reason and no prediction.

    Feature rows keep the columns `keep`; image rows (with `images`) the origin of the image.
    """

    registry: Registry
    path: str
    keep: Sequence[str] = ()
    images: bool = False
    order: Sequence[str] | None = None
    _loaded: dict[str, PipelineModel] = field(default_factory=dict, repr=False)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch_of_job(spark):
            scored = self.scored(batch, self.resolved(batch, number))
            with published(spark, f"{self.path.rstrip('/')}/predictions/batch={number}") as folder:
                scored.write.parquet(folder)

    def resolved(self, batch: DataFrame, number: int) -> dict[int, str]:
        """Model paths by the numbers that occur in a batch; one row for each model of the listing at most."""
        spark, path = batch.sparkSession, f"{self.path.rstrip('/')}/models/batch={number}"
        if not exists(spark, path):
            wanted = [r[0] for r in batch.select(F.col(BY_MODEL).cast("bigint")).distinct().collect() if r[0] is not None]
            order = {} if self.order is None else {"order": self.order}
            found = find(listing(self.registry.rows(), **order), wanted).select("idx", "model_path")
            with published(spark, path) as folder:
                found.coalesce(1).write.parquet(folder)
        return {r["idx"]: r["model_path"] for r in spark.read.schema("idx bigint, model_path string").parquet(path).collect()}

    def _model(self, path: str) -> PipelineModel:
        if path not in self._loaded:
            while len(self._loaded) >= MODELS_KEPT:
                del self._loaded[next(iter(self._loaded))]
            self._loaded[path] = PipelineModel.load(path)
        return self._loaded[path]

    def scored(self, rows: DataFrame, models: dict[int, str]) -> DataFrame:
        """Rows with their outcome and the path of the model that made it."""
        if self.images and "origin" not in rows.columns:
            rows = rows.withColumn("origin", F.col("image.origin"))
        keep = ["origin"] if self.images else list(self.keep)
        index = F.col(BY_MODEL).cast("bigint")
        known = index.isNotNull() & index.isin(list(models)) if models else F.lit(False)
        why = F.concat(F.lit("no model number "), F.coalesce(index.cast("string"), F.lit("given")))
        outcomes = {name: F.lit(None).cast(kind) for name, kind in OUTCOME.items()} | {"reason": why}
        missing = rows.filter(~known).select(
            *keep, *[c.alias(name) for name, c in outcomes.items()], index.alias(BY_MODEL), F.lit(None).cast("string").alias("model_path")
        )
        parts = [missing]
        for number, path in models.items():
            own = rows.filter(index == number)
            if self.images:
                part = score_images(own, self._model(path))
            else:
                part = score_features(own, self._model(path), keep=keep).withColumn("reason", F.lit(None).cast("string"))
            parts.append(part.select(*keep, *OUTCOME, F.lit(number).cast("bigint").alias(BY_MODEL), F.lit(path).alias("model_path")))
        return union_frames(parts)

    def predictions(self, spark: SparkSession) -> DataFrame:
        """All predictions so far, with the number of their batch."""
        return spark.read.parquet(f"{self.path.rstrip('/')}/predictions")


def run_available_by_model(stream: DataFrame, scorer: ScoreByModel, checkpoint: str) -> StreamingQuery:
    """Score what is there, each row with the model it names, and stop. `stream` has the column `model_index`."""
    query = stream.writeStream.foreachBatch(scorer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def model_of_folder(origin: Column) -> Column:
    """The model number that an upload names by its folder: .../<number>/<file>; null for other folders."""
    return F.try_element_at(F.split(origin, "/"), F.lit(-2)).try_cast("bigint")


def score_changed_uploads(
    files: DataFrame, read: Callable[[DataFrame], DataFrame | None], score: Callable[[DataFrame], DataFrame], path: str
) -> int | None:
    """Score the uploads that are new or replaced since the last time; the number of this round, None without any.

    A file stream sees a path once. Here a manifest of path, length and time of modification is
    compared with the file list, so a file that takes the place of another is scored again, and its
    row is marked `replaced`. `read` gives the image rows of the changes, with their `origin` as in the
    file list; `score` gives their predictions with `origin`. Predictions of a round appear as a
    whole, then the manifest; a round that ends in between is done again and replaces the first try.
    """
    spark = files.sparkSession
    manifest = Manifest(spark, f"{path.rstrip('/')}/manifest")
    with scratch_of_job(spark):
        changes = materialise(manifest.changes(files), "changes")
        if changes.isEmpty():
            return None
        number = manifest.next_commit()
        rows = read(changes)
        if rows is not None:
            fate = changes.filter(F.col("change") != REMOVED).select(
                F.col("origin").alias("_origin"), (F.col("change") == CHANGED).alias("replaced"), "modified"
            )
            scored = score(rows)
            marked = scored.join(fate, F.col("origin") == F.col("_origin")).drop("_origin")
            with published(spark, f"{path.rstrip('/')}/predictions/commit={number}") as folder:
                marked.write.parquet(folder)
        manifest.commit(changes, number)
    return number


def upload_predictions(spark: SparkSession, path: str) -> DataFrame:
    """All predictions of `score_changed_uploads`, with the number of their round."""
    folder = f"{path.rstrip('/')}/predictions"
    make_folder(spark, folder)
    return spark.read.parquet(folder)
