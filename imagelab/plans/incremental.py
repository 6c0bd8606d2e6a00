"""Feature tables that follow an image folder: only new and changed images are opened."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.plans.training import write_features
from imagelab.schemas import IMAGE_EXTENSIONS
from imagelab.session import exists, materialise, published, scratch_of_job
from imagelab.sources.manifest import Manifest, changed_images, file_list


def update_features(
    files: DataFrame, read: Callable[[DataFrame], DataFrame | None], featurizer: ImageFeaturizer, path: str, salt: str = ""
) -> dict[str, int]:
    """Bring a feature table up to date with a file list; how many files were new, changed and removed.

    `read` gives the labelled images of the changes that it gets. Their features go to a folder of this
    update, then the manifest is written; an update that ends in between is done again as a whole.
    """
    spark = files.sparkSession
    manifest = Manifest(spark, f"{path.rstrip('/')}/manifest")
    with scratch_of_job(spark):
        changes = materialise(manifest.changes(files), "changes")
        counts = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}  # three rows at most
        if not counts:
            return counts
        number = manifest.next_commit()
        images = read(changes)
        if images is not None:
            with published(spark, f"{path.rstrip('/')}/features/commit={number}") as folder:
                write_features(images, featurizer, folder, salt=salt)
        manifest.commit(changes, number)
    return counts


def update_folder_features(
    spark: SparkSession,
    images: str,
    names: Sequence[str],
    featurizer: ImageFeaturizer,
    path: str,
    extensions: Sequence[str] = IMAGE_EXTENSIONS,
    salt: str = "",
) -> dict[str, int]:
    """`update_features` for the class folders of an image folder."""
    files = file_list(spark, images, extensions, names)
    return update_features(files, lambda changes: changed_images(changes, names), featurizer, path, salt)


def current_features(spark: SparkSession, path: str) -> DataFrame | None:
    """The last features of every image that is still there, with the rejected ones; None before the first.

    Superseded rows are found by their origin and update alone; the features themselves are shuffled
    only when there are too many of those rows to broadcast.
    """
    folder = f"{path.rstrip('/')}/features"
    if not exists(spark, folder):
        return None
    table = spark.read.parquet(folder)
    current = Manifest(spark, f"{path.rstrip('/')}/manifest").last_commits().withColumnRenamed("commit", "_last")
    # by origin alone, which the last commits are placed by: a join by both columns would shuffle them again
    found = table.select("origin", F.col("commit").cast("bigint").alias("commit")).join(current, "origin", "left")
    superseded = F.col("_last").isNull() | (F.col("commit") != F.col("_last"))
    stale = materialise(found.filter(superseded).select("origin", "commit"), "stale")
    old = stale.select(F.col("origin").alias("_origin"), F.col("commit").alias("_commit"))
    return table.join(old, (table["origin"] == old["_origin"]) & (table["commit"] == old["_commit"]), "left_anti")
