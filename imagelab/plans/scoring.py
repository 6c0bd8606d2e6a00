"""Score features or images with a saved model, in batch."""

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imagelab.functions.columns import class_name, confidence, named_top_k
from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.operators.images import feature_table
from imagelab.sources.registry import find_one


def names_of(model: PipelineModel, names: Sequence[str] | None = None) -> list[str]:
    """Class names that were saved with a model, or the given ones for a model without any."""
    saved = [list(stage.getLabels()) for stage in model.stages if isinstance(stage, IndexToString)]
    if saved and names is not None and list(names) != saved[-1]:
        raise ValueError(f"the model was trained on the classes {saved[-1]}")
    if not saved and names is None:
        raise ValueError("the model has no class names; give the list it was trained with")
    return saved[-1] if saved else list(names)


def score_features(
    df: DataFrame, model: PipelineModel | str, names: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """`keep` columns, class_name, confidence and the five best classes, as plain types.

    `df` has a `features` vector. The class names come from the model. They are literals of the
    plan: a classifier has a weight vector or a leaf count for each of them, so the list is small
    where the model is.
    """
    if isinstance(model, str):
        model = PipelineModel.load(model)
    names = names_of(model, names)
    classifier = PipelineModel([s for s in model.stages if not isinstance(s, IndexToString)])
    scores = classifier.transform(df).withColumn("_scores", vector_to_array("probability"))
    return scores.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        class_name(F.col("prediction"), names).alias("class_name"),
        confidence(F.col("_scores")).alias("confidence"),
        named_top_k(F.col("_scores"), names, 5).alias("top5"),
    )


def score_images(df: DataFrame, model: PipelineModel | str, names: Sequence[str] | None = None) -> DataFrame:
    """Image rows to predictions, with the origin of the image.

    `model` begins with an image featurizer. An image that cannot be processed keeps its row:
    `reason` is set, the rest is null. To score everything in one pass it goes through the
    classifier as zeros, and its outcome is blanked.
    """
    if isinstance(model, str):
        model = PipelineModel.load(model)
    featurizer, *classifier = model.stages
    if not isinstance(featurizer, ImageFeaturizer):
        raise ValueError("the model was not trained on images: it has no featurizer")
    rows = df.withColumn("origin", F.col("image.origin"))
    embedded = feature_table(rows, ["origin"], **featurizer.embed_options())
    width = next(stage.numFeatures for stage in classifier if hasattr(stage, "numFeatures"))
    zeros = F.array_repeat(F.lit(0.0).cast("float"), width)
    vectors = embedded.select(
        "origin", "reason", array_to_vector(F.coalesce("features", zeros)).alias("features")
    )
    scored = score_features(vectors, PipelineModel(classifier), names, keep=["origin", "reason"])
    good = F.col("reason").isNull()
    outcome = ["prediction", "class_name", "confidence", "top5"]
    return scored.select("origin", *[F.when(good, F.col(c)).alias(c) for c in outcome], "reason")


def score_with_registry_model(
    df: DataFrame, numbered: DataFrame, index: str | int, names: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Score features with the model that has a number in the registry listing."""
    model_path, _ = find_one(numbered, index)
    return score_features(df, model_path, names, keep)


def score_images_with_registry_model(
    df: DataFrame, numbered: DataFrame, index: str | int, names: Sequence[str] | None = None
) -> DataFrame:
    """Score uploaded images with the model that has a number in the registry listing."""
    model_path, _ = find_one(numbered, index)
    return score_images(df, model_path, names)
