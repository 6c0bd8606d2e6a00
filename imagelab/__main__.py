"""Command line: train, list and score. Run with `spark-submit` or `python -m imagelab`."""

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.operators.featurizer import ImageFeaturizer
from imagelab.plans import scoring, training
from imagelab.schemas import CAR_CLASSES
from imagelab.sources import images as src
from imagelab.sources import registry as rg
from imagelab.streaming import scoring as streaming

SPECS = {
    "logistic": lambda: [training.logistic_regression()],
    "elastic-net": lambda: [training.elastic_net_regression()],
    "tree": lambda: [training.decision_tree()],
    "forest": lambda: [training.random_forest(n) for n in training.FOREST_SIZES],
    "perceptron": lambda: [training.perceptron()],
    "head": lambda: [training.relu_head()],
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="imagelab")
    top.add_argument("--registry", required=True, help="folder of the model registry")
    jobs = top.add_subparsers(dest="job", required=True)

    train = jobs.add_parser("train", help="train on class folders, save and log")
    train.add_argument("--images", help="folder with one sub-folder per class")
    train.add_argument("--features", required=True, help="feature table: written from --images, or trained on without")
    train.add_argument("--classes", default=",".join(CAR_CLASSES), help="class names in the order of their ids")
    train.add_argument("--models", required=True, help="folder for fitted models")
    train.add_argument("--algorithm", choices=SPECS, default="logistic")
    train.add_argument("--predictor", default="imagelab.functions.predictors:grid_colour", help="module:factory")
    train.add_argument("--size", type=int, default=224, help="side of the resized images")
    train.add_argument("--scaling", choices=["none", "inception", "resnet"], default="none", help="predictor input")
    train.add_argument("--train-percent", type=int, default=70)
    train.add_argument("--rows-per-class", type=int)

    jobs.add_parser("models", help="list the logged models")

    for name in ("score", "watch"):
        job = jobs.add_parser(name, help="score an image folder" + (" as a stream" if name == "watch" else ""))
        job.add_argument("--images", required=True)
        job.add_argument("--model", required=True, help="number in the listing")
        job.add_argument("--out", required=True, help="folder for the predictions")
        if name == "watch":
            job.add_argument("--checkpoint", required=True)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Run one job; the result is what it has to show."""
    registry = rg.ParquetRegistry(spark, args.registry)
    registry.create()
    if args.job == "train":
        featurizer = ImageFeaturizer(
            predictor=args.predictor, height=args.size, width=args.size, scaling=args.scaling
        )
        job = (SPECS[args.algorithm](), registry, args.models, featurizer)
        if args.images:
            names = args.classes.split(",")
            images = src.read_labelled_images(spark, args.images, names, drop_invalid=False, extensions=src.IMAGE_EXTENSIONS)
            training.train_on_images(images, *job, args.features, args.train_percent, args.rows_per_class)
        else:
            training.train_on_features(spark, args.features, *job, args.train_percent)
        for reason, n in training.reject_counts(spark, args.features).collect():  # one row per reason
            print(f"{n} images without features: {reason}")
    numbered = rg.listing(registry.rows())
    if args.job in ("train", "models"):
        return numbered.orderBy("idx")
    if args.job == "score":
        images = src.read_images(spark, args.images, drop_invalid=False, extensions=src.IMAGE_EXTENSIONS)
        scored = scoring.score_images_with_registry_model(images, numbered, args.model)
        src.write_table(scored, args.out, "overwrite")
    else:
        model_path, _ = rg.find_one(numbered, args.model)
        stream = src.stream_images(spark, args.images, drop_invalid=False)
        scored = streaming.score_image_stream(stream, PipelineModel.load(model_path))
        streaming.run_available(scored, args.out, args.checkpoint)
    return spark.read.parquet(args.out).groupBy("class_name", "reason").agg(F.count("*").alias("n"))


if __name__ == "__main__":
    run(SparkSession.builder.appName("imagelab").getOrCreate(), parser().parse_args()).show(100, False)
