"""Quantile sketches: ROC curves and profiles of image sizes whose size does not depend on the rows.

A sketch (KLL, built into Spark) is a few kilobytes for any number of rows. It is made by partial
aggregation, so a shuffle carries one for each group and task, and sketches of several tables merge
into the sketch of all their rows. The rank of a value in a group is off by at most `RANK_ERROR` of the
group's rows, with a probability far above 99 % for `SKETCH_K`.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.session import published

SKETCH_K = 1000
GRID = 500  # shares of a group's rows at which a sketch is read to find the rank of a score
RANK_ERROR = 0.01  # more than the published 99 % bound of 2.296 / k ^ 0.9021 = 0.0045 and 1 / GRID together


def score_sketches(df: DataFrame, label: str = "label", scores: str = "scores") -> DataFrame:
    """(class_id, positive, n, sketch): the scores for each class of its own rows and of all others."""
    each = df.select(F.col(label).alias("_label"), F.posexplode(scores).alias("class_id", "_score"))
    known = each.filter(F.col("_score").isNotNull() & ~F.isnan("_score") & F.col("_label").isNotNull())
    positive = (F.col("class_id") == F.col("_label")).alias("positive")
    score = F.col("_score").cast("double")
    return known.groupBy("class_id", positive).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(score, F.lit(SKETCH_K)).alias("sketch")
    )


def merged_score_sketches(df: DataFrame) -> DataFrame:
    """The sketches of several tables as those of all their rows together."""
    return df.groupBy("class_id", "positive").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch")
    )


def roc_curve(sketches: DataFrame, points: int = 100) -> DataFrame:
    """(class_id, threshold, fpr, tpr): rates of scores above a threshold among the others and the own rows.

    At most `points` + 2 thresholds a class: evenly spaced quantiles of its own scores and the others' together, and
    one below all. Classes without rows of both kinds have no curve. Each rate is within `RANK_ERROR`
    of the exact one at its threshold.
    """
    grid = _shares([(i + 1) / GRID for i in range(GRID)])

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col("class_id").alias(f"_{name}"), "sketch", F.kll_sketch_get_quantile_double("sketch", grid).alias(name))

    own = side(sketches.filter("positive"), "own").withColumnRenamed("sketch", "_own_sketch")
    rest = side(sketches.filter("NOT positive"), "rest").withColumnRenamed("sketch", "_rest_sketch")
    both = own.join(rest, F.col("_own") == F.col("_rest"))
    steps = _shares([i / points for i in range(points + 1)])
    of_all = F.kll_sketch_get_quantile_double(F.kll_sketch_merge_double("_own_sketch", "_rest_sketch"), steps)
    every = both.select(F.col("_own").alias("class_id"), "own", "rest", F.concat(F.array(F.lit(float("-inf"))), of_all).alias("_thresholds"))
    at = every.select("class_id", "own", "rest", F.explode(F.array_distinct("_thresholds")).alias("threshold"))

    def above(values: str) -> Column:
        return F.size(F.filter(values, lambda value: value > F.col("threshold"))) / F.lit(float(GRID))

    return at.select("class_id", "threshold", above("rest").alias("fpr"), above("own").alias("tpr"))


def _shares(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def size_sketches(df: DataFrame, group: str, sizes: dict[str, Column]) -> DataFrame:
    """(group, n, one sketch for each named size), one row for each group; null sizes do not count in a sketch."""
    aggregates = [F.kll_sketch_agg_bigint(value.cast("bigint"), F.lit(SKETCH_K)).alias(name) for name, value in sizes.items()]
    return df.groupBy(group).agg(F.count("*").alias("n"), *aggregates)


def image_size_sketches(images: DataFrame, group: str = "class_name") -> DataFrame:
    """Sketches of height, width and bytes of the decodable images of each class; no image leaves its task."""
    image = F.col("image")
    sizes = {"height": image["height"], "width": image["width"], "bytes": F.octet_length(image["data"])}
    return size_sketches(images.filter(image["height"] > 0), group, sizes)


def append_profile(sketches: DataFrame, path: str, part: str) -> None:
    """Add the sketches of one more part of a data set to its profile; a part that is written again is replaced."""
    with published(sketches.sparkSession, f"{path.rstrip('/')}/part={part}") as folder:
        sketches.coalesce(1).write.parquet(folder)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all parts merged: a row for each group, whatever the number of parts."""
    parts = spark.read.parquet(path).drop("part")
    group, _, *names = parts.columns
    merged = [F.kll_merge_agg_bigint(name, F.lit(SKETCH_K)).alias(name) for name in names]
    return parts.groupBy(group).agg(F.sum("n").alias("n"), *merged)


def size_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(group, n, share, one value for each size): the smallest sizes that reach each share of the group's rows."""
    group, _, *names = sketches.columns
    steps = _shares(shares)
    values = {name: F.kll_sketch_get_quantile_bigint(name, steps).alias(name) for name in names}
    zipped = sketches.select(group, "n", F.arrays_zip(steps.alias("share"), *values.values()).alias("_rows"))
    return zipped.select(group, "n", F.inline("_rows"))
