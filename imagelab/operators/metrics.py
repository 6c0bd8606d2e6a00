"""Evaluation of scored rows and profiles of data sets."""

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from imagelab.operators.filters import wrong_or_right
from imagelab.operators.indexing import with_running_total


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (rows, correct, accuracy, test_error); the rates are null for an empty input."""
    hit = wrong_or_right(label, prediction)
    counted = scored.agg(F.count("*").alias("rows"), F.count_if(hit).alias("correct"))
    share = F.try_divide(F.col("correct").cast("double"), F.col("rows"))
    return counted.select("rows", "correct", share.alias("accuracy"), (1.0 - share).alias("test_error"))


def evaluator_accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """The same accuracy from MLlib's evaluator."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy"
    ).evaluate(scored)


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n); counted before the shuffle, so it moves k x k rows per task."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def class_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts alone."""
    cells = confusion_matrix(scored, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    # each cell counts once for the class it has and once for the class it was given
    as_label = F.struct(
        F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).alias("given"), hit.alias("hits")
    )
    as_given = F.struct(
        F.col("prediction").alias("class"), F.lit(0).alias("support"), F.col("n").alias("given"), F.lit(0).alias("hits")
    )
    wide = "struct<class:double,support:bigint,given:bigint,hits:bigint>"
    sides = cells.select(F.inline(F.array(as_label.cast(wide), as_given.cast(wide))))
    totals = sides.groupBy(F.col("class").cast("int").alias("class_id")).agg(
        F.sum("support").alias("support"), F.sum("given").alias("given"), F.sum("hits").alias("hits")
    )
    rate = lambda n, d: F.coalesce(F.try_divide(n.cast("double"), d), F.lit(0.0))
    precision, recall = rate(F.col("hits"), F.col("given")), rate(F.col("hits"), F.col("support"))
    return totals.select(
        "class_id",
        precision.alias("precision"),
        recall.alias("recall"),
        rate(2 * F.col("hits"), F.col("given") + F.col("support")).alias("f1"),
        "support",
    )


def one_vs_rest_auc(df: DataFrame, label: str = "label", scores: str = "scores") -> DataFrame:
    """(class_id, auc): area under the ROC curve of every class against the others, in one pass.

    `scores` is an array with a score per class. Rows become counts per class and distinct score
    before the shuffle; the negatives below a score are a running total in the order of a
    distributed sort. A class without positives or without negatives has no area.
    """
    own = F.posexplode(F.transform(scores, lambda s: s.cast("double"))).alias("class_id", "score")
    pairs = df.select(F.col(label).alias("label"), own)
    is_own = F.col("label") == F.col("class_id")
    counted = pairs.groupBy("class_id", "score").agg(
        F.count_if(is_own).alias("own"), F.count_if(~is_own).alias("others")
    )
    lined = with_running_total(counted, ["class_id", "score"], "others", "upto")
    begins = lined.groupBy("class_id").agg(F.min(F.col("upto") - F.col("others")).alias("before"))
    begins = begins.withColumnRenamed("class_id", "_class_id")
    below = F.col("upto") - F.col("others") - F.col("before") + F.col("others") / 2
    area = lined.join(begins, F.col("class_id") == F.col("_class_id")).groupBy("class_id").agg(
        F.sum(F.col("own") * below).alias("above"), F.sum("own").alias("own"), F.sum("others").alias("others")
    )
    return area.select("class_id", F.try_divide("above", F.col("own") * F.col("others")).alias("auc"))


def distinct_labels(df: DataFrame, label: str = "label") -> DataFrame:
    return df.select(label).distinct()


def dataset_profile(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rows, missing values and cells (rows x columns) per class."""
    return df.groupBy(label).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(value).isNull()).alias("missing"),
        (F.count("*") * len(df.columns)).alias("cells"),
    )
