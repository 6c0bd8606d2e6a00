"""One-hot label columns."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame


def one_hot_column(df: DataFrame, class_col: str, output: str) -> DataFrame:
    """Sparse one-hot vector of a class column, one place per class in alphabetical order."""
    index = f"{output}_index"
    stages = [
        StringIndexer(inputCol=class_col, outputCol=index, stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol=index, outputCol=output, dropLast=False),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop(index)
