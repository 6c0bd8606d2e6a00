"""Row filters on image rows and feature rows. None of them shuffles."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.functions.columns import as_class, class_id


def drop_invalid(df: DataFrame, image: str = "image") -> DataFrame:
    """Keep rows whose file was decoded; the image source marks the others with height -1."""
    return df.filter(F.col(f"{image}.height") > 0)


def keep_dimensions(
    df: DataFrame, min_channels: int = 3, below_height: int = 700, image: str = "image"
) -> DataFrame:
    """Keep colour images under a height, as a SQL predicate on nested fields."""
    return df.filter(f"{image}.nChannels >= {int(min_channels)} AND {image}.height < {int(below_height)}")


def drop_mode(df: DataFrame, mode: int, image: str = "image") -> DataFrame:
    """Leave out one pixel code (16 is ordinary B,G,R, so leaving it out keeps the unusual ones)."""
    return df.filter(f"NOT {image}.mode = {int(mode)}")


def keep_modes(df: DataFrame, modes: Sequence[int], image: str = "image") -> DataFrame:
    return df.filter(F.col(f"{image}.mode").isin(list(modes)))


def drop_null_features(df: DataFrame, features: str = "features") -> DataFrame:
    """Rows without features would make the vector conversion fail; they belong to `rejects`."""
    return df.filter(F.col(features).isNotNull())


def rejects(df: DataFrame, reason: str = "reason") -> DataFrame:
    """The rows that an image operator could not process, with the reason."""
    return df.filter(F.col(reason).isNotNull())


def class_subset(df: DataFrame, class_col: str, names: Sequence[str]) -> DataFrame:
    """Only the named classes, with labels renumbered in alphabetical order."""
    ordered = sorted(names)
    label = as_class(class_id(F.col(class_col), ordered), ordered)
    return df.filter(F.col(class_col).isin(ordered)).select("*", label)


def rows_by_key(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows by key; positions are not stable in a distributed table, keys are."""
    return df.filter(F.col(key).isin(list(values)))


def wrong_or_right(label: str = "label", prediction: str = "prediction") -> Column:
    """True where the prediction is correct."""
    return F.col(label) == F.col(prediction)
