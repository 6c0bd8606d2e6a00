"""Column expressions. All of them are built-in Spark expressions and run in the JVM."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from imagelab.schemas import IMAGE_EXTENSIONS


def _names(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def label_from_path(path: Column) -> Column:
    """Name of the parent folder, whatever the depth of the path; null if there is none."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def decoded_path(path: Column) -> Column:
    """A file path as Spark's metadata column gives it, with its percent-encoding undone."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))  # a plus in a path is no space


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def allowed_extension(path: Column, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> Column:
    """True when the text after the last dot is in the list, ignoring case; no dot is false."""
    last = F.lower(F.regexp_extract(path, r"\.([^.]*)$", 1))
    return last.isin([e.lower() for e in extensions])


def class_id(name: Column, names: Sequence[str]) -> Column:
    """Position of `name` in a given class list, counted from 0; null for unknown names."""
    return (F.nullif(F.array_position(_names(names), name), F.lit(0)) - 1).cast("int")


def class_name(class_id: Column, names: Sequence[str]) -> Column:
    """Inverse of `class_id`; null outside the list."""
    position = F.when(class_id >= 0, class_id.cast("int") + 1)
    return F.try_element_at(_names(names), position)


def as_class(label: Column, names: Sequence[str], alias: str = "label") -> Column:
    """Label column that carries its class names, which saves the estimators a counting pass."""
    return label.alias(alias, metadata={"ml_attr": {"type": "nominal", "name": alias, "vals": list(names)}})


def hash_bucket(key: Column, salt: str = "") -> Column:
    """Bucket 0..99 from the md5 of a row key: the same on every run, cluster and partitioning.

    A null key has the bucket of an empty one.
    """
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def confidence(scores: Column) -> Column:
    """Largest class score."""
    return F.array_max(scores)


def best_class(scores: Column) -> Column:
    """Id of the largest score, the lower id on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def top_k(scores: Column, k: int = 5) -> Column:
    """The k best classes as array<struct<class_id,score>>, best first, lower id first on ties."""
    keyed = F.transform(scores, lambda v, i: F.struct((-v).alias("rank"), i.alias("class_id")))
    best = F.slice(F.array_sort(keyed), 1, k)
    return F.transform(
        best, lambda s: F.struct(s["class_id"].alias("class_id"), (-s["rank"]).alias("score"))
    )


def named_top_k(scores: Column, names: Sequence[str], k: int = 5) -> Column:
    """`top_k` with class names instead of ids."""
    return F.transform(
        top_k(scores, k),
        lambda s: F.struct(
            F.try_element_at(_names(names), s["class_id"] + 1).alias("class_name"),
            s["score"].alias("score"),
        ),
    )


def one_hot(class_id: Column, classes: int) -> Column:
    """array<int> of width `classes` with a 1 at the class id."""
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == class_id).cast("int"))
