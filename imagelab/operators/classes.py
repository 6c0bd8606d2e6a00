"""Class dictionary, labels from it, per-class caps, unions of class frames, splits."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from imagelab.functions.columns import hash_bucket
from imagelab.operators.indexing import with_global_index
from imagelab.session import materialise


def class_dictionary(df: DataFrame, class_col: str) -> DataFrame:
    """(class_id, class_name): distinct names numbered from 0 in alphabetical order."""
    names = df.select(F.col(class_col).alias("class_name")).dropna().distinct()
    numbered = with_global_index(names, ["class_name"])
    ids = (F.col("idx") - 1).cast("int").alias("class_id")
    return materialise(numbered.select(ids, "class_name"), "dictionary")


def with_label(df: DataFrame, dictionary: DataFrame, class_col: str, alias: str = "label") -> DataFrame:
    """Label by dictionary; null for names it does not hold.

    The dictionary is a written table, so Spark knows its size and broadcasts it while it is
    under `spark.sql.autoBroadcastJoinThreshold`; beyond that the join shuffles.
    """
    ids = dictionary.select(F.col("class_id").alias(alias), F.col("class_name").alias("_name"))
    return df.join(ids, F.col(class_col) == F.col("_name"), "left").drop("_name")


def with_class_name(df: DataFrame, dictionary: DataFrame, id_col: str, alias: str = "class_name") -> DataFrame:
    """Class name of an id or of a model's (double) prediction."""
    names = dictionary.select(F.col("class_id").alias("_id"), F.col("class_name").alias(alias))
    return df.join(names, F.col(id_col).cast("int") == F.col("_id"), "left").drop("_id")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union of the frames of all classes, by column name; None for an empty list."""
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def cap_bounds(df: DataFrame, class_col: str, key: str, rows: int) -> DataFrame:
    """(class, no_key, last_key): the last key to keep of every class that has more than `rows` rows.

    Only the two narrow columns are read. They are numbered by one distributed sort, so no task
    sees a whole class, however large the class or the cap is. Null keys come last.
    """
    slim = df.select(F.col(class_col).alias("class"), F.col(key).alias("last_key"))
    order = [F.col("class").asc_nulls_last(), F.col("last_key").asc_nulls_last()]
    numbered = with_global_index(slim, order)
    begins = numbered.groupBy("class").agg(F.min("idx").alias("begin"))
    joined = numbered.join(begins.withColumnRenamed("class", "_class"), F.col("class").eqNullSafe(F.col("_class")))
    cut = joined.filter(F.col("idx") == F.col("begin") + rows - 1)
    return materialise(cut.select("class", F.col("last_key").isNull().alias("no_key"), "last_key"), "bounds")


def within_bound(key: Column, no_key: Column, last_key: Column) -> Column:
    """Whether a key is not behind the last one to keep; a null key is behind all others."""
    return no_key | F.coalesce(key <= last_key, F.lit(False))


def cap_per_class(df: DataFrame, class_col: str, key: str, rows: int) -> DataFrame:
    """The first `rows` rows of every class by key, null keys last; rows that tie with the last one stay too.

    The wide rows are only filtered by the last key of their class and never sorted.
    """
    bounds = cap_bounds(df, class_col, key, rows)
    joined = df.join(bounds, F.col(class_col).eqNullSafe(F.col("class")), "left")
    kept = F.col("no_key").isNull() | within_bound(F.col(key), F.col("no_key"), F.col("last_key"))
    return joined.filter(kept).select(*[df[c] for c in df.columns])


def with_bucket(df: DataFrame, key: Column, salt: str = "", alias: str = "bucket") -> DataFrame:
    return df.withColumn(alias, hash_bucket(key, salt))


def hash_split(
    df: DataFrame, key: Column, train_percent: int = 70, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of a stable row key; reproducible and free of shuffles."""
    bucket = hash_bucket(key, salt)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


DIGIT = 3  # hexadecimal digits of the key hash that one round looks at: 4,096 counts for each class


def share_bounds(df: DataFrame, class_col: str, key: Column, percent: int, salt: str = "") -> DataFrame:
    """(class, bound): hashes up to `bound`, by prefix, are those of exactly floor(percent / 100 * n) rows of the class.

    The hash that parts a class is found by radix selection: rows are counted by the first digits of
    their hash, the digit where the wanted count is reached is opened, and its rows counted by the next
    ones, until the count is met exactly, which takes two or three rounds. Each round is one aggregate
    over narrow rows; nothing is sorted. Rows of one key are never parted: if only some of them fit, none are
    taken. A class of which nothing is taken has no bound.
    """
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    rows = materialise(df.select(F.col(class_col).alias("class"), digest.alias("digest")), "digests")
    wanted = F.floor(F.count("*") * percent / 100)
    state = materialise(rows.groupBy("class").agg(wanted.cast("bigint").alias("left")).withColumns({"prefix": F.lit(""), "met": F.col("left") == 0}), "bounds")
    for depth in range(0, 32, DIGIT):
        is_open = state.filter("NOT met").select(F.col("class").alias("_class"), "prefix", "left")
        if is_open.isEmpty():
            break
        inside = rows.join(is_open, F.col("class").eqNullSafe(F.col("_class")) & (F.substring("digest", 1, depth) == F.col("prefix")))
        digit = F.substring("digest", 1, depth + DIGIT)
        counts = inside.groupBy("class", "left", digit.alias("next")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("class").orderBy("next"))  # at most 4,096 rows of a class
        line = counts.withColumn("upto", upto)
        reached = line.filter((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
        before = F.col("upto") - F.col("n")
        met = F.col("upto") == F.col("left")
        found = reached.select("class", (F.col("left") - before).alias("left"), F.col("next").alias("prefix"), met.alias("met"))
        state = materialise(state.filter("met").unionByName(found), "bounds")
    # what is not met after the whole hash is one key with more rows than fit: it stays out, by a bound just below
    bound = F.when(F.col("met"), F.col("prefix")).otherwise(F.concat(F.col("prefix"), F.lit("<")))
    return materialise(state.filter("prefix <> ''").select("class", bound.alias("bound")), "bounds")


def exact_split(df: DataFrame, class_col: str, key: Column, percent: int = 70, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly floor(percent / 100 * n) training rows of every class, by the hash of a unique row key.

    The wide rows are only filtered, by the bound of their class: one row for each class, which Spark
    broadcasts by its size.
    """
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    bounds = share_bounds(df, class_col, key, percent, salt).select(F.col("class").alias("_class"), F.col("bound").alias("_bound"))
    joined = df.withColumn("_digest", digest).join(bounds, F.col(class_col).eqNullSafe(F.col("_class")), "left")
    whole = ~F.col("_bound").endswith("<")
    plain = F.rtrim(F.col("_bound"), F.lit("<"))
    first = F.substring(F.col("_digest"), F.lit(1), F.length(plain))
    taken = F.coalesce((first < plain) | (whole & (first == plain)), F.lit(False))
    columns = [df[c] for c in df.columns]
    return joined.filter(taken).select(*columns), joined.filter(~taken).select(*columns)


def random_split(df: DataFrame, train_percent: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Spark's own sampling split; it depends on the partitioning of `df` besides the seed."""
    train, test = df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
    return train, test


def spread(df: DataFrame, partitions: int, key: Sequence[str] = ()) -> DataFrame:
    """Repartition, by a unique key so that the placement survives the retry of a lost task."""
    return df.repartition(partitions, *key)


def first_rows(df: DataFrame, order_by: Sequence[Column | str], rows: int) -> DataFrame:
    """Top rows by an explicit order."""
    return df.orderBy(*order_by).limit(rows)
