"""What several operators of this subpackage share."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from imagelab.session import materialise

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` does not use yet, in any letter case."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def col(name: str) -> Column:
    """Column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of pairs of columns, as a join condition."""
    first, *rest = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    for condition in rest:
        first = first & condition
    return first


def address(df: DataFrame) -> Column | None:
    """File and place of each row, if `df` reads files that know them; the same in every later read of `df`."""
    if "_metadata" in df.columns:
        return None
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    try:
        df.select(at).schema
    except AnalysisException:
        return None
    return at


def without_rows(df: DataFrame, at: Column, dropped: DataFrame) -> DataFrame:
    """The rows of `df` whose address `at` is not in the written list `dropped`, a column `row` of distinct addresses.

    A bounded list of hash buckets tells which rows can be meant at all. All others stay where they
    lie; only the rows in these buckets are joined with the list.
    """
    place, bucket = fresh(df, "_row"), fresh(df, "_bucket")
    named = df.withColumn(place, at).withColumn(bucket, F.pmod(F.xxhash64(col(place)), F.lit(BUCKETS)))
    hit = dropped.select(F.pmod(F.xxhash64("row"), F.lit(BUCKETS)).alias("_hit")).distinct()
    hit = F.broadcast(materialise(hit, "buckets"))  # at most BUCKETS numbers
    meant = named[bucket] == hit["_hit"]
    listed = dropped.select(F.col("row").alias("_dropped"))
    joined = named.join(hit, meant, "left_semi")
    joined = joined.join(listed, col(place) == F.col("_dropped"), "left_anti")
    columns = [col(c) for c in df.columns]
    return named.join(hit, meant, "left_anti").select(*columns).unionByName(joined.select(*columns))


def keep_listed(df: DataFrame, keys: dict[str, Column], listed: DataFrame) -> DataFrame:
    """The rows of `df` whose key values are in `listed`, one row for each listed key.

    `keys` gives the expression over `df` for each column of `listed`, whose rows are distinct.
    `df` is shuffled once by the key; the narrow list is the hashed side, so wide rows are sorted
    only to choose one of several rows that repeat a key (by a hash of the whole row).
    """
    names = {k: fresh(df, f"_{k}") for k in keys}
    listed_names = {k: fresh(df, f"_listed_{k}") for k in keys}
    number = fresh(df, "_number")
    wide = df.withColumns({names[k]: e for k, e in keys.items()})
    narrow = listed.select(*[col(k).alias(listed_names[k]) for k in keys]).hint("shuffle_hash")
    matched = wide.join(narrow, same(wide, narrow, [(names[k], listed_names[k]) for k in keys]))
    row_hash = F.xxhash64(*[col(c) for c in df.columns])
    one = Window.partitionBy(*[col(names[k]) for k in keys]).orderBy(row_hash)
    numbered = matched.withColumn(number, F.row_number().over(one))
    return numbered.filter(col(number) == 1).select(*[col(c) for c in df.columns])
