"""Exact deduplication with the frequent texts split off before the shuffle.

Texts are equal when they are identical after every run of white space became one space; null
counts as empty. Digests are written once as a narrow table. A Misra-Gries summary (Spark's
`approx_top_k`, a bounded frequent-items sketch that merges across tasks) names the digests that
may be frequent; their exact winners and sizes are verified by one partially aggregated pass and
broadcast, so their rows are resolved where they lie. The rest goes through an ordinary shuffle by
digest, where a group can hold only a small share of the rows: a digest with more than about
3.5 / `tracked` of all rows cannot escape the summary.

Defined results: null text equals empty text; the row with the smallest id stays, null ids come
last; of rows that repeat id and text exactly one stays; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from imagelab.llm.common import SPACES, address, col, keep_listed, without_rows
from imagelab.session import materialise

TRACKED = 4096  # counters of the summary in each task; the bound on what it reports
REPORTED = 1024  # frequent digests at most, so the broadcast has at most as many rows
LEAST_COPIES = 64  # below this estimate a digest is left to the shuffle


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def digest_table(df: DataFrame, id_col: str, text_col: str, row: Column | None = None) -> DataFrame:
    """(id, digest, row): the written narrow table that all later passes read; `row` tells rows apart."""
    rows = df.select(
        col(id_col).alias("id"),
        digest(col(text_col)).alias("digest"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )
    return materialise(rows, "digests")


def frequent_keys(digests: DataFrame, tracked: int = TRACKED, reported: int = REPORTED) -> DataFrame:
    """(key): 64-bit keys of the digests that may be frequent, at most `reported` rows."""
    lanes = F.pmod(F.spark_partition_id(), F.lit(32)).alias("lane")  # two levels: no task merges all sketches
    summaries = (
        digests.select(lanes, F.xxhash64("digest").alias("key"))
        .groupBy("lane")
        .agg(F.expr(f"approx_top_k_accumulate(key, {tracked})").alias("summary"))
    )
    # grouped by one value: an ungrouped combine fails on tasks without rows
    one = (F.col("lane") < 0).alias("one")
    merged = summaries.groupBy(one).agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
    top = merged.select(F.expr(f"inline(approx_top_k_estimate(summary, {reported}))"))
    return top.filter(F.col("count") >= LEAST_COPIES).select(F.col("item").alias("key"))


def _first_row() -> Column:
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))


def resolve(digests: DataFrame) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, row): the fate of every row of a digest table."""
    suspects = F.broadcast(materialise(frequent_keys(digests), "suspects"))  # at most REPORTED rows
    suspected = digests.join(suspects, F.xxhash64("digest") == suspects["key"], "left_semi")
    exact = suspected.groupBy("digest").agg(_first_row().alias("first"), F.count("*").alias("size"))
    hot = F.broadcast(materialise(exact, "winners"))  # one row for each suspect
    whole_group = Window.partitionBy("digest")
    frequent = digests.join(hot, "digest")
    ordinary = digests.join(hot, "digest", "left_anti").select(
        "*", _first_row().over(whole_group).alias("first"), F.count("*").over(whole_group).alias("size")
    )
    return frequent.unionByName(ordinary).select(
        "id",
        F.col("first.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
        "row",
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, digest, row), one row for each row of `df`."""
    return resolve(digest_table(df, id_col, text_col))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, with all their columns.

    Rows of files are told apart by their place in them, so digests are computed once and no row is
    shuffled but those near a dropped one; of rows that repeat id and text the first one by place stays.
    Other frames are joined with the list of what stays, and a hash of the whole row chooses.
    """
    at = address(df)
    if at is not None:
        fate = resolve(digest_table(df, id_col, text_col, at))
        return without_rows(df, at, materialise(fate.filter("NOT kept").select("row"), "dropped"))
    kept = exact_duplicates(df, id_col, text_col).filter("kept").select(F.col("id"), F.col("digest"))
    return keep_listed(df, {"id": col(id_col), "digest": digest(col(text_col))}, kept)
