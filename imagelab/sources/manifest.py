"""Which files of a folder are new, changed or gone since they were last processed."""

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.functions.columns import decoded_path, label_from_path
from imagelab.session import make_folder, published
from imagelab.sources.images import extension_glob, read_images, read_labelled_images

FILES = "origin string, length bigint, modified timestamp"
NEW, CHANGED, REMOVED = "new", "changed", "removed"


def file_list(
    spark: SparkSession, path: str | list[str], extensions: Sequence[str] | None = None, names: Sequence[str] | None = None
) -> DataFrame:
    """(origin, length, modified) of the files in a folder tree, of `names` only if given; none of them is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extensions:
        reader = reader.option("pathGlobFilter", extension_glob(extensions))
    files = reader.load(path).select(
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    if names is None:
        return files
    return files.filter(label_from_path(decoded_path(F.col("origin"))).isin(list(names)))


@dataclass(frozen=True)
class Manifest:
    """A table of processed files. Every commit adds what changed, in a folder that appears as a whole.

    What is processed is written first and the commit last. A job that ends in between leaves no
    commit, so the next one gets the same number, finds the same changes, and replaces what it finds
    under that number. One job at a time may write.
    """

    spark: SparkSession
    path: str

    def rows(self) -> DataFrame:
        """(origin, length, modified, change, commit) of all commits."""
        make_folder(self.spark, self.path)
        return self.spark.read.schema(f"{FILES}, change string, commit bigint").parquet(self.path)

    def current(self) -> DataFrame:
        """(origin, length, modified, commit): the last state of every file that is not removed."""
        state = F.struct("commit", "length", "modified", "change")
        last = self.rows().groupBy("origin").agg(F.max(state).alias("last"))
        return last.filter(F.col("last.change") != REMOVED).select("origin", "last.length", "last.modified", "last.commit")

    def last_commits(self) -> DataFrame:
        """(origin, commit): the last commit of every file that is not removed.

        Like `current` without the rest, in one number, so Spark aggregates by hash and sorts nothing.
        """
        state = 2 * F.col("commit") + (F.col("change") == REMOVED).cast("int")
        last = self.rows().groupBy("origin").agg(F.max(state).alias("_state"))
        return last.filter("_state % 2 = 0").select("origin", F.shiftright("_state", 1).alias("commit"))

    def changes(self, files: DataFrame) -> DataFrame:
        """(origin, length, modified, change) of the files that are new, changed or removed since the last commit.

        A file is changed when its length or its time of modification is another. Both sides are
        narrow; nothing else of a file is looked at.
        """
        known = self.current().select(
            F.col("origin").alias("_origin"), F.col("length").alias("_length"), F.col("modified").alias("_modified")
        )
        both = files.select("origin", "length", "modified").join(known, F.col("origin") == F.col("_origin"), "full_outer")
        same = F.col("length").eqNullSafe(F.col("_length")) & F.col("modified").eqNullSafe(F.col("_modified"))
        change = F.when(F.col("origin").isNull(), REMOVED).when(F.col("_origin").isNull(), NEW).when(~same, CHANGED)
        return both.select(F.coalesce("origin", "_origin").alias("origin"), "length", "modified", change.alias("change")).filter(
            F.col("change").isNotNull()
        )

    def next_commit(self) -> int:
        last = self.rows().agg(F.max("commit")).first()[0]
        return 0 if last is None else last + 1

    def commit(self, changes: DataFrame, number: int) -> None:
        with published(self.spark, f"{self.path.rstrip('/')}/commit={number}") as folder:
            changes.select("origin", "length", "modified", "change").write.parquet(folder)


def literal_paths(origins: Sequence[str]) -> list[str]:
    """Paths for a reader, from the percent-encoded ones of a file list; no character in them is a pattern."""
    return [re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(origin)) for origin in origins]


def _to_read(changes: DataFrame) -> list[str]:
    # a file scan keeps the paths of all its files on the driver, so this list is no longer than the scan's own
    return literal_paths([r["origin"] for r in changes.filter(F.col("change") != REMOVED).select("origin").toLocalIterator()])


def changed_images(changes: DataFrame, names: Sequence[str] | None = None) -> DataFrame | None:
    """Image rows of the new and changed files alone, labelled if class names are given; None without any."""
    paths = _to_read(changes)
    if not paths:
        return None
    if names is None:
        rows = read_images(changes.sparkSession, paths, drop_invalid=False, recursive=False)
        return rows.select(F.col("image").withField("origin", F.col("_metadata.file_path")).alias("image"))  # as in the file list
    return read_labelled_images(changes.sparkSession, paths, names, drop_invalid=False, recursive=False)
