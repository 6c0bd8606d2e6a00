"""The model registry: one row per training run, in parquet files or behind JDBC."""

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.operators.classes import union_frames
from imagelab.operators.indexing import with_global_index
from imagelab.schemas import REGISTRY, REGISTRY_ORDER
from imagelab.session import make_folder, published


@dataclass(frozen=True)
class ParquetRegistry:
    """Registry folder, partitioned by algorithm so that one algorithm is read alone.

    Each append commits into a sub-folder of its own: jobs that log at the same time would
    otherwise remove each other's temporary files. It appears as a whole or, if it fails, not at all.
    """

    spark: SparkSession
    path: str

    def create(self) -> None:
        """Create the empty table if there is none."""
        make_folder(self.spark, self.path)

    def append(self, runs: DataFrame) -> None:
        with published(self.spark, f"{self.path.rstrip('/')}/append={uuid.uuid4()}") as folder:
            runs.select(REGISTRY.names).write.partitionBy("algorithm").parquet(folder)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(REGISTRY).parquet(self.path).select(REGISTRY.names)


@dataclass(frozen=True)
class JdbcRegistry:
    """Registry table in a database. Url, table, driver and credentials come from the caller."""

    spark: SparkSession
    options: dict[str, str] = field(repr=False)

    def create(self) -> None:
        """Create the empty table if there is none."""
        empty = self.spark.createDataFrame([], REGISTRY)
        empty.write.format("jdbc").options(**self.options).mode("ignore").save()

    def append(self, runs: DataFrame) -> None:
        runs.select(REGISTRY.names).write.format("jdbc").options(**self.options).mode("append").save()

    def rows(self) -> DataFrame:
        """The whole table, with whatever columns it has."""
        return self.spark.read.format("jdbc").options(**self.options).load()


Registry = ParquetRegistry | JdbcRegistry


def log_run(
    registry: Registry, algorithm: str, model: str, accuracy: float, elapsed: float, model_path: str
) -> str:
    """Append one run and return its id."""
    run_id = str(uuid.uuid4())
    row = registry.spark.createDataFrame(
        [(run_id, model, accuracy, elapsed, model_path, None, algorithm)], REGISTRY
    )
    registry.append(row.coalesce(1).withColumn("created_at", F.current_timestamp()))
    return run_id


def runs_of_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Runs from one registry table per algorithm, ready for `append` or `listing`.

    The tables have the columns id, model, accuracy, elapsed_time, hdfs_path and created_at. Ids
    are padded, so that they sort as numbers.
    """
    frames = [
        rows.select(
            F.lpad(F.col("id").cast("string"), 12, "0").alias("run_id"),
            "model",
            F.col("accuracy").cast("double").alias("accuracy"),
            F.col("elapsed_time").cast("double").alias("elapsed_time"),
            F.col("hdfs_path").alias("model_path"),
            F.col("created_at").cast("timestamp").alias("created_at"),
            F.lit(algorithm).alias("algorithm"),
        )
        for algorithm, rows in tables.items()
    ]
    return union_frames(frames)


def _place(order: Sequence[str]) -> Column:
    """Place of the algorithm in the listing; algorithms outside the list come last."""
    position = F.array_position(F.array(*[F.lit(a) for a in order]), F.col("algorithm"))
    return F.coalesce(F.nullif(position, F.lit(0)), F.lit(len(order) + 1))


def listing(rows: DataFrame, order: Sequence[str] = REGISTRY_ORDER) -> DataFrame:
    """All runs numbered from 1: by algorithm in the given order, then by time, then by id."""
    numbered = with_global_index(
        rows.withColumn("_place", _place(order)), ["_place", "algorithm", "created_at", "run_id"]
    )
    return numbered.select("idx", "created_at", "elapsed_time", "model_path", "accuracy", "model", "run_id")


def listing_json(numbered: DataFrame) -> DataFrame:
    """The listing as one JSON document per run, for an API edge."""
    return numbered.select("idx", F.to_json(F.struct(*numbered.columns)).alias("value"))


def parse_index(value: str | int | None) -> int:
    """Model number from outside; ValueError says what is wrong with it."""
    if value is None:
        raise ValueError("the model number is missing")
    try:
        index = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"the model number is not an integer: {value!r}") from None
    if index < 1:
        raise ValueError(f"model numbers start at 1: {index}")
    return index


def find(numbered: DataFrame, indexes: Sequence[int]) -> DataFrame:
    """Listing rows by number; numbers outside the listing give no row."""
    return numbered.filter(F.col("idx").isin(list(indexes)))


def find_one(numbered: DataFrame, value: str | int | None) -> tuple[str, str]:
    """(model_path, model) of one run; LookupError beyond the end of the listing."""
    index = parse_index(value)
    row = find(numbered, [index]).select("model_path", "model").first()
    if row is None:
        raise LookupError(f"no model number {index}")
    return row["model_path"], row["model"]
