"""The model registry, with `events` as its runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from imagelab.session import delete_on_exit, scratch_path
from imagelab.sources import registry as rg

ORDER = ["purchase", "click", "view"]  # the remaining types follow by name
SQL_NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER (ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2
    WHEN 'view' THEN 3 ELSE 4 END, event_type, ts, lpad(CAST(event_id AS VARCHAR), 12, '0')) AS idx
  FROM events)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a training run."""
    return table(spark, sf_dir, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("run_id"),
        F.initcap("event_type").alias("model"),
        F.col("value").alias("accuracy"),
        F.col("user_id").cast("double").alias("elapsed_time"),
        F.concat(F.lit("/models/"), "event_type", F.lit("/"), "event_id").alias("model_path"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_type").alias("algorithm"),
    )


def _micros() -> F.Column:
    return F.unix_micros("created_at").alias("created_us")


@query("""
SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id, event_type AS algorithm, value AS accuracy,
       epoch_us(ts) AS created_us
FROM events""")
def registry_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, append twice, read back."""
    path = scratch_path(spark, "registry")
    registry = rg.ParquetRegistry(spark, path)
    registry.create()
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    bought = F.col("algorithm") == "purchase"
    registry.append(runs(spark, sf_dir).filter(bought))
    registry.append(runs(spark, sf_dir).filter(~bought))
    return registry.rows().select("run_id", "algorithm", "accuracy", _micros())


@query(f"""WITH {SQL_NUMBERED}
SELECT idx, epoch_us(ts) AS created_us, CAST(user_id AS DOUBLE) AS elapsed_time,
       '/models/' || event_type || '/' || event_id AS model_path, value AS accuracy,
       upper(event_type[1]) || event_type[2:] AS model
FROM numbered""")
def registry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = rg.listing(runs(spark, sf_dir), ORDER)
    return numbered.select("idx", _micros(), "elapsed_time", "model_path", "accuracy", "model")


@query(f"""WITH {SQL_NUMBERED}
SELECT idx, '/models/' || event_type || '/' || event_id AS model_path
FROM numbered WHERE idx IN (0, 1, (SELECT count(*) FROM events), (SELECT count(*) + 1 FROM events))""")
def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First, last, and the two numbers just outside the listing."""
    numbered = rg.listing(runs(spark, sf_dir), ORDER)
    last = numbered.count()
    return rg.find(numbered, [0, 1, last, last + 1]).select("idx", "model_path")


@query(f"""WITH {SQL_NUMBERED}
SELECT idx, event_type AS model, '/models/' || event_id AS model_path FROM numbered""")
def registry_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per algorithm, united and listed."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("model"),
        F.col("value").alias("accuracy"),
        F.lit(0.0).alias("elapsed_time"),
        F.concat(F.lit("/models/"), "event_id").alias("hdfs_path"),
        F.col("ts").alias("created_at"),
    )
    kinds = sorted(r.model for r in events.select("model").distinct().collect())  # one table for each
    tables = {kind: events.filter(F.col("model") == kind) for kind in kinds}
    return rg.listing(rg.runs_of_tables(tables), ORDER).select("idx", "model", "model_path")
