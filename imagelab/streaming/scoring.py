"""Score a stream of features or uploaded images."""

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from imagelab.plans.scoring import score_features, score_images
from imagelab.session import published


def score_stream(
    stream: DataFrame, model: PipelineModel, names: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Predictions of a feature stream. Stateless, so late and repeated triggers need no state."""
    return score_features(stream, model, names, keep)


def score_image_stream(stream: DataFrame, model: PipelineModel, names: Sequence[str] | None = None) -> DataFrame:
    """Predictions of an image stream, by a model that begins with an image featurizer."""
    return score_images(stream, model, names)


def running_hits(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows and hits per label so far; state is one row per label."""
    return scored.groupBy(label).agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == F.col(prediction)).alias("hits")
    )


def run_available_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, and leave the totals so far as a table that each batch replaces by a finished one."""

    def replace(batch: DataFrame, _: int) -> None:
        with published(batch.sparkSession, path) as folder:
            batch.write.parquet(folder)

    query = (
        totals.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_available(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop. A restart with the same checkpoint adds only new rows."""
    query = (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
