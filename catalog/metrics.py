"""Scores, accuracy and profiles."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog import query, table
from imagelab.functions import columns as fx
from imagelab.operators import metrics as ms
from imagelab.operators import sketches as sk
from imagelab.session import delete_on_exit, materialise, scratch_path

NAMES = [f"class_{i:02d}" for i in range(64)]


@query("""
SELECT vec_id, CAST(list_max(embedding) AS DOUBLE) AS confidence,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS class_id
FROM embeddings""")
def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        fx.confidence(scores).cast("double").alias("confidence"),
        fx.best_class(scores).alias("class_id"),
    )


SQL_TOP = """
ranked AS (
  SELECT vec_id, i, v, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, i) AS rank
  FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(64)) AS i FROM embeddings))"""


@query(f"""WITH {SQL_TOP}
SELECT vec_id, string_agg(i, ',' ORDER BY rank) AS top5, CAST(min(v) AS DOUBLE) AS fifth
FROM ranked WHERE rank <= 5 GROUP BY vec_id""")
def topk_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = table(spark, sf_dir, "embeddings").select("vec_id", fx.top_k(F.col("embedding"), 5).alias("best"))
    return best.select(
        "vec_id",
        F.array_join("best.class_id", ",").alias("top5"),
        F.element_at("best.score", 5).cast("double").alias("fifth"),
    )


@query(f"""WITH {SQL_TOP}
SELECT vec_id, string_agg('class_' || lpad(CAST(i AS VARCHAR), 2, '0'), ',' ORDER BY rank) AS top5
FROM ranked WHERE rank <= 5 GROUP BY vec_id""")
def topk_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = fx.named_top_k(F.col("embedding"), NAMES, 5).alias("best")
    best = table(spark, sf_dir, "embeddings").select("vec_id", named)
    return best.select("vec_id", F.array_join("best.class_name", ",").alias("top5"))


@query("""
SELECT count(*) AS "rows", count(*) FILTER (quality = toxic) AS correct,
       round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy
FROM labels""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = ms.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")
    return rates.select("rows", "correct", F.round("accuracy", 9).alias("accuracy"))


@query("""
SELECT round(1.0 - avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS test_error FROM labels""")
def test_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = ms.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")
    return rates.select(F.round("test_error", 9).alias("test_error"))


@query("SELECT DISTINCT label FROM embeddings")
def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.distinct_labels(table(spark, sf_dir, "embeddings"))


@query("""
SELECT label, count(*) AS "rows", count(*) FILTER (embedding[1] < 0) AS missing, count(*) * 3 AS cells
FROM embeddings GROUP BY label""")
def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    features = F.when(F.element_at("embedding", 1) >= 0, F.col("embedding")).alias("features")
    return ms.dataset_profile(rows.select("vec_id", "label", features), "label", "features")


@query("SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.confusion_matrix(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("""
WITH sides AS (
  SELECT quality AS class_id, 1 AS support, 0 AS given, CASE WHEN quality = toxic THEN 1 ELSE 0 END AS hits FROM labels
  UNION ALL SELECT toxic, 0, 1, 0 FROM labels),
totals AS (SELECT class_id, sum(support) AS support, sum(given) AS given, sum(hits) AS hits FROM sides GROUP BY ALL)
SELECT class_id, round(coalesce(hits / nullif(given, 0), 0.0), 9) AS precision,
       round(coalesce(hits / nullif(support, 0), 0.0), 9) AS recall,
       round(coalesce(2 * hits / nullif(given + support, 0), 0.0), 9) AS f1, CAST(support AS BIGINT) AS support
FROM totals""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ms.class_report(table(spark, sf_dir, "labels"), "quality", "toxic")
    rates = [F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("class_id", *rates, "support")


@query("""
WITH scored AS (
  SELECT c AS class_id, CAST(embedding[c + 1] AS DOUBLE) AS s, CAST(label = c AS INTEGER) AS y
  FROM embeddings, range(10) AS k(c)),
ranked AS (
  SELECT class_id, y, rank() OVER (PARTITION BY class_id ORDER BY s)
         + (count(*) OVER (PARTITION BY class_id, s) - 1) / 2.0 AS r FROM scored)
SELECT CAST(class_id AS INTEGER) AS class_id, round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0)
  / (sum(y) * (count(*) - sum(y))), 6) AS auc
FROM ranked GROUP BY class_id""")
def one_vs_rest_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten classes at once."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.slice("embedding", 1, 10).alias("scores"))
    return ms.one_vs_rest_auc(rows).select("class_id", F.round("auc", 6).alias("auc"))


@query("SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM labels")
def evaluator_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select(F.col("quality").cast("double"), F.col("toxic").cast("double"))
    rate = ms.evaluator_accuracy(rows, "quality", "toxic")
    return spark.createDataFrame([(round(rate, 9),)], "accuracy double")


def _rank_is_right(df: DataFrame, at: DataFrame, group: str, value: str, claimed: str) -> DataFrame:
    """(group, points, within): whether the claimed share of rows up to each value is that of all rows, within the error."""
    both = df.join(F.broadcast(at.withColumnRenamed(group, "_group")), F.col(group) == F.col("_group"))  # a few points a group
    counted = both.groupBy(group, "_at", claimed).agg(
        F.avg((F.col(value) <= F.col("_at")).cast("double")).alias("upto"), F.avg((F.col(value) < F.col("_at")).cast("double")).alias("below")
    )
    close = (F.col(claimed) <= F.col("upto") + sk.RANK_ERROR) & (F.col(claimed) >= F.col("below") - sk.RANK_ERROR)
    return counted.groupBy(group).agg(F.count("*").alias("points"), F.bool_and(close).alias("within"))


@query("""
WITH s AS (SELECT c AS class_id, embedding[c + 1] AS score FROM embeddings, range(10) AS k(c))
SELECT CAST(class_id AS INTEGER) AS class_id, true AS fpr_within, true AS tpr_within, true AS falls, count(*) > 0 AS any_rows
FROM s GROUP BY class_id""")
def roc_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curves of ten classes from merged sketches of two halves, against the exact rates at their thresholds."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.slice("embedding", 1, 10).alias("scores"))
    halves = [sk.score_sketches(rows.filter(F.col("vec_id") % 2 == half)) for half in (0, 1)]
    curve = materialise(sk.roc_curve(sk.merged_score_sketches(halves[0].unionByName(halves[1])), 20), "curve")
    each = rows.select("label", F.posexplode("scores").alias("class_id", "score")).withColumn("score", F.col("score").cast("double"))
    sides = {"fpr": F.col("label") != F.col("class_id"), "tpr": F.col("label") == F.col("class_id")}
    checked = None
    for rate, side in sides.items():
        at = curve.filter(F.col("threshold") > float("-inf")).select("class_id", F.col("threshold").alias("_at"), (1 - F.col(rate)).alias("_share"))
        found = _rank_is_right(each.filter(side), at, "class_id", "score", "_share").select("class_id", F.col("within").alias(f"{rate}_within"))
        checked = found if checked is None else checked.join(found, "class_id")
    line = Window.partitionBy("class_id").orderBy("threshold")
    falls = curve.withColumn("_ok", F.coalesce((F.lag("fpr").over(line) >= F.col("fpr")) & (F.lag("tpr").over(line) >= F.col("tpr")), F.lit(True)))
    shape = falls.groupBy("class_id").agg(F.bool_and("_ok").alias("falls"), (F.count("*") > 0).alias("any_rows"))
    return checked.join(shape, "class_id").select("class_id", "fpr_within", "tpr_within", "falls", "any_rows")


@query("""
SELECT l_returnflag, count(*) AS n, CAST(9 AS BIGINT) AS points, true AS within FROM lineitem GROUP BY l_returnflag""")
def size_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles of a size from a profile that was written in two parts, against the exact shares."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", (F.col("l_partkey") * 7 + F.col("l_orderkey")).alias("size"))
    path = scratch_path(spark, "profile")
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    for status in ("F", "O"):
        part = lines.filter(F.col("l_linestatus") == status)
        sk.append_profile(sk.size_sketches(part, "l_returnflag", {"size": F.col("size")}), path, status)
    deciles = sk.size_quantiles(sk.read_profile(spark, path), [i / 10 for i in range(1, 10)])
    at = deciles.select("l_returnflag", F.col("size").alias("_at"), "share")
    checked = _rank_is_right(lines, at, "l_returnflag", "size", "share").withColumnRenamed("l_returnflag", "_flag")
    counts = deciles.select("l_returnflag", "n").distinct()
    return counts.join(checked, F.col("l_returnflag") == F.col("_flag")).select("l_returnflag", "n", "points", "within")
