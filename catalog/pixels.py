"""Pixel operators, featurizers and batch scoring on images derived from `embeddings`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.standins import SQL_BYTES, SQL_MIXED, images, mixed_images
from imagelab.functions import columns as fx
from imagelab.functions.predictors import GridColour, LinearColour
from imagelab.operators import filters
from imagelab.operators import images as ops
from imagelab.operators.classes import spread
from imagelab.session import delete_on_exit, scratch_path
from imagelab.sources.images import write_table

# Every pixel of the 8 x 8 images: place p, channel c (0 = R, 1 = G, 2 = B) and value v.
SQL_PIXELS = f"""{SQL_BYTES},
places AS (SELECT vec_id, p, q[p + 1] AS q FROM bytes, range(64) AS r(p)),
pixels AS (
  SELECT vec_id, p, c, CASE c WHEN 0 THEN 255 - q WHEN 1 THEN q // 2 ELSE q END AS v
  FROM places, range(3) AS k(c))"""


def _checksum(floats: Column) -> Column:
    """Sum of place x value, which sees both a wrong value and a wrong order."""
    weighted = F.transform(floats, lambda v, i: v.cast("bigint") * (i + 1))
    return F.aggregate(weighted, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _total(floats: Column) -> Column:
    return F.aggregate(floats, F.lit(0.0), lambda s, x: s + x.cast("double"))


@query(f"""WITH {SQL_MIXED} SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM mixed GROUP BY ALL""")
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = mixed_images(spark, sf_dir).select("vec_id", ops.rgb_pixels("image").alias("_p"))
    reason = F.coalesce("_p.reason", F.lit("ok"))
    return decoded.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {SQL_MIXED} SELECT vec_id, reason FROM mixed WHERE reason IS NOT NULL""")
def reject_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    resized = ops.resized_table(mixed_images(spark, sf_dir), 4, 4, "nearest")
    return filters.rejects(resized).select("vec_id", "reason")


@query(f"""WITH {SQL_BYTES}
SELECT vec_id, 192 AS n,
  CAST(list_sum(list_transform(q, lambda x, i: x * (3 * i - 2) + (x // 2) * (3 * i - 1) + (255 - x) * 3 * i))
       AS BIGINT) AS checksum
FROM bytes""")
def raw_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = images(spark, sf_dir).select("vec_id", ops.raw_floats("image.data").alias("raw"))
    return raw.select("vec_id", F.size("raw").alias("n"), _checksum(F.col("raw")).alias("checksum"))


@query(f"""WITH {SQL_PIXELS}
SELECT vec_id, CAST(sum(CASE WHEN p = 0 AND c = 0 THEN v END) AS INTEGER) AS first_red,
       CAST(sum(v * (3 * p + c + 1)) AS BIGINT) AS checksum
FROM pixels GROUP BY vec_id""")
def bgr_to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rgb = images(spark, sf_dir).select("vec_id", ops.rgb_pixels("image").alias("_p"))
    raw = rgb.select("vec_id", ops.raw_floats("_p.pixels").alias("raw"))
    first = F.element_at("raw", 1).cast("int").alias("first_red")
    return raw.select("vec_id", first, _checksum(F.col("raw")).alias("checksum"))


@query(f"""WITH {SQL_MIXED},
sums AS (SELECT vec_id, channels, avg(x) AS b, avg(x // 2) AS half, avg(255 - x) AS rest
         FROM (SELECT vec_id, channels, unnest(q) AS x FROM mixed WHERE reason IS NULL) GROUP BY ALL)
SELECT vec_id, CASE WHEN channels = 1 THEN b ELSE rest END AS r,
       CASE WHEN channels = 1 THEN b ELSE half END AS g, b
FROM sums""")
def to_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray, colour and alpha images of different shapes, all as R,G,B."""
    rgb = mixed_images(spark, sf_dir).select("vec_id", ops.rgb_pixels("image").alias("_p"))
    means = rgb.select("vec_id", ops.opened(ops.channel_means("_p.pixels")))
    return means.filter("reason IS NULL").drop("reason")


@query(f"""WITH {SQL_BYTES}
SELECT vec_id, list_avg(list_transform(q, lambda x: 255 - x)) AS r,
       list_avg(list_transform(q, lambda x: x // 2)) AS g, list_avg(q) AS b
FROM bytes""")
def pixel_channel_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rgb = images(spark, sf_dir).select("vec_id", ops.rgb_pixels("image").alias("_p"))
    return rgb.select("vec_id", ops.opened(ops.channel_means("_p.pixels"))).drop("reason")


def _resized(spark: SparkSession, sf_dir: str, height: int, width: int, method: str) -> DataFrame:
    table = ops.resized_table(images(spark, sf_dir), height, width, method)
    raw = table.select("vec_id", ops.raw_floats("pixels").alias("raw"))
    return raw.select("vec_id", F.size("raw").alias("n"), _checksum(F.col("raw")).alias("checksum"))


@query(f"""WITH {SQL_PIXELS}
SELECT vec_id, 48 AS n, CAST(sum(v * (3 * (4 * (p // 16) + (p % 8) // 2) + c + 1)) AS BIGINT) AS checksum
FROM pixels WHERE (p // 8) % 2 = 1 AND p % 2 = 1 GROUP BY vec_id""")
def resize_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 to 4 x 4: pixel centres fall on the odd rows and columns."""
    return _resized(spark, sf_dir, 4, 4, "nearest")


@query(f"""WITH {SQL_PIXELS}
SELECT vec_id, label, 4 * 4 * 3 AS n,
       CAST(sum(v * (3 * (4 * (p // 16) + (p % 8) // 2) + c + 1)) AS BIGINT) AS checksum
FROM pixels JOIN embeddings USING (vec_id) WHERE (p // 8) % 2 = 1 AND p % 2 = 1 GROUP BY ALL""")
def resized_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of resized images, written and read back."""
    path = scratch_path(spark, "resized")
    write_table(ops.resized_table(images(spark, sf_dir), 4, 4, "nearest"), path)
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    raw = spark.read.parquet(path).select("vec_id", "label", ops.raw_floats("pixels").alias("raw"))
    return raw.select("vec_id", "label", F.size("raw").alias("n"), _checksum(F.col("raw")).alias("checksum"))


def _resample_sql(height: int, width: int, reach: float, kernel: str) -> str:
    """Separable resampling of the 8 x 8 images with 22-bit weights, columns before rows."""
    weights = []
    for axis, size in (("wx", width), ("wy", height)):
        stretch = max(8 / size, 1.0)
        weights.append(f"""
{axis} AS (
  SELECT t, s, trunc(w * 4194304 + CASE WHEN w < 0 THEN -0.5 ELSE 0.5 END) AS w FROM (
    SELECT t, s, k / sum(k) OVER (PARTITION BY t) AS w FROM (
      SELECT t, s, {kernel} AS k FROM (
        SELECT t, s, abs((s - (t + 0.5) * {8 / size} + 0.5) / {stretch}) AS x
        FROM range({size}) AS a(t), range(8) AS b(s)
        WHERE s >= floor(greatest((t + 0.5) * {8 / size} - {reach * stretch} + 0.5, 0))
          AND s < floor((t + 0.5) * {8 / size} + {reach * stretch} + 0.5)))))""")
    return f"""WITH {SQL_PIXELS}, {weights[0]}, {weights[1]},
across AS (
  SELECT vec_id, c, p // 8 AS y, t AS tx,
         greatest(0, least(255, floor(CAST(sum(v * w) AS DOUBLE) / 4194304 + 0.5))) AS v
  FROM pixels JOIN wx ON s = p % 8 GROUP BY ALL),
down AS (
  SELECT vec_id, c, tx, t AS ty,
         greatest(0, least(255, floor(CAST(sum(v * w) AS DOUBLE) / 4194304 + 0.5))) AS v
  FROM across JOIN wy ON s = y GROUP BY ALL)
SELECT vec_id, {height * width * 3} AS n,
       CAST(sum(v * (3 * ({width} * ty + tx) + c + 1)) AS BIGINT) AS checksum
FROM down GROUP BY vec_id"""


@query(_resample_sql(5, 3, 1.0, "greatest(1 - x, 0)"))
def resize_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resized(spark, sf_dir, 5, 3, "bilinear")


SQL_CUBIC = """CASE WHEN x < 1 THEN (1.5 * x - 2.5) * x * x + 1
  WHEN x < 2 THEN ((-0.5 * x + 2.5) * x - 4) * x + 2 ELSE 0 END"""


@query(_resample_sql(5, 3, 2.0, SQL_CUBIC))
def resize_bicubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resized(spark, sf_dir, 5, 3, "bicubic")


@query(_resample_sql(12, 9, 2.0, SQL_CUBIC))
def enlarge_bicubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resized(spark, sf_dir, 12, 9, "bicubic")


def _scaled(spark: SparkSession, sf_dir: str, scaling: str, digits: int) -> DataFrame:
    """Checksum of the scaled values in units of the given decimal; no value falls on a half unit."""
    rgb = images(spark, sf_dir).select("vec_id", ops.rgb_pixels("image").alias("_p"))
    scaled = rgb.select("vec_id", ops.opened(ops.scaled_floats("_p.pixels", scaling)))
    units = F.transform("values", lambda v: F.floor(v.cast("double") * 10**digits + 0.5))
    return scaled.select("vec_id", F.size("values").alias("n"), _checksum(units).alias("checksum"))


@query(f"""WITH {SQL_PIXELS}
SELECT vec_id, 192 AS n, CAST(sum(floor((v / 127.5 - 1) * 10000 + 0.5) * (3 * p + c + 1)) AS BIGINT) AS checksum
FROM pixels GROUP BY vec_id""")
def scale_inception(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "inception", 4)


@query(f"""WITH {SQL_PIXELS}, means(c, mean) AS (VALUES (0, 123.68), (1, 116.779), (2, 103.939))
SELECT vec_id, 192 AS n,
       CAST(sum(floor(CAST(v - mean AS DOUBLE) * 100 + 0.5) * (3 * p + 2 - c + 1)) AS BIGINT) AS checksum
FROM pixels JOIN means USING (c) GROUP BY vec_id""")
def scale_resnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "resnet", 2)


@query(f"""WITH {SQL_PIXELS},
cells AS (
  SELECT vec_id, 6 * (p // 32) + 3 * ((p % 8) // 4) + c AS place, avg(v) AS f FROM pixels GROUP BY ALL),
histogram AS (
  SELECT vec_id, 12 + 4 * c + b AS place, avg(CASE WHEN v // 64 = b THEN 1.0 ELSE 0.0 END) AS f
  FROM pixels, range(4) AS k(b) GROUP BY vec_id, c, b),
features AS (SELECT * FROM cells UNION ALL SELECT * FROM histogram)
SELECT vec_id, count(*) AS width, CAST(sum(f * (place + 1)) AS DOUBLE) AS checksum
FROM features GROUP BY vec_id""")
def embed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.feature_table(
        images(spark, sf_dir), ["vec_id"], make_predict_fn=GridColour(2, 4), height=8, width=8
    )
    weighted = F.transform("features", lambda v, i: v.cast("double") * (i + 1))
    return features.select(
        "vec_id", F.size("features").cast("bigint").alias("width"), _total(weighted).alias("checksum")
    )


def _grid_sql(grid: int, bins: int) -> str:
    """Checksum of cell means and histograms of the 8 x 8 pixels; every cell has whole pixels."""
    side = 8 // grid
    return f"""WITH {SQL_PIXELS},
cells AS (
  SELECT vec_id, {3 * grid} * (p // {8 * side}) + 3 * ((p % 8) // {side}) + c AS place, avg(v) AS f FROM pixels GROUP BY ALL),
histogram AS (
  SELECT vec_id, {3 * grid * grid} + {bins} * c + b AS place, avg(CASE WHEN v * {bins} // 256 = b THEN 1.0 ELSE 0.0 END) AS f
  FROM pixels, range({bins}) AS k(b) GROUP BY vec_id, c, b),
features AS (SELECT * FROM cells UNION ALL SELECT * FROM histogram)
SELECT vec_id, count(*) AS width, round(CAST(sum(f * (place + 1)) AS DOUBLE), 2) AS checksum
FROM features GROUP BY vec_id"""


def _grid_checksum(rows: DataFrame, features: str) -> DataFrame:
    weighted = F.transform(features, lambda v, i: v.cast("double") * (i + 1))
    return rows.select(
        "vec_id", F.size(features).cast("bigint").alias("width"), F.round(_total(weighted), 2).alias("checksum")
    )


def _spread_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small images over all cores, before they grow."""
    return spread(images(spark, sf_dir), spark.sparkContext.defaultParallelism, ["vec_id"])


@query(_grid_sql(8, 4))
def resize_224(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 to 224 x 224: every block of 28 x 28 pixels has the mean of the pixel it comes from."""
    resized = ops.resized_table(_spread_images(spark, sf_dir), 224, 224, "nearest")
    means = ops.predict_pixels("pixels", GridColour(8, 4), 224, 224)
    return _grid_checksum(resized.select("vec_id", ops.opened(means)), "scores")


@query(_grid_sql(4, 8))
def embed_224(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default featurizer at its full size."""
    features = ops.feature_table(_spread_images(spark, sf_dir), ["vec_id"], method="nearest")
    return _grid_checksum(features, "features")


# Ten fixed colour forms; the scores are whole numbers, so they compare exactly.
COLOUR_FORMS = [[c - 4, 3 * c % 7 - 3, 5 * c % 11 - 5] for c in range(10)]
SQL_FORMS = ", ".join(f"{r} * red + {g} * green + {b} * blue" for r, g, b in COLOUR_FORMS)


@query(f"""WITH {SQL_BYTES},
sums AS (
  SELECT vec_id, list_sum(list_transform(q, lambda x: 255 - x)) AS red,
         list_sum(list_transform(q, lambda x: x // 2)) AS green, list_sum(q) AS blue
  FROM bytes),
scores AS (SELECT vec_id, [{SQL_FORMS}] AS s FROM sums)
SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS class_id, CAST(list_max(s) AS DOUBLE) AS score
FROM scores""")
def classify_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    resized = ops.resized_table(images(spark, sf_dir), 8, 8)
    scores = ops.predict_pixels("pixels", LinearColour(COLOUR_FORMS), 8, 8)
    scored = resized.select("vec_id", ops.opened(scores))
    best = fx.confidence(F.col("scores")).cast("double")
    return scored.select("vec_id", fx.best_class(F.col("scores")).alias("class_id"), best.alias("score"))
