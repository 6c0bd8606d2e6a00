"""Labels, dictionaries, filters, unions, caps and splits."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query, table
from catalog.standins import SQL_BYTES, SQL_MIXED, images, line_key, mixed_images
from imagelab.functions import columns as fx
from imagelab.operators import classes, filters
from imagelab.operators.encoding import one_hot_column

SQL_LANGS = """
dictionary AS (
  SELECT CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS class_id, lang AS class_name
  FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))"""


@query("SELECT page_id, string_split(url, '/')[-2] AS label FROM pages")
def label_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", fx.label_from_path(F.col("url")).alias("label"))


@query(f"WITH {SQL_LANGS} SELECT class_id, class_name FROM dictionary")
def class_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes.class_dictionary(table(spark, sf_dir, "documents"), "lang")


@query(f"""WITH {SQL_LANGS}
SELECT doc_id, lang, class_id AS label FROM documents LEFT JOIN dictionary ON lang = class_name""")
def label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return classes.with_label(docs, classes.class_dictionary(docs, "lang"), "lang")


@query(f"""WITH {SQL_LANGS}
SELECT doc_id, CAST(class_id AS DOUBLE) AS prediction, class_name
FROM documents JOIN dictionary ON lang = class_name""")
def decode_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    dictionary = classes.class_dictionary(docs, "lang")
    labelled = classes.with_label(docs, dictionary, "lang", "prediction")
    scored = labelled.select("doc_id", F.col("prediction").cast("double").alias("prediction"))
    return classes.with_class_name(scored.dropna(), dictionary, "prediction")


@query("""
SELECT p_partkey, p_type, CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'PROMO' THEN 1 ELSE 2 END AS label
FROM part WHERE p_type IN ('PROMO', 'STANDARD', 'ECONOMY')""")
def class_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return filters.class_subset(parts, "p_type", ["PROMO", "STANDARD", "ECONOMY"])


SQL_NAMES = """CASE label WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.Gif'
  WHEN 4 THEN '.bmp' WHEN 5 THEN '' WHEN 6 THEN '.tar.png' WHEN 7 THEN '.png.exe' WHEN 8 THEN '.' ELSE '.png/x' END"""


@query(f"""
SELECT vec_id, name FROM (SELECT vec_id, '/up.load/' || vec_id || {SQL_NAMES} AS name FROM embeddings)
WHERE lower(string_split(name, '.')[-1]) IN ('png', 'jpg', 'jpeg', 'gif')""")
def ext_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    endings = [".png", ".JPG", ".jpeg", ".Gif", ".bmp", "", ".tar.png", ".png.exe", "."]
    ending = F.coalesce(fx.class_name(F.col("label"), endings), F.lit(".png/x"))
    named = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.concat(F.lit("/up.load/"), "vec_id", ending).alias("name")
    )
    return named.filter(fx.allowed_extension(F.col("name")))


@query("""
SELECT vec_id, '/img/class_' || label || '/' || vec_id || '.png' AS origin, 8 AS height, 8 AS width,
       3 AS "nChannels", 16 AS mode, 192 AS bytes
FROM embeddings""")
def flatten_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = images(spark, sf_dir).select("vec_id", "image.*")
    return flat.withColumn("bytes", F.length("data")).drop("data")


@query(f"WITH {SQL_MIXED} SELECT vec_id, height, width FROM mixed WHERE height > 0")
def drop_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = filters.drop_invalid(mixed_images(spark, sf_dir))
    return valid.select("vec_id", "image.height", "image.width")


@query(f"""WITH {SQL_MIXED}
SELECT vec_id, height, channels AS "nChannels" FROM mixed WHERE channels > 2 AND height < 8""")
def filter_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.keep_dimensions(mixed_images(spark, sf_dir), min_channels=3, below_height=8)
    return kept.select("vec_id", "image.height", "image.nChannels")


@query(f"WITH {SQL_MIXED} SELECT vec_id, mode FROM mixed WHERE NOT mode = 16")
def filter_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.drop_mode(mixed_images(spark, sf_dir), 16).select("vec_id", "image.mode")


@query(f"WITH {SQL_MIXED} SELECT vec_id, mode FROM mixed WHERE mode IN (16, 24)")
def keep_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keep_modes(mixed_images(spark, sf_dir), [16, 24]).select("vec_id", "image.mode")


@query(f"""WITH {SQL_BYTES}
SELECT vec_id, len(q) AS width FROM bytes WHERE first >= -0.2""")
def drop_null_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.element_at("embedding", 1).cast("double")
    features = F.when(first >= -0.2, F.col("embedding")).alias("features")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", features)
    kept = filters.drop_null_features(rows)
    return kept.select("vec_id", F.size("features").cast("bigint").alias("width"))


@query("""
SELECT vec_id, len(embedding) AS width,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
FROM embeddings""")
def vector_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector("embedding").alias("v"))
    back = vectors.select("vec_id", vector_to_array("v").alias("a"))
    total = F.aggregate("a", F.lit(0.0), lambda s, x: s + x)
    return back.select("vec_id", F.size("a").cast("bigint").alias("width"), F.round(total, 6).alias("total"))


@query("SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS label FROM part")
def union_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame per kind that there is, put together again."""
    parts = table(spark, sf_dir, "part")
    kinds = sorted(r.p_type for r in parts.select("p_type").distinct().collect())  # as many as frames
    frames = [
        parts.filter(F.col("p_type") == kind).select("p_partkey", F.lit(i).alias("label"))
        for i, kind in enumerate(kinds)
    ]
    return classes.union_frames(frames)


@query("""
SELECT source, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20""")
def cap_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id")
    return classes.cap_per_class(docs, "source", "doc_id", 20)


@query("""
SELECT vec_id, label FROM embeddings
QUALIFY rank() OVER (PARTITION BY label ORDER BY CASE WHEN vec_id % 7 <> 0 THEN vec_id END NULLS LAST) <= 20""")
def cap_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key come last and tie with each other."""
    key = F.when(F.col("vec_id") % 7 != 0, F.col("vec_id")).alias("key")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", key)
    return classes.cap_per_class(rows, "label", "key", 20).drop("key")


@query("""
SELECT vec_id, label, '/img/class_' || label || '/' || vec_id || '.png' AS origin
FROM embeddings WHERE vec_id = 40""")
def row_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.rows_by_key(images(spark, sf_dir), "vec_id", [40])
    return rows.select("vec_id", "label", "image.origin")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY ALL LIMIT 5")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return classes.first_rows(table(spark, sf_dir, "lineitem").select(*keys), keys, 5)


@query("SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def repartitioned_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return classes.spread(rows, 200, ["vec_id"]).groupBy("label").agg(F.count("*").alias("n"))


def _split_sql(salt: str, percent: int) -> str:
    bucket = f"CAST('0x' || substr(md5('{salt}' || vec_id), 1, 8) AS BIGINT) % 100"
    return f"SELECT vec_id, CASE WHEN {bucket} < {percent} THEN 'train' ELSE 'test' END AS side FROM embeddings"


def _both_sides(spark: SparkSession, sf_dir: str, percent: int, salt: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id")
    train, test = classes.hash_split(rows, F.col("vec_id"), percent, salt)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(_split_sql("", 70))
def split_70_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_sides(spark, sf_dir, 70, "")


@query(_split_sql("s", 80))
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_sides(spark, sf_dir, 80, "s")


@query("""
SELECT vec_id, CASE WHEN CAST('0x' || substr(md5(coalesce(CASE WHEN vec_id % 7 <> 0 THEN vec_id::VARCHAR END, '')), 1, 8) AS BIGINT) % 100 < 70
               THEN 'train' ELSE 'test' END AS side FROM embeddings""")
def split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key are all on one side, and none is lost."""
    key = F.when(F.col("vec_id") % 7 != 0, F.col("vec_id")).alias("key")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", key)
    train, test = classes.hash_split(rows, F.col("key"), 70)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test"))).drop("key")


@query(f"""WITH {SQL_LANGS}
SELECT doc_id, lang, (SELECT string_agg(CASE WHEN d.class_id = k.class_id THEN '1' ELSE '0' END, ','
                      ORDER BY k.class_id) FROM dictionary k) AS bits
FROM documents JOIN dictionary d ON lang = class_name""")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    coded = one_hot_column(docs, "lang", "coded")
    bits = F.array_join(vector_to_array("coded").cast("array<int>"), ",")
    return coded.select("doc_id", "lang", bits.alias("bits"))


@query(f"""WITH {SQL_LANGS}
SELECT doc_id, (SELECT string_agg(CASE WHEN d.class_id = k.class_id THEN '1' ELSE '0' END, ','
                ORDER BY k.class_id) FROM dictionary k) AS bits
FROM documents JOIN dictionary d ON lang = class_name""")
def one_hot_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    dictionary = classes.class_dictionary(docs, "lang")
    labelled = classes.with_label(docs, dictionary, "lang")
    bits = F.array_join(fx.one_hot(F.col("label"), dictionary.count()), ",")
    return labelled.select("doc_id", bits.alias("bits"))


@query("""
WITH ranked AS (
  SELECT l_returnflag, l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))) AS place,
         count(*) OVER (PARTITION BY l_returnflag) AS n
  FROM lineitem)
SELECT l_returnflag, CASE WHEN place <= floor(n * 70 / 100) THEN 'train' ELSE 'test' END AS side, count(*) AS n,
       CAST(sum(l_orderkey * 8 + l_linenumber) AS BIGINT) AS keys
FROM ranked GROUP BY ALL""")
def split_exact_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 70 % of the lines of every flag, rounded down."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    sides = classes.exact_split(lines, "l_returnflag", line_key(), 70)
    named = [df.withColumn("side", F.lit(name)) for name, df in zip(("train", "test"), sides)]
    keys = F.sum(F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("keys")
    return named[0].unionByName(named[1]).groupBy("l_returnflag", "side").agg(F.count("*").alias("n"), keys)
