"""Image rows and feature rows derived from the driver tables, and the same in SQL.

The driver tables hold no images. A vector of `embeddings` becomes an image of 64 pixels: value
x gives the byte q = floor((x + 1) * 127.5), and a pixel is B = q, G = q // 2, R = 255 - q.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import table
from imagelab.functions.columns import as_class, class_id
from imagelab.schemas import IMAGE_STRUCT

SIDE = 8
RETURN_FLAGS = ["A", "N", "R"]
LINE_STATUS = ["F", "O"]

# Common table expression: vec_id, label, first (value) and q (64 bytes) of every vector.
SQL_BYTES = """
bytes AS (
  SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS first,
         list_transform(embedding, lambda x: CAST(floor(
           (greatest(-1.0, least(1.0, CAST(x AS DOUBLE))) + 1) * 127.5) AS INTEGER)) AS q
  FROM embeddings)"""

# The shape of every mixed image: some undecodable, some cut short, gray, colour and alpha.
SQL_MIXED = f"""{SQL_BYTES},
mixed AS (
  SELECT *,
    CASE WHEN first < -0.2 THEN -1 WHEN label = 3 THEN 4 ELSE 8 END AS height,
    CASE WHEN first < -0.2 THEN -1 WHEN label = 3 THEN 16 ELSE 8 END AS width,
    CASE WHEN first < -0.2 THEN -1 WHEN label IN (6, 7) THEN 4 WHEN label = 8 THEN 1 ELSE 3 END AS channels,
    CASE WHEN first < -0.2 THEN -1 WHEN label IN (6, 7) THEN 24 WHEN label = 8 THEN 0 ELSE 16 END AS mode,
    CASE WHEN first < -0.2 THEN 'undecodable' WHEN first > 0.25 THEN 'length' END AS reason
  FROM bytes)"""


def _vector_bytes() -> Column:
    clipped = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double")))
    return F.transform("embedding", lambda x: F.floor((clipped(x) + 1) * 127.5).cast("int"))


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def _pixels(values: Column, channels: int) -> Column:
    """Hex digits of the pixels of a list of bytes."""
    half = lambda v: F.floor(v / 2).cast("int")
    colour = lambda v: F.concat(_hex(v), _hex(half(v)), _hex(255 - v))
    forms = {1: _hex, 3: colour, 4: lambda v: F.concat(colour(v), _hex(half(v)))}
    return F.array_join(F.transform(values, forms[channels]), "")


def _image(height: Column, width: Column, channels: Column, mode: Column, data: Column) -> Column:
    origin = F.concat(F.lit("/img/class_"), "label", F.lit("/"), "vec_id", F.lit(".png"))
    return _struct(origin, height, width, channels, mode, data)


def _struct(*values: Column) -> Column:
    """Image struct of typed fields; unused ones are pruned, which a cast of the struct would stop."""
    fields = zip(values, IMAGE_STRUCT, strict=True)
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in fields]).alias("image")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, image: 8 x 8 colour images."""
    vectors = table(spark, sf_dir, "embeddings").withColumn("_q", _vector_bytes())
    side, data = F.lit(SIDE), F.unhex(_pixels(F.col("_q"), 3))
    return vectors.select("vec_id", "label", _image(side, side, F.lit(3), F.lit(16), data))


def mixed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, image: several shapes and pixel codes, with broken images among them."""
    vectors = table(spark, sf_dir, "embeddings").withColumn("_q", _vector_bytes())
    first, label = F.element_at("embedding", 1).cast("double"), F.col("label")
    broken, cut = first < -0.2, first > 0.25
    alpha, gray = label.isin(6, 7), label == 8
    digits = (
        F.when(alpha, _pixels(F.col("_q"), 4)).when(gray, _pixels(F.col("_q"), 1)).otherwise(_pixels(F.col("_q"), 3))
    )
    whole = F.when(cut, F.substring(digits, 1, 40)).otherwise(digits)
    return vectors.select(
        "vec_id",
        "label",
        _image(
            F.when(broken, -1).when(label == 3, 4).otherwise(8),
            F.when(broken, -1).when(label == 3, 16).otherwise(8),
            F.when(broken, -1).when(alpha, 4).when(gray, 1).otherwise(3),
            F.when(broken, -1).when(alpha, 24).when(gray, 0).otherwise(16),
            F.unhex(F.when(broken, "").otherwise(whole)),
        ),
    )


def line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# Held-out lines of the 70/30 split, with their label.
SQL_HELD_OUT = """
held_out AS (
  SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label
  FROM lineitem
  WHERE CAST('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)
        AS BIGINT) % 100 >= 70)"""


def line_features(lines: DataFrame, *more: Column) -> DataFrame:
    """Lines with one-hot `features` of flag and status, and the flag as label.

    The classes are separable, so a correct fit, score and decode gives every row its own flag.
    """
    flags = [F.col("l_returnflag") == f for f in RETURN_FLAGS]
    status = [F.col("l_linestatus") == s for s in LINE_STATUS]
    features = F.array(*[c.cast("float") for c in flags + status])
    return lines.select(
        features.alias("features"),
        as_class(class_id(F.col("l_returnflag"), RETURN_FLAGS), RETURN_FLAGS),
        "l_returnflag",
        line_key().alias("key"),
        *more,
    )


def _line_data() -> Column:
    """Bytes of a 4 x 4 image: the upper half in a colour of the flag, the lower in one of the status."""
    flag = F.col("l_returnflag")
    upper = F.when(flag == "A", "0A1EC8").when(flag == "N", "C80A1E").otherwise("1EC80A")
    lower = F.when(F.col("l_linestatus") == "F", "505050").otherwise("A0A0A0")
    return F.unhex(F.concat(F.repeat(upper, 8), F.repeat(lower, 8)))


def _line_label() -> Column:
    return as_class(class_id(F.col("l_returnflag"), RETURN_FLAGS), RETURN_FLAGS)


def line_images(lines: DataFrame) -> DataFrame:
    """Lines as images, with their label and key."""
    side = F.lit(4)
    image = _struct(F.lit(None), side, side, F.lit(3), F.lit(16), _line_data())
    return lines.select(image, _line_label(), line_key().alias("key"))


def line_origin() -> Column:
    return F.concat(F.lit("/lines/"), "l_returnflag", F.lit("/"), line_key(), F.lit(".png"))


def line_pictures(lines: DataFrame, *more: str) -> DataFrame:
    """Lines as labelled images in a folder per flag; those of quantity 50 are cut short.

    An `origin` that the lines already have is taken, so that a placement by it is known to Spark.
    """
    side = F.lit(4)
    origin = F.col("origin") if "origin" in lines.columns else line_origin()
    data = F.when(F.col("l_quantity") == 50, F.substring(_line_data(), 1, 20)).otherwise(_line_data())
    image = _struct(origin, side, side, F.lit(3), F.lit(16), data)
    return lines.select(image, F.col("l_returnflag").alias("class_name"), _line_label(), *more)
