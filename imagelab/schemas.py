"""Fixed schemas of the tables this package reads and writes."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

# The struct produced by Spark's own image source; `data` is row-major B,G,R.
IMAGE_STRUCT = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("nChannels", T.IntegerType()),
        T.StructField("mode", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]
)
IMAGE_ROWS = T.StructType([T.StructField("image", IMAGE_STRUCT)])

# Pixel codes of the image source.
MODE_GRAY, MODE_BGR, MODE_BGRA, MODE_INVALID = 0, 16, 24, -1

CLASS_DICTIONARY = T.StructType(
    [
        T.StructField("class_id", T.IntegerType()),
        T.StructField("class_name", T.StringType()),
    ]
)

FEATURE_VECTORS = T.StructType([T.StructField("features", VectorUDT())])

REGISTRY = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("elapsed_time", T.DoubleType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("algorithm", T.StringType()),
    ]
)

# Class names by id, as used by models trained on the car photo collection.
CAR_CLASSES = [
    "4runner", "alphard", "avalon", "avanza", "avensis", "aygo", "camry", "celica",
    "corolla", "corona", "crown", "estima", "etios", "fortuner", "hiace", "highlander",
    "hilux", "innova", "iq", "matrix", "mirai", "previa", "prius", "rav4", "revo", "rush",
    "sequoia", "sienna", "soarer", "starlet", "supra", "tacoma", "tundra", "venza", "verso",
    "vios", "vitz", "yaris",
]

# File extensions accepted for scoring.
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "gif"]

# Order in which the registry lists its algorithms.
REGISTRY_ORDER = ["Random Forest", "Logistic Regression", "Decision Tree"]
