"""Image folders, in batch and as a stream, and in-memory feature vectors."""

from collections.abc import Iterable, Sequence

from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.readwriter import DataFrameReader

from imagelab.functions.columns import allowed_extension, as_class, class_id, decoded_path, label_from_path
from imagelab.schemas import FEATURE_VECTORS, IMAGE_EXTENSIONS, IMAGE_ROWS


def extension_glob(extensions: Sequence[str] = IMAGE_EXTENSIONS) -> str:
    """File glob for an extension list that ignores case, such as *.{[pP][nN][gG],[gG][iI][fF]}."""
    either = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e) for e in extensions]
    return "*.{" + ",".join(either) + "}"


def _options(
    reader: DataFrameReader | DataStreamReader, drop_invalid: bool, extensions: Sequence[str] | None
) -> DataFrameReader | DataStreamReader:
    reader = reader.format("image").option("dropInvalid", drop_invalid)
    if extensions:  # files of other kinds are dropped while listing and never opened
        reader = reader.option("pathGlobFilter", extension_glob(extensions))
    return reader


def read_images(
    spark: SparkSession,
    path: str | list[str],
    drop_invalid: bool = True,
    extensions: Sequence[str] | None = None,
    recursive: bool = True,
) -> DataFrame:
    """Image rows of a folder tree, a glob or a list of them, in a single scan.

    With `drop_invalid=False` undecodable files stay, with height -1.
    """
    return _options(spark.read, drop_invalid, extensions).option("recursiveFileLookup", recursive).load(path)


def read_labelled_images(
    spark: SparkSession, path: str | list[str], names: Sequence[str], **options
) -> DataFrame:
    """Image rows with `origin`, the parent folder as `class_name` and its position in `names` as `label`.

    One scan of all class folders. All but the image comes from the path of the file, so filters on
    class, label or origin are applied to the file list: files of folders outside the list, and
    files that a later filter on these columns leaves out, are never opened. With
    `drop_invalid=False` these columns alone are read without opening any file.
    """
    rows = read_images(spark, path, **options)
    file = F.col("_metadata.file_path")
    class_name = label_from_path(decoded_path(file))
    labelled = rows.select("image", file.alias("origin"), class_name.alias("class_name"))
    label = as_class(class_id(F.col("class_name"), names), names)
    return labelled.filter(F.col("class_name").isin(list(names))).select("image", "origin", "class_name", label)


def stream_images(
    spark: SparkSession,
    path: str,
    drop_invalid: bool = True,
    extensions: Sequence[str] | None = IMAGE_EXTENSIONS,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Image rows of an upload folder and all folders in it, as a stream."""
    reader = _options(spark.readStream, drop_invalid, extensions).option("recursiveFileLookup", True)
    return reader.schema(IMAGE_ROWS).option("maxFilesPerTrigger", files_per_trigger).load(path)


def allowed_only(df: DataFrame, path_col: str = "image.origin") -> DataFrame:
    """Rows whose file name has an accepted extension."""
    return df.filter(allowed_extension(F.col(path_col)))


def from_vectors(spark: SparkSession, vectors: Iterable[Sequence[float]]) -> DataFrame:
    """A `features` frame from local vectors; works for an empty list too."""
    return spark.createDataFrame([(Vectors.dense(list(v)),) for v in vectors], FEATURE_VECTORS)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write image, feature or prediction rows as a parquet table."""
    df.write.mode(mode).parquet(path)
