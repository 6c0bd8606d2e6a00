"""Session helpers: the shared scratch folder, written intermediate tables, code shipping."""

import atexit
import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

PARTITION_ROWS = 250_000  # rows of a table that one task of a learner keeps
ROW_SLACK = 1.25  # files differ a little in their bytes per row, and one of so many rows is not to be split

_shipped: "weakref.WeakSet" = weakref.WeakSet()
_job_folders: ContextVar[list[str] | None] = ContextVar("job_folders", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a local session without that setting
    gets a temporary folder of its own; a cluster session without it is an error, because a
    machine-local folder would be lost with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(_own_folder("imagelab-"))
    return context.getCheckpointDir()


def _own_folder(prefix: str) -> str:
    """A temporary folder that goes away with this process."""
    folder = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/imagelab-{uuid.uuid4()}/{name}"


def materialise(df: DataFrame, name: str, by: Sequence[str] = (), by_rows: bool = False) -> DataFrame:
    """Write `df` once to the shared folder, in a sub-folder for each value of `by`, and read it back.

    With `by_rows` no partition of the result has many more than PARTITION_ROWS rows, for learners that keep them.

    Cuts the lineage, so that a lost executor costs a re-read and not a recomputation, and gives
    the planner true sizes: small tables then join by broadcast, large ones do not. The table
    goes away with the `scratch_of_job` it is written in, or else with the application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    folders = _job_folders.get()
    if folders is None:
        delete_on_exit(spark, path.rsplit("/", 1)[0])
    else:
        folders.append(path.rsplit("/", 1)[0])
    writer = df.write.partitionBy(*by)
    if by_rows:
        writer = with_bounded_files(writer)
    writer.parquet(path)
    if by_rows:
        spark = session_by_rows(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def with_bounded_files(writer: DataFrameWriter) -> DataFrameWriter:
    """Files of PARTITION_ROWS rows at most, for `session_by_rows`."""
    return writer.option("maxRecordsPerFile", PARTITION_ROWS)


def session_by_rows(spark: SparkSession, path: str) -> SparkSession:
    """A session like `spark` that reads the parquet table at `path` in partitions of about PARTITION_ROWS rows at most.

    Spark cuts and packs files by their bytes alone. Feature rows are small in a file, where equal values
    are stored once, and large in the memory of a learner that keeps them, so bytes do not bound its
    tasks. The limits of scans are settings of a session; here they follow from the mean bytes of a row.
    A file is cut at its row groups only, so write the table `with_bounded_files`.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    count = spark.read.parquet(path).count()  # from the footers
    if count:
        file_system, hadoop_path = _hadoop(spark, path)
        size = int(file_system.getContentSummary(hadoop_path).getLength() * PARTITION_ROWS * ROW_SLACK / count)
        in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        for key, most in (("maxPartitionBytes", size), ("openCostInBytes", size // 32)):
            name = f"spark.sql.files.{key}"
            session.conf.set(name, str(max(1, min(in_bytes(spark.conf.get(name)), most))))
    return session


@contextmanager
def scratch_of_job(spark: SparkSession) -> Iterator[None]:
    """Drop all tables that `materialise` writes inside, at the end, whether the job succeeds or not.

    For jobs whose results are written elsewhere: frames over these tables end with it too.
    """
    folders: list[str] = []
    token = _job_folders.set(folders)
    try:
        yield
    finally:
        _job_folders.reset(token)
        for folder in folders:
            file_system, hadoop_path = _hadoop(spark, folder)
            file_system.delete(hadoop_path, True)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) for a path of any file system that Spark reads."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder if there is none; safe for jobs that start at the same time."""
    file_system, hadoop_path = _hadoop(spark, path)
    file_system.mkdirs(hadoop_path)


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _hadoop(spark, path)
    return file_system.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    file_system, hadoop_path = _hadoop(spark, path)
    file_system.delete(hadoop_path, True)


@contextmanager
def published(spark: SparkSession, path: str) -> Iterator[str]:
    """A staging folder beside `path` that becomes `path` in one rename when the block ends well, and goes if it fails.

    Readers see the whole folder or none. What an earlier, unfinished try left at `path` is replaced.
    Spark's readers skip names that begin with an underscore, so they never see a staging folder.
    """
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_staging-{uuid.uuid4()}"
    try:
        yield staged
        make_folder(spark, parent)
        delete(spark, path)
        file_system, source = _hadoop(spark, staged)
        _, target = _hadoop(spark, f"{parent}/{name}")
        if not file_system.rename(source, target):
            raise OSError(f"could not rename {staged} to {path}")
    except BaseException:
        delete(spark, staged)
        raise


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop a scratch folder of ours when the application ends."""
    file_system, hadoop_path = _hadoop(spark, path)
    file_system.deleteOnExit(hadoop_path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per Spark context."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(package):  # already inside a shipped archive otherwise
        base = os.path.join(_own_folder("imagelab-code-"), "imagelab")
        archive = shutil.make_archive(base, "zip", os.path.dirname(package), "imagelab")
        context.addPyFile(archive)
    _shipped.add(context)
