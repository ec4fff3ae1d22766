"""Tables written to the shared folder.

An intermediate table that several later jobs read is written once as Parquet
below ``spark.checkpoint.dir``: it survives lost executors, its lineage ends
there, and later jobs read only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
#: The file in a table's folder that names its current version.
POINTER = "CURRENT"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if configured.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is on each machine's own disk; name a shared folder")
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tenura-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tenura-{application}/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the frame once and go on from the written table."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Make the frame the content of the table at ``path``, and read it back.

    The rows are written beside the current version; then a pointer is renamed over the old one, which
    readers see at once or not at all. So the frame may read the table that it replaces, a write that fails
    leaves the table as it was, and readers that have begun keep the version before, the only one that is kept.
    Schema and partitioning may change. One writer at a time.
    """
    spark = df.sparkSession
    version, before = f"v-{uuid.uuid4().hex[:12]}", _version(spark, path)
    df.write.parquet(f"{path}/{version}")
    files, folder = _file_system(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fresh = hadoop.Path(folder, f".{version}.tmp")
    out = files.create(fresh, True)
    out.write(bytearray(version, "ascii"))
    out.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(hadoop.Path(folder, POINTER)), options)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            files.delete(status.getPath(), True)
    return read_table(spark, path)


def _version(spark: SparkSession, path: str) -> str | None:
    files, folder = _file_system(spark, path)
    pointer = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, POINTER)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    text = bytes(stream.readAllBytes()).decode("ascii")
    stream.close()
    return text


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that ``replace_table`` wrote."""
    version = _version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{path}/{version}")


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def release(spark: SparkSession) -> bool:
    """Delete the tables this application stored; call it when its results are written."""
    application = spark.sparkContext.applicationId
    files, target = _file_system(spark, f"{shared_folder(spark)}/tenura-{application}")
    return files.delete(target, True)
