"""Small helpers shared by the operators: written tables, columns, Arrow batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.sources.workspace import new_path


def written(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """Write the frame into the shared folder; the written table and its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that no later job reads."""
    context = spark.sparkContext
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for files that tasks write themselves.

    Without a scheme the folder is on the default file system, as for Spark's own writers. One on the
    machines' own disks is an error on a cluster.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(new_path(spark, name))
    uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if uri.startswith("file:") and not context.master.startswith("local"):
        raise ValueError(f"{uri} is on each machine's own disk; set spark.checkpoint.dir to a shared folder")
    return uri


def write_files(contents: DataFrame, folder: str) -> DataFrame:
    """Write every ``content`` as a file of its own with a line feed behind it; see ``read_files``.

    Spark's writer and committer do it, so the folder may be on any file system that Spark reaches, and a task
    that is run again leaves no second file.
    """
    text = contents.select(F.col("content").cast("string"))
    text.write.option("maxRecordsPerFile", 1).text(folder)
    return read_files(contents.sparkSession, [folder])


def read_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The files of ``write_files`` as ``path, part, number, content``; the line feed is left out.

    ``part`` is the partition that wrote the file, ``number`` counts the files of the partition.
    """
    if not folders:
        return spark.createDataFrame([], "path string, part int, number int, content binary")
    name = r"part-(\\d+)-.*-c(\\d+)[.]txt$"
    # The first partition leaves an empty file if it has no row.
    return spark.read.format("binaryFile").load(folders).where("length > 0").selectExpr(
        "path",
        *[f"CAST(regexp_extract(path, '{name}', {i}) AS INT) AS {c}" for i, c in enumerate(("part", "number"), 1)],
        "substring(content, 1, CAST(length AS INT) - 1) AS content",
    )


def folders_of(manifest: DataFrame) -> list[str]:
    """The folders of the files that the manifest names by ``path``."""
    rows = manifest.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()
    return [r["folder"] for r in rows]


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its columns named by number, and the new name of each old one.

    Whatever an input calls its columns, they meet none that an operator adds.
    """
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def pieces(batch: pa.RecordBatch, name: str, size: int = 1 << 21):
    """Slices of the batch with about ``size`` bytes in the text column, one row at least."""
    import numpy as np

    lengths = _lengths(column(batch, name))
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _lengths(texts: pa.Array):
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64")
