"""A training corpus from raw documents: rate, deduplicate, decontaminate, mix, write token files.

Every stage takes all rows that the one before kept and returns what it keeps; the last returns
what it reads back from the files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.decontamination import drop_contaminated
from tenura.llm.frames import written
from tenura.llm.mixing import mix
from tenura.llm.near_duplicates import near_duplicates
from tenura.llm.queries import vocabulary_path
from tenura.llm.site_quality import keep_good
from tenura.llm.token_files import read_token_files, write_token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rated good; the others go."""
    return keep_good(docs, _table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Rows that repeat an id are one document, of which one row stays. Rows with a null id, which
    are linked with nothing, all stay.
    """
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias("_kept_id"))
    one_each = docs.join(kept, docs["doc_id"] == kept["_kept_id"], "left_semi")
    return one_each.dropDuplicates(["doc_id"]).union(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by the sources' target weights, in random order."""
    return mix(docs, marked=False)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every copy's ids, read back from the files written."""
    return read_token_files(write_token_files(docs, vocabulary_path()), digest=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages fit models and write files, which SQL cannot express; tests compare them with
#: brute force.
ORACLE_SQL = None
