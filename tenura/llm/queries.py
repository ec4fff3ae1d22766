"""The operators of this package bound to the given tables, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import mixing
from tenura.llm.decontamination import find_contamination
from tenura.llm.fuzzy_passages import fuzzy_passages
from tenura.llm.maxent import maxent_scores
from tenura.llm.near_duplicates import near_duplicates
from tenura.llm.near_vectors import near_vectors
from tenura.llm.periodic_runs import periodic_runs, run_digests, with_planted_periods
from tenura.llm.ranked_search import SEARCH_SQL, ranked_search
from tenura.llm.sharding import shard_documents
from tenura.llm.site_quality import site_quality
from tenura.llm.token_files import read_token_files, write_token_files
from tenura.llm.toxicity import fit_toxicity, held_out, score_toxicity
from tenura.llm.warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_site_quality(spark, sf_dir):
    rated = site_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rated.select("doc_id", "p_document", "p_host", "p_path", "quality", "keep")


def op2_decontamination(spark, sf_dir):
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_cover_tree_links(spark, sf_dir):
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_chosen_path_near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_token_files(spark, sf_dir):
    files = write_token_files(_table(spark, sf_dir, "documents"), vocabulary_path())
    return read_token_files(files, digest=True)


def op6_warc_archives(spark, sf_dir):
    return read_archives(write_archives(_table(spark, sf_dir, "pages")))


def op7_poisson_mix(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_minimax_shards(spark, sf_dir):
    return shard_documents(_table(spark, sf_dir, "documents"), 24)


def op9_toxicity(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    network = fit_toxicity(documents, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(documents, network)
    return scored.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op10_fuzzy_passages(spark, sf_dir):
    return fuzzy_passages(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark, sf_dir):
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_maxent_scores(spark, sf_dir):
    return maxent_scores(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark, sf_dir):
    documents = with_planted_periods(_table(spark, sf_dir, "documents"))
    return run_digests(periodic_runs(documents))


QUERIES = {
    "op1_site_quality": op1_site_quality,
    "op2_decontamination": op2_decontamination,
    "op3_cover_tree_links": op3_cover_tree_links,
    "op4_chosen_path_near_duplicates": op4_chosen_path_near_duplicates,
    "op5_token_files": op5_token_files,
    "op6_warc_archives": op6_warc_archives,
    "op7_poisson_mix": op7_poisson_mix,
    "op8_minimax_shards": op8_minimax_shards,
    "op9_toxicity": op9_toxicity,
    "op10_fuzzy_passages": op10_fuzzy_passages,
    "op11_ranked_search": op11_ranked_search,
    "op12_maxent_scores": op12_maxent_scores,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES = {"op7_poisson_mix": mixing.MIX_SQL, "op11_ranked_search": SEARCH_SQL}
