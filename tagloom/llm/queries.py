"""Registered queries of the numbered operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import (
    byte_bpe,
    cross_polytope,
    decontam,
    lattice,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    repair,
    rollups,
    surrogates,
    toxicity,
    warc,
)
from tagloom.llm.common import OWN, staged, table


def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document by a subword lattice model of the documents not held out."""
    return lattice.lattice_scores(table(spark, sf_dir, "documents"), lattice.contract_held_out())


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of at most 2048 tokens, packed into sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document lie inside ten-word windows of benchmark items."""
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of the live corpus after a history of signed batches over all documents."""
    return rollups.corpus_history(spark, table(spark, sf_dir, "documents")).totals()


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found neighbours of every fiftieth vector among all vectors."""
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    out = surrogates.replace_entities(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col(OWN + "n").alias("n_replaced"), F.col(OWN + "kinds").alias("kinds"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at five-word Jaccard similarity 0.8."""
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable WARC bundles and read back."""
    back = warc.warc_round_trip(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a recurrent network over all its windows."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by kernel ridge scores of its statistics, calibrated."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair_report(rows, lambda df: staged(df, "repair-reports"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by byte-level BPE and decoded again."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, which share first turns within families of five ids."""
    turns = prefix_trie.turn_digests(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt_turns(turns))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lattice_likelihood,
        op2_best_fit_packing,
        op3_decontamination,
        op4_token_counts,
        op5_cross_polytope,
        op6_surrogates,
        op7_ngram_join,
        op8_warc,
        op9_toxicity,
        op10_quality,
        op11_structure_repair,
        op12_byte_bpe,
        op13_prefix_trie,
    )
}
