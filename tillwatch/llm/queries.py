"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwatch.llm.common import held_out, table
from tillwatch.llm.conversation_repair import op12_conversation_repair as repair_of
from tillwatch.llm.embed_dedup import near_duplicate_vectors
from tillwatch.llm.html_main import op8_line_block_html as html_of
from tillwatch.llm.language import fit_language, identify
from tillwatch.llm.licenses import op2_license_scan as licenses_of
from tillwatch.llm.mixing import op11_entropy_mixture as mixture_of
from tillwatch.llm.oracle import oracle_sql  # noqa: F401  registered beside the queries
from tillwatch.llm.packing import pack
from tillwatch.llm.piece_lattice import op6_sentencepiece_lattice as pieces_of
from tillwatch.llm.prefix_trie import op13_prefix_trie as trie_of
from tillwatch.llm.quality import scored
from tillwatch.llm.rules import op3_quality_rules as rules_of
from tillwatch.llm.rules import quality_base_statistics as base_of
from tillwatch.llm.sharding import op4_sampled_splitter_shards as shards_of
from tillwatch.llm.simhash import op9_simhash_near_dedup as simhash_of

Query = Callable[[SparkSession, str], DataFrame]


def op1_byte_network_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_language(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses_of(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_base_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_of(table(spark, sf_dir, "documents"))


def op4_sampled_splitter_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_of(table(spark, sf_dir, "documents"))


def op5_hyperplane_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op6_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_of(table(spark, sf_dir, "documents"), ["doc_id"])


def op6_sentencepiece_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_of(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, table(spark, sf_dir, "labels"), narrow=True).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_line_block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_of(table(spark, sf_dir, "pages"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_of(table(spark, sf_dir, "documents"))


def op10_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_entropy_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_of(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_of(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_of(table(spark, sf_dir, "conversations"))


_QUERIES: tuple[Query, ...] = (
    op1_byte_network_language,
    op2_license_scan,
    op3_quality_rules,
    quality_base_statistics,
    op4_sampled_splitter_shards,
    op5_hyperplane_embedding_dedup,
    op6_sentencepiece_lattice,
    op6_sentencepiece_turns,
    op7_quality_classifier,
    op8_line_block_html,
    op9_simhash_near_dedup,
    op10_order_preserving_packing,
    op11_entropy_mixture,
    op12_conversation_repair,
    op13_prefix_trie,
)


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
