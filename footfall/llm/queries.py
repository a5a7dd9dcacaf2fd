"""The registered queries of the numbered operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import table
from footfall.llm.decontaminate import contamination
from footfall.llm.line_dedup import drop_frequent_lines
from footfall.llm.merkle_manifest import manifest, row_digest
from footfall.llm.ngram_join import near_duplicates
from footfall.llm.piece_nbest import segment
from footfall.llm.prefix_tokens import count_prefixes, within_budget
from footfall.llm.quality_divergence import METRICS, judge_quality
from footfall.llm.relative_lz import remove_earlier
from footfall.llm.substring_dedup import remove_repeats
from footfall.llm.token_store import read_token_files, write_token_files
from footfall.llm.toxicity_grammar import fold, score_toxicity, train
from footfall.llm.url_redirects import Rule, judge_pages
from footfall.llm.walsh_clusters import cluster
from footfall.session import shared_path, staged, staging

#: The folder of public vocabulary files, as a package; its place is found at run time.
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = drop_frequent_lines(docs.select("doc_id", "text"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", *METRICS, "base_failed", "kept")


def op3_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), length=400, with_text=False)
    return found.withColumnRenamed("doc", "doc_id")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    judged = contamination(docs, items, window=13, share=20)
    return judged.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file(BYTE_BPE), end_id=2)
    return read_token_files(spark, path, with_ids=False).withColumnRenamed("doc", "doc_id")


def op6_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_earlier(table(spark, sf_dir, "documents"), window=13, with_text=False)
    return found.withColumnRenamed("doc", "doc_id")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = near_duplicates(table(spark, sf_dir, "documents"), share=Fraction(90, 100), size=3)
    return placed.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op8_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), max_rows=20_000)
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return score_toxicity(docs, model).select("doc_id", held_out, "score", "predicted")


def op9_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segment(docs, tokenizer_file(PIECES), n_best=4, with_paths=True)


def op10_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_pages(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    held = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(
        docs, "source", "doc_id", row_digest(*others, F.col("text")), row_digest(*others, held), keep=("doc_id",)
    )


def op12_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with staging(spark) as stage:
        stored = stage(count_prefixes(docs, tokenizer_file(BYTE_BPE)), "prefixes")
        return staged(within_budget(stored, limit=1024).drop("n_prefixes"), "budgets")


def op13_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    placed = cluster(vectors, k=40, rounds=5, seed="2", id_col="vec_id", vector_col="embedding")
    return placed.drop("n_finished")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_divergence": op2_quality_divergence,
    "op3_prefix_free_parsing": op3_prefix_free_parsing,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_token_store": op5_token_store,
    "op6_relative_lz": op6_relative_lz,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_toxicity_grammar": op8_toxicity_grammar,
    "op9_piece_nbest": op9_piece_nbest,
    "op10_url_redirects": op10_url_redirects,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_tokens": op12_prefix_tokens,
    "op13_walsh_clusters": op13_walsh_clusters,
}
