"""A corpus pipeline of five stages, each an operator of ``footfall.llm`` at work on whole tables.

quality rules -> line dedup -> n-gram Jaccard join -> benchmark decontamination -> SentencePiece

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet to
the shared folder and the next stage reads that. All stages but the last return the columns of
``documents`` (``n_chars`` follows the text). Rows with null ids or texts, repeated rows and further
columns are handled as the operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.common import table
from footfall.llm.decontaminate import drop_contaminated
from footfall.llm.line_dedup import drop_frequent_lines
from footfall.llm.ngram_join import keep_one_of_each
from footfall.llm.piece_nbest import segment
from footfall.llm.quality_divergence import judge_quality
from footfall.llm.queries import PIECES, tokenizer_file
from footfall.session import arrow_batches, staged

#: Rows a Python task is sent at once; Spark's 10,000 documents are 20 MB and more, held twice for every task.
BATCH_ROWS = 1000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or stray from every language reference go."""
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("text", "lang", F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"))
    kept = judge_quality(packed).where("kept")
    return kept.select(*(F.col("text" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; a document of which nothing is left stays with the empty text."""
    others = [c for c in docs.columns if c != "text"]
    packed = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in others)).alias("__row"))
    kept = drop_frequent_lines(packed, min_docs=10)
    columns = {c: F.col(f"__row.`{c}`").alias(c) for c in others} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast("long").alias("n_chars")
    return kept.select(*(columns[c] for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles one stays, the smallest id."""
    return keep_one_of_each(docs, share=Fraction(8, 10), size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages in a twentieth of their words or more go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13, share=20)


def piece_segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, with its four best segmentations into pieces, each decoded again."""
    return segment(docs, tokenizer_file(PIECES), n_best=4, with_paths=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece_nbest", piece_segmentation),
]

#: No SQL: neither the learned references nor the search over the piece lattice can be put in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what each returns is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    with arrow_batches(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
