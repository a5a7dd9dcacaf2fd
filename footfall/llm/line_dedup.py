"""Line deduplication: lines found in many documents leave every document.

Lines are exploded with their position, normalised and hashed; a shuffle by (hash, document) makes
them distinct and a second one, of partial counts, gives documents per hash. The positions of lines
over the threshold are gathered per document and the rest is joined in order. Text itself moves
once, in the last join. A line that every document has costs one row per document, and only counts
of it meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import ROW_KEY, SPACES, ascii_lower, map_batches, row_key


def keyed_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key_hi, key_lo, doc, pos, hash_hi, hash_lo`` of every line with a key of one code point or more."""
    lines = docs.select(
        *row_key(id_col, text_col),
        F.col(id_col).alias("doc"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("pos", "line"),
    ).withColumn("line", F.btrim(ascii_lower(F.col("line")), F.lit(SPACES)))
    return lines.where(F.length("line") >= 1).select(
        *ROW_KEY,
        "doc",
        "pos",
        F.xxhash64("line").alias("hash_hi"),
        F.xxhash64(F.lit("second"), "line").alias("hash_lo"),
    )


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes of keys found in ``min_docs`` documents or more. Rows that share an id are one document."""
    return (
        lines.select("hash_hi", "hash_lo", "doc")
        .distinct()
        .groupBy("hash_hi", "hash_lo")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, lengths = [], []
        for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            gone = set(drop or ())
            kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else "\n".join(lines))
            lengths.append((len(lines), len(gone)))
        rest = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name not in ("text", "drop")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(kept, pa.string()), pa.array([n for n, _ in lengths], pa.int64()),
             pa.array([n for _, n in lengths], pa.int64())],
            [*(n for n in batch.schema.names if n not in ("text", "drop")), "kept_text", "n_lines", "n_dropped"],
        )


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the text left after line deduplication, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased; lines without a key
    always stay. Null or empty text is one empty line and becomes the empty text. Repeated rows
    give repeated results and count as one document; rows with a null id count as one document
    together. Other columns are passed through; ``n_lines`` and ``n_dropped`` replace columns of
    that name.
    """
    lines = keyed_lines(docs, id_col, text_col)
    drop = (
        lines.join(frequent_lines(lines, min_docs), ["hash_hi", "hash_lo"], "left_semi")
        .groupBy(*ROW_KEY)
        .agg(F.collect_set("pos").alias("drop"))
    )
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    joined = (
        docs.select(*(F.col(f"`{n}`").alias(c) for n, c in carried.items()), F.col(text_col).alias("text"),
                    *row_key(id_col, text_col))
        .join(drop, ROW_KEY, "left")
        .drop(*ROW_KEY)
    )
    schema = T.StructType([joined.schema[c] for c in carried.values()])
    schema = schema.add("kept_text", "string").add("n_lines", "long").add("n_dropped", "long")
    out = map_batches(joined, _without, schema)
    back = {name: F.col(c).alias(name) for name, c in carried.items()} | {
        text_col: F.col("kept_text").alias(text_col)
    }
    return out.select(*(back[n] for n in docs.columns if n in back), "n_lines", "n_dropped")
