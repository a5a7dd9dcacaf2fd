"""Substring deduplication of words by relative Lempel-Ziv factors.

The reference of a document is all text of documents with smaller ids. It is cut into blocks by
content: every window of ``window`` words belongs to the block of its minimizer (of its runs of
``RUN`` words the one with the smallest hash), so a passage falls into the same blocks wherever it
stands. The index holds each distinct block once, with the smallest id it occurs under. A document
is factored against it block by block: a run of blocks found in the reference is one factor, as long
as it goes. Where a factor ends inside a block, the block's name is new though its minimizer is
known; there, at the factor boundaries, each single window is looked up among the windows of all
reference blocks with that minimizer. So factors are checked against every indexed block, no match
is lost at a boundary, and only factors of a window or longer count.

Each block is one row, a quarter of the windows; equal blocks in a row are one. Copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import ROW_KEY, map_batches, narrow_key
from footfall.llm.rolling import Rolling, mixed, ranges, runs
from footfall.session import staged

#: Words that decide on a block.
RUN = 5
#: Texts are cut into pieces of so many bytes, overlapping by a window, so memory does not grow with a text.
PIECE = 1 << 21
SPAN_BITS = 12
SPACE = b" \t\n\x0b\x0c\r"


@cache
def _hashes() -> tuple[Rolling, Rolling]:
    return Rolling(0x9E3779B97F4A7C15, 3, PIECE), Rolling(0xD6E8FEB86659FD95, 4, PIECE)


def word_pieces(data: bytes, window: int) -> Iterator[tuple[int, list[bytes]]]:
    """``(number of the first word, words)``; each piece begins with the last window - 1 words of the one before."""
    at, n, tail = 0, 0, []
    while at < len(data) or n == 0:
        end = at + PIECE
        while end < len(data) and data[end] not in SPACE:
            end += 1
        words = tail + data[at:end].split()
        yield n - len(tail), words
        n += len(words) - len(tail)
        tail = words[len(words) - window + 1 :] if len(words) >= window else words
        if end >= len(data):
            break
        at = end


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _prefixes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    one, two = _hashes()
    codes = word_codes(words)
    return one.prefix(codes), two.prefix(mixed(codes))


def blocks(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``k, t, low, count``: hash of the minimizer, name of the block, its first window and how many it has.

    Equal blocks in a row share their fate, so they are one run of windows: text whose period is at most the
    window - RUN + 1 runs of a window has one such block per period, text of longer periods several that differ.
    """
    one, two = _hashes()
    a, b = _prefixes(words)
    grams = mixed(one.windows(a, RUN))
    n = len(words) - window + 1
    best, at = grams[:n].copy(), np.arange(n)
    for i in range(1, window - RUN + 1):
        here = grams[i : i + n]
        less = here <= best  # the last one of equals
        best = np.where(less, here, best)
        at = np.where(less, np.arange(i, i + n), at)
    low = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    count = np.diff(np.concatenate((low, [n])))
    k = best[low]
    t = two.spans(b, low, low + count - 1 + window) + mixed(((at[low] - low) * PIECE + count).astype(np.uint64))
    same = (k[1:] == k[:-1]) & (t[1:] == t[:-1]) & (count[1:] == count[:-1])
    if not same.any():
        return k, t, low, count
    first = np.concatenate(([0], np.flatnonzero(~same) + 1))
    size = np.diff(np.concatenate((first, [len(k)])))
    most = ((1 << SPAN_BITS) - 1) // count[first]
    parts = -(-size // most)
    of, before = np.repeat(first, parts), ranges(np.zeros(len(parts), np.int64), parts) * np.repeat(most, parts)
    here = np.minimum(np.repeat(most, parts), np.repeat(size, parts) - before)
    return k[of], t[of], low[of] + before * count[of], here * count[of]


def _block_rows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[tuple] = []
        held = 0
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ROW_KEY]
        for i, text in enumerate(batch.column("text")):
            for first, words in word_pieces((text.as_py() or "").encode(), window):
                if len(words) < window:
                    continue
                k, t, low, count = blocks(words, window)
                parts.append((i, k, t, ((low + first) << SPAN_BITS) | count))
                held += len(k)
            if held > 100_000:
                yield _rows(keys, parts)
                parts, held = [], 0
        if parts:
            yield _rows(keys, parts)


def _rows(keys: list[np.ndarray], parts: list[tuple]) -> pa.RecordBatch:
    of = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts])
    k, t, at = (np.concatenate([p[c] for p in parts]) for c in (1, 2, 3))
    return pa.RecordBatch.from_arrays(
        [pa.array(k.view(np.int64)), pa.array(t.view(np.int64)), pa.array(keys[0][of]), pa.array(keys[1][of]), pa.array(at)],
        ["k", "t", *ROW_KEY, "at"],
    )


def _window_names(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit names of all windows of the blocks asked for."""
    one, two = _hashes()
    for batch in batches:
        names = (*ROW_KEY, "text", "asked")
        for hi, lo, text, asked in zip(*(batch.column(c) for c in names), strict=True):
            at = np.sort(np.array(asked.as_py(), np.int64))
            low, count = at >> SPAN_BITS, at & ((1 << SPAN_BITS) - 1)
            for first, words in word_pieces((text.as_py() or "").encode(), window):
                mine = slice(*np.searchsorted(low, (first, first + len(words) - window + 1)))
                if mine.start >= mine.stop:
                    continue
                a, b = _prefixes(words)
                p = ranges(low[mine] - first, count[mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.spans(a, p, p + window).view(np.int64)), pa.array(two.spans(b, p, p + window).view(np.int64)),
                     pa.array(np.full(len(p), hi.as_py())), pa.array(np.full(len(p), lo.as_py())), pa.array(p + first)],
                    ["w1", "w2", *ROW_KEY, "p"],
                )


def _cut(window: int, with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "n_factors": pa.int64(), "kept_sha256": pa.string()}
    kinds |= {"factors": span, "kept": pa.string()} if with_text else {}
    for batch in batches:
        rows = []
        for text, whole, single in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "single")), strict=True):
            words = (text or "").encode().split()
            at = np.array(whole or [], np.int64)
            low, count = at >> SPAN_BITS, at & ((1 << SPAN_BITS) - 1)
            p = np.array(single or [], np.int64)
            start, end = runs(np.concatenate((low, p)), np.concatenate((low + count - 1 + window, p + window)))
            bounds = np.concatenate(([0], np.stack((start, end), 1).reshape(-1), [len(words)])).tolist()
            kept = b" ".join([b" ".join(words[x:y]) for x, y in zip(bounds[::2], bounds[1::2], strict=True) if x < y])
            row = {"n_words": len(words), "n_removed": int((end - start).sum()), "n_factors": len(start), "kept_sha256": sha256(kept).hexdigest()}
            if with_text:
                row["factors"] = [{"start": x, "end": y} for x, y in zip(start.tolist(), end.tolist(), strict=True)]
                row["kept"] = kept.decode()
            rows.append(row)
        found = [pa.array([row[c] for row in rows], kind) for c, kind in kinds.items()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *found], ["doc", *kinds])


def remove_earlier(
    docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Per row of ``docs``: ``doc, n_words, n_removed, n_factors, kept_sha256``, and ``factors, kept`` with ``with_text``.

    A word (a run of other than ASCII white space, unchanged) is removed when a window of ``window``
    words that covers it also starts in a document with a smaller id; windows are judged on the input
    and never cross documents. ``factors`` are the maximal removed runs of words, ``kept`` the other
    words joined by one space. Null and empty texts have no words. Ids are integers; rows that share
    an id are one document and do not remove from each other, null ids are one document after all
    others. ``window`` is between RUN and 2000.
    """
    if docs.schema[id_col].dataType.typeName() not in ("long", "integer", "short", "byte"):
        raise TypeError(f"{id_col} must be an integer: smaller ids come first")
    if not RUN <= window <= 2000:
        raise ValueError(f"window {window} is out of range")
    texts = docs.select(*narrow_key(docs, id_col, text_col), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = map_batches(texts.select(*ROW_KEY, "text"), lambda b: _block_rows(window, b), "k long, t long, key_hi long, key_lo long, at long")
    # one shuffle by k serves all of these: the smallest id of a block, of a minimizer, and whether it has several blocks
    minimizer, block = Window.partitionBy("k"), Window.partitionBy("k", "t")
    met = (
        rows.withColumn("lowest", F.min("key_hi").over(minimizer)).withColumn("highest", F.max("key_hi").over(minimizer))
        .withColumn("several", F.min("t").over(minimizer) != F.max("t").over(minimizer))
        .where("lowest < highest")
        .withColumn("first", F.min("key_hi").over(block))
    )
    found = staged(
        met.select(
            *ROW_KEY, "at", (F.col("first") < F.col("key_hi")).alias("repeat"),
            (F.col("several") & (F.col("first") == F.col("key_hi"))).alias("asked"),
        ).where("repeat or asked"),
        "blocks",
    )
    asked = found.where("asked").groupBy(*ROW_KEY).agg(F.collect_set("at").alias("asked"))
    # texts are dealt once by their key; the plan's two joins with lists of places reuse that shuffle
    dealt = texts.repartition(*(F.col(c) for c in ROW_KEY))
    names = map_batches(
        dealt.join(asked, ROW_KEY), lambda b: _window_names(window, b), "w1 long, w2 long, key_hi long, key_lo long, p long"
    )
    earliest = F.min("key_hi").over(Window.partitionBy("w1", "w2"))
    single = names.withColumn("first", earliest).where("key_hi > first").select(*ROW_KEY, "p")
    lists = found.where("repeat").groupBy(*ROW_KEY).agg(F.collect_set("at").alias("whole")).join(
        single.groupBy(*ROW_KEY).agg(F.collect_set("p").alias("single")), ROW_KEY, "full_outer"
    )
    joined = dealt.join(lists, ROW_KEY, "left").drop(*ROW_KEY)
    schema = T.StructType([joined.schema["doc"]]).add("n_words", "long").add("n_removed", "long")
    schema = schema.add("n_factors", "long").add("kept_sha256", "string")
    if with_text:
        schema = T.StructType(schema.fields + T.StructType.fromDDL("factors array<struct<start:long,end:long>>, kept string").fields)
    return map_batches(joined, lambda b: _cut(window, with_text, b), schema)
