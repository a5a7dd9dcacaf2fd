"""Exact substring deduplication by prefix-free parsing.

A rolling hash over ``TRIGGER`` bytes cuts every text into phrases: a phrase begins where the hash
is small, which depends on those bytes alone, so equal strings are parsed alike wherever they stand.
A window of ``length`` bytes is then (a suffix of one phrase, the parse that follows): its first
trigger is its anchor, and two windows are equal only if their anchors stand at the same place in
them and the texts agree to both sides.

Order is needed only to depth ``length``, and only to tell equal from unequal, so the parse and the
phrase suffixes are named by 128-bit hashes instead of being sorted into one suffix array of the
corpus, which no single task could hold:

1. Each anchor gives one row: the name of the parse after it (``k``), the name of all the text its
   windows cover (``t``) and where they start. Rows meet by ``k``.
2. A ``k`` that occurs once is unique text. Rows whose ``t`` occurs twice or more are duplicates with
   all their windows. Only where equal parses stand in unequal surroundings, at the edges of
   repeats, are single windows (suffixes of dictionary phrases) named and counted.
3. Windows without an anchor near enough (in periodic text, mostly) have names of their own.

A piece of text sends each of its names once, whatever named it, and runs of windows that it repeats
itself as one row, so text of many short periods brings no more rows of a name than copies do.

Copies of a text of n bytes give about n / 50 rows each, however many there are; nothing is paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import BROADCAST_ROWS, ROW_KEY, map_batches, narrow_key
from footfall.llm.rolling import Rolling, mixed, ranges, runs
from footfall.session import staged

#: Bytes that decide on a phrase's start; one in so many is one; bytes after it that name the parse.
TRIGGER, SPACING, CONTEXT = 12, 52, 120
#: Texts are read in pieces of so many bytes (window starts), so memory does not grow with a text.
PIECE = 1 << 20
SPAN_BITS = 12


@cache
def _hashes(length: int) -> tuple[Rolling, Rolling]:
    limit = PIECE + length
    return Rolling(0x9E3779B97F4A7C15, 1, limit), Rolling(0xD6E8FEB86659FD95, 2, limit)


def _prefixes(piece: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    one, two = _hashes(length)
    return one.prefix(one.codes[piece]), two.prefix(two.codes[piece])


def anchors(piece: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``k, t, at``: names of the anchors of a piece, and the window starts that each stands for.

    ``at`` holds the first start, how many (SPAN_BITS) and whether the name is known to occur twice
    (one bit). Every start p with p + length <= len(piece) is covered.
    """
    one, two = _hashes(length)
    a, b = _prefixes(piece, length)
    last = len(piece) - length
    trigger = np.flatnonzero(mixed(one.windows(a, TRIGGER)) < np.uint64((1 << 64) // SPACING))
    reach = length - CONTEXT
    previous = np.concatenate(([-1], trigger[:-1])) if len(trigger) else trigger
    low = np.maximum(previous + 1, trigger - reach)
    high = np.minimum(trigger, last)
    some = low <= high
    trigger, low, high = trigger[some], low[some], high[some]
    k = mixed(one.spans(a, trigger, trigger + CONTEXT))
    t = two.spans(b, low, high + length) + mixed(((trigger - low) * PIECE + high - low).astype(np.uint64))
    covered = np.zeros(last + 2, np.int32)
    np.add.at(covered, low, 1)
    np.add.at(covered, high + 1, -1)
    alone = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    found = _named(k, t, low, high - low + 1)
    if len(alone):
        found += _named(mixed(one.spans(a, alone, alone + length)), two.spans(b, alone, alone + length), alone, np.ones_like(alone))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def pack(low: np.ndarray, count: np.ndarray | int, twice: np.ndarray | int) -> np.ndarray:
    return ((low.astype(np.int64) << SPAN_BITS) + count << 1) + twice


def unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at >> SPAN_BITS + 1, at >> 1 & (1 << SPAN_BITS) - 1


def _named(k: np.ndarray, t: np.ndarray, low: np.ndarray, count: np.ndarray) -> list[tuple]:
    """One row per name, and the runs of places whose name occurs before in this piece.

    Periodic text has one name thousands of times. What it repeats itself is known here, so only one
    of them goes to where its name is counted.
    """
    ordered = np.sort(k)
    if (ordered[1:] != ordered[:-1]).all():
        return [(k, t, pack(low, count, 0))]
    order = np.lexsort((t, k))
    new = np.concatenate(([True], (k[order][1:] != k[order][:-1]) | (t[order][1:] != t[order][:-1])))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((starts, [len(order)])))
    first, again = order[starts], order[~new]
    rows = [(k[first], t[first], pack(low[first], count[first], (sizes > 1).astype(np.int64)))]
    if len(again):
        start, end = runs(low[again], low[again] + count[again])
        most = (1 << SPAN_BITS) - 1
        parts = -(-(end - start) // most)
        low = np.repeat(start, parts) + most * (ranges(np.zeros(len(parts), np.int64), parts))
        at = pack(low, np.minimum(most, np.repeat(end, parts) - low), 1)
        unlike = mixed(mixed(t[:1]) + at.view(np.uint64))  # a name of their own: they only carry places
        rows.append((unlike, ~unlike, at))
    return rows


def _pieces(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    for start in range(0, len(data) - length + 1, PIECE):
        yield start, data[start : start + PIECE + length - 1]


def _anchor_rows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[tuple] = []
        held = 0
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ROW_KEY]
        for i, text in enumerate(batch.column("text")):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            for start, piece in _pieces(data, length):
                k, t, at = anchors(piece, length)
                parts.append((i, k, t, at + (start << SPAN_BITS + 1)))
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


def _window_names(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the single windows of unresolved anchors (weight 1) and of one of each known repeat (weight 2)."""
    one, two = _hashes(length)
    for batch in batches:
        names = (*ROW_KEY, "text", "asked")
        for hi, lo, text, asked in zip(*(batch.column(c) for c in names), strict=True):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            at = np.array(asked.as_py(), np.int64)  # here the last bit says whether it occurs twice anywhere
            weight = (at & 1) + 1
            low, count = unpack(at)
            order = np.argsort(low, kind="stable")
            low, count, weight = low[order], count[order], weight[order]
            for start, piece in _pieces(data, length):
                mine = slice(*np.searchsorted(low, (start, start + PIECE)))
                if mine.start == mine.stop:
                    continue
                a, b = _prefixes(piece, length)
                p = ranges(low[mine] - start, count[mine])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.spans(a, p, p + length).view(np.int64)), pa.array(two.spans(b, p, p + length).view(np.int64)),
                     pa.array(np.full(len(p), hi.as_py())), pa.array(np.full(len(p), lo.as_py())), pa.array(p + start),
                     pa.array(np.repeat(weight[mine], count[mine]))],
                    ["w1", "w2", *ROW_KEY, "p", "weight"],
                )


def _cut(length: int, with_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
    kinds |= {"spans": span, "kept": pa.binary()} if with_text else {}
    for batch in batches:
        rows = []
        for text, whole, single in zip(*(batch.column(c).to_pylist() for c in ("text", "whole", "single")), strict=True):
            data = (text or "").encode()
            low, count = unpack(np.array(whole or [], np.int64))
            p = np.array(single or [], np.int64)
            start, end = runs(np.concatenate((low, p)), np.concatenate((low + count - 1 + length, p + length)))
            bounds = np.concatenate(([0], np.stack((start, end), 1).reshape(-1), [len(data)])).tolist()
            digest = sha256()
            for x, y in zip(bounds[::2], bounds[1::2], strict=True):
                digest.update(data[x:y])
            row = {"n_bytes": len(data), "n_removed": int((end - start).sum()), "n_spans": len(start), "kept_sha256": digest.hexdigest()}
            if with_text:
                row["spans"] = [{"start": x, "end": y} for x, y in zip(start.tolist(), end.tolist(), strict=True)]
                row["kept"] = b"".join(data[x:y] for x, y in zip(bounds[::2], bounds[1::2], strict=True))
            rows.append(row)
        found = [pa.array([row[c] for row in rows], kind) for c, kind in kinds.items()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *found], ["doc", *kinds])


def _by_text(texts: DataFrame, lists: DataFrame, n_entries: int, how: str) -> DataFrame:
    """Lists of positions meet their texts: broadcast up to BROADCAST_ROWS entries, else both sides shuffle."""
    return texts.join(F.broadcast(lists) if n_entries <= BROADCAST_ROWS else lists, ROW_KEY, how)


def remove_repeats(
    docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Per row of ``docs``: ``doc, n_bytes, n_removed, n_spans, kept_sha256``, and ``spans, kept`` with ``with_text``.

    A byte of a text's UTF-8 is removed when a string of ``length`` bytes that covers it also starts
    anywhere else, in any document or the same one; matches never cross documents, and all are judged
    on the input. ``spans`` are the maximal removed runs, ``kept`` the rest as bytes (a cut may fall
    inside a character). Null and short texts keep all they have. Repeated rows are copies of each
    other: both lose what they share. ``length`` is between CONTEXT + TRIGGER and 4000.
    """
    if not CONTEXT + TRIGGER <= length < 1 << SPAN_BITS:
        raise ValueError(f"length {length} is out of range")
    texts = docs.select(*narrow_key(docs, id_col, text_col), F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    keyed = texts.select(*ROW_KEY, "text")
    rows = map_batches(keyed, lambda b: _anchor_rows(length, b), "k long, t long, key_hi long, key_lo long, at long")
    # one shuffle by k serves all of these: counts of a name, of a parse, and whether a parse has several names
    parse, name = Window.partitionBy("k"), Window.partitionBy("k", "t")
    times = 1 + F.col("at").bitwiseAND(1)
    place = F.xxhash64(*ROW_KEY, "at")
    met = (
        rows.withColumn("n_rows", F.sum(times).over(parse)).where("n_rows > 1")
        .withColumn("several", F.min("t").over(parse) != F.max("t").over(parse))
        .withColumn("n", F.sum(times).over(name))
        .withColumn("speaks", place == F.min(place).over(name))
    )
    repeat = F.col("n") > 1
    found = staged(
        met.select(*ROW_KEY, "at", repeat.alias("repeat"), (F.col("several") & (~repeat | F.col("speaks"))).alias("asked")),
        "repeats",
    )
    asked = found.where("asked").groupBy(*ROW_KEY).agg(
        F.collect_set(F.col("at") - F.col("at").bitwiseAND(1) + F.col("repeat").cast("long")).alias("asked")
    )
    n_asked = found.where("asked").count()
    names = map_batches(
        _by_text(keyed, asked, n_asked, "inner"), lambda b: _window_names(length, b),
        "w1 long, w2 long, key_hi long, key_lo long, p long, weight long",
    )
    total = F.sum("weight").over(Window.partitionBy("w1", "w2"))
    single = staged(
        names.withColumn("n", total).where("n > 1 and weight = 1").select(*ROW_KEY, "p"), "windows"
    )
    n_found = found.where("repeat").count() + single.count()
    lists = found.where("repeat").groupBy(*ROW_KEY).agg(F.collect_set("at").alias("whole")).join(
        single.groupBy(*ROW_KEY).agg(F.collect_set("p").alias("single")), ROW_KEY, "full_outer"
    )
    joined = _by_text(texts, lists, n_found, "left").drop(*ROW_KEY)
    schema = T.StructType([joined.schema["doc"]]).add("n_bytes", "long").add("n_removed", "long")
    schema = schema.add("n_spans", "long").add("kept_sha256", "string")
    if with_text:
        schema = T.StructType(schema.fields + T.StructType.fromDDL("spans array<struct<start:long,end:long>>, kept binary").fields)
    return map_batches(joined, lambda b: _cut(length, with_text, b), schema)
