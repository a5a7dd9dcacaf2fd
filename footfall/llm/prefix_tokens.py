"""Exact token counts of every prefix of every text, stored once, for questions of length and budget.

A byte-level encoder cuts a text into chunks and merges pairs within each. Inside a chunk a dynamic
program over its prefixes needs no merging: the encoding of a prefix ends in one token, and it is the
token whose pair with the last token of what lies before it would be left alone by the merges. So
``count[end] = count[start] + 1`` for the one start and token that fit, and pairs are looked up.

Counts of chunks add up. Where a text is cut off, its last chunk may be cut otherwise than in the whole
text, and only there counts are set apart: at the last of several white spaces (the whole text leaves
it to the next word), inside ``'re 've 'll``, and inside the string of a special token.

What is stored per text is the difference of the count from prefix to prefix, by code point, one
signed byte each (four where one does not fit: the width is the length divided by ``n_prefixes``).
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import fresh, map_batches

#: The cut of a byte-level encoder into chunks.
CHUNKS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD, _DIGIT, _SPACE = "A-Za-z", "0-9", r"\t-\r\x20"
ASCII_CHUNKS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_WORD}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_WORD}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
WIDE_CHUNKS = regex.compile(CHUNKS)
#: Characters whose class has not changed between versions of Unicode; others are left to the library's cut.
SETTLED = re.compile(
    "[^\x00-՗א-תؠ-ۿअ-हก-ฺḀ-ᾴ‐-⁗₠-₵"
    "←-⏿─-☄　-〿ぁ-ゖァ-ヺ一-龥가-힣！-～\U0001f600-\U0001f64f]"
)
_BREAKS = {"'re", "'ve", "'ll"}
_LEADING = re.compile(r"\s+")
_SEVERAL = re.compile(r"\s\s")
#: Remembered chunks and pairs take about this many bytes per worker at most; then they are learned anew.
CACHE_BYTES = 160 << 20
LONGEST_CACHED = 64
PAIRS = 200_000
_counters: dict[str, PrefixCounter] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next beyond 255."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PrefixCounter:
    """Counts tokens of prefixes for one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        self.library = tokenizers.Tokenizer.from_file(path)
        kind = json.loads(self.library.to_str())
        cut = kind["pre_tokenizer"] or {}
        plain = kind["normalizer"] is None and kind["model"]["type"] == "BPE" and not kind["model"].get("ignore_merges")
        special = list(self.library.get_added_tokens_decoder().values())
        odd = any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in special)
        if not plain or odd or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        contents = sorted((t.content for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, contents))) if contents else None
        self.letters = [letter for _, letter in sorted(_byte_letters().items())]
        added = {t.content for t in special}
        vocabulary = {t: i for t, i in self.library.get_vocab().items() if t not in added}
        #: Finds every token that ends at a place of a chunk, long ones first.
        self.tokens = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            self.tokens.add_word(token, (i, len(token)))
        self.tokens.make_automaton()
        self.text_of = {i: t for t, i in vocabulary.items()}
        #: Merges by their two tokens: the rank. Of each merged token its rank and its two parts.
        self.rank_of_pair, self.made_of = {}, {}
        for rank, (left, right) in enumerate(kind["model"]["merges"]):
            pair = vocabulary[left], vocabulary[right]
            self.rank_of_pair[pair] = rank
            self.made_of[vocabulary[left + right]] = (rank, *pair)
        self.single: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.held = 0

    # -- one chunk

    def _single(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        found = self.single.get(token)
        if found is None:
            merged = self.library.model.tokenize(self.text_of[token])
            found = self.single[token] = [t.id for t in merged] == [token]
        return found

    def _apart(self, pair: tuple[int, int]) -> bool:
        """Whether the merges leave two tokens, side by side, as they are.

        Undoes the merges of both, the latest first, and looks at the pieces that face each other: if
        these have a merge of their own that comes before the ones just undone (of equal merges the
        left one comes first), it would have been made instead.
        """
        found = self.pairs.get(pair)
        if found is not None:
            return found
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        left, right = pair
        left_gone = right_gone = len(self.rank_of_pair)
        piece = (-1, 0, 0)
        while True:
            across = self.rank_of_pair.get((left, right))
            if across is not None and across < left_gone and across <= right_gone:
                self.pairs[pair] = False
                return False
            of_left, of_right = self.made_of.get(left, piece), self.made_of.get(right, piece)
            if of_left[0] > of_right[0]:
                left_gone, left = of_left[0], of_left[2]
            elif of_right[0] >= 0:
                right_gone, right = of_right[0], of_right[1]
            else:
                self.pairs[pair] = True
                return True

    def _program(self, chunk: str) -> list[int]:
        """Counts of a chunk's prefixes of 1, 2, ... code points."""
        data = chunk.encode()
        text, n = "".join(map(self.letters.__getitem__, data)), len(data)
        count, last = [0] * (n + 1), [-1] * (n + 1)
        pairs, done = self.pairs, 0
        for end, (token, length) in self.tokens.iter(text):
            end += 1
            if end == done:
                continue  # the last token of this prefix is known
            before = last[end - length]
            if before < 0:
                fits = self._single(token)
            else:
                fits = pairs.get((before, token))
                if fits is None:
                    fits = self._apart((before, token))
                    pairs = self.pairs
            if fits:
                last[end], count[end], done = token, count[end - length] + 1, end
        if len(chunk) == n:
            return count[1:]
        return [count[at] for at in accumulate(len(c.encode()) for c in chunk)]

    def chunk(self, chunk: str) -> bytes:
        """Counts of a chunk's prefixes, as a text that ends within it would have them."""
        found = self.known.get(chunk)
        if found is None:
            counts = self._program(chunk)
            if chunk in _BREAKS:  # cut off, the quote is a chunk of its own
                counts[1] = counts[0] + self._program(chunk[1])[0]
            found = array("i", counts).tobytes()
            if len(chunk) <= LONGEST_CACHED:
                self.held += 200 + 6 * len(chunk)
                if self.held > CACHE_BYTES:  # the chunks learned first are the commonest
                    self.known = dict(islice(self.known.items(), len(self.known) // 2))
                    self.held //= 2
                self.known[chunk] = found
        return found

    # -- a text

    def chunks(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_CHUNKS.findall(text)
        if SETTLED.search(text) is None:
            return WIDE_CHUNKS.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _segment(self, text: str) -> np.ndarray:
        """Counts of all prefixes of a text without special tokens."""
        if not text:
            return np.zeros(0, np.int64)
        chunks, known = self.chunks(text), self.known
        parts = list(map(known.get, chunks))
        if None in parts:
            parts = [self.chunk(c) if p is None else p for c, p in zip(chunks, parts, strict=True)]
        within = np.frombuffer(b"".join(parts), np.intc).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        tokens = within[ends - 1]
        base = np.cumsum(tokens) - tokens
        counts = within + np.repeat(base, np.diff(ends, prepend=0))
        several = _SEVERAL.search(text) is not None
        for i in [i for i, c in enumerate(chunks) if c.isspace()] if several else ():
            if i + 1 < len(chunks) and chunks[i + 1][0].isspace():
                run = np.frombuffer(self.chunk(chunks[i] + chunks[i + 1][0]), np.intc)
                counts[ends[i]] = base[i] + run[-1]
        return counts

    def counts(self, text: str) -> np.ndarray:
        """How many tokens the library makes of the first 1, 2, ... code points of a text."""
        found = list(self.special.finditer(text)) if self.special else []
        if not found:
            return self._segment(text)
        parts, total, at = [], 0, 0
        for match in found:
            segment = text[at : match.start()]
            counts = self._segment(segment) + total
            parts.append(counts)
            before = int(counts[-1]) if segment else total
            # cut off inside the special string, it is ordinary text after the segment's last words
            spaces = [m.start() for m in _LEADING.finditer(segment)]
            tail = spaces[-1] if spaces else 0
            base = int(counts[tail - 1]) if tail else total
            inside = [base + int(self._segment(segment[tail:] + match[0][:k])[-1]) for k in range(1, len(match[0]))]
            total, at = before + 1, match.end()
            parts.append(np.array([*inside, total], np.int64))
        parts.append(self._segment(text[at:]) + total)
        return np.concatenate(parts)


def counter(path: str) -> PrefixCounter:
    """One counter per worker process."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


# ---- the stored table

#: Rows are passed on when they hold so many bytes of steps.
PASSED_ON = 1 << 23
STORED = ("n_bytes", "n_prefixes", "n_tokens", "steps")


def _steps(counts: np.ndarray) -> bytes:
    steps = np.diff(counts, prepend=0)
    narrow = np.abs(steps).max(initial=0) < 128
    return steps.astype("i1" if narrow else "<i4").tobytes()


def counts_from(steps: bytes, n_prefixes: int) -> np.ndarray:
    """The counts of all prefixes from what is stored of a text."""
    width = len(steps) // n_prefixes if n_prefixes else 1
    return np.cumsum(np.frombuffer(steps, "i1" if width == 1 else "<i4"), dtype=np.int64)


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = counter(path)

    def passed_on(batch: pa.RecordBatch, start: int, rows: list[tuple]) -> pa.RecordBatch:
        part = batch.slice(start, len(rows))
        rest = [(m, c) for m, c in zip(part.schema.names, part.columns, strict=True) if m != "text"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*(c for _, c in rest), *arrays], [*(m for m, _ in rest), *STORED])

    for batch in batches:
        start, held, rows = 0, 0, []
        for value in batch.column("text"):
            text = value.as_py() or ""
            counts = of.counts(text)
            rows.append((len(text.encode()), len(text), int(counts[-1]) if len(counts) else 0, _steps(counts)))
            held += len(rows[-1][3])
            if held > PASSED_ON:
                yield passed_on(batch, start, rows)
                start, held, rows = start + len(rows), 0, []
        if rows:
            yield passed_on(batch, start, rows)


def count_prefixes(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_bytes, n_prefixes, n_tokens, steps``.

    ``n_prefixes`` is the number of code points, ``n_tokens`` the count of the whole text and ``steps``
    the stored counts of its prefixes. Counts are the library's, without begin or end tokens; the
    strings of special tokens in a text count as those tokens. Null and empty texts have no prefix and
    no token. Repeated rows count alike; columns with the results' names are replaced.
    """
    others = [c for c in docs.columns if c != text_col and c.lower() not in STORED]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    plain = docs.select(*(F.col(f"`{m}`").alias(c) for m, c in carried.items()), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([plain.schema[c] for c in carried.values()])
    schema = schema.add("n_bytes", "long").add("n_prefixes", "long").add("n_tokens", "long").add("steps", "binary")
    out = map_batches(plain, lambda b: _count(tokenizer, b), schema)
    return out.select(*(F.col(c).alias(m) for m, c in carried.items()), *STORED)


def _within(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for steps, n in zip(batch.column("steps"), batch.column("n_prefixes").to_pylist(), strict=True):
            fitting = np.flatnonzero(counts_from(steps.as_py(), n) <= limit)
            kept.append(int(fitting[-1]) + 1 if len(fitting) else 0)
        names = [c for c in batch.schema.names if c != "steps"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(kept, pa.int64())], [*names, "chars_within"])


def within_budget(prefixes: DataFrame, limit: int) -> DataFrame:
    """Stored prefixes without their steps, with ``over_limit`` and ``chars_within``.

    ``chars_within`` is the longest beginning, in code points, of at most ``limit`` tokens: all of a
    text within the limit, 0 of an empty one. No text is read, none encoded again.
    """
    results = ("over_limit", "chars_within")
    others = [c for c in prefixes.columns if c.lower() not in (*results, *STORED)]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    plain = prefixes.select(*(F.col(f"`{m}`").alias(c) for m, c in carried.items()), *STORED)
    schema = T.StructType([*(f for f in plain.schema.fields if f.name != "steps"), T.StructField("chars_within", T.LongType())])
    out = map_batches(plain, lambda b: _within(limit, b), schema)
    return out.select(
        *(F.col(c).alias(m) for m, c in carried.items()), "n_bytes", "n_prefixes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"), "chars_within",
    )


def truncate(docs: DataFrame, budgets: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every text cut to its ``chars_within``; ids of both sides are unique, null ids keep their text."""
    of, within = fresh("of", docs.columns), fresh("within", docs.columns)
    cut = budgets.select(F.col(f"`{id_col}`").alias(of), F.col("chars_within").cast("int").alias(within))
    joined = docs.join(cut, F.col(f"`{id_col}`") == F.col(of), "left")
    whole = F.col(f"`{text_col}`")
    text = F.coalesce(F.substring(whole, F.lit(1), F.col(within)), whole)
    return joined.select(*((text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns))
