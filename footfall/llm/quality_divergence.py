"""Quality rules by distribution divergence.

Every document gives two histograms: characters by class, and words by the common words of a
language (all other words in one bin). A language's reference is the sum of both over all its
documents of some length that hold no mass of symbols or capitals; the languages are all those that
the table names. A document is compared with every reference by Jensen-Shannon distance (base 2, 0 to 1)
and the nearest language counts, so a wrong ``lang`` does no harm; one that names a language of which no
document can be a reference is left to the base rules. Short
documents are judged more loosely: their histograms stray by chance, by about
sqrt(bins / (8 * ln 2 * n)), and below a minimum length the word test is left out.

Pass one sums the histograms: a task sends one row per language and bin, so only sums move. Pass
two judges each document where it lies. The references are some seventy numbers a language and go to
the tasks ``LANGUAGES_AT_ONCE`` languages at a time: with more, the documents pass once for each such
block and carry the smallest distances so far, so neither driver nor tasks hold more than a block.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches
from footfall.session import delete_paths, shared_path, staging

SYMBOLS = b"#*$%&|<>"
#: References of so many languages are compared in one pass over the documents.
LANGUAGES_AT_ONCE = 1024
#: Common words have at most so many bytes (function words are short), a language so many of them.
WORD_BYTES, COMMON_WORDS = 6, 60

#: Digits count as word characters: numbers and keys in prose are no sign of junk.
CLASSES = {
    "word": b"abcdefghijklmnopqrstuvwxyz0123456789",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "space": b" \t\n\x0b\x0c\r",
    "stop": b".,",
    "symbol": SYMBOLS,
    "control": bytes([*range(0, 9), *range(14, 32), 127]),
    "beyond": bytes(range(0xC0, 0x100)),  # first bytes; later ones do not count
    "later": bytes(range(0x80, 0xC0)),
}
CLASSES["mark"] = bytes(set(range(256)) - set(b"".join(CLASSES.values())))
CLASSES["later"] = CLASSES.pop("later")
N_CLASSES = len(CLASSES) - 1


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, len(CLASSES)))
    for i, chars in enumerate(CLASSES.values()):
        table[list(chars), i] = 1
    return table


BYTE_CLASSES = _byte_classes()
#: A-Z to a-z, every ASCII character that is no letter or digit to a space.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds. Distances are to the nearest reference; ``slack`` is added per unit of the chance term."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_class_distance: float = 0.085
    reference_symbol_percent: int = 1
    reference_upper_percent: int = 20
    max_word_distance: float = 0.15
    min_words_for_word_test: int = 100
    slack: float = 1.0


@dataclass(frozen=True)
class References:
    """A row per language: class shares (``classes``), shares of its common words and of all others (``words``).

    ``bins`` has, for each common word, the places in ``words``, row after row, where it counts.
    """

    classes: np.ndarray
    words: np.ndarray
    bins: dict[bytes, list[int]]
    languages: frozenset[str] = frozenset()

    def leaves_out(self, lang: str | None) -> bool:
        """Whether a text names a language that there is no reference of (one that names none may be any)."""
        return bool(self.languages) and lang is not None and lang not in self.languages

    @staticmethod
    def of(
        classes: list[np.ndarray], words: list[dict[bytes, float]], totals: list[float], languages: list[str] = ()
    ) -> References:
        """From class counts, counts of common words and of all words, in the same order of languages."""
        shares = np.zeros((len(words), COMMON_WORDS + 1))
        bins: dict[bytes, list[int]] = {}
        for i, (found, total) in enumerate(zip(words, totals, strict=True)):
            for k, word in enumerate(sorted(found, key=lambda w: (-found[w], w))):
                shares[i, k] = found[word] / total
                bins.setdefault(word, []).append(i * shares.shape[1] + k)
            shares[i, -1] = 1 - shares[i].sum()
        return References(np.array([c / c.sum() for c in classes]).reshape(-1, N_CLASSES), shares, bins, frozenset(languages))


def byte_counts(data: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256)


def base_metrics(text: str, data: bytes, counts: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, its UTF-8 and its byte counts."""
    words = data.split()
    chars = len(text) - len(data) + sum(map(len, words))  # white space is one byte a character
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_symbols = int(counts[list(SYMBOLS)].sum())
    return len(words), chars, n_symbols, len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words inside a run of three words that the text holds twice or more (runs are told apart by 64-bit hashes)."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = (h[:-2] * MIX[0] + h[1:-1]) * MIX[1] + h[2:]
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    again = np.isin(runs, twice)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(runs)] |= again
    return int(inside.sum())


MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def base_failed(n_words: int, n_repeat_words: int, rules: QualityRules) -> bool:
    return n_words < rules.min_words or 100 * n_repeat_words > rules.max_repeat_percent * n_words


def class_histogram(counts: np.ndarray) -> np.ndarray:
    return (counts @ BYTE_CLASSES)[:N_CLASSES]


def plain_words(data: bytes) -> Counter:
    """Counts of the runs of letters and digits, A-Z lower-cased."""
    return Counter(data.translate(PLAIN).split())


def _is_reference(data: bytes, histogram: np.ndarray, rules: QualityRules) -> bool:
    """Documents of some length without a mass of symbols or capitals."""
    classes = dict(zip(CLASSES, histogram.tolist(), strict=False))
    total = sum(classes.values())
    return (
        data.count(b" ") + data.count(b"\n") >= rules.min_words
        and 100 * classes["symbol"] <= rules.reference_symbol_percent * total
        and 100 * classes["upper"] <= rules.reference_upper_percent * total
    )


def _sum_histograms(rules: QualityRules, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(N_CLASSES))
    words: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = (text or "").encode()
            histogram = class_histogram(byte_counts(data))
            if not _is_reference(data, histogram, rules):
                continue
            classes[lang] += histogram
            counts = plain_words(data)
            words[lang][b""] += counts.total()
            words[lang].update({w: n for w, n in counts.items() if len(w) <= WORD_BYTES})
        if sum(map(len, words.values())) > 200_000:  # bounded memory; the rest of the sum is Spark's
            yield _histogram_rows(classes, words)
            classes.clear()
            words.clear()
    yield _histogram_rows(classes, words)


def _histogram_rows(classes: dict, words: dict) -> pa.RecordBatch:
    rows = [(lang, f"class {name}", int(n)) for lang, h in classes.items() for name, n in zip(CLASSES, h, strict=False)]
    rows += [(lang, f"word {w.decode()}", n) for lang, c in words.items() for w, n in c.items()]
    lang, item, n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(item, pa.string()), pa.array(n, pa.int64())], ["lang", "item", "n"]
    )


def reference_blocks(
    docs: DataFrame, rules: QualityRules, at_once: int, max_languages: int | None = None,
    lang_col: str = "lang", text_col: str = "text",
) -> Iterator[References]:
    """References of all languages of ``docs``, about ``at_once`` of them at a time (at least one block, maybe empty).

    Each is summed over all documents of the language that ``_is_reference`` admits. The commonest
    ``max_languages`` alone count where a caller asks for that.
    """
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null")
    if max_languages is not None:
        named = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        texts = texts.join(named.orderBy(F.desc("n"), "lang").limit(max_languages), "lang", "left_semi")
    with staging(docs.sparkSession) as stage:
        sums = map_batches(texts, lambda batches: _sum_histograms(rules, batches), "lang string, item string, n long")
        sums = stage(sums.groupBy("lang", "item").agg(F.sum("n").alias("n")), "histograms")
        # some seventy rows a language: all classes, all its words as one number, its commonest words
        is_word = F.col("item").startswith("word ") & (F.col("item") != "word ")
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
        top = sums.where(is_word).withColumn("place", place).where(F.col("place") <= COMMON_WORDS).drop("place")
        rows = sums.where(~is_word).unionByName(top)
        n_blocks = -(-sums.where("item = 'word '").count() // at_once)
        if n_blocks < 2:
            yield _references(rows.collect())
            return
        rows = stage(rows.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(n_blocks))), "references")
        for block in range(n_blocks):
            refs = _references(rows.where(F.col("block") == block).drop("block").collect())
            if refs.languages:
                yield refs


def language_references(
    docs: DataFrame, rules: QualityRules, max_languages: int | None = None, lang_col: str = "lang", text_col: str = "text"
) -> References:
    """``reference_blocks`` as one."""
    return next(reference_blocks(docs, rules, sys.maxsize, max_languages, lang_col, text_col))


def _references(rows: list[Row]) -> References:
    names = list(CLASSES)
    classes: dict[str, np.ndarray] = {}
    counts: dict[str, dict[bytes, int]] = defaultdict(dict)
    for row in rows:
        kind, _, name = row["item"].partition(" ")
        if kind == "class":
            classes.setdefault(row["lang"], np.zeros(N_CLASSES))[names.index(name)] = row["n"]
        else:
            counts[row["lang"]][name.encode()] = row["n"]
    known = [lang for lang in sorted(classes) if counts[lang].get(b"")]
    totals = [counts[lang].pop(b"") for lang in known]
    return References.of([classes[lang] for lang in known], [counts[lang] for lang in known], totals, known)


def nearest(shares: np.ndarray, references: np.ndarray) -> float:
    """Smallest Jensen-Shannon distance (base 2) of rows of shares and of references: 0 equal, 1 disjoint."""
    middle = (shares + references) / 2
    middle[middle == 0] = 1
    left = shares * np.log2(np.where(shares > 0, shares, middle) / middle)
    right = references * np.log2(np.where(references > 0, references, middle) / middle)
    return float(np.sqrt(max(0.0, ((left + right).sum(axis=1) / 2).min())))


def distances(data: bytes, histogram: np.ndarray, refs: References) -> tuple[float | None, float | None]:
    """Distance of the classes and of the common words to the nearest reference (null without any)."""
    if not data or not len(refs.classes):
        return None, None
    by_class = nearest(histogram[None, :] / histogram.sum(), refs.classes)
    counts = plain_words(data)
    total = counts.total()
    if not total:
        return by_class, None
    found = np.zeros(refs.words.shape)
    met = [(place, counts[word]) for word in refs.bins.keys() & counts.keys() for place in refs.bins[word]]
    if met:
        found.reshape(-1)[[place for place, _ in met]] = [n for _, n in met]
    found[:, -1] = total - found.sum(axis=1)
    return by_class, nearest(found / total, refs.words)


def chance_term(bins: int, n: int) -> float:
    return float(np.sqrt(bins / (8 * np.log(2) * max(n, 1))))


def verdict(n_words: int, n_chars: int, by_class: float | None, by_word: float | None, rules: QualityRules) -> bool:
    if by_class is not None and by_class > rules.max_class_distance + rules.slack * chance_term(N_CLASSES, n_chars):
        return False
    if by_word is None or n_words < rules.min_words_for_word_test:
        return True
    return by_word <= rules.max_word_distance + rules.slack * chance_term(COMMON_WORDS, n_words)


METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


#: What texts carry from block to block: whether a block held their language, smallest distances so far.
SO_FAR = {"placed": pa.bool_(), "by_class": pa.float64(), "by_word": pa.float64()}


def _so_far(batch: pa.RecordBatch) -> list[tuple]:
    """The values of ``SO_FAR`` row by row; without any block yet all are null."""
    if SO_FAR.keys() <= set(batch.schema.names):
        return list(zip(*(batch.column(c).to_pylist() for c in SO_FAR), strict=True))
    return [(None, None, None)] * batch.num_rows


def _compared(refs: References, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with ``SO_FAR`` brought up to one more block of references."""

    def smaller(a: float | None, b: float | None) -> float | None:
        return b if a is None else a if b is None else min(a, b)

    for batch in batches:
        rows = []
        for value, lang, (placed, *known) in zip(batch.column("text"), batch.column("lang").to_pylist(), _so_far(batch), strict=True):
            data = (value.as_py() or "").encode()
            found = distances(data, class_histogram(byte_counts(data)), refs)
            rows.append((bool(placed) or not refs.leaves_out(lang), *map(smaller, known, found)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(SO_FAR)
        rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in SO_FAR]
        yield pa.RecordBatch.from_arrays(
            [*(c for _, c in rest), *(pa.array(c, k) for c, k in zip(columns, SO_FAR.values(), strict=True))],
            [*(n for n, _ in rest), *SO_FAR],
        )


def _judged(rules: QualityRules, refs: References, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        langs = batch.column("lang").to_pylist()
        for value, lang, (placed, by_class, by_word) in zip(batch.column("text"), langs, _so_far(batch), strict=True):
            text = value.as_py()
            data = (text or "").encode()
            counts = byte_counts(data)
            base = base_metrics(text or "", data, counts)
            if placed is None:
                placed, (by_class, by_word) = not refs.leaves_out(lang), distances(data, class_histogram(counts), refs)
            by_class, by_word = (by_class, by_word) if placed else (None, None)
            failed = base_failed(base[0], base[4], rules)
            kept = not failed and verdict(base[0], len(text or ""), by_class, by_word, rules)
            rows.append((*base, by_class, by_word, failed, kept))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
        names = [n for n in batch.schema.names if n.startswith("c")]
        rest = [batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*rest, batch.column("text"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            [*names, "text", *(f"m{i}" for i in range(9))],
        )


def _compared_in_passes(plain: DataFrame, blocks: Iterable[References]) -> DataFrame:
    """``plain`` with ``SO_FAR`` over all blocks, stored after each of them (a folder goes once the next is written)."""
    spark, last = plain.sparkSession, None
    schema = T.StructType(plain.schema.fields + T.StructType.fromDDL("placed boolean, by_class double, by_word double").fields)
    for refs in blocks:
        path = shared_path(spark, "compared")
        map_batches(plain, partial(_compared, refs), schema).write.parquet(path)
        plain = spark.read.schema(schema).parquet(path)
        if last is not None:
            delete_paths(spark, [last])
        last = path
    return plain


RESULTS = [*METRICS, "class_distance", "word_distance", "base_failed", "kept"]


def judge_quality(
    docs: DataFrame, rules: QualityRules = QualityRules(), refs: References | None = None,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``docs`` with the base metrics, both distances, ``base_failed`` and ``kept`` (replacing columns so named).

    Words are runs of other than ASCII white space. Null and empty texts have no words and fail the
    base rules; every row is judged by itself, so repeated rows are judged alike. Without ``refs``
    they are learned from ``docs``, of all its languages; where there are none (an empty table, a language
    without a text fit to be one) the base rules decide alone. All other columns pass through.
    """
    others = [c for c in docs.columns if c != text_col and c.lower() not in RESULTS]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    plain = docs.select(
        *(F.col(f"`{n}`").alias(c) for n, c in carried.items()), F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    blocks = iter([refs]) if refs is not None else reference_blocks(
        docs, rules, LANGUAGES_AT_ONCE, lang_col=lang_col, text_col=text_col
    )
    refs, more = next(blocks), next(blocks, None)
    schema = T.StructType([plain.schema[c] for c in carried.values()] + [plain.schema["text"]])
    if more is not None:
        plain = _compared_in_passes(plain, chain((refs, more), blocks))
    for i in range(9):
        schema = schema.add(f"m{i}", "long" if i < 5 else "double" if i < 7 else "boolean")
    out = map_batches(plain, lambda batches: _judged(rules, refs, batches), schema)
    back = {n: F.col(c).alias(n) for n, c in carried.items()} | {text_col: F.col("text").alias(text_col)}
    return out.select(*(back[n] for n in docs.columns if n in back), *(F.col(f"m{i}").alias(n) for i, n in enumerate(RESULTS)))
