"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report, other. Five small transducers read a
clause's symbols side by side: one passes the weight of insults, one knows whether somebody is
addressed, one whether a negation stands shortly before, one whether the clause reports what another
said, one joins a threat with its target. Their composition is a table of states, computed once; a
clause's score is what the composed machine emits. A text's score is a logistic function of its
clauses' scores.

What is learned, and from which rows: the insult lexicon (whole words and word beginnings, with their
log odds) and the logistic function, both from labelled rows of the training folds, at most
``max_rows`` of them, chosen by a hash of the id. Counts are summed in Spark; the lexicon
(``MAX_ENTRIES`` at most) and four numbers a sampled row reach the driver. Target, negation, report
and threat words are fixed lists.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches

# fixed values: closed word classes in the languages of the corpus
TARGETS = set(
    "you your yours yourself he him his she her they them their this that these those we us "
    "du dich dir dein deine ihr euch sie ihn ihm dieser diese dieses "
    "tu te toi ton ta tes vous votre vos il elle ils elles ce cet cette ces "
    "tú ti tu tus usted ustedes él ella ellos ellas este esta estos estas ese esa".split()
)
NEGATIONS = set("not no never nor neither nicht kein keine nie ne pas jamais aucun non nunca ningún ninguna".split())
REPORTS = set(
    "said says say told wrote writes quoted claimed called sagte sagt schrieb nannte "
    "dit disait écrit appelé dijo dice escribió llamó".split()
)
THREATS = set(
    "kill hurt destroy beat shoot burn stab töten schlagen vernichten zerstören "
    "tuer frapper détruire brûler matar golpear destruir quemar".split()
)

SYMBOLS = OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: A negation reaches over so many words after it.
NEGATION_REACH = 3
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT = 0.4, 0.5, 1.25, 4.0
WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.,;:!?|\n\"()]+")
#: Lengths of the word beginnings that can enter the lexicon.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
MAX_ENTRIES, MIN_TOXIC_ROWS, MIN_LOG_ODDS = 5000, 6, 3.0
CACHED_WORDS, KEPT_WORDS = 500_000, 300_000


# ---- the grammar


def _target(state: int, symbol: int) -> tuple[int, float]:
    """Insults weigh more once somebody is addressed."""
    state = 1 if symbol == TARGET else state
    return state, TARGETED if state else 1.0


def _negation(state: int, symbol: int) -> tuple[int, float]:
    """``state`` counts the words that the last negation still reaches."""
    factor = NEGATED if state else 1.0
    return (NEGATION_REACH if symbol == NEGATION else max(0, state - 1)), factor


def _report(state: int, symbol: int) -> tuple[int, float]:
    """After a verb of saying the rest of the clause is another's words."""
    state = 1 if symbol == REPORT else state
    return state, REPORTED if state else 1.0


def _threat(state: int, symbol: int) -> tuple[int, float]:
    """State: 1 target seen, 2 threat seen, 3 both; emits 1 when both have met."""
    seen = state | (1 if symbol == TARGET else 2 if symbol == THREAT else 0)
    return seen, 1.0 if seen == 3 and state != 3 else 0.0


def compose() -> list[list[tuple[int, float, float]]]:
    """Table of the composed machine: state, symbol -> next state, factor of an insult's weight, threat weight."""
    states = list(product(range(2), range(NEGATION_REACH + 1), range(2), range(4)))
    number = {s: i for i, s in enumerate(states)}
    table = []
    for t, n, r, h in states:
        row = []
        for symbol in SYMBOLS:
            t2, by_target = _target(t, symbol)
            n2, by_negation = _negation(n, symbol)
            r2, by_report = _report(r, symbol)
            h2, threat = _threat(h, symbol)
            context = by_negation * by_report
            row.append((number[t2, n2, r2, h2], by_target * context if symbol == INSULT else 0.0, threat * context * THREAT_WEIGHT))
        table.append(row)
    return table


MACHINE = compose()


def clause_score(symbols: list[tuple[int, float]]) -> float:
    """What the composed machine emits for the symbols (and weights) of a clause."""
    state, total = 0, 0.0
    for symbol, weight in symbols:
        state, factor, threat = MACHINE[state][symbol]
        total += factor * weight + threat
    return total


# ---- the lexicon


def entries_of(word: str) -> list[str]:
    """Lexicon entries a word can match: itself (with a closing mark) and its beginnings."""
    return [f"{word}$", *(word[:k] for k in BEGINNINGS if len(word) > k)]


@dataclass(frozen=True)
class ToxicityModel:
    """Log odds by lexicon entry; logistic weights of (1, score, score per clause with a match, score per word)."""

    lexicon: dict[str, float]
    logistic: tuple[float, ...]


class Reader:
    """Turns texts into features; remembers the symbol of each word it met."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, float]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        weight = max((self.lexicon.get(e, 0.0) for e in entries_of(word)), default=0.0)
        if weight:
            return INSULT, weight
        for symbol, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
            if word in words:
                return symbol, 0.0
        return OTHER, 0.0

    def features(self, text: str) -> tuple[float, float, float, float]:
        lowered = text.lower()
        words = WORD.findall(lowered)
        known = self.known
        new = set(words).difference(known)
        if new:
            if len(known) > CACHED_WORDS:
                self.known = known = dict(islice(known.items(), KEPT_WORDS))
                new = set(words).difference(known)
            known.update((w, self.symbol(w)) for w in new)
        if not any(known[w][0] in (INSULT, THREAT) for w in set(words)):
            return 1.0, 0.0, 0.0, 0.0
        scores = [clause_score([known[w] for w in WORD.findall(c)]) for c in CLAUSE_END.split(lowered)]
        total = sum(scores)
        matched = sum(s > 0 for s in scores)
        return 1.0, np.log1p(total), total / max(matched, 1), np.log1p(100 * total / len(words))


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found = {e for w in set(WORD.findall((text or "").lower())) for e in entries_of(w)}
            (toxic if label else clean).update(found)
        if len(toxic) + len(clean) > 400_000:
            yield _entry_rows(toxic, clean)
            toxic.clear()
            clean.clear()
    yield _entry_rows(toxic, clean)


def _entry_rows(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    names = list(toxic | clean)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
        ["entry", "toxic", "clean"],
    )


def _features(lexicon: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader(lexicon)
    for batch in batches:
        rows = [reader.features(t or "") for t in batch.column("text").to_pylist()]
        columns = np.array(rows, float).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column("label")], ["f0", "f1", "f2", "f3", "label"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps on the penalised likelihood."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fold(id_column: Column) -> Column:
    """crc32 of the id as text, mod 3; fold 1 is held out."""
    return F.crc32(id_column.cast("string")) % 3


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """Lexicon and logistic weights from at most about ``max_rows`` labelled rows outside fold 1.

    The sample is chosen by a hash of the id, so it does not depend on the run. Rows without label,
    id or text teach nothing; of several labels of an id the highest counts.
    """
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 1))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    # bounded by max_rows (and its chance deviation), so it may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(rows), "id").select("text", "label")
    sums = map_batches(texts, _count_entries, "entry string, toxic long, clean long").groupBy("entry")
    sums = sums.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    size = rows.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    if not size["toxic"]:
        return ToxicityModel({}, ())
    base = size["toxic"] / max(1, size["n"] - size["toxic"])
    odds = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5) / F.lit(base))
    found = (
        sums.where(F.col("toxic") >= MIN_TOXIC_ROWS).withColumn("odds", odds).where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc("odds"), "entry").limit(MAX_ENTRIES).collect()
    )
    lexicon = {row["entry"]: float(row["odds"]) for row in found}
    sample = map_batches(texts, lambda b: _features(lexicon, b), "f0 double, f1 double, f2 double, f3 double, label int").toPandas()
    x, y = sample[["f0", "f1", "f2", "f3"]].to_numpy(), sample["label"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # sums in a fixed order
    return ToxicityModel(lexicon, tuple(fit_logistic(x[order], y[order]).tolist()))


def _scores(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader(model.lexicon)
    weights = np.array(model.logistic or (-30.0, 0, 0, 0))
    for batch in batches:
        x = np.array([reader.features(t or "") for t in batch.column("text").to_pylist()], float).reshape(-1, 4)
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
        yield pa.RecordBatch.from_arrays([*(c for _, c in rest), batch.column("text"), pa.array(p)], [*(n for n, _ in rest), "text", "score"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``), replacing columns so named.

    Only the text is read. Null and empty texts, and texts without a match, get the lowest score of
    the model; without any labelled toxic row every score is near 0. Repeated rows score alike.
    """
    others = [c for c in docs.columns if c not in (text_col, "score", "predicted")]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    plain = docs.select(*(F.col(f"`{n}`").alias(c) for n, c in carried.items()), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*(plain.schema[c] for c in carried.values()), plain.schema["text"]]).add("score", "double")
    out = map_batches(plain, lambda b: _scores(model, b), schema)
    back = {n: F.col(c).alias(n) for n, c in carried.items()} | {text_col: F.col("text").alias(text_col)}
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return out.select(*(back[n] for n in docs.columns if n in back), "score", predicted)
