"""SentencePiece N-best segmentation and decoding.

A text's lattice has an edge for every vocabulary piece. Forward Viterbi gives the best score from
the start to every place. The search for the N best paths then runs backward from the end with
A*: the forward score is the exact score of the best way to complete a partial path, so paths leave
the queue in order of their full score and nothing but the N best is ever completed.

No piece has a space mark after another character, and none has a line end, so a lattice falls apart
at these places into words. Equal words are searched once and remembered. A text's best path is that
of its words; the next ones differ from it in the words whose second path costs least, and the
difference of the second path is known from the forward scores alone (the cheapest edge beside the
best path), so A* runs only in words that can be among the N best.

Texts are taken some at a time, and the words in them that are not remembered are searched forward
side by side, place by place, with the pieces found in a trie of arrays.
"""

from __future__ import annotations

import gc
import heapq
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches

MARK = "▁"
#: Scores below this are placeholders of the model; they count as its lowest other score.
PLACEHOLDER = -1e8
#: What a worker remembers of words and of their further paths, in bytes; longer words are not remembered.
WORD_BYTES, PATH_BYTES, LONGEST = 48 << 20, 16 << 20, 200
#: Characters of the texts whose words are searched together, and of the words in one set of arrays.
TOGETHER, IN_ARRAYS = 1 << 18, 1 << 14
_models: dict[str, PieceModel] = {}


class PieceTrie:
    """Forward Viterbi over many words at once, every character of which is a piece."""

    def __init__(self, pieces: dict[str, tuple[float, int]]) -> None:
        nodes = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                nodes.setdefault(p[:k], len(nodes))
        letters = sorted({p[-1] for p in nodes if p})
        self.longest = max(map(len, nodes))
        self.size = len(letters) + 1
        #: Number of each character, 0 if no piece has it.
        self.number = np.zeros(0x110000, np.uint16 if self.size < 1 << 16 else np.uint32)
        self.number[[ord(c) for c in letters]] = np.arange(1, self.size)
        steps = sorted((nodes[p[:-1]] * self.size + int(self.number[ord(p[-1])]), i) for p, i in nodes.items() if p)
        steps.append((np.iinfo(np.int64).max, 0))
        self.step, self.to = (np.array(x, np.int64) for x in zip(*steps, strict=True))
        self.first = np.array([nodes.get(p, 0) for p in ["", *letters]], np.int64)
        #: Score and id of the piece that ends at a node; no score at what is only the beginning of pieces.
        self.weight, self.piece = np.full(len(nodes), -np.inf), np.zeros(len(nodes), np.int32)
        for p, (weight, i) in pieces.items():
            self.weight[nodes[p]], self.piece[nodes[p]] = weight, i

    def best(self, words: list[str]) -> tuple[list[float], np.ndarray, list[int], list[float]]:
        """Score of each word's best path, the ids of all one after the other, where each ends, what the second falls short by.

        The words come longest first. Arrays go by place, and inside a place by word, so those still
        running are the first ones of each place.
        """
        n, sizes = len(words), np.array([len(w) for w in words])
        running = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # words of more characters than the place
        begin = np.cumsum(running) - running
        word = np.repeat(np.arange(n), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cells = begin[place] + word
        letters = np.zeros(len(word) + 1, np.int64)
        letters[cells] = self.number[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")]
        after = np.full(len(word) + 1, len(word))  # the cell of a word's next character; behind its last one a cell without letter
        after[cells[:-1]] = np.where(word[1:] == word[:-1], cells[1:], len(word))
        # pieces by length and by the cell in which they end
        weight, reached = np.full((self.longest, len(word)), -np.inf), np.zeros((self.longest, len(word)), np.int32)
        cell, node = np.arange(len(word)), self.first[letters[:-1]]
        for k in range(self.longest):
            if k:
                cell = after[cell]
                wanted = node * self.size + letters[cell]
                at = np.searchsorted(self.step, wanted)
                on = np.flatnonzero(self.step[at] == wanted)
                cell, node = cell[on], self.to[at[on]]
            weight[k, cell], reached[k, cell] = self.weight[node], node
        score, second = np.zeros((len(running) + 1, n)), np.empty((len(running) + 1, n))
        back = np.zeros((len(running) + 1, n), np.int64)
        for end, (most, first) in enumerate(zip(running.tolist(), begin.tolist(), strict=True), 1):
            few = min(end, self.longest)
            ways = score[end - few : end, :most] + weight[few - 1 :: -1, first : first + most]  # the longest piece first
            top, every = ways.argmax(axis=0), np.arange(most)
            score[end, :most], back[end, :most] = ways[top, every], few - top
            ways[top, every] = -np.inf
            second[end, :most] = ways.max(axis=0)
        # the way back
        word, at, loss = np.arange(n), sizes.copy(), np.full(n, np.inf)
        owners, ids = [], []
        while len(word):
            loss[word] = np.minimum(loss[word], score[at, word] - second[at, word])
            k = back[at, word]
            owners.append(word)
            ids.append(self.piece[reached[k - 1, begin[at - 1] + word]])
            at = at - k
            word, at = word[at > 0], at[at > 0]
        owner = np.concatenate(owners[::-1])
        in_order = np.concatenate(ids[::-1])[np.argsort(owner, kind="stable")]
        return score[sizes, np.arange(n)].tolist(), in_order, np.cumsum(np.bincount(owner, minlength=n)).tolist(), loss.tolist()


class PieceModel:
    """Pieces of a SentencePiece model with their scores; a lattice search and a decoder over them."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.normalize = model.normalize
        self.pieces = {
            model.id_to_piece(i): (model.get_score(i), i)
            for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        lowest = min((s for s, _ in self.pieces.values() if s > PLACEHOLDER), default=0.0)
        self.unknown_score = lowest - 10
        self.pieces = {p: (max(s, lowest), i) for p, (s, i) in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=1)
        #: Score and id of each piece; None for what is only the beginning of pieces.
        self.entries: dict[str, tuple[float, bytes] | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.entries |= {p: (s, i.to_bytes(4, "little")) for p, (s, i) in self.pieces.items()}
        self.letters = {p for p in self.pieces if len(p) == 1}
        self.texts = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else b"" if model.is_control(i) else "⁇".encode() if model.is_unknown(i)
            else model.id_to_piece(i).replace(MARK, " ").encode()
            for i in ids
        ]
        self.trie = PieceTrie(self.pieces)
        inner = any(MARK in p.lstrip(MARK) for p in self.pieces)
        used = set("".join(self.pieces))
        self.alone = [chr(c) for c in range(32) if chr(c) not in used]
        alone = re.escape("".join(self.alone))
        self.word = None if inner else re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+|[{alone}]")
        self.known: dict[str, tuple[float, bytes, float, bytes]] = {}
        self.searched: dict[str, list[tuple[float, bytes, bytes]]] = {}
        self.known_bytes = self.searched_bytes = 0

    # -- one word

    def _forward(self, word: str) -> tuple[list[float], list[list[tuple[float, int, bytes]]]]:
        """Best score to every place, and the edges that end there: score, start, ids."""
        ending: list[list[tuple[float, int, bytes]]] = [[] for _ in range(len(word) + 1)]
        best = [0.0] + [-np.inf] * len(word)
        for start in range(len(word)):
            for end in range(start + 1, len(word) + 1):
                found = self.entries.get(word[start:end], 0)
                if not found and end == start + 1:
                    found = self._unknown(word[start])
                if found:
                    ending[end].append((found[0], start, found[1]))
                    best[end] = max(best[end], best[start] + found[0])
                elif found == 0:
                    break
        return best, ending

    def best(self, word: str) -> tuple[float, bytes, float]:
        """Score and ids of the best path, and by how much the second falls short (infinite without one)."""
        n, entry = len(word), self.entries.get
        score, second = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1)
        back: list[tuple[int, bytes]] = [(0, b"")] * (n + 1)
        for start in range(n):
            at = score[start]
            for end in range(start + 1, n + 1):
                found = entry(word[start:end], 0)
                if found is None:  # only the beginning of pieces
                    if end > start + 1:
                        continue
                    found = self._unknown(word[start])
                elif not found:
                    if end > start + 1:
                        break
                    found = self._unknown(word[start])
                new = at + found[0]
                if new > score[end]:
                    second[end], score[end], back[end] = score[end], new, (start, found[1])
                elif new > second[end]:
                    second[end] = new
        return self._traced(score, second, back)

    def _traced(self, score: list[float], second: list[float], back: list[tuple[int, bytes]]) -> tuple[float, bytes, float]:
        at, ids, loss = len(score) - 1, [], np.inf
        while at:
            loss = min(loss, score[at] - second[at])
            at, found = back[at]
            ids.append(found)
        ids.reverse()
        return score[-1], b"".join(ids), loss

    def _unknown(self, char: str) -> tuple[float, bytes]:
        ids = [self.bytes.get(b) for b in char.encode("utf-8", "surrogatepass")]
        ids = [self.unknown_id] if None in ids else ids
        return self.unknown_score, b"".join(i.to_bytes(4, "little") for i in ids)

    def search(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best paths, best first, by backward A*."""
        forward, ending = self._forward(word)
        queue = [(-forward[-1], 0, len(word), 0.0, None)]
        found, order = [], 0
        while queue and len(found) < n:
            rank, _, at, behind, path = heapq.heappop(queue)
            if at == 0:
                ids = []
                while path is not None:
                    ids.append(path[0])
                    path = path[1]
                found.append((-rank, b"".join(ids)))
                continue
            for weight, start, ids in ending[at]:
                order += 1
                heapq.heappush(queue, (-(forward[start] + weight + behind), order, start, behind + weight, (ids, path)))
        return found

    # -- a text

    def words(self, text: str) -> list[str]:
        marked = self.normalize(text)
        if self.word is None:
            return [marked] if marked else []
        if MARK + MARK in marked or "\0" in marked:
            return self.word.findall(marked)
        cut = marked.replace(MARK, "\0" + MARK)
        for char in self.alone:
            if char in marked:
                cut = cut.replace(char, f"\0{char}\0")
        return [w for w in cut.split("\0") if w]

    def _learned(self, words: list[str]) -> dict[str, tuple[float, bytes, float, bytes]]:
        """Entries of new words, which are remembered while there is room."""
        new: dict[str, tuple[float, bytes, float, bytes]] = {}
        every = self.letters.issuperset("".join(words))
        of_letters = [w for w in words if len(w) <= LONGEST and (every or self.letters.issuperset(w))]
        of_letters.sort(key=len, reverse=True)
        start = 0
        while start < len(of_letters):
            part = of_letters[start : start + max(1, IN_ARRAYS // len(of_letters[start]))]
            start += len(part)
            scores, pieces, ends, losses = self.trie.best(part)
            ids, texts, at = pieces.astype("<i4").tobytes(), list(map(self.texts.__getitem__, pieces.tolist())), 0
            for word, score, end, loss in zip(part, scores, ends, losses, strict=True):
                new[word] = (score, ids[4 * at : 4 * end], loss, b"".join(texts[at:end]))
                at = end
            self.known_bytes += 300 * len(part) + 2 * sum(map(len, part)) + len(ids) + sum(map(len, texts))
        self.known.update(new)
        if len(new) < len(words):
            for word in words:
                if word not in new:
                    score, ids, loss = self.best(word)
                    new[word] = entry = (score, ids, loss, self._spelled(ids))
                    if len(word) <= LONGEST:
                        self.known_bytes += 300 + 2 * len(word) + len(ids) + len(entry[3])
                        self.known[word] = entry
        if self.known_bytes > WORD_BYTES:  # the words learned first are the commonest
            self.known = dict(islice(self.known.items(), len(self.known) // 2))
            self.known_bytes //= 2
        return new

    def n_best(self, text: str, n: int) -> list[tuple[float, bytes, bytes]]:
        """The ``n`` best segmentations of a text, best first: score, ids (little-endian, 32 bits), decoded bytes."""
        return next(self.n_best_of_each([text], n))

    def n_best_of_each(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes, bytes]]]:
        """``n_best`` of some texts, whose new words are searched together."""
        cut = [self.words(text) for text in texts]
        found = [list(map(self.known.get, words)) for words in cut]
        gaps = [(words, entries) for words, entries in zip(cut, found, strict=True) if None in entries]
        new = self._learned(list(dict.fromkeys(w for words, entries in gaps for w, e in zip(words, entries, strict=True) if e is None)))
        for words, entries in gaps:
            entries[:] = [e or new[w] for w, e in zip(words, entries, strict=True)]
        del new
        for words, entries in zip(cut, found, strict=True):
            yield self._ranked(words, entries, n)

    def _ranked(self, words: list[str], found: list[tuple[float, bytes, float, bytes]], n: int) -> list[tuple[float, bytes, bytes]]:
        """The ``n`` best paths of a text from the entries of its words.

        Of equal scores, those that leave the best path in earlier words come first. A further path is
        the best one with a few words replaced, in its ids and in its bytes alike.
        """
        if not found:
            return [(0.0, b"", b"")]
        scores, ids, losses, spelled = zip(*found, strict=True)
        total = sum(scores)
        all_ids, all_bytes = b"".join(ids), b"".join(spelled)
        out = [(total, all_ids, _without_first_space(all_bytes))]
        if n < 2:
            return out
        # another path changes words; only the n - 1 words with the smallest loss can be among the n best
        loss_of = np.array(losses)
        last = np.sort(np.partition(loss_of, min(n - 1, len(losses)) - 1)[: n - 1])[-1]
        near = np.flatnonzero(loss_of < last).tolist() + np.flatnonzero(loss_of == last).tolist()
        near = sorted(i for i in near[: n - 1] if losses[i] < np.inf)
        choices: list[tuple[float, tuple]] = [(0.0, ())]
        paths_of = {i: self._paths(words[i], n) for i in near}
        for i in near:
            top = paths_of[i][0][0]
            merged = [(loss + top - s, (*changed, (i, k)) if k else changed) for loss, changed in choices for k, (s, _, _) in enumerate(paths_of[i])]
            choices = heapq.nsmallest(n, merged)
        start_ids = {i: sum(map(len, ids[:i])) for i in near}
        start_bytes = {i: sum(map(len, spelled[:i])) for i in near}
        for loss, changed in choices[1:]:
            other_ids, other_bytes = [], []
            at_ids = at_bytes = 0
            for i, k in changed:
                _, new_ids, new_bytes = paths_of[i][k]
                other_ids += (all_ids[at_ids : start_ids[i]], new_ids)
                other_bytes += (all_bytes[at_bytes : start_bytes[i]], new_bytes)
                at_ids, at_bytes = start_ids[i] + len(ids[i]), start_bytes[i] + len(spelled[i])
            other_ids.append(all_ids[at_ids:])
            other_bytes.append(all_bytes[at_bytes:])
            out.append((total - loss, b"".join(other_ids), _without_first_space(b"".join(other_bytes))))
        return out

    def _paths(self, word: str, n: int) -> list[tuple[float, bytes, bytes]]:
        found = self.searched.get(word)
        if found is None or len(found) < n:
            found = [(score, ids, self._spelled(ids)) for score, ids in self.search(word, n)]
            if len(word) <= LONGEST:
                self.searched_bytes += 200 + sum(200 + len(ids) + len(data) for _, ids, data in found)
                if self.searched_bytes > PATH_BYTES:
                    self.searched, self.searched_bytes = {}, 0
                self.searched[word] = found
        return found[:n]

    def _spelled(self, ids: bytes) -> bytes:
        return b"".join(map(self.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """The text of ids: bytes joined to characters, marks to spaces, the first space dropped."""
        return _without_first_space(self._spelled(ids)).decode("utf-8", "replace")


def _without_first_space(data: bytes) -> bytes:
    return data[1:] if data[:1] == b" " else data


def piece_model(path: str) -> PieceModel:
    """One model per worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


RESULTS = {
    "n_pieces": pa.int64(), "score": pa.float64(), "n_found": pa.int64(), "margin": pa.float64(),
    "ids_crc32": pa.int64(), "round_trip": pa.bool_(),
}
#: Rows are passed on when their paths have this many bytes, so that long texts do not add up.
PASSED_ON = 1 << 22


def _path_lists(paths: list[list[tuple[float, bytes, bytes]]]) -> pa.Array:
    """``list<struct<score, ids, decoded>>``, built from flat arrays: one object per piece would be slow."""
    every = [path for of_row in paths for path in of_row]
    places = np.cumsum([0, *(len(ids) // 4 for _, ids, _ in every)], dtype=np.int32)
    pieces = pa.array(np.frombuffer(b"".join(ids for _, ids, _ in every), "<i4"), pa.int32())
    parts = [
        pa.array([score for score, _, _ in every], pa.float64()),
        pa.ListArray.from_arrays(pa.array(places, pa.int32()), pieces),
        pa.array([data for _, _, data in every], pa.string()),
    ]
    rows = np.cumsum([0, *map(len, paths)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.StructArray.from_arrays(parts, ["score", "ids", "decoded"]))


@contextmanager
def _without_collector() -> Iterator[None]:
    """Entries of words hold no cycles; the collector of cycles would only walk them, again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _segment(path: str, n: int, with_paths: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with _without_collector():
        yield from _segmented(path, n, with_paths, batches)


def _segmented(path: str, n: int, with_paths: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = piece_model(path)

    def passed_on(batch: pa.RecordBatch, start: int, rows: list[tuple], paths: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(RESULTS)
        arrays = [pa.array(c, k) for c, k in zip(columns, RESULTS.values(), strict=True)]
        names = list(RESULTS)
        if with_paths:
            arrays.append(_path_lists(paths))
            names.append("paths")
        part = batch.slice(start, len(rows))
        rest = [(m, c) for m, c in zip(part.schema.names, part.columns, strict=True) if m != "text"]
        return pa.RecordBatch.from_arrays([*(c for _, c in rest), *arrays], [*(m for m, _ in rest), *names])

    for batch in batches:
        start, held, rows, paths = 0, 0, [], []
        for texts in _together(batch.column("text")):
            for text, found in zip(texts, model.n_best_of_each(texts, n), strict=True):
                data = text.encode()
                score, ids, _ = found[0]
                margin = score - found[1][0] if len(found) > 1 else None
                whole = [decoded == data for _, _, decoded in found]
                rows.append((len(ids) // 4, score, len(found), margin, zlib.crc32(ids), all(whole)))
                if with_paths:
                    # what does not spell the text may be no valid UTF-8
                    paths.append([
                        (s, i, d if same else d.decode("utf-8", "replace").encode())
                        for (s, i, d), same in zip(found, whole, strict=True)
                    ])
                    held += sum(len(i) + len(d) for _, i, d in found)
                if held > PASSED_ON:
                    yield passed_on(batch, start, rows, paths)
                    start, held, rows, paths = start + len(rows), 0, [], []
        if rows:
            yield passed_on(batch, start, rows, paths)


def _together(column: pa.Array) -> Iterator[list[str]]:
    """Texts (nulls: empty) some at a time: of TOGETHER characters, or a longer one at the end."""
    texts, held = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        held += len(texts[-1])
        if held >= TOGETHER:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def segment(
    docs: DataFrame, model_path: str, n_best: int = 4, with_paths: bool = True, text_col: str = "text",
) -> DataFrame:
    """``docs`` without the text, with its segmentation.

    ``n_pieces, score, ids_crc32`` of the best path, ``n_found`` (how many of the ``n_best`` exist),
    ``margin`` (best score less second, null without a second), ``round_trip`` (decoding gives the
    text back, for every path found) and, ``with_paths``, ``paths`` (of each its score, ids and
    decoded text, best first). Null and empty texts have one empty path of score 0. Characters beyond
    the vocabulary become their bytes. Repeated rows are segmented alike; columns with the results'
    names are replaced.
    """
    results = {*RESULTS, "paths"}
    others = [c for c in docs.columns if c != text_col and c not in results]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    plain = docs.select(*(F.col(f"`{m}`").alias(c) for m, c in carried.items()), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([plain.schema[c] for c in carried.values()])
    schema = schema.add("n_pieces", "long").add("score", "double").add("n_found", "long").add("margin", "double")
    schema = schema.add("ids_crc32", "long").add("round_trip", "boolean")
    if with_paths:
        schema = T.StructType(schema.fields + T.StructType.fromDDL("paths array<struct<score:double,ids:array<int>,decoded:string>>").fields)
    out = map_batches(plain, lambda b: _segment(model_path, n_best, with_paths, b), schema)
    return out.select(*(F.col(c).alias(m) for m, c in carried.items()), *schema.fieldNames()[len(carried) :])
