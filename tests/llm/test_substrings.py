import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose

from footfall.llm import relative_lz, substring_dedup
from footfall.llm.rolling import runs


def cut(size, marks, join):
    kept = [x for x, m in zip(size, marks, strict=True) if not m]
    return sum(marks), sum(m and (i == 0 or not marks[i - 1]) for i, m in enumerate(marks)), hashlib.sha256(join(kept)).hexdigest()


def slow_bytes(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        marks, done = [False] * len(d), 0
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                marks[max(p, done) : p + length] = [True] * (p + length - max(p, done))
                done = p + length
        out.append((doc, len(d), *cut(d, marks, bytes)))
    return out


def slow_words(rows, window):
    rank = lambda doc: (1 << 63) if doc is None else doc
    data = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, data, strict=True):
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, rank(doc)), rank(doc))
    out = []
    for (doc, _), w in zip(rows, data, strict=True):
        marks = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < rank(doc):
                marks[p : p + window] = [True] * window
        out.append((doc, len(w), *cut(w, marks, b" ".join)))
    return out


@pytest.fixture(scope="module")
def rows(odd_rows):
    passage, other = prose(50, 60), prose(51, 90)
    more = [(200 + i, f"{prose(300 + i, 20)} {passage} {prose(400 + i, 15)}") for i in range(6)]
    more += [(220 + i, f"{other[i:]} {prose(500 + i, 30)}") for i in range(5)]       # cut at different places
    more += [(240, prose(60, 40) + passage + passage), (241, "ab" * 700), (242, "a" * 500), (245, "xyz " * 3000), (246, "b" + "xyz " * 120), (243, "a" * 399), (244, "a" * 401)]
    return [(r[0], r[1]) for r in odd_rows] + more


def ordered(found):
    return sorted(found, key=str)


def test_bytes_against_brute_force(spark, rows):
    small = [(d, t if t is None else t[:4000]) for d, t in rows]
    got = substring_dedup.remove_repeats(spark.createDataFrame(small, "doc_id long, text string"), with_text=True).collect()
    assert ordered((r["doc"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == ordered(slow_bytes(small, 400))
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_words_against_brute_force(spark, rows):
    got = relative_lz.remove_earlier(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert ordered((r["doc"], r["n_words"], r["n_removed"], r["n_factors"], r["kept_sha256"]) for r in got) == ordered(slow_words(rows, 13))


def test_pieces_of_long_texts(monkeypatch, spark, rows):
    # local workers import the module anew, so the tasks are called here
    import pyarrow as pa

    monkeypatch.setattr(substring_dedup, "PIECE", 700)
    substring_dedup._hashes.cache_clear()
    text = (prose(5, 500) + prose(6, 300)).encode()
    data = np.frombuffer(text, np.uint8)
    starts = []
    for start, piece in substring_dedup._pieces(data, 400):
        low, count = substring_dedup.unpack(substring_dedup.anchors(piece, 400)[2])
        starts += [start + low[i] + k for i in range(len(low)) for k in range(count[i])]
    assert sorted(starts) == list(range(len(text) - 399))
    periodic = np.frombuffer(b"abcd" * 250, np.uint8)
    low, count = substring_dedup.unpack(substring_dedup.anchors(periodic, 400)[2])
    assert len(low) < 20 and {low[i] + k for i in range(len(low)) for k in range(count[i])} == set(range(601))
    monkeypatch.setattr(relative_lz, "PIECE", 300)
    words = text.split()
    seen = []
    for first, part in relative_lz.word_pieces(text, 13):
        assert part == words[first : first + len(part)]
        if len(part) >= 13:
            _, _, low, count = relative_lz.blocks(part, 13)
            seen += [first + low[i] + k for i in range(len(low)) for k in range(count[i])]
    assert sorted(seen) == list(range(len(words) - 12))
    substring_dedup._hashes.cache_clear()
    assert pa is not None


def test_a_name_leaves_a_piece_once():
    # some of these periods hold a trigger, so that an anchor of one name stands in each of them
    anchored = 0
    for i in range(40):
        piece = np.frombuffer(f"{prose(i, 30)} {f'is on{i}he. ' * 400}{prose(i + 70, 30)}".encode(), np.uint8)
        k, t, at = substring_dedup.anchors(piece, 400)
        low, count = substring_dedup.unpack(at)
        assert len(set(zip(k.tolist(), t.tolist(), strict=True))) == len(k)
        assert sorted(p for x, n in zip(low.tolist(), count.tolist(), strict=True) for p in range(x, x + n)) == list(range(len(piece) - 399))
        seen = Counter(piece[p : p + 400].tobytes() for p in range(len(piece) - 399))
        for x, n, twice in zip(low.tolist(), count.tolist(), (at & 1).tolist(), strict=True):
            assert not twice or all(seen[piece[p : p + 400].tobytes()] > 1 for p in range(x, x + n))
        trigger = substring_dedup.mixed(substring_dedup._hashes(400)[0].windows(substring_dedup._prefixes(piece, 400)[0], 12))
        anchored += (trigger < np.uint64((1 << 64) // substring_dedup.SPACING)).sum() > 300
    assert anchored > 0


def test_equal_blocks_in_a_row_are_one(spark):
    relative_lz._hashes.cache_clear()  # another test's are for short pieces
    for period in (1, 2, 3, 7, 9):
        words = prose(8, 20).encode().split() + [b"w%d" % (i % period) for i in range(9000)] + prose(9, 20).encode().split()
        k, t, low, count = relative_lz.blocks(words, 13)
        assert len(low) < 60 and count.max() < 1 << relative_lz.SPAN_BITS
        assert sorted(p for x, n in zip(low.tolist(), count.tolist(), strict=True) for p in range(x, x + n)) == list(range(len(words) - 12))
    turns = [(i, f"{prose(i, 20)} {'is onhe. ' * (30 * i)}{'a b c ' * (i % 3 * 2000)}{prose(i % 2, 30)}") for i in range(9)]
    got = relative_lz.remove_earlier(spark.createDataFrame(turns, "doc_id long, text string"), with_text=False).collect()
    assert ordered((r["doc"], r["n_words"], r["n_removed"], r["n_factors"], r["kept_sha256"]) for r in got) == ordered(slow_words(turns, 13))


def test_runs():
    start, end = runs(np.array([5, 0, 2, 9]), np.array([7, 2, 3, 12]))
    assert (start.tolist(), end.tolist()) == ([0, 5, 9], [3, 7, 12])


def test_empty(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert relative_lz.remove_earlier(nothing).count() == 0


def test_ids_must_be_ordered(spark):
    with pytest.raises(TypeError):
        relative_lz.remove_earlier(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
