import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose

from footfall.llm import quality_divergence as q


def slow_metrics(text):
    data = (text or "").encode()
    words = data.split()
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in data.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(data.count(c.encode()) for c in "#*$%&|<>"), dup, len(inside))


@pytest.mark.parametrize("text", [None, "", "  ", "a", "a a a a", "x y z\nx y z\n\n x", "é è # | ü ö", "a b c d a b c e a b c", "<*> " * 70])
def test_base_metrics(text):
    data = (text or "").encode()
    assert q.base_metrics(text or "", data, q.byte_counts(data)) == slow_metrics(text)


def test_distance_is_jensen_shannon():
    p, r = np.array([[0.5, 0.5, 0.0]]), np.array([[0.25, 0.25, 0.5]])
    m = (p + r) / 2
    want = np.sqrt(sum((np.where(d > 0, d * np.log2(np.where(d > 0, d, 1) / m), 0)).sum() for d in (p, r)) / 2)
    assert q.nearest(p, r) == pytest.approx(want)
    assert q.nearest(np.array([[1.0, 0.0]]), np.array([[0.0, 1.0]])) == pytest.approx(1)
    assert q.nearest(p, p) == 0


def test_junk_goes_and_clean_stays(spark):
    clean = [(i, "Of the " + prose(i, 150).capitalize() + " and the end.", "en") for i in range(30)]
    junk = [
        (100, " ".join(w + "***" for w in prose(7, 150).split()), "en"),
        (101, prose(8, 150).upper().replace(" ", "!! "), "en"),
        (102, prose(9, 150).replace(" ", " | "), "en"),
        (103, "same few words " * 60, "en"),
        (104, "too short", "en"), (105, None, None),
    ]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in q.judge_quality(docs).where("kept").collect()}
    assert kept == {i for i, _, _ in clean}


def test_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = q.judge_quality(docs).join(labels, "doc_id").where("not base_failed").select("kept", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.3 * len(bad)


def test_odd_rows(odd, odd_rows, nothing):
    out = q.judge_quality(odd)
    assert out.count() == odd.count()
    got = sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out.collect())
    assert got == sorted(slow_metrics(r[1]) for r in odd_rows)
    assert not any(r["kept"] for r in out.where("text is null or length(text) < 9").collect())
    assert q.judge_quality(nothing).count() == 0
    assert q.judge_quality(odd, refs=q.References.of([], [], [])).where("kept <> (not base_failed)").count() == 0


def test_every_named_language_has_its_reference(spark):
    """A language of its own script stays; texts in a language beyond the commonest face the base rules alone."""
    russian, greek = "привет как дела сегодня мы идём гулять в парк и потом домой".split(), "και το να είναι στο δεν θα με για από".split()
    rng = random.Random(4)
    rows = [(i, prose(i, 120), "en") for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice(russian) + rng.choice("абвгдежзик") for _ in range(120)), "ru") for i in range(40)]
    rows += [(200 + i, " ".join(rng.choice(greek) + rng.choice("αβγδεζη") for _ in range(120)), "el") for i in range(3)]
    rows += [(300, "### $$$ ||| " * 60, "en"), (301, "слово", "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for limit in (64, 2):
        refs = q.language_references(docs, q.QualityRules(), limit)
        assert refs.languages == ({"en", "ru", "el"} if limit > 2 else {"en", "ru"})
        judged = {r.doc_id: r.kept for r in q.judge_quality(docs, refs=refs).collect()}
        assert all(judged[i] for i in judged if 100 <= i < 300), limit
        assert not judged[300] and not judged[301]


def test_no_language_is_one_too_many(spark, monkeypatch):
    """Junk that names the rarest of 70 languages goes, and blocks of references judge as all of them at once do."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for lang in range(70):
        rng = random.Random(lang)
        words = ["".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(40)]
        texts = 3 if lang < 69 else 2
        rows += [(1000 * lang + i, " ".join(rng.choices(words, k=150)) + ".", f"l{lang:02}") for i in range(texts)]
    junk = " ".join("".join(random.Random(i).choices(letters, k=5)) for i in range(150))
    rows += [(99_000, "### $$$ ||| " + junk.replace(" ", " ||| "), "l69"), (99_001, junk, "zz"), (99_002, "x " * 40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    at_once = {tuple(r) for r in q.judge_quality(docs).collect()}
    kept = {r[0]: r[-1] for r in at_once}
    assert not kept[99_000] and all(kept[i] for i in kept if i < 99_000)
    monkeypatch.setattr(q, "LANGUAGES_AT_ONCE", 9)
    assert {tuple(r) for r in q.judge_quality(docs).collect()} == at_once
