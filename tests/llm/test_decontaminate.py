import re
from collections import defaultdict

import pytest
from conftest_llm import prose

from footfall.llm.decontaminate import contamination, drop_contaminated

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, window=13, share=20):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[s : s + n])].add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit) and share * len(hit) >= len(w)))
    return out


@pytest.fixture(scope="module")
def items():
    return [(1, prose(70, 40)), (2, prose(71, 13)), (3, "short item"), (4, "alone"), (5, prose(72, 5)), (6, None), (7, " .,"),
            (8, prose(70, 30)), (10, "a a a a a a a a a a a a a a a"), (None, prose(73, 20)), (1, prose(74, 15))]


@pytest.fixture(scope="module")
def docs(odd_rows):
    more = [(300, f"{prose(1, 9)} {prose(70, 40).upper()}! {prose(2, 300)}"), (301, f"x {prose(71, 13)} y"), (302, prose(71, 12)),
            (303, "a SHORT   item, é alone!"), (304, "a " * 40), (305, prose(70, 25) + " " + prose(73, 19)), (306, prose(70, 13) + " z " * 247),
            (307, prose(70, 13) + " z " * 248), (308, "short"), (309, prose(72, 5)), (310, prose(74, 15) + prose(74, 15))]
    return [(r[0], r[1]) for r in odd_rows] + more


def test_against_brute_force(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    for use in (items, items[:2], items[5:7]):
        got = contamination(d, spark.createDataFrame(use, "item_id long, text string")).collect()
        got = [(r["doc"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]) for r in got]
        assert sorted(got, key=str) == sorted(slow(docs, use), key=str)


def test_dropping(spark, odd, nothing, items):
    i = spark.createDataFrame(items, "item_id long, text string")
    clean = drop_contaminated(odd, i)
    assert clean.columns == odd.columns
    assert clean.count() == odd.count()
    assert contamination(nothing, i).count() == 0
    assert not contamination(odd, i.limit(0)).where("contaminated or n_hit > 0").count()
