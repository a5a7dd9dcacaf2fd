import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import prefix_tokens
from footfall.llm.prefix_tokens import (
    ASCII_CHUNKS, SETTLED, WIDE_CHUNKS, PrefixCounter, count_prefixes, counts_from, truncate, within_budget,
)
from footfall.llm.queries import BYTE_BPE, op12_prefix_tokens, tokenizer_file

PIECES = [*"ab'reLlvsd  \n\t .!1é日\x1c\u0378-", "<|endoftext|>", "<|endof", "'ll", " the", "  ", "\U0001f600", "ation"]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(tokenizer_file(BYTE_BPE))


def brute(counter, text):
    encode = counter.library.encode
    return [len(encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]


def test_every_prefix_against_the_library(counter, odd_rows):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 24))) for _ in range(400)]
    texts += ["a" * 150, "=-" * 60, "0" * 90, " " * 40 + "x", "\n \n  ab", "don't we'll they've'r 'rex", "<|endoftext|>" * 3]
    texts += [r[1][:120] for r in odd_rows if r[1]]
    for text in texts:
        assert counter.counts(text).tolist() == brute(counter, text), text


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab 'sl\n\t<|>"), st.characters(exclude_categories=["Cs"])), max_size=25))
def test_any_text(counter, text):
    assert counter.counts(text).tolist() == brute(counter, text)


def test_cut_of_settled_characters(counter):
    cut = counter.library.pre_tokenizer.pre_tokenize_str
    for code in [*range(0x3000), *range(0x3000, sys.maxunicode + 1, 23)]:
        if 0xD800 <= code < 0xE000 or SETTLED.search(chr(code)):
            continue
        text = "a{0}1{0}{0}a {0}-{0} ".format(chr(code))
        want = [text[a:b] for _, (a, b) in cut(text)]
        assert WIDE_CHUNKS.findall(text) == want, hex(code)
        assert code > 127 or ASCII_CHUNKS.findall(text) == want, hex(code)


def test_a_small_memory_changes_nothing(monkeypatch, odd_rows):
    monkeypatch.setattr(prefix_tokens, "CACHE_BYTES", 2000)
    monkeypatch.setattr(prefix_tokens, "PAIRS", 20)
    counter = PrefixCounter(tokenizer_file(BYTE_BPE))
    for text in [r[1] for r in odd_rows if r[1]]:
        assert counter.counts(text)[-1] == len(counter.library.encode(text, add_special_tokens=False).ids)
    assert counter.held <= 2000 + 600


def test_stored_steps_of_any_size(spark):
    for counts in ([], [1, 2, 2, 1, 3], [5, 400, 2]):
        stored = prefix_tokens._steps(np.array(counts, np.int64))
        assert counts_from(stored, len(counts)).tolist() == counts


def test_tables_budgets_and_cuts(spark, odd, odd_rows, nothing, counter):
    path = tokenizer_file(BYTE_BPE)
    stored = count_prefixes(odd.withColumnRenamed("kept", "Steps"), path)
    assert stored.columns == [*(c for c in odd.columns if c not in ("text", "kept")), *prefix_tokens.STORED]
    rows = stored.collect()
    texts = sorted(r[1] or "" for r in odd_rows)
    assert sorted(r.n_bytes for r in rows) == sorted(len(t.encode()) for t in texts)
    for limit in (0, 7, 10**6):
        got = sorted((r.n_bytes, r.n_prefixes, r.n_tokens, r.over_limit, r.chars_within) for r in within_budget(stored, limit).collect())
        want = []
        for t in texts:
            counts = counter.counts(t).tolist()
            fits = max((i + 1 for i, c in enumerate(counts) if c <= limit), default=0)
            total = len(counter.library.encode(t, add_special_tokens=False).ids)
            want.append((len(t.encode()), len(t), total, total > limit, fits))
        assert got == sorted(want)
    assert within_budget(count_prefixes(nothing, path), 5).count() == 0
    docs = spark.createDataFrame([(1, "one two three four"), (2, None), (None, "as it is")], "doc_id long, text string")
    cut = truncate(docs, within_budget(count_prefixes(docs, path), 2), "doc_id").collect()
    assert sorted(cut, key=str) == sorted([(1, "one two"), (2, None), (None, "as it is")], key=str)


def test_query_against_the_library(spark, sf_dir, counter):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = op12_prefix_tokens(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        n = len(counter.library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)
        assert r.chars_within == len(text) if n <= 1024 else r.chars_within < len(text)
