import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import token_store as t
from footfall.llm.queries import BYTE_BPE, tokenizer_file
from footfall.session import shared_path


@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=700), st.sampled_from([8, 128, 256]), st.sampled_from([0, 50, 90, 100]))
@settings(max_examples=80, deadline=None)
def test_pack_round_trip(values, block, percentile):
    v = np.array(values, np.uint32)
    assert (t.unpack(t.pack(v, percentile, block)) == v).all()


def test_outliers_are_exceptions():
    v = np.arange(128, dtype=np.uint32) % 16
    v[5] = 2**31
    assert len(t.pack(v)) < t.HEADER.size + 8 + 6 + 128 // 8 * 4 + 5 + 1
    with pytest.raises(ValueError):
        t.unpack(b"\0" * 40)


@pytest.fixture(scope="module")
def encoder():
    return t.PieceEncoder(tokenizer_file(BYTE_BPE))


PARTS = ["a", "Word", " ", "  ", "\n", "\n\n", "\t", "'s", "é", "日本", " ", "　", "<|endoftext|>", "1", "12.", "\0", "\x1c", "\x85", "!", "\r\n"]


@given(st.lists(st.sampled_from(PARTS), max_size=14))
@settings(max_examples=400, deadline=None)
def test_chunks_encode_as_the_whole(encoder, parts):
    text = "".join(parts)
    whole = encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole


def test_full_cache(encoder, monkeypatch):
    monkeypatch.setattr(t, "CACHED_CHUNKS", 5)
    monkeypatch.setattr(t, "KEPT_CHUNKS", 2)
    for text in ("one two three four five six seven", "eight nine ten", "one ten"):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def test_files(spark, odd, odd_rows, nothing, encoder):
    path = shared_path(spark, "tokens")
    t.write_token_files(odd, path, tokenizer_file(BYTE_BPE), end_id=2)
    got = t.read_token_files(spark, path).orderBy("start").collect()
    rows = sorted(((r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode(), r[0]) for r in odd_rows), key=lambda r: r[:4])
    start = 0
    for row, found in zip(rows, got, strict=True):
        ids = [*encoder.library.encode(row[3].decode(), add_special_tokens=False).ids, 2]
        assert (found["doc"], found["start"], found["n_tokens"], found["ids"]) == (row[4], start, len(ids), ids)
        assert found["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    empty = shared_path(spark, "tokens")
    t.write_token_files(nothing, empty, tokenizer_file(BYTE_BPE), end_id=2)
    assert t.read_token_files(spark, empty).count() == 0
