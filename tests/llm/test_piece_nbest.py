import numpy as np
import pytest

import corpus_pipeline
from footfall.llm import piece_nbest as n
from footfall.llm.queries import PIECES, QUERIES, tokenizer_file


@pytest.fixture(scope="module")
def model():
    return n.PieceModel(tokenizer_file(PIECES))


def every_path(model, text):
    marked, out = model.normalize(text), []

    def walk(i, score, ids):
        if i == len(marked):
            out.append((score, ids))
            return
        for k in range(i + 1, min(len(marked), i + model.longest) + 1):
            if marked[i:k] in model.pieces:
                s, piece = model.pieces[marked[i:k]]
                walk(k, score + s, ids + piece.to_bytes(4, "little"))
        if marked[i] not in model.pieces:
            walk(i + 1, score + model.unknown_score, ids + b"".join(model.bytes[b].to_bytes(4, "little") for b in marked[i].encode()))

    walk(0, 0.0, b"")
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["", "a", " ", "a b", "the cat", "  x", "a\nb", "né é", "日本x", "idiot  ok", "a b c d", "ab\tcd", "\x00a", "a\r\nb", "▁x"])
def test_n_best_against_all_paths(model, text):
    found, every = model.n_best(text, 6), every_path(model, text)
    assert [s for s, *_ in found] == pytest.approx([s for s, _ in every[:6]])
    assert all(any(ids == other and s == pytest.approx(t) for t, other in every) for s, ids, _ in found)
    assert len({ids for _, ids, _ in found}) == len(found)
    assert all(model.decode(ids) == spelled.decode("utf-8", "replace") for _, ids, spelled in found)
    if "▁" not in text:
        assert all(spelled.decode() == text for *_, spelled in found)


def test_full_cache(model, monkeypatch):
    text = "one two three four five six"
    want = model.n_best(text, 3)
    monkeypatch.setattr(n, "WORD_BYTES", 900)
    monkeypatch.setattr(n, "PATH_BYTES", 900)
    assert model.n_best("seven eight", 3) and model.n_best(text, 3) == want


def test_segment(spark, odd, odd_rows, nothing, model):
    out = n.segment(odd, tokenizer_file(PIECES), n_best=3)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert all(r["round_trip"] for r in rows)
    assert "text" not in out.columns and "lang" in out.columns
    for r in rows:
        assert len(r["paths"]) == r["n_found"] and len(r["paths"][0]["ids"]) == r["n_pieces"]
        assert [p["score"] for p in r["paths"]] == sorted((p["score"] for p in r["paths"]), reverse=True)
    texts = sorted(model.decode(np.array(r["paths"][-1]["ids"], "<u4").tobytes()) for r in rows)
    assert texts == sorted(r[1] or "" for r in odd_rows)
    assert n.segment(nothing, tokenizer_file(PIECES)).count() == 0


def test_every_path_is_in_the_result(spark, model, tmp_path):
    """op9 and the pipeline's last stage return score, ids and decoded text of all four paths."""
    texts = {1: "the cat", 2: "a b c d", 3: "a\nb", 4: "n\u00e9 \u00e9", 5: "", 6: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    op9 = QUERIES["op9_piece_nbest"](spark, str(tmp_path))
    for out in (op9, corpus_pipeline.piece_segmentation(spark, docs, str(tmp_path))):
        rows = {r["doc_id"]: r for r in out.collect()}
        assert rows.keys() == texts.keys()
        for doc, text in texts.items():
            every = every_path(model, text or "")
            paths = rows[doc]["paths"]
            assert [p["score"] for p in paths] == pytest.approx([s for s, _ in every[:4]])
            found = [np.array(p["ids"], "<u4").tobytes() for p in paths]
            assert len(set(found)) == len(found) == rows[doc]["n_found"]
            assert all(any(ids == other and p["score"] == pytest.approx(s) for s, other in every) for ids, p in zip(found, paths, strict=True))
            assert all(p["decoded"] == (text or "") for p in paths) and rows[doc]["round_trip"]


def test_rows_are_passed_on_in_parts(monkeypatch):
    """Parts of a batch, cut by the size of their paths, hold the same rows as the whole."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"c0": list(range(5)), "text": ["one two", None, "three four five", "", "six"]})
    run = lambda: list(n._segment(tokenizer_file(PIECES), 3, True, iter([batch])))
    whole = run()
    monkeypatch.setattr(n, "PASSED_ON", 20)
    parts = run()
    assert len(whole) == 1 and len(parts) > 2
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches(whole).to_pylist()


def test_new_words_of_many_texts_are_searched_together(model, monkeypatch):
    texts = [f"{w} the cat{i} {w}ing oune{w} \u00e9a{w * 3} \u65e5 {'x' * 250}" for i, w in enumerate(["dog", "re", "tion", "zq", ""] * 8)]
    fresh, calls, best = n.PieceModel(tokenizer_file(PIECES)), [], n.PieceTrie.best
    monkeypatch.setattr(n.PieceTrie, "best", lambda trie, words: calls.append(len(words)) or best(trie, words))
    together = list(fresh.n_best_of_each(texts, 4))
    assert len(calls) == 1 and calls[0] > 50
    assert together == [model.n_best(text, 4) for text in texts]
    for word in sorted({w for text in texts for w in model.words(text)}):
        (score, ids), *others = model.search(word, 2)
        found = fresh.known[word] if word in fresh.known else fresh.best(word)
        assert found[0] == pytest.approx(score)
        assert found[2] == (pytest.approx(score - others[0][0], abs=1e-9) if others else np.inf)
        assert sum(found[0] == pytest.approx(s) and found[1] == i for s, i in model.search(word, 6)) == 1
