import corpus_pipeline
from conftest_llm import prose

from footfall.session import staged


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece_nbest"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_whole_run_keeps_whom_it_should(spark, tmp_path):
    boiler = "The same line stands in every document of this site."
    bench = prose(900, 30)
    clean = [(i, f"{prose(i, 200)}\n{boiler}\n{prose(i + 500, 100)}") for i in range(1, 21)]
    copies = [(50, clean[0][1]), (51, clean[1][1].replace(".", "", 1))]
    junk = [(60, "again and again " * 80), (61, "short"), (62, None), (63, ""), (None, None)]
    leaked = [(70, f"{prose(70, 100)} {bench}\n{prose(71, 40)}")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in clean + copies + junk + leaked + clean[:1]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, str(tmp_path)), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "line_dedup":
            before = {r["doc_id"]: r for r in docs.collect()}
    assert all(boiler not in r["text"] and r["n_chars"] == len(r["text"]) for r in before.values())
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in last) == list(range(1, 21))
    assert all(r["round_trip"] for r in last)


def test_odd_rows_and_no_rows(spark, odd, nothing, sf_dir):
    for rows in (odd, nothing):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir), "test")
            assert docs.columns == rows.columns
        n = docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == n
        assert n == 0 or n < rows.count()


def test_group_of_many_copies_is_not_lost(spark, tmp_path):
    """All lines of ten copies are frequent: each copy stays, with the empty text, to the end."""
    copied = f"{prose(3, 150)}\n{prose(4, 150)}"
    rows = [(i, copied) for i in range(1, 13)] + [(i, prose(i, 200)) for i in range(20, 25)]
    rows = [(i, t, "en", "s", len(t)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(900, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = staged(corpus_pipeline.quality_rules(spark, docs, str(tmp_path)), "test")
    left = corpus_pipeline.line_dedup(spark, judged, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in left} == {
        i: ("", 0) if i < 20 else (t, n) for i, t, _, _, n in rows
    }
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["n_pieces"] > 0 for r in last} == {r[0]: r[0] >= 20 for r in rows}
