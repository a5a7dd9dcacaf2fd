import pytest
from conftest_llm import prose

from footfall.llm import toxicity_grammar as g


def score(text, lexicon):
    reader = g.Reader(lexicon)
    return g.clause_score([reader.symbol(w) for w in g.WORD.findall(text)])


def test_grammar():
    lexicon = {"fool$": 2.0, "nitw": 3.0}
    assert score("a plain clause", lexicon) == 0
    assert score("fool here", lexicon) == 2
    assert score("nitwit nitw", lexicon) == 3  # a beginning, not a whole word
    assert score("you fool", lexicon) == pytest.approx(2 * g.TARGETED)
    assert score("not one fool", lexicon) == pytest.approx(2 * g.NEGATED)
    assert score("not a b c fool", lexicon) == 2  # out of the negation's reach
    assert score("someone said fool", lexicon) == pytest.approx(2 * g.REPORTED)
    assert score("said not fool", lexicon) == pytest.approx(2 * g.REPORTED * g.NEGATED)
    assert score("kill time", lexicon) == 0
    assert score("kill you", lexicon) == score("you kill", lexicon) == g.THREAT_WEIGHT
    assert score("never kill you", lexicon) == pytest.approx(g.THREAT_WEIGHT * g.NEGATED)


def labelled(spark, n=240):
    rows = [(i, prose(i, 60) + (f" you grumpf{'abcdefgh'[i % 8]} and {prose(i + 900, 40)} zonk." if i % 5 == 0 else "."), int(i % 5 == 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_learns_words_and_beginnings(spark, odd, nothing):
    docs, labels = labelled(spark)
    model = g.train(docs, labels)
    assert "zonk$" in model.lexicon and any(e.startswith("gru") for e in model.lexicon)
    got = g.score_toxicity(docs, model).join(labels, "doc_id").select("predicted", "toxic", "score").collect()
    assert all(r["predicted"] == r["toxic"] for r in got)
    fresh = spark.createDataFrame([(1, "a new text with grumpfzz in it"), (2, "a new text"), (3, None)], "doc_id long, text string")
    one, two, three = (r["score"] for r in g.score_toxicity(fresh, model).orderBy("doc_id").collect())
    assert one > two == three
    out = g.score_toxicity(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted"]
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert g.score_toxicity(nothing, model).count() == 0


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(spark)
    held = labels.withColumn("toxic", g.F.when(g.fold(g.F.col("doc_id")) == 1, 1 - g.F.col("toxic")).otherwise(g.F.col("toxic")))
    assert g.train(docs, labels) == g.train(docs, held)


def test_without_labels(spark, nothing):
    docs, labels = labelled(spark)
    model = g.train(docs, labels.limit(0))
    assert g.score_toxicity(docs, model).where("score > 0.01 or predicted = 1").count() == 0


def test_held_out_accuracy(spark, sf_dir):
    from footfall.llm.queries import op8_toxicity_grammar

    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/labels.parquet")
    got = op8_toxicity_grammar(spark, sf_dir.replace("0.001", "0.01")).where("held_out").join(labels, "doc_id").collect()
    clean = [r["predicted"] for r in got if r["toxic"] == 0]
    toxic = [r["predicted"] for r in got if r["toxic"] == 1]
    assert sum(clean) <= 0.02 * len(clean)
    assert sum(toxic) >= 0.6 * len(toxic)
