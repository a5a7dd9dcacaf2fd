from collections import defaultdict

from footfall.llm.common import SPACES
from footfall.llm.line_dedup import drop_frequent_lines


def expected(rows, min_docs):
    docs = defaultdict(set)

    def key(line):
        return line.encode().strip(SPACES.encode()).lower()

    for doc, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(doc)
    often = {k for k, ids in docs.items() if k and len(ids) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in often]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_against_brute_force(spark, odd, odd_rows):
    shared = [(100 + i, f"own {i}\n\t Shared LINE \x0b\nown too {i}\n\n") for i in range(4)] + [(100, "shared line")]
    rows = [(r[0], r[1]) for r in odd_rows] + shared
    for min_docs in (1, 2, 4):
        got = drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs)
        assert ordered(map(tuple, got.collect())) == ordered(expected(rows, min_docs))


def test_columns_pass_through_and_results_replace(odd, nothing):
    out = drop_frequent_lines(odd, 10)
    assert out.columns == [c for c in odd.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert out.count() == odd.count()
    assert drop_frequent_lines(nothing, 10).count() == 0
