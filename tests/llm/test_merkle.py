import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from footfall.llm.merkle_manifest import BAND, manifest, manifest_nodes, row_digest

COLUMNS = ["doc_id", "source", "text"]
SCHEMA = "doc_id long, source string, text string, g string, payload int, `Leaf` string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def digest(*values):
    return sha("".join(map(frame, values)))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def brute(rows, tampered):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, digest(*row[:3]), row[:3]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([d for *_, d, _ in sorted(groups[s])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (*_, leaf, row) in enumerate(sorted(groups[s])):
            path = siblings(trees[s], i) + siblings(top, k)
            held = tampered(row)
            for left, right in path if held is not None else ():
                held = sha(left + held + right)
            proof = sha("".join(a + b for a, b in path))
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], proof, held, held == top[-1][0]))
    return out


def results(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    columns = [F.col(c) for c in COLUMNS]
    # every second id: a changed text; every fifth: no digest at all
    claimed = F.when(F.col("doc_id") % 5 == 0, None).when(
        F.col("doc_id") % 2 == 0, row_digest(*columns[:2], F.concat(F.coalesce("text", F.lit("")), F.lit("!")))
    ).otherwise(row_digest(*columns))
    return manifest(df.repartition(5), "source", "doc_id", row_digest(*columns), claimed, keep=("doc_id",))


def tampered(row):
    if row[0] is not None and row[0] % 5 == 0:
        return None
    return digest(row[0], row[1], (row[2] or "") + "!") if row[0] is not None and row[0] % 2 == 0 else digest(*row)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 2, "": 3, "a": 1}, {"é": 4, "z": 9, "Z": 10},
    {"hot": 3**BAND + 1, "full": 3**BAND, "one": 1, None: 28},
])
def test_against_brute_force(spark, sizes):
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i, name, None if i % 7 == 0 else f"text {i}\n", "g", 1, "x"))
            i += 3
    rows += [rows[0], rows[0], (None, "a", None, None, None, None), (None, "a", "", None, None, None)]
    assert results(run(spark, rows)) == sorted(brute(rows, tampered), key=str)


def test_many_groups_of_one(spark):
    rows = [(i, f"s{i}", str(i), None, None, None) for i in range(3**BAND + 40)]
    assert results(run(spark, rows)) == sorted(brute(rows, tampered), key=str)


def test_nodes_are_intervals(spark):
    rows = [(i, "hot" if i % 3 else None, str(i), "g", 1, "x") for i in range(3 ** (BAND + 1) + 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = manifest_nodes(df, "source", "doc_id", row_digest(*(F.col(c) for c in COLUMNS))).collect()
    by_name = defaultdict(dict)
    for n in nodes:
        assert (n.level, n.lo) not in by_name[n.name]
        by_name[n.name][n.level, n.lo] = (n.hi, n.digest)
    for name, members in (("hot", [r for r in rows if r[1]]), (None, [r for r in rows if not r[1]])):
        levels = levels_of([digest(*r[:3]) for r in members])
        want = {
            (k, i * 3**k): (min((i + 1) * 3**k, len(members)) - 1, d) for k, level in enumerate(levels) for i, d in enumerate(level)
        }
        assert by_name[name] == want


def test_columns_and_empty_tables(spark, odd, nothing):
    claimed = row_digest(F.col("doc_id"), F.col("text"))
    out = manifest(odd.withColumn("Leaf", F.lit("own")), "source", "doc_id", claimed, claimed, ("doc_id", "Leaf", "kept"), True)
    assert out.columns == ["doc_id", "kept", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path"]
    assert out.count() == odd.count() and out.where("verified").count() == odd.count()
    assert manifest(nothing, "source", "doc_id", claimed, claimed, ("doc_id",)).count() == 0
