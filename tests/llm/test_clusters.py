import hashlib
import random
from math import floor, inf, nan

import numpy as np
import pytest

from footfall.llm.walsh_clusters import _decoded, _encoded, cluster, inverse, nearest, sequency_order, transform

LARGEST = (1 << 63) - 1


def brute(rows, k, rounds, seed, n, scale=256):
    """Lloyd's rounds in Python integers; rows are (id, vector)."""
    kept = [(i, [floor(scale * int(x)) if abs(x) > 1e15 else floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == n and all(x is not None and x == x and abs(x) != inf for x in v)]
    if not kept:
        return []

    def start(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest())

    centroids = [v for _, v in sorted(kept, key=start)[:k]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[place(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    placed = [(i, *reversed(place(v))) for i, v in kept]
    total = sum(d for *_, d in placed)
    of = {j: sum(d for _, c, d in placed if c == j) for j in range(len(centroids))}

    def fits(v):
        return v if v <= LARGEST else None

    def fits_all(parts):
        return None if any(d > LARGEST for d in parts) else fits(sum(parts))

    return sorted(((i, j, fits(d), fits_all([e for _, c, e in placed if c == j]), fits_all([e for *_, e in placed]),
                    hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, j, d in placed), key=str), total, of


def run(spark, rows, k, rounds, n, kind="float"):
    df = spark.createDataFrame(rows, f"id long, vector array<{kind}>").repartition(3)
    out = cluster(df, k, rounds, "2", "id", "vector", components=n)
    assert out.columns[0] == "id"
    return sorted((tuple(r) for r in out.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_transform_is_exact_and_keeps_distances():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 64):
        values = rng.integers(-5000, 5000, (20, n))
        coefs = transform(values)
        assert [inverse(row) for row in coefs.tolist()] == values.tolist()
        assert (coefs**2).sum(axis=1).tolist() == (n * (values**2).sum(axis=1)).tolist()
        rows = transform(np.eye(n, dtype=np.int64)).T
        changes = (np.diff(rows, axis=1) != 0).sum(axis=1)
        assert changes.tolist() == sorted(changes.tolist()) and sorted(sequency_order(n)) == list(range(n))


@pytest.mark.parametrize("kind", [np.int64, object])
def test_progressive_search_against_all_distances(kind):
    rng = np.random.default_rng(2)
    values = rng.integers(-900, 900, (300, 64))
    centroids = np.concatenate([values[:10], values[:10], rng.integers(-900, 900, (20, 64))])  # ties
    coefs, of = transform(values).astype(kind), transform(centroids).astype(kind)
    chosen, best, finished = nearest(coefs, of)
    every = ((values[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert chosen.tolist() == every.argmin(axis=1).tolist()
    assert (best // 64).tolist() == every.min(axis=1).tolist()
    assert finished.min() >= 1 and finished.mean() < 40


def test_rows_of_any_width():
    rows = np.empty((2, 4), object)
    rows[0], rows[1] = [1, -2, 3, 1 << 90], [0, -(1 << 70), 5, 6]
    images = [*_encoded(np.array([[1, -2, 3, 4]])), *_encoded(np.array([[1, -2, 3, 1 << 40]])), *_encoded(rows)]
    found = {p: row for places, coefs in _decoded(images, 4) for p, row in zip(places, coefs.tolist())}
    assert found == {0: [1, -2, 3, 4], 1: [1, -2, 3, 1 << 40], 2: rows[0].tolist(), 3: rows[1].tolist()}


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.gauss(i % 4, 1))) for _ in range(8)]) for i in range(200)]
    rows += [rows[0]] * 30 + [(200 + i, [0.5] * 8) for i in range(40)]
    rows += [(None, [1.0] * 8), (300, None), (301, [1.0] * 7), (302, [1.0] * 7 + [None]), (303, [nan] * 8), (304, [inf] * 8)]
    for k, rounds in ((6, 4), (1, 1), (500, 2)):
        want, *_ = brute(rows, k, rounds, "2", 8)
        assert run(spark, rows, k, rounds, 8) == want


def test_values_beyond_64_bits(spark):
    rows = [(i, [float(s) * 2.0**e for s in range(4)]) for i, e in enumerate((0, 10, 24, 50, 80, 120))]
    want, *_ = brute(rows, 3, 2, "2", 4)
    assert run(spark, rows, 3, 2, 4, "double") == want


def test_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", 5)], "id long, vector array<double>, c0 string, `Cluster` int")
    out = cluster(df, 2, 1, "2", "id", "vector", components=2)
    assert out.columns == ["id", "c0", "cluster", "distance", "n_finished", "cluster_inertia", "inertia", "centroid_sha256"]
    assert out.select("id", "c0", "cluster", "distance").collect() == [(1, "a", 0, 0)]
    assert cluster(df.where("false"), 2, 1, "2", "id", "vector", components=2).count() == 0
