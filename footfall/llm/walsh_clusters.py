"""Centroid clustering with progressive search in Walsh-Hadamard coefficients.

Vectors become integers, ``floor(scale * x)``, and those their Walsh-Hadamard coefficients, also
integers. The transform multiplies every squared distance by the number of components, so sums of
squared coefficient differences, taken from coarse to fine, are lower bounds that end in the exact
distance. A centroid whose bound exceeds the finished distance of another one is strictly worse and
leaves; those left finish all coefficients, and the smallest distance, then number, wins.

Each round is one pass over the stored coefficients: a task returns a sum per centroid, Spark adds
these up, and the driver holds nothing but the centroids. Coefficients are stored in the narrowest
integers that hold a row, and rows of any width are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import fresh, map_batches
from footfall.session import staged, staging

#: Coefficients are added in these blocks, coarse to fine (sequency order); the rest is the last block.
BLOCKS = (8, 8, 16)
#: Below this size of a coefficient, sums of squared differences fit into 64 bits for 2^16 components.
SAFE = 1 << 22
LONG = 1 << 63
LIMB_BITS = 48
LIMB = 1 << LIMB_BITS


def sequency_order(n: int) -> np.ndarray:
    """Rows of the Hadamard matrix of order ``n`` (a power of two) by their number of sign changes."""
    bits = n.bit_length() - 1
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    return np.array([int(format(g, f"0{bits}b")[::-1], 2) if bits else 0 for g in gray.tolist()])


def transform(values: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row in sequency order; integers stay integers."""
    rows, n = values.shape
    out, half = values.copy(), 1
    while half < n:
        pairs = out.reshape(rows, n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return out[:, sequency_order(n)]


def inverse(coefficients: list[int]) -> list[int]:
    """The integers whose coefficients these are, as Python integers of any size."""
    n = len(coefficients)
    natural = np.empty((1, n), object)
    natural[0, sequency_order(n)] = coefficients
    back = transform(natural)[0]
    plain = [0] * n
    for place, value in zip(sequency_order(n).tolist(), back, strict=True):
        plain[place] = value // n
    return plain


def nearest(coefs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number and squared distance (times the components) of the nearest centroid of each row.

    Third, how many centroids had to be finished. Equal distances go to the smaller number.
    """
    n = coefs.shape[1]
    bounds = [0, *np.cumsum(BLOCKS).tolist()]
    bounds = [*(b for b in bounds if b < n), n]
    rows = np.arange(len(coefs))
    differences = coefs[:, None, : bounds[1]] - centroids[None, :, : bounds[1]]
    partial = (differences * differences).sum(axis=2)
    # the most promising centroid is finished first; its distance is what the others must not exceed
    first = partial.argmin(axis=1)
    rest = coefs - centroids[first]
    limit = (rest * rest).sum(axis=1)
    at, number = np.nonzero(partial <= limit[:, None])
    sums = partial[at, number]
    for low, high in zip(bounds[1:-1], bounds[2:], strict=True):
        step = coefs[at, low:high] - centroids[number, low:high]
        sums = sums + (step * step).sum(axis=1)
        left = sums <= limit[at]
        at, number, sums = at[left], number[left], sums[left]
    best = np.full(len(coefs), limit.max(initial=0) + 1, coefs.dtype)
    np.minimum.at(best, at, sums)
    winners = sums == best[at]
    chosen = np.full(len(coefs), len(centroids))
    np.minimum.at(chosen, at[winners], number[winners])
    return chosen, best, np.bincount(at, minlength=len(rows))


# ---- rows as bytes: every coefficient of a row in as many bytes as its largest needs


def _encoded(values: np.ndarray) -> list[bytes]:
    if values.dtype != object:
        kind = "<i4" if np.abs(values).max(initial=0) < 1 << 31 else "<i8"
        return [row.tobytes() for row in values.astype(kind)]
    out = []
    for row in values:
        width = max(9, *(v.bit_length() // 8 + 1 for v in row))
        out.append(b"".join(v.to_bytes(width, "little", signed=True) for v in row))
    return out


def _decoded(images: list[bytes], n: int) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places and coefficients of the rows, those of one width together."""
    widths = np.array([len(i) // n for i in images])
    for width in np.unique(widths).tolist():
        places = np.flatnonzero(widths == width).tolist()
        if width in (4, 8):
            data = np.frombuffer(b"".join(images[p] for p in places), f"<i{width}")
            yield places, data.astype(np.int64).reshape(len(places), n)
        else:
            rows = np.empty((len(places), n), object)
            for r, p in enumerate(places):
                rows[r] = [int.from_bytes(images[p][i : i + width], "little", signed=True) for i in range(0, n * width, width)]
            yield places, rows


def _integers(values: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and ``floor(scale * x)`` of the rows: 64 bits where they are wide enough, else any size."""
    scaled = np.floor(values * scale)
    wide = ~(np.abs(scaled).max(axis=1, initial=0) < 1 << 40)
    if not wide.all():
        yield np.flatnonzero(~wide), scaled[~wide].astype(np.int64)
    if wide.any():
        rows = np.empty((int(wide.sum()), values.shape[1]), object)
        for r, row in enumerate(values[wide].tolist()):
            rows[r] = [(lambda a, b: a * scale // b)(*x.as_integer_ratio()) for x in row]
        yield np.flatnonzero(wide), rows


def _coefficients(n: int, scale: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        images: list[bytes | None] = [None] * batch.num_rows
        for places, integers in _integers(flat.reshape(-1, n), scale):
            for place, image in zip(places.tolist(), _encoded(transform(integers)), strict=True):
                images[place] = image
        names = [c for c in batch.schema.names if c != "vector"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(images, pa.binary())], [*names, "coefs"])


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]]) -> Iterator[tuple[list[int], np.ndarray, tuple]]:
    n = len(centroids[0])
    most = max((abs(v) for row in centroids for v in row), default=0)
    exact = np.empty((len(centroids), n), object)
    exact[:] = centroids
    for places, coefs in _decoded(batch.column("coefs").to_pylist(), n):
        for cut in range(0, len(places), 1024):
            part = coefs[cut : cut + 1024]
            fits = most < SAFE and part.dtype != object and np.abs(part).max(initial=0) < SAFE
            found = nearest(part if fits else part.astype(object), exact.astype(np.int64) if fits else exact)
            yield places[cut : cut + 1024], part, found


def _limbs(value: int) -> list[int]:
    """An integer of any size as signed digits to the base 2^48, lowest first."""
    sign, rest, out = (1, value, []) if value >= 0 else (-1, -value, [])
    while rest or not out:
        out.append(sign * (rest & LIMB - 1))
        rest >>= LIMB_BITS
    return out


def _sums(centroids: list[list[int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's row counts (place -1) and coefficient sums per centroid, in digits that Spark can add."""
    totals: dict[int, tuple] = {}
    for batch in batches:
        for _, coefs, (chosen, _, _) in _assigned(batch, centroids):
            for c in np.unique(chosen).tolist():
                members = coefs[chosen == c]
                added = members.sum(axis=0).astype(object)
                count, sums = totals.get(c, (0, 0))
                totals[c] = (count + len(members), sums + added)
    rows = [
        (c, place, i, digit)
        for c, (count, sums) in totals.items()
        for place, value in ((-1, count), *enumerate(sums.tolist()))
        for i, digit in enumerate(_limbs(value))
    ]
    if rows:
        kinds = {"cluster": pa.int32(), "place": pa.int32(), "limb": pa.int32(), "digit": pa.int64()}
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


def _placed(centroids: list[list[int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = len(centroids[0])
    for batch in batches:
        out: list[tuple] = [(0, None, 0)] * batch.num_rows
        for places, _, (chosen, best, finished) in _assigned(batch, centroids):
            for place, c, d, f in zip(places, chosen.tolist(), best.tolist(), finished.tolist(), strict=True):
                out[place] = (c, d // n if d // n < LONG else None, f)
        names = [c for c in batch.schema.names if c != "coefs"]
        clusters, distances, finished = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64()),
             pa.array(finished, pa.int32())],
            [*names, "cluster", "distance", "n_finished"],
        )


def _moved(centroids: list[list[int]], digits: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """Every centroid as the floor of its members' mean; those without members stay."""
    totals: dict[int, dict[int, int]] = {}
    for cluster, place, limb, digit in digits:
        of = totals.setdefault(cluster, {})
        of[place] = of.get(place, 0) + (int(digit) << LIMB_BITS * limb)
    out = list(centroids)
    for cluster, of in totals.items():
        mean = np.empty((1, len(centroids[0])), object)
        mean[0] = [v // of[-1] for v in inverse([of[i] for i in range(len(centroids[0]))])]
        out[cluster] = transform(mean)[0].tolist()
    return out


RESULTS = ("cluster", "distance", "n_finished", "cluster_inertia", "inertia", "centroid_sha256")


def cluster(
    vectors: DataFrame, k: int, rounds: int, seed: str, id_col: str, vector_col: str, components: int = 64, scale: int = 256,
) -> DataFrame:
    """``vectors`` without the vector, with the cluster of each.

    Kept are vectors of exactly ``components`` (a power of two) values, none null or not finite. The
    first centroids are the ``k`` kept vectors with the smallest hash of ``<seed>:<id>`` (equal ids:
    by vector; null ids last); with fewer kept vectors there are fewer centroids. Results: ``cluster``,
    ``distance`` (squared; null where it fits no 64 bits), ``n_finished`` (centroids whose distance was
    needed to the end), ``cluster_inertia`` and ``inertia`` (null likewise), ``centroid_sha256``.
    Repeated rows are clustered alike; an empty table gives an empty result; columns with the
    results' names are replaced.
    """
    spark = vectors.sparkSession
    others = [c for c in vectors.columns if c != vector_col and c.lower() not in RESULTS]
    carried = {name: f"c{i}" for i, name in enumerate(others)}
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    good = vectors.where(
        (F.size(vector) == components) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    plain = good.select(*(F.col(f"`{m}`").alias(c) for m, c in carried.items()), vector.alias("vector"))
    start = F.concat(F.lit(f"{seed}:"), F.col(carried[id_col]).cast("string"))
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields if f.name != "vector")
    with staging(spark) as stage:
        stored = stage(
            map_batches(plain, lambda b: _coefficients(components, scale, b), f"{ids}, coefs binary")
            .withColumn("start", F.sha2(start, 256)),
            "coefficients",
        )
        first = stored.orderBy(F.col("start").asc_nulls_last(), "coefs").limit(k).select("coefs").collect()  # k rows
        images = [bytes(row.coefs) for row in first]
        centroids: list[list[int]] = [[]] * len(images)
        for places, coefs in _decoded(images, components):
            for place, row in zip(places, coefs.tolist(), strict=True):
                centroids[place] = row
        if not centroids:
            centroids = [[0] * components]  # no rows to place either
        for _ in range(rounds):
            sums = map_batches(
                stored.select("coefs"), lambda b, c=centroids: _sums(c, b), "cluster int, place int, limb int, digit long"
            )
            added = sums.groupBy("cluster", "place", "limb").agg(F.sum(F.col("digit").cast("decimal(38,0)")))
            centroids = _moved(centroids, [tuple(r) for r in added.collect()])  # k rows a component, at most a few limbs
        placed = stage(
            map_batches(
                stored.select(*carried.values(), "coefs"), lambda b: _placed(centroids, b),
                f"{ids}, cluster int, distance long, n_finished int",
            ),
            "placed",
        )
        wide, missing = F.sum(F.col("distance").cast("decimal(38,0)")), F.count_if(F.col("distance").isNull())
        rows = placed.groupBy("cluster").agg(wide.alias("part"), missing.alias("lost")).collect()  # at most k rows

        def long_or_null(value: int, lost: bool) -> int | None:
            return None if lost or value >= LONG else value

        total = long_or_null(sum(int(r.part or 0) for r in rows), any(r.lost for r in rows))
        facts = [
            (r.cluster, long_or_null(int(r.part or 0), bool(r.lost)), total,
             hashlib.sha256(",".join(map(str, inverse(centroids[r.cluster]))).encode()).hexdigest())
            for r in rows
        ]
        of = fresh("of", list(carried.values()))
        known = spark.createDataFrame(facts, f"{of} int, cluster_inertia long, inertia long, centroid_sha256 string")
        out = placed.join(F.broadcast(known), F.col("cluster") == F.col(of))  # at most k rows
        return staged(out.select(*(F.col(c).alias(m) for m, c in carried.items()), *RESULTS), "clusters")
