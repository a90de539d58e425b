"""Centroid clustering with Ptolemaic pivots: exact nearest centroids, most distances ruled out by bounds.

Vectors are turned to integers and clustered by a fixed number of rounds of assignment and update, all in exact integer
arithmetic. Distances to a few fixed pivots are computed once per vector and stored with it. In each round, for a
vector v, a centroid c and a pair of pivots p, q, Ptolemy's inequality

    d(v, c) * d(p, q) >= |d(v, p) * d(c, q) - d(v, q) * d(c, p)|

gives a lower bound of d(v, c) from stored numbers. The distance to the vector's centroid of the round before is computed
exactly; a centroid is compared exactly only if its bound, rounded down, doesn't exceed the best distance known.

Scale: the table of vectors is written once with its pivot distances; a round is one map pass that sends one row for each
(cluster, component) and task to a sum of k * dimensions groups. Centroids and pivots (k * dimensions numbers) are all that
reaches the driver and the closures, whatever the number of vectors.

Edge cases: a vector counts if it has exactly ``DIMENSIONS`` components, none null, NaN or infinite; all others (null and empty
arrays too) give no row. A null ``vec_id`` is hashed as the empty text; rows that repeat are vectors of their own, and rows
with equal ids are ordered by their components. With fewer vectors than centroids every vector is a centroid; an empty table
gives an empty result. Components of any size are exact: where a squared distance could pass 62 bits, Python integers
take over; a distance or a sum that doesn't fit a long is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_arrow
from starloom.sources.store import materialize

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Pivot pairs used for bounds, the farthest apart of the starting centroids.
PAIRS = 6
#: Up to this size of components squared distances of up to 4,096 dimensions fit 62 bits.
SMALL = 1 << 24
_DIGIT = 1 << 56
_LONG = 2**63 - 1

Centre = tuple[int, ...]


def _valid(dimensions: int) -> Column:
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(e) == dimensions) & ~bad, F.lit(False))


def _scaled(column: pa.ChunkedArray | pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x): int64, or Python integers if one is large."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    if not len(x) or np.abs(x).max() * scale < SMALL:
        return np.floor(x * scale).astype(np.int64)
    exact = lambda v: math.floor(v * scale) if math.isfinite(v * scale) else int(v) * scale
    return np.array([[exact(v) for v in row] for row in x.tolist()], dtype=object)


def _squared(x: np.ndarray, c: Centre) -> np.ndarray:
    """Squared distances of rows to one point, exact."""
    if x.dtype == object or max(map(abs, c), default=0) >= SMALL:
        return ((x.astype(object) - np.array(c, dtype=object)) ** 2).sum(axis=1)
    d = x - np.array(c, dtype=np.int64)
    return np.einsum("ij,ij->i", d, d)


def _floats(squares: np.ndarray) -> np.ndarray:
    """As floats; infinite from 1e280 on."""
    if squares.dtype != object:
        return squares.astype(np.float64)
    return np.array([float(v) if v < 10**280 else math.inf for v in squares.tolist()])


class Pivots:
    """Fixed pairs of pivots and the bounds they give."""

    def __init__(self, points: list[Centre], pairs: int = PAIRS):
        apart = [(math.sqrt(_floats(_squared(np.array([points[i]], dtype=object), points[j]))[0]), i, j)
                 for i, j in combinations(range(len(points)), 2)]
        best = [x for x in sorted(apart, reverse=True) if 0 < x[0] < math.inf][:pairs]
        used = sorted({i for x in best for i in x[1:]})
        self.points = [points[i] for i in used]
        self.pairs = [(used.index(i), used.index(j), d) for d, i, j in best]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """(rows, pivots)."""
        out = [np.sqrt(_floats(_squared(x, p))) for p in self.points]
        return np.stack(out, axis=1) if out else np.zeros((len(x), 0))

    def bounds(self, cached: np.ndarray, centres: list[Centre]) -> np.ndarray:
        """Lower bounds of the squared distances, (rows, centres), rounded down by far more than the error of the
        arithmetic: each product carries a relative error of a few 1e-16, so 1e-12 of the larger one is taken off.
        Beyond the range of floats nothing is ruled out (0)."""
        out = np.zeros((len(cached), len(centres)))
        if not self.pairs:
            return out
        to = self.distances(np.array(centres, dtype=object))
        with np.errstate(over="ignore", invalid="ignore"):
            for i, j, apart in self.pairs:
                a, b = cached[:, i, None] * to[None, :, j], cached[:, j, None] * to[None, :, i]
                low = (np.abs(a - b) - 1e-12 * np.maximum(a, b)) / apart
                out = np.maximum(out, np.where(low < 1e140, low, 0))
        return np.square(out) * (1 - 1e-12)


def nearest(x: np.ndarray, cached: np.ndarray, centres: list[Centre], pivots: Pivots):
    """(cluster, squared distance, distances computed) of each row; ties go to the smaller number. The centroid with the
    least bound is compared first, the others where their bound doesn't exceed the best distance so far."""
    bounds = pivots.bounds(cached, centres)
    first = np.argmin(bounds, axis=1)
    wide = x.dtype == object or any(abs(v) >= SMALL for c in centres for v in c)
    found, checked = first.copy(), np.ones(len(x), dtype=np.int32)
    best = np.zeros(len(x), dtype=object if wide else np.int64)
    for j, c in enumerate(centres):
        rows = np.flatnonzero(first == j)
        best[rows] = _squared(x[rows], c)
    for j, c in enumerate(centres):
        rows = np.flatnonzero((first != j) & (bounds[:, j] <= _floats(best) * (1 + 1e-12)))
        checked[rows] += 1
        d = _squared(x[rows], c)
        closer = (d < best[rows]) | ((d == best[rows]) & (j < found[rows]))
        best[rows[closer]], found[rows[closer]] = d[closer], j
    return found, best, checked


def _sums(x: np.ndarray, cluster: np.ndarray, into: dict) -> None:
    for j in np.unique(cluster):
        rows = x[cluster == j]
        n, s = into.get(int(j), (0, [0] * x.shape[1]))
        into[int(j)] = n + len(rows), [a + int(b) for a, b in zip(s, rows.sum(axis=0), strict=True)]


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """``value`` in base 2^56, sign on every digit: (place, digit), so that a sum of any size goes through longs."""
    sign, value, place = (1 if value >= 0 else -1), abs(value), 0
    while value:
        value, d = divmod(value, _DIGIT)
        yield place, sign * d
        place += 1


def prepared(vectors: DataFrame, pivots: Pivots, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding, pivot): the vectors that count, with their pivot distances."""
    rows = vectors.filter(_valid(dimensions)).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches):
        for b in batches:
            near = pivots.distances(_scaled(b.column(1), dimensions, scale))
            offsets = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(near.reshape(-1)))],
                names=["vec_id", "embedding", "pivot"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return map_arrow(rows, run, f"vec_id {kind}, embedding array<double>, pivot array<double>")


def _read(b: pa.RecordBatch, pivots: Pivots, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    x = _scaled(b.column("embedding"), dimensions, scale)
    near = b.column("pivot").flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(pivots.points))
    return x, near


def start(vectors: DataFrame, k: int = CLUSTERS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> list[Centre]:
    """The first centroids: the k vectors with the smallest hash of ``<seed>:<vec_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = (vectors.filter(_valid(dimensions)).select(digest.alias("h"), F.col("embedding").cast("array<double>").alias("e"))
            .orderBy("h", "e").limit(k).collect())
    return [tuple(int(v) for v in _scaled(pa.array([r.e], pa.list_(pa.float64())), dimensions, scale)[0]) for r in rows]


def updated(table: DataFrame, centres: list[Centre], pivots: Pivots, dimensions: int = DIMENSIONS, scale: int = SCALE) -> list[Centre]:
    """One round: the floors of the clusters' means; an empty cluster keeps its centroid."""
    def run(batches):
        total: dict = {}
        for b in batches:
            x, near = _read(b, pivots, dimensions, scale)
            if len(x):
                cluster, _, _ = nearest(x, near, centres, pivots)
                _sums(x, cluster, total)
        out = [(j, i, place, digit, 0) for j, (_, s) in total.items() for i, v in enumerate(s) for place, digit in _digits(v)]
        out += [(j, -1, 0, 0, n) for j, (n, _) in total.items()]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                names=["cluster", "i", "place", "digit", "n"])

    parts = map_arrow(table, run, "cluster int, i int, place int, digit long, n long")
    rows = parts.groupBy("cluster", "i", "place").agg(F.sum(F.col("digit").cast("decimal(20,0)")).alias("digit"), F.sum("n").alias("n")).collect()
    sums, counts = [[0] * dimensions for _ in centres], [0] * len(centres)
    for r in rows:
        if r.i < 0:
            counts[r.cluster] += r.n
        else:
            sums[r.cluster][r.i] += int(r.digit) * _DIGIT ** r.place
    return [tuple(v // n for v in s) if n else c for c, s, n in zip(centres, sums, counts, strict=True)]


def assigned(table: DataFrame, centres: list[Centre], pivots: Pivots, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, checked): ``checked`` centroids of all were compared exactly."""
    def run(batches):
        for b in batches:
            x, near = _read(b, pivots, dimensions, scale)
            if len(x):
                cluster, d, checked = nearest(x, near, centres, pivots)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array(cluster, pa.int32()),
                     pa.array([v if v <= _LONG else None for v in d.tolist()], pa.int64()), pa.array(checked, pa.int32())],
                    names=["vec_id", "cluster", "distance", "checked"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return map_arrow(table, run, f"vec_id {kind}, cluster int, distance long, checked int")


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
              seed: int = SEED) -> tuple[DataFrame, list[Centre]]:
    """The vectors with their clusters (see ``assigned``), written to the shared checkpoint folder, and the centroids."""
    centres = start(vectors, k, dimensions, scale, seed)
    pivots = Pivots(centres)
    table = materialize(prepared(vectors, pivots, dimensions, scale))
    if not centres:
        return table.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("checked")), []
    for _ in range(rounds):
        now = updated(table, centres, pivots, dimensions, scale)
        if now == centres:
            break  # all later rounds would give the same
        centres = now
    return materialize(assigned(table, centres, pivots, dimensions, scale)), centres


def report(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows, centres = clustered(vectors)
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.s for r in rows.groupBy("cluster").agg(total.alias("s")).collect()}  # a row per cluster
    every = None if None in sums.values() else sum(sums.values())
    long = lambda v: F.lit(int(v) if v is not None and v <= _LONG else None).cast("long")
    sha = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centres] or [F.lit("")]
    per = F.array(*[long(sums.get(j, 0)) for j in range(max(1, len(centres)))])
    return rows.select("vec_id", "cluster", "distance", F.get(per, F.col("cluster")).alias("cluster_inertia"),
                       long(every).alias("inertia"), F.get(F.array(*sha), F.col("cluster")).alias("centroid_sha256"))
