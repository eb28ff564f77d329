"""Centroid clustering by exact Lloyd rounds with bounds that are loosened by the norm of the total displacement.

Every vector keeps the distance to its centroid and, for each group of centroids, a lower bound of the
distance to any other of them, each with the round in which it was found. All centroids of all rounds are
kept, which is a few thousand numbers a round. A bound is later loosened by how far its centroid is now from
where it was in that round, as one distance, instead of by the sum of the steps in between, which is
never less. Vectors whose bounds still hold are not looked at; of the others the groups that failed are compared
anew, in whole numbers.

A round is one pass over a staged table of vectors and bounds: it writes the next one, and a few rows for
each task with its sums of each cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import Staged, stage
from refinery.operators.partitioning import spread

#: Centroids that share a bound.
GROUP = 8
#: Room for rounding: bounds that are closer than this, relatively, do not decide.
SLACK = 1e-9
#: Beyond this, squared distances do not fit a long.
MOST = 1 << 27
NONE = np.iinfo(np.int64).max

STATE = "vec_id long, v array<int>, cluster int, upper double, evaluated int, lower array<double>, seen array<int>, n long, sums array<long>"


def _kept(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def whole(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) of the vectors with ``dims`` components, all finite."""
    large = F.raise_error(F.lit(f"a component beyond {MOST} gives distances beyond a long")).cast("int")
    v = F.transform(F.col(vector_col), lambda x: F.when(F.abs(x.cast("double") * scale) < MOST, F.floor(x.cast("double") * scale).cast("int")).otherwise(large))
    return vectors.where(_kept(F.col(vector_col), dims)).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x and c, exactly: in double precision where all sums are whole numbers that it holds."""
    if not len(x) or not len(c):
        return np.zeros((len(x), len(c)), np.int64)
    most = max(int(np.abs(x).max()), int(np.abs(c).max()))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def own_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of each row of x and the row of c beside it."""
    return ((x - c) ** 2).sum(1)


class Bounds:
    """State of some vectors: cluster, distance to its centroid (upper, found in round ``evaluated``), and for each group a lower bound for the others (found in round ``seen``)."""

    def __init__(self, cluster: np.ndarray, upper: np.ndarray, evaluated: np.ndarray, lower: np.ndarray, seen: np.ndarray) -> None:
        self.cluster, self.upper, self.evaluated, self.lower, self.seen = cluster, upper, evaluated, lower, seen

    @classmethod
    def start(cls, x: np.ndarray, c: np.ndarray) -> Bounds:
        d = distances(x, c)
        cluster = d.argmin(1).astype(np.int32)
        rows = np.arange(len(x))
        own = d[rows, cluster].copy()
        d[rows, cluster] = NONE
        lower = np.minimum.reduceat(d, np.arange(0, len(c), GROUP), axis=1)
        return cls(cluster, np.sqrt(own), np.zeros(len(x), np.int32), np.sqrt(lower), np.zeros(lower.shape, np.int32))

    def update(self, x: np.ndarray, history: list[np.ndarray]) -> int:
        """Assigns x to the last centroids of the history, exactly; ties to smaller numbers. Returns how many distances it took."""
        c, now = history[-1], len(history) - 1
        # [round, centroid]: how far the centroid is from where it was.
        moved = np.sqrt(np.stack([own_distances(c, old) for old in history]))
        apart = np.maximum.reduceat(moved, np.arange(0, len(c), GROUP), axis=1)
        upper = self.upper + moved[self.evaluated, self.cluster]
        lower = self.lower - apart[self.seen, np.arange(apart.shape[1])]
        rows = np.flatnonzero((lower <= (upper * (1 + SLACK) + SLACK)[:, None]).any(1))
        if not len(rows):
            return 0
        xs, before = x[rows], self.cluster[rows]
        best, best_d = before.copy(), own_distances(xs, c[before])
        failed = lower[rows] <= (np.sqrt(best_d) * (1 + SLACK) + SLACK)[:, None]
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        took = len(rows)

        def rescan(g: int, some: np.ndarray) -> np.ndarray:
            nonlocal took
            d = distances(xs[some], c[g * GROUP : (g + 1) * GROUP])
            took += d.size
            found.setdefault(g, []).append((some, d))
            return d

        for g in range(failed.shape[1]):
            some = np.flatnonzero(failed[:, g])
            if len(some):
                d = rescan(g, some)
                j = d.argmin(1)
                least, j = d[np.arange(len(some)), j], (j + g * GROUP).astype(np.int32)
                nearer = (least < best_d[some]) | ((least == best_d[some]) & (j < best[some]))
                best[some[nearer]], best_d[some[nearer]] = j[nearer], least[nearer]
        # The group of a centroid that was left has a bound without it.
        left = (best != before) & ~failed[np.arange(len(rows)), before // GROUP]
        for g in np.unique(before[left] // GROUP):
            rescan(int(g), np.flatnonzero(left & (before // GROUP == g)))
        for g, scans in found.items():
            for some, d in scans:
                mine = np.flatnonzero(best[some] // GROUP == g)
                d[mine, best[some[mine]] - g * GROUP] = NONE
                self.lower[rows[some], g], self.seen[rows[some], g] = np.sqrt(d.min(1)), now
        self.cluster[rows], self.upper[rows], self.evaluated[rows] = best, np.sqrt(best_d), now
        return took


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lists(a: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel(), kind))


def _assigned(batch: pa.RecordBatch, history: list[np.ndarray]) -> tuple[np.ndarray, Bounds]:
    k, dims = history[0].shape
    x = _matrix(batch.column("v"), dims, np.int64)
    if "cluster" not in batch.schema.names:
        return x, Bounds.start(x, history[0])
    of = [batch.column(n).to_numpy(zero_copy_only=False).astype(t) for n, t in (("cluster", np.int32), ("upper", float), ("evaluated", np.int32))]
    groups = -(-k // GROUP)
    bounds = Bounds(*of, _matrix(batch.column("lower"), groups, float), _matrix(batch.column("seen"), groups, np.int32))
    bounds.update(x, history)
    return x, bounds


NAMES = ["vec_id", "v", "cluster", "upper", "evaluated", "lower", "seen", "n", "sums"]
KINDS = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.int64(), pa.list_(pa.int64())]


def _round(history: list[np.ndarray]):
    """A task of a round: its vectors with their new bounds, and last a row for each of its clusters with number and sum of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = history[0].shape
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, b = _assigned(batch, history)
            by = np.argsort(b.cluster, kind="stable")
            of, at = np.unique(b.cluster[by], return_index=True)
            sums[of] += np.add.reduceat(x[by], at, axis=0)
            n += np.bincount(b.cluster, minlength=k)
            rows = len(x)
            columns = [batch.column("vec_id"), batch.column("v").cast(KINDS[1]), pa.array(b.cluster), pa.array(b.upper), pa.array(b.evaluated), _lists(b.lower, pa.float64()), _lists(b.seen, pa.int32()), pa.nulls(rows, KINDS[7]), pa.nulls(rows, KINDS[8])]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)
        some = np.flatnonzero(n)
        if len(some):
            given = {"cluster": pa.array(some.astype(np.int32)), "n": pa.array(n[some]), "sums": _lists(sums[some], pa.int64())}
            yield pa.RecordBatch.from_arrays([given.get(c, pa.nulls(len(some), t)) for c, t in zip(NAMES, KINDS)], names=NAMES)

    return run


def _last(history: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, b = _assigned(batch, history)
                d = own_distances(x, history[-1][b.cluster])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(b.cluster), pa.array(d)], names=["vec_id", "cluster", "distance"])

    return run


def _means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Rounded-down means of the clusters, added up from the tasks' rows; an empty one stays. At most a row for each centroid comes back."""
    dims = before.shape[1]
    each = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    after = before.copy()
    for r in state.where("n is not null").groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect():
        after[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return after


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Lloyd's clustering of floor(scale * x) in whole numbers: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors without exactly ``dims`` finite components take no part. Centroids start as the ``k`` vectors
    (all, if fewer) of smallest sha256 of ``seed:id``, ties by their components; rows without id start none. Each of
    ``rounds`` rounds assigns all vectors to their nearest centroid (ties: smaller number) and replaces centroids by
    the rounded-down means; centroids without vectors stay. At the end vectors are assigned once more.

    Repeated rows count each; an empty table gives an empty one; other columns are ignored. A component of
    which ``scale`` times is beyond MOST is an error: squared distances would not fit a long.
    """
    spark = vectors.sparkSession
    points = stage(whole(spread(vectors.select(id_col, vector_col)), id_col, vector_col, dims, scale))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = points.where(F.col("vec_id").isNotNull()).select(name.alias("name"), "v").orderBy("name", "v").limit(k).collect()
    out = "vec_id long, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
    history = [np.array([r["v"] for r in first], np.int64)]
    state, held = points, None
    for _ in range(rounds):
        after = Staged(state.mapInArrow(_round(history), STATE))
        if held:
            held.drop()
        held = after
        history.append(_means(held.df, history[-1]))
        state = held.df.where("n is null").drop("n", "sums")
    done = stage(state.mapInArrow(_last(history), out))
    if held:
        held.drop()
    per = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in history[-1]]
    rows = [(j, d, sum(per.values()), sha[j]) for j, d in per.items()]
    return done.join(F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
