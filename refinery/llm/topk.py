"""Exact top-k by inner product: columnar branch and bound over blocks.

Candidates go to the cell of their nearest pivot, and cells to blocks. Each query first searches a
block near it, whose k-th best score is its floor; it then meets only those blocks that hold a cell
whose pivot and radius allow a score as high. Within a block candidates are held dimension by
dimension. Scores grow block of dimensions by block; what a candidate can still gain is bounded by the
product of the remaining norms, and those that can no longer reach the floor or the query's k-th best
are compacted away before the next dimensions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import partitions, stage

MOST_IN_BLOCK = 8192
LEAST_IN_BLOCK = 512
QUERIES_IN_BLOCK = 2048
MOST_PIVOTS = 2048
#: Queries whose blocks are looked up together.
TOGETHER = 256
DIMENSIONS = 16
#: Sums below this are exact in double precision.
EXACT = 2.0**52


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """(id, v): v holds floor(scale * x) of each component. Vectors that are null, empty of an id, or hold null or non-finite components are left out."""
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    # floor() of a double gives a long; what is beyond it is kept as the largest long's double.
    finite = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), x.alias("v"))


def _matrix(v: pd.Series, width: int) -> np.ndarray:
    """Components in columns (one row for each dimension), shorter vectors filled with zeros."""
    out = np.zeros((width, len(v)))
    sizes = v.map(len)
    if len(v) and (sizes == width).all():
        out[:] = np.stack(v.to_numpy()).T
    else:
        for k, x in enumerate(v):
            out[: len(x), k] = x
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _exact(q: list[float], rows: list[list[float]]) -> list[int]:
    """Inner products in whole numbers, stopped at the ends of a long."""
    limit = 2**63 - 1
    whole = [int(x) for x in q]
    return [max(-limit, min(limit, sum(a * int(b) for a, b in zip(whole, r)))) for r in rows]


def search_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """(query_id, q, vec_id, score): for each query the k best of this block, ties to smaller ids.

    queries: id, v, q (the query's number) and floor (scores below it are not wanted). Vectors whose
    products may be too large for double precision are settled in whole numbers by themselves.
    """
    width = max([1, *map(len, queries["v"]), *map(len, rows["v"])])
    c, q = _matrix(rows["v"], width), _matrix(queries["v"], width)
    c_ids, q_ids, numbers = (x.to_numpy(np.int64) for x in (rows["id"], queries["id"], queries["q"]))
    floors = queries["floor"].to_numpy(float)
    most = (EXACT / width) ** 0.5
    c_large, q_large = np.abs(c).max(0, initial=0) >= most, np.abs(q).max(0, initial=0) >= most
    large = np.flatnonzero(c_large)
    small, small_ids = c[:, ~c_large], c_ids[~c_large]
    # Dimensions of most mass first, so that bounds close early.
    order = np.argsort(-(small**2).sum(1), kind="stable")
    small, q = np.ascontiguousarray(small[order]), np.ascontiguousarray(q[order])
    steps = list(range(0, width, DIMENSIONS))
    rest_c = np.stack([np.sqrt((small[s + DIMENSIONS :] ** 2).sum(0)) for s in steps])
    rest_q = np.stack([np.sqrt((q[s + DIMENSIONS :] ** 2).sum(0)) for s in steps])
    some = min(4 * k, small.shape[1])
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for lo in range(0, q.shape[1], 256):
        part = q[:, lo : lo + 256]
        first = part[:DIMENSIONS].T @ small[:DIMENSIONS]
        for j in range(part.shape[1]):
            x, me = part[:, j], q_ids[lo + j]
            by_hand = large[c_ids[large] != me]
            if q_large[lo + j]:
                by_hand = np.flatnonzero(c_ids != me)
            ids, scores = np.array([], np.int64), np.array([], np.int64)
            if len(by_hand):
                v = rows["v"].iloc
                ids, scores = c_ids[by_hand], np.array(_exact(queries["v"].iloc[lo + j], [v[i] for i in by_hand]), np.int64)
            if not q_large[lo + j] and len(small_ids):
                partial, keep = first[j].copy(), np.arange(small.shape[1])
                partial[small_ids == me] = -np.inf
                # The exact scores of the most promising few give a floor for the k-th best.
                probe = np.argpartition(-partial, some - 1)[:some] if some < len(partial) else keep
                probe = probe[small_ids[probe] != me]
                full = x @ small[:, probe]
                floor = max(floors[lo + j], np.partition(full, len(full) - k)[len(full) - k] if len(full) >= k else -np.inf)
                keep = keep[small_ids != me]
                partial = partial[keep]
                for n, s in enumerate(steps):
                    if n:
                        partial = partial + x[s : s + DIMENSIONS] @ small[s : s + DIMENSIONS][:, keep]
                    if n + 1 < len(steps):
                        alive = partial + rest_q[n, lo + j] * rest_c[n, keep] * (1 + 1e-9) + 1e-6 >= floor
                        if not alive.all():
                            keep, partial = keep[alive], partial[alive]
                ids, scores = np.concatenate([ids, small_ids[keep]]), np.concatenate([scores, np.rint(partial).astype(np.int64)])
            top = np.lexsort((ids, -scores))[:k]
            top = top[scores[top] >= floors[lo + j]]
            out.append((me, numbers[lo + j], ids[top], scores[top]))
    sizes = [len(x[2]) for x in out]
    join = lambda parts: np.concatenate(parts) if parts else np.array([], np.int64)
    return pd.DataFrame({"query_id": np.repeat(np.array([x[0] for x in out], np.int64), sizes), "q": np.repeat(np.array([x[1] for x in out], np.int64), sizes), "vec_id": join([x[2] for x in out]), "score": join([x[3] for x in out])})


def _to(v: list, width: int) -> np.ndarray:
    return _matrix(pd.Series(list(v)), width).T


def search(queries: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of most inner product with each query, rows of its own id left out; ties to smaller ids.

    Both sides are (id, v) of ``integers``. Vectors of unequal length count as filled up with zeros.
    Rows that share an id are rows like others; queries that do share one answer. Scores beyond a long
    stop at its ends. An empty side gives an empty result. Pivots are a bounded sample of the rows;
    every row is placed, and every query meets every row that its bounds do not leave out.
    """
    spark = rows.sparkSession
    rows, queries = stage(rows), stage(queries.withColumn("q", F.monotonically_increasing_id()))
    n = rows.count()
    chosen = [np.array(r["v"], float) for r in rows.orderBy(F.xxhash64("id", F.lit(3)), "id", "v").limit(min(max(int(n**0.5), 1), MOST_PIVOTS)).select("v").collect()]
    width = max([1, *map(len, chosen)])
    blocks = max(min(partitions(spark), -(-n // LEAST_IN_BLOCK)), -(-n // MOST_IN_BLOCK), 1)
    pivots = _to(chosen, width) if chosen else np.zeros((1, width))
    norms = (pivots**2).sum(1)

    def nearest(v: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, distance from its pivot and norm; what lies beyond the pivots' width only adds to the distance."""
        x = _to(v, max([width, *map(len, v)]))
        square, inner = (x**2).sum(1), x[:, :width]
        d = (inner**2).sum(1)[:, None] - 2 * inner @ pivots.T + norms[None, :]
        cell = d.argmin(1)
        beyond = (x[:, width:] ** 2).sum(1)
        # From the differences themselves: the squares' difference would lose digits of large vectors.
        far = np.sqrt(((inner - pivots[cell]) ** 2).sum(1) + beyond)
        return cell.astype(np.int32), far, np.sqrt(square)

    def place(batches):
        for b in batches:
            if len(b):
                b["cell"], b["far"], b["norm"] = nearest(b["v"].tolist())
                yield b

    placed = rows.mapInPandas(place, "id long, v array<double>, cell int, far double, norm double")
    sized = stage(placed.groupBy("cell").agg(F.count("*").alias("in_cell"), F.max("far").alias("far"), F.max("norm").alias("norm")))
    # A cell's rows go to blocks of its own number, as many as its size needs.
    parts = F.ceil(F.col("in_cell") / max(-(-n // blocks), 1)).cast("int")
    shares = sized.select("cell", parts.alias("parts"))
    part = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")
    own = F.pmod(F.xxhash64("cell", part), F.lit(blocks)).cast("int")
    placed = stage(placed.join(shares, "cell").select("id", "v", own.alias("b"), "cell"))
    # At most MOST_PIVOTS rows: each cell's reach, and the blocks that hold some of it.
    reach = {r["cell"]: r for r in sized.collect()}
    held = {r["cell"]: r["at"] for r in placed.groupBy("cell").agg(F.collect_set("b").alias("at")).collect()}
    known = sorted(reach)
    radius, longest = np.array([reach[c]["far"] for c in known]), np.array([reach[c]["norm"] for c in known])
    # A cell's blocks one after the other, all cells' together: about as many as there are cells and blocks.
    holders = np.array([b for c in known for b in sorted(held[c])], np.int32)
    many = np.array([len(held[c]) for c in known], np.int64)
    begin = np.cumsum(many) - many

    def bounds(v: list) -> tuple[np.ndarray, np.ndarray]:
        """[query, cell]: inner product with the pivot, and the most that any row of the cell may have, with room for rounding."""
        x = _to(v, max([width, *map(len, v)]))
        size = np.sqrt((x**2).sum(1))[:, None]
        middle = x[:, :width] @ pivots[known].T
        most = np.minimum(middle + size * radius[None, :], size * longest[None, :])
        return middle, most + 1e-6 + 1e-9 * size * longest[None, :]

    def first_look(batches):
        """Each query to one block that holds rows of the cell most like it."""
        for b in batches:
            if len(b) and len(known):
                middle, _ = bounds(b["v"].tolist())
                b["b"] = holders[begin[middle.argmax(1)]]
                b["floor"] = -np.inf
                yield b[["id", "v", "q", "floor", "b"]]

    def second_look(batches):
        """Each query to the other blocks that may hold a score as high as its floor."""
        for whole in batches:
            # Some at a time: each may want all blocks.
            for lo in range(0, len(whole) if known else 0, TOGETHER):
                b = whole.iloc[lo : lo + TOGETHER]
                middle, most = bounds(b["v"].tolist())
                seen = holders[begin[middle.argmax(1)]]
                at, cell = np.nonzero(most >= b["floor"].to_numpy()[:, None])
                size = many[cell]
                to = holders[np.repeat(begin[cell] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                at, to = np.divmod(np.unique(np.repeat(at, size) * blocks + to), blocks)
                other = to != seen[at]
                out = b.iloc[at[other]][["id", "v", "q", "floor"]].copy()
                out["b"] = to[other].astype(np.int32)
                yield out

    shape = "id long, v array<double>, q long, floor double, b int"

    def met(asked: DataFrame, turns: int) -> DataFrame:
        own = lambda parts: F.pmod(F.xxhash64("q", F.lit(5)), F.lit(parts)).cast("int")
        left = stage(asked.withColumn("t", own(turns)))
        # A block goes to those turns only in which a query wants it.
        pairs = left.select(F.col("t").alias("_t"), F.col("b").alias("_b")).distinct()
        right = placed.join(pairs, F.col("b") == F.col("_b")).select("id", "v", F.col("_t").alias("t"), F.col("_b").alias("b")).groupBy("t", "b")
        return left.groupBy("t", "b").cogroup(right).applyInPandas(lambda q, c: search_block(q, c, k), "query_id long, q long, vec_id long, score long")

    m = queries.count()
    near = stage(met(queries.mapInPandas(first_look, shape), 1 if m <= QUERIES_IN_BLOCK * blocks else -(-m // (QUERIES_IN_BLOCK * blocks))))
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("vec_id"))
    floors = near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == k).select("q", F.col("score").cast("double").alias("floor"))
    # A score that double precision holds only nearly must not lie above itself.
    lower = F.coalesce(F.col("floor") - F.abs("floor") * 1e-12 - 1, F.lit(float("-inf")))
    asked = queries.join(floors, "q", "left").select("id", "v", "q", lower.alias("floor")).mapInPandas(second_look, shape)
    found = near.unionByName(met(asked, max(-(-m // QUERIES_IN_BLOCK), 1)))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
