"""Embedding near-duplicates by a cover tree and dual traversal of its nodes.

The upper levels are sets of pivots: every vector goes to the nearest of about a square root of all,
a cell with many vectors gets pivots of its own, and what still is large is cut into blocks. Each
block is covered by nested nets of halving radii. Two blocks are compared only if their covering radii
allow a pair within the threshold; blocks are dealt to a few bundles, and a block is sent to those
bundles only that hold one of its likes, packed to a few rows. In a meeting of two bundles, pairs of nodes are
pruned, or linked as a whole, by their covering radii, and only the rest are compared vector by vector. Where many
nodes meet many, their centres' shadows in a few leading directions are compared first: no cosine exceeds theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import Staged, components, partitions, stage

MOST_IN_BLOCK = 4096
#: Vectors of a bundle, and bytes of their components as doubles, unless there would be fewer bundles than keep all cores busy with meetings.
IN_BUNDLE, BUNDLE_BYTES = 65536, 1 << 25
#: Bytes of components, as doubles, in a row of a packed block.
PIECE_BYTES = 1 << 19
#: Pivots above, and in each cell of more than MOST_IN_BLOCK vectors.
MOST_PIVOTS, MOST_INNER = 2048, 64
DEPTH = 4
#: Room for rounding when distances of unit vectors stand for cosines.
SLACK = 1e-7
#: Pairs whose distance is this close to the threshold are decided by the cosine itself.
NEAR = 1e-6
#: Directions of a shadow, and the vectors they are taken from.
LEADING, SAMPLE = 23, 512
#: Time of a pair of nodes that is looked up by itself, against one of all pairs of many nodes.
BY_ONE = 64
#: Nodes that meet at once, so that their products stay in a core's cache; pairs of nodes, and links, that are held at once.
TILE, TOGETHER, MOST_LINKS = (512, 1024), 1 << 18, 1 << 20


def _usable(id_col: str, vector_col: str) -> Column:
    finite = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    some = F.exists(F.col(vector_col), lambda c: c != 0)
    return F.coalesce(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite & some, F.lit(False))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that can link: not null, not zero, all components finite."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    return vectors.where(_usable(id_col, vector_col)).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def _stacked(v) -> np.ndarray:
    return np.stack([np.asarray(a, dtype=float) for a in v]) if len(v) else np.zeros((0, 0))


def _of_length_one(x: np.ndarray) -> np.ndarray:
    if len(x):
        x = x / np.maximum(x.max(axis=1, keepdims=True), -x.min(axis=1, keepdims=True))
        for lo in range(0, len(x), 4096):
            x[lo : lo + 4096] /= np.linalg.norm(x[lo : lo + 4096], axis=1, keepdims=True)
    return x


def _unit(v) -> np.ndarray:
    return _of_length_one(_stacked(v))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def net(x: np.ndarray, radius: float) -> np.ndarray:
    """Rows of x that are more than ``radius`` apart and within it of every row."""
    centres: list[int] = []
    for lo in range(0, len(x), 256):
        part = np.arange(lo, min(lo + 256, len(x)))
        if centres:
            part = part[_distances(x[part], x[centres]).min(1) > radius]
        far = _distances(x[part], x[part]) > radius
        left = np.ones(len(part), bool)
        while left.any():
            k = int(left.argmax())
            left[k] = False
            left &= far[k]
            centres.append(int(part[k]))
    return np.array(centres, dtype=np.int64)


def levels(x: np.ndarray, top: float = 1.0, depth: int = DEPTH) -> np.ndarray:
    """[row, level]: the row that is the centre of the row's node. Nets of halving radii, each inside the nodes of the one before, so a node's rows lie within its radius."""
    out = np.zeros((len(x), depth), np.int32)
    whole, radius = [np.arange(len(x))], top
    for level in range(depth):
        nodes = []
        for members in whole:
            if len(members) == 1:
                out[members, level] = members
                continue
            centres = members[net(x[members], radius)]
            nearest = _nearest(x[members], x[centres])
            out[members, level] = centres[nearest]
            by = np.argsort(nearest, kind="stable")
            nodes += np.split(members[by], np.searchsorted(nearest[by], np.arange(1, len(centres))))
        alone = [m for m in nodes if len(m) == 1]
        for later in range(level + 1, depth) if alone else ():
            out[np.concatenate(alone), later] = np.concatenate(alone)
        whole, radius = [m for m in nodes if len(m) > 1], radius / 2
    return out


class CoverTree:
    """The nodes of each level of ``levels``: centre, covering radius and the first node of each parent, in order of parents; and the rows of the last level's nodes."""

    def __init__(self, x: np.ndarray, centre: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        above = np.zeros(len(x), np.int64)
        for level in range(centre.shape[1]):
            c = centre[:, level].astype(np.int64)
            nodes, of = np.unique(above * len(x) + c, return_inverse=True)
            nodes = nodes % len(x)
            far = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", x, x[c]), 0.0))
            far[c == np.arange(len(x))] = 0.0
            cover = np.zeros(len(nodes))
            np.maximum.at(cover, of, far)
            parent = np.zeros(len(nodes), np.int64)
            parent[of] = above
            self.levels.append((nodes, cover, np.searchsorted(parent, np.arange(parent[-1] + 2))))
            above = of
        self.order = np.argsort(above, kind="stable")
        self.cuts = np.searchsorted(above[self.order], np.arange(len(nodes) + 1))

    def members(self, node: int) -> np.ndarray:
        return self.order[self.cuts[node] : self.cuts[node + 1]]


def _cosines(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of rows p of x with rows q of y, one by one."""
    out = np.empty(len(p))
    for lo in range(0, len(p), 1 << 12):
        s = slice(lo, lo + (1 << 12))
        out[s] = np.einsum("ij,ij->i", x[p[s]], y[q[s]])
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for lo in range(0, len(x), 1024):
        out[lo : lo + 1024] = (x[lo : lo + 1024] @ centres.T).argmax(1)
    return out


def _leading(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Orthonormal directions that hold most of a sample of the vectors."""
    some = [v[:: -(-len(v) // SAMPLE)] for v in ((x,) if x is y else (x, y))]
    return np.linalg.svd(np.concatenate(some), full_matrices=False)[2][:LEADING]


def _shadow(x: np.ndarray, along: np.ndarray) -> np.ndarray:
    """Each vector's part along the directions, and the length of what is left: by the inequality of Cauchy and Schwarz no two shadows have a smaller product than their vectors."""
    out = np.empty((len(x), len(along) + 1), np.float32)
    for lo in range(0, len(x), 4096):
        part = x[lo : lo + 4096] @ along.T
        out[lo : lo + 4096, :-1] = part
        out[lo : lo + 4096, -1] = np.sqrt(np.maximum(1.0 - np.einsum("ij,ij->i", part, part), 0.0))
    return out


class _Descent:
    """Pairs of last-level nodes that the bounds leave, by going down both trees at once. Of one tree with itself (b is a) each pair comes once."""

    def __init__(self, a: CoverTree, b: CoverTree, x: np.ndarray, y: np.ndarray, reach: float) -> None:
        self.a, self.b, self.x, self.y, self.reach, self.same = a, b, x, y, reach, b is a
        along = _leading(x, y)
        self.shadow_x = _shadow(x, along)
        self.shadow_y = self.shadow_x if self.same else _shadow(y, along)
        # For the rounding of single precision, in the vectors and in sums of their products.
        self.room = 1e-5

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        level = self._first()
        yield from self._all(level, *(np.arange(len(t.levels[level][0])) for t in (self.a, self.b)))

    def _first(self) -> int:
        """The level from which, by a sample of the nodes of each, the least work leads to the last: all pairs of its nodes, and the pairs of children of those that its radii leave from there on."""
        work, below = [], 0.0
        for level in reversed(range(len(self.a.levels))):
            (ca, ra, _), (cb, rb, _) = self.a.levels[level], self.b.levels[level]
            if level + 1 < len(self.a.levels):
                i, j = (np.arange(0, len(c), -(-len(c) // SAMPLE)) for c in (ca, cb))
                live = _distances(self.x[ca[i]], self.y[cb[j]]) <= self.reach + ra[i][:, None] + rb[j] + SLACK
                na, nb = (np.diff(t.levels[level + 1][2])[k] for t, k in ((self.a, i), (self.b, j)))
                below += BY_ONE * (na @ live @ nb) * (len(ca) / len(i)) * (len(cb) / len(j))
            work.append((len(ca) * len(cb) + below, level))
        return min(work)[1]

    def _all(self, level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From all nodes i with all nodes j of a level."""
        held, n = [], 0
        for found in self._tiles(level, i, j):
            held.append(found)
            n += len(found[0])
            if n > TOGETHER:
                yield from self._down(level, *map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            yield from self._down(level, *map(np.concatenate, zip(*held)))

    def _tiles(self, level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of nodes i and j whose distance is at most reach and both radii, some at a time: by shadows in single precision with room for its rounding first, by nodes with and without extent."""
        (ca, ra, _), (cb, rb, _) = self.a.levels[level], self.b.levels[level]
        for p in (i[ra[i] == 0], i[ra[i] > 0]):
            for q in (j[rb[j] == 0], j[rb[j] > 0]):
                if not len(p) or not len(q):
                    continue
                least = (1.0 - (self.reach + ra[p] + rb[q].max() + SLACK) ** 2 / 2 - self.room).astype(np.float32)
                left = self.shadow_x[ca[p]]
                for lo in range(0, len(q), TILE[1]):
                    cols = q[lo : lo + TILE[1]]
                    right = np.ascontiguousarray(self.shadow_y[cb[cols]].T)
                    for first in range(0, len(p), TILE[0]):
                        part, low = p[first : first + TILE[0]], least[first : first + TILE[0]]
                        if self.same and part[0] > cols[-1]:
                            break
                        product = left[first : first + TILE[0]] @ right
                        some = np.flatnonzero(product.max(1) >= low)
                        if not len(some):
                            continue
                        r, c = np.nonzero(product[some] >= low[some, None])
                        rows = part[some]
                        if len(r) > product.size >> 5:
                            d = _distances(self.x[ca[rows]], self.y[cb[cols]])
                            r, c = np.nonzero(d <= self.reach + ra[rows][:, None] + rb[cols] + SLACK)
                            yield self._once(rows[r], cols[c])
                        else:
                            yield self._near(level, *self._once(rows[r], cols[c]))

    def _once(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (i[i <= j], j[i <= j]) if self.same else (i, j)

    def _near(self, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (ca, ra, _), (cb, rb, _) = self.a.levels[level], self.b.levels[level]
        d = np.sqrt(np.maximum(2 - 2 * _cosines(self.x, ca[i], self.y, cb[j]), 0))
        near = d <= self.reach + ra[i] + rb[j] + SLACK
        return i[near], j[near]

    def _down(self, level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if level + 1 == len(self.a.levels):
            yield i, j
            return
        first_a, first_b = self.a.levels[level + 1][2], self.b.levels[level + 1][2]
        na, nb = np.diff(first_a)[i], np.diff(first_b)[j]
        each = na * nb
        many = each > TOGETHER >> 6
        for p, q in zip(i[many], j[many]):
            yield from self._all(level + 1, np.arange(first_a[p], first_a[p + 1]), np.arange(first_b[q], first_b[q + 1]))
        i, j, nb, each = i[~many], j[~many], nb[~many], each[~many]
        turn = (np.cumsum(each) - each) // TOGETHER
        for lo, hi in _runs(turn):
            at = np.repeat(np.arange(lo, hi), each[lo:hi])
            inner = np.arange(len(at)) - np.repeat(np.cumsum(each[lo:hi]) - each[lo:hi], each[lo:hi])
            p, q = self._once(first_a[i[at]] + inner // nb[at], first_b[j[at]] + inner % nb[at])
            yield from self._down(level + 1, *self._near(level + 1, p, q))


def _runs(key: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
    return ((lo, hi) for lo, hi in zip(cuts, cuts[1:]) if lo < hi)


class _Side:
    """Numbers, counts and unit vectors of whole blocks' classes, and the tree over all of them."""

    def __init__(self, node: np.ndarray, n: np.ndarray, v: np.ndarray, centre: np.ndarray) -> None:
        self.node, self.n, self.x = node, n, _of_length_one(v)
        self.tree = CoverTree(self.x, centre)


def _of_rows(rows: pd.DataFrame) -> dict[int, _Side]:
    """The sides of blocks whose classes are rows, by width."""
    out = {}
    for w, part in rows.sort_values(["block", "k"]).groupby("w"):
        k = part["k"].to_numpy()
        begin = np.arange(len(part)) - k
        out[w] = _Side(part["node"].to_numpy(np.int64), part["n"].to_numpy(np.int64), _stacked(part["v"]), np.stack(part["centre"].to_numpy()) + begin[:, None])
    return out


def pack(part: pd.DataFrame, v: np.ndarray, centre: np.ndarray) -> pd.DataFrame:
    """A block of one width as a few rows of bytes: components in single precision where that keeps them all."""
    out, step = [], max(PIECE_BYTES // (8 * v.shape[1]), 1)
    for k in range(0, len(v), step):
        s = slice(k, k + step)
        with np.errstate(over="ignore"):
            short = v[s].astype(np.float32)
        kept = short if (short == v[s]).all() else v[s]
        numbers = (part[c].to_numpy(np.int64)[s].tobytes() for c in ("node", "n"))
        out.append((k, len(short), *numbers, kept.tobytes(), centre[s].astype(np.int32).tobytes()))
    return pd.DataFrame(out, columns=["k", "size", "node", "n", "v", "centre"])


def _of_pieces(pieces: pd.DataFrame) -> dict[int, _Side]:
    """The sides of packed blocks, by width."""
    out = {}
    for w, part in pieces.sort_values(["block", "k"]).groupby("w"):
        size = part["size"].to_numpy()
        node, n = (np.frombuffer(b"".join(part[c]), np.int64) for c in ("node", "n"))
        v = np.concatenate([np.frombuffer(b, np.float32 if len(b) == 4 * w * m else np.float64).reshape(m, w) for b, m in zip(part["v"], size)])
        begin = np.repeat(np.cumsum(size) - size - part["k"].to_numpy(), size)
        out[w] = _Side(node, n, v.astype(float), np.frombuffer(b"".join(part["centre"]), np.int32).reshape(len(v), -1) + begin[:, None])
    return out


def link_blocks(a: pd.DataFrame, b: pd.DataFrame | None, least: float) -> pd.DataFrame:
    """``_link`` of whole blocks: their pieces, or a row for each class."""
    sides = _of_pieces if "size" in a else _of_rows
    return _link(sides(a), None if b is None else sides(b), least)


def _link(a: dict[int, _Side], b: dict[int, _Side] | None, least: float) -> pd.DataFrame:
    """Rows (node, other, n): other null: node has n links here, members of classes counted; else a link, enough to join components.

    Without b, the pairs within a. Whole linked pairs of nodes give a count and a few links each.
    """
    links, tally = _Links(), []
    for w in a if b is None else a.keys() & b.keys():
        p, q = a[w], a[w] if b is None else b[w]
        na, nb = _meet(p, q, least, links)
        tally += [(p.node, na + nb)] if p is q else [(p.node, na), (q.node, nb)]
    rows, cols = links.spanning()
    node, n = (np.concatenate([np.array([], np.int64), *x]) for x in ((t[0][t[1] > 0] for t in tally), (t[1][t[1] > 0] for t in tally)))
    out = pd.concat([pd.DataFrame({"node": rows, "other": cols}), pd.DataFrame({"node": node, "n": n})])
    return out.astype({"node": "int64", "other": "Int64", "n": "Int64"})


class _Links:
    """Links found so far, or as many as join the same components."""

    def __init__(self) -> None:
        self.a: list[np.ndarray] = [np.array([], np.int64)]
        self.b: list[np.ndarray] = [np.array([], np.int64)]
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.held += len(a)
        if self.held > MOST_LINKS:
            rows, cols = self.spanning()
            self.a, self.b, self.held = [rows], [cols], 0

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        return spanning(np.concatenate(self.a), np.concatenate(self.b))


def _meet(a: _Side, b: _Side, least: float, links: _Links) -> tuple[np.ndarray, np.ndarray]:
    """Links of each class of a and of b between them; within a, where b is a, each pair once for either end."""
    reach, same = float(np.sqrt(max(2.0 - 2.0 * least, 0.0))), a is b
    x, y, ta, tb = a.x, b.x, a.tree, b.tree
    (ca, ra, _), (cb, rb, _) = ta.levels[-1], tb.levels[-1]
    na, nb = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    one_a, one_b = np.diff(ta.cuts) == 1, np.diff(tb.cuts) == 1
    for left, right in _Descent(ta, tb, x, y, reach).pairs():
        one = one_a[left] & one_b[right]
        p, q = ta.order[ta.cuts[left[one]]], tb.order[tb.cuts[right[one]]]
        hit = _cosines(x, p, y, q) >= least
        if same:
            hit &= p != q
        p, q = p[hit], q[hit]
        np.add.at(na, p, b.n[q])
        np.add.at(nb, q, a.n[p])
        links.add(a.node[p], b.node[q])
        for i, j in zip(left[~one], right[~one]):
            p, q = ta.members(i), tb.members(j)
            itself = same and i == j
            d = float(np.sqrt(max(2 - 2 * float(x[ca[i]] @ y[cb[j]]), 0)))
            if d + ra[i] + rb[j] <= reach - NEAR:
                na[p] += b.n[q].sum()
                if not itself:
                    nb[q] += a.n[p].sum()
                else:
                    na[p] -= a.n[p]
                links.add(a.node[p], np.full(len(p), b.node[q[0]]))
                links.add(np.full(len(q), a.node[p[0]]), b.node[q])
                continue
            for lo in range(0, len(p), 1024):
                part = p[lo : lo + 1024]
                hit = x[part] @ y[q].T >= least
                if itself:
                    hit &= part[:, None] != q[None, :]
                na[part] += hit @ b.n[q]
                if not itself:
                    nb[q] += a.n[part] @ hit
                rows, cols = forest(hit)
                links.add(a.node[part[rows]], b.node[q[cols]])
    return na, nb


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least of its component) of the graph of links a - b, for all nodes but the least: labels spread along links and jump to their own labels."""
    names, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = both[: len(a)], both[len(a) :]
    label = np.arange(len(names))
    while True:
        new = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(names))
    return names[other], names[label[other]]


def forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) of a spanning forest of the bipartite graph ``hit``."""
    left, right = hit.any(1), hit.any(0)
    out_a, out_b = [], []
    while left.any():
        todo = [int(left.argmax())]
        left[todo[0]] = False
        while todo:
            r = todo.pop()
            new = np.flatnonzero(hit[r] & right)
            if not len(new):
                continue
            right[new] = False
            out_a.append(np.full(len(new), r))
            out_b.append(new)
            rows = np.flatnonzero(left)
            met = hit[np.ix_(rows, new)]
            reached = met.any(1)
            out_a.append(rows[reached])
            out_b.append(new[met[reached].argmax(1)])
            left[rows[reached]] = False
            todo += rows[reached].tolist()
    empty = np.array([], np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _nearest_pivots(v: pd.Series, pivots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the nearest of the pivots of its length, and how far it is (-1 and 2 where there is none)."""
    cell, far = np.full(len(v), -1, np.int32), np.full(len(v), 2.0)
    widths = v.map(len).to_numpy()
    by_width: dict[int, list[int]] = {}
    for n, p in enumerate(pivots):
        by_width.setdefault(len(p), []).append(n)
    for w in set(widths.tolist()) & set(by_width):
        at, same = np.flatnonzero(widths == w), np.array(by_width[w], np.int32)
        x, p = _unit(v.iloc[at]), np.stack([pivots[n] for n in same])
        for lo in range(0, len(at), 1024):
            d = _distances(x[lo : lo + 1024], p)
            cell[at[lo : lo + 1024]], far[at[lo : lo + 1024]] = same[d.argmin(1)], d.min(1)
    return cell, far


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row.

    n_links: other rows with cosine >= ``least``; component_id: smallest id reachable by links, its
    own included; kept: the row names its component. Equal vectors are one class with a count. Rows
    that cannot link (see ``usable``), or whose id is null, have no links and are their own component.
    Vectors of unequal length never link. Rows that share an id are rows like others: each has its
    own links and component. Pivots are a bounded sample; every vector is placed and compared.
    """
    spark = vectors.sparkSession
    me = F.col(id_col).cast("long")
    text = F.concat_ws(",", F.transform("v", lambda c: c.cast("string")))
    good = usable(vectors, id_col, vector_col)
    rows = stage(good.select("id", "v", F.xxhash64(text).alias("h"), F.xxhash64(F.lit(7), text).alias("g")))
    # Staged, so that the numbers of the classes stay the same whatever is computed again.
    classes = stage(rows.groupBy("h", "g").agg(F.any_value("v").alias("v"), F.min("id").alias("id"), F.count("*").alias("n")).withColumn("node", F.monotonically_increasing_id()))
    total, numbers = classes.agg(F.count("*"), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    parts = partitions(spark)
    pivots = min(max(int(total**0.5), 1), MOST_PIVOTS)
    chosen = classes.orderBy(F.xxhash64("id", "h"), "node").limit(pivots).select("v").collect()
    unit = [_unit([np.asarray(r["v"])])[0] for r in chosen]

    def place(batches):
        for b in batches:
            b["cell"], b["far"] = _nearest_pivots(b["v"], unit)
            b["w"] = b["v"].map(len).astype(np.int32)
            yield b[["node", "v", "n", "w", "cell", "far"]]

    placed = stage(classes.select("node", "v", "n").mapInPandas(place, "node long, v array<double>, n long, w int, cell int, far double"))
    cells = stage(placed.groupBy("cell").agg(F.count("*").alias("in_cell")))
    # Large cells: pivots of their own, brought to each part of the cell.
    large = cells.where(F.col("in_cell") > MOST_IN_BLOCK).withColumn("turns", F.ceil(F.col("in_cell") / MOST_IN_BLOCK).cast("int"))
    turn = F.pmod(F.xxhash64("node"), F.col("turns")).cast("int")
    inner = placed.join(large, "cell").withColumn("turn", turn)
    # About MOST_INNER rows of the cell by hash, then exactly so many at most.
    sampled = inner.where(F.pmod(F.xxhash64("node", F.lit(9)), F.col("in_cell")) < 2 * MOST_INNER).groupBy("cell", "turns").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("node", F.lit(9)).alias("o"), "v"))), 1, MOST_INNER).alias("p"))
    sampled = stage(sampled.select("cell", F.transform("p", lambda x: x["v"]).alias("p"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")))

    def place_again(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        rows["sub"] = np.int32(-1)
        if len(rows) and len(pivots):
            own = [_unit([np.asarray(p)])[0] for p in pivots["p"].iloc[0]]
            rows["sub"] = _nearest_pivots(rows["v"], own)[0]
        return rows[["node", "v", "n", "w", "cell", "far", "sub"]]

    shape = "node long, v array<double>, n long, w int, cell int, far double"
    again = inner.groupBy("cell", "turn").cogroup(sampled.groupBy("cell", "turn")).applyInPandas(place_again, shape + ", sub int")
    small = placed.join(cells.where(F.col("in_cell") <= MOST_IN_BLOCK).select("cell"), "cell").withColumn("sub", F.lit(-1))
    filed = stage(again.unionByName(small))
    sized = filed.groupBy("cell", "sub").agg(F.ceil(F.count("*") / MOST_IN_BLOCK).cast("int").alias("_blocks"))
    dealt = filed.join(sized, ["cell", "sub"]).withColumn("block", F.concat_ws(":", "cell", "sub", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")))

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        # The levels of each block are made once; every meeting of the block uses them.
        out = []
        for w, part in pdf.groupby("w"):
            part = part.sort_values("node")
            v = _stacked(part["v"])
            x = _of_length_one(v)
            # The block's own centre, besides its cell's: the vector nearest to the mean.
            middle = x[int((x @ x.mean(0)).argmax())]
            packed = pack(part, v, levels(x)).assign(w=w, cell=part["cell"].iloc[0], block=f"{part['block'].iloc[0]}:{w}")
            packed["far"], packed["around"] = part["far"].max(), _distances(x, middle[None])[:, 0].max()
            packed["middle"] = [middle.tolist()] * len(packed)
            out.append(packed)
        return pd.concat(out)[["block", "w", "cell", "far", "middle", "around", "k", "size", "node", "n", "v", "centre"]]

    # Blocks of few rows are covered together.
    deal = F.pmod(F.xxhash64("block"), F.lit(max(parts, -(-total // MOST_IN_BLOCK))))
    covered = dealt.select("node", "v", "n", "w", "cell", "block", "far", deal.alias("deal"))

    def cover_each(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([cover(part) for _, part in pdf.groupby("block")])

    dealt = stage(covered.groupBy("deal").applyInPandas(cover_each, "block string, w int, cell int, far double, middle array<double>, around double, k int, size int, node binary, n binary, v binary, centre binary"))
    # Each bundle more is a copy more of all vectors, so there are no more than three meetings or so for each core.
    busy = min(parts, 3 * spark.sparkContext.defaultParallelism)
    bundles = max(min(int((2 * busy) ** 0.5) + 1, total // 512), -(-total // IN_BUNDLE), -(-8 * numbers // BUNDLE_BYTES), 1)
    bundle = F.pmod(F.xxhash64("block", F.lit(1)), F.lit(bundles)).cast("int")
    blocks = stage(dealt.where("k = 0").select("block", "w", "cell", "far", "middle", "around", bundle.alias("bundle")))
    reach = float(np.sqrt(max(2.0 - 2.0 * least, 0.0)))
    # At most MOST_PIVOTS + 1 rows.
    radius = {r["cell"]: r["far"] for r in blocks.groupBy("cell").agg(F.max("far").alias("far")).collect()}

    def likely(batches):
        """Of each block the cells that may hold likenesses, and how far their pivots are."""
        for b in batches:
            out = []
            for cell, part in b.groupby("cell"):
                same = [c for c in radius if (c < 0) == (cell < 0) and (c < 0 or len(unit[c]) == len(unit[cell]))]
                gap = np.zeros(len(same)) if cell < 0 else _distances(unit[cell][None], np.stack([unit[c] for c in same]))[0]
                gap[[c == cell for c in same]] = 0.0
                for block, far in zip(part["block"], part["far"]):
                    out += [(block, c, g) for c, g in zip(same, gap.tolist()) if g <= reach + SLACK + far + radius[c]]
            yield pd.DataFrame(out, columns=["block_a", "cell", "gap"]).astype({"cell": "int32", "gap": "float64"})

    asked = blocks.select("block", "cell", "far").mapInPandas(likely, "block_a string, cell int, gap double")
    a, b = (blocks.select(*[F.col(c).alias(c + x) for c in blocks.columns]) for x in ("_a", "_b"))
    close = asked.join(b, asked["cell"] == b["cell_b"]).where(F.col("block_a") < F.col("block_b")).join(a, "block_a")
    close = close.where((F.col("w_a") == F.col("w_b")) & (F.col("gap") <= F.lit(reach + SLACK) + F.col("far_a") + F.col("far_b")))
    inner_product = F.aggregate(F.zip_with("middle_a", "middle_b", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    close = close.where(F.sqrt(F.greatest(2 - 2 * inner_product, F.lit(0.0))) <= F.lit(reach + SLACK) + F.col("around_a") + F.col("around_b"))
    turned = F.col("bundle_a") > F.col("bundle_b")
    pairs = close.select(F.least("bundle_a", "bundle_b").alias("p"), F.greatest("bundle_a", "bundle_b").alias("q"), *[F.when(turned, F.col(x)).otherwise(F.col(y)).alias(n) for x, y, n in (("block_b", "block_a", "left"), ("block_a", "block_b", "right"))]).where("p < q")
    sides = [pairs.select(F.col(c).alias("block"), F.lit(n).alias("side"), F.col("p").alias("bundle_a"), F.col("q").alias("bundle_b")) for n, c in enumerate(("left", "right"))]
    met = sides[0].unionByName(sides[1]).distinct()
    within = blocks.select("block", F.lit(0).alias("side"), F.col("bundle").alias("bundle_a"), F.col("bundle").alias("bundle_b"))
    met = stage(met.unionByName(within))
    sent = dealt.select("block", "w", "k", "size", "node", "n", "v", "centre").join(met, "block")
    # Few meetings share a task, of which there would be no more than partitions.
    sent = sent.repartition(2 * bundles * (bundles + 1), "bundle_a", "bundle_b")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        b = pdf[pdf["side"] == 1]
        return link_blocks(pdf[pdf["side"] == 0], None if pdf["bundle_a"].iloc[0] == pdf["bundle_b"].iloc[0] else b, least)

    found = Staged(sent.groupBy("bundle_a", "bundle_b").applyInPandas(meet, "node long, other long, n long")).df
    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("_links"))
    joined = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.drop("v").join(counts, "node", "left").join(joined, "node", "left").withColumn("_class", F.coalesce("component", "node"))
    lowest = named.groupBy("_class").agg(F.min("id").alias("_component"))
    named = named.join(lowest, "_class").select("h", "g", (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_n"), "_component")
    linked = rows.select("id", "h", "g").join(named, ["h", "g"]).select("id", "_n", "_component")
    alone = vectors.where(~_usable(id_col, vector_col)).select(me.alias("id"), F.lit(0).alias("_n"), me.alias("_component"))
    out = linked.unionByName(alone)
    kind = vectors.schema[id_col].dataType
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("_n").cast("long").alias("n_links"), F.col("_component").alias("component_id"), F.coalesce(F.col("_component") == F.col("id"), F.lit(True)).alias("kept"))
