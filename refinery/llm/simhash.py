"""SimHash near-duplicates by the generalised pigeonhole principle.

Two fingerprints that differ in at most t bits differ, for any partition of the bits into m groups
and any thresholds with sum t - m + 1, in at most the threshold's bits in one group (-1: skip it).
Bits that go together are put in one group; each fingerprint gets its own thresholds by dynamic
programming over estimated candidate counts, probes the index of exact group values, and verifies.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import Staged, components, stage
from refinery.operators.partitioning import spread

BITS = 64
#: An index value with more fingerprints than this is searched block by block, without candidate rows.
HOT = 256
BLOCK = 4096
#: Keys under which the members of one class are joined.
SALTS = 16
#: Cost of making one probe, counted in candidates.
PROBE = 30.0
#: Bands of a set's least values, and values of a band; rows of a table that is broadcast.
BANDS, ROWS, MOST_BROUGHT = 24, 3, 500_000
#: Times that the sets of a band meet one of them, before those still apart meet each other.
STARS = 2
#: A band in which more sets than DENSE are still apart is searched by prefixes instead of pair by pair; cells whose counts tell common shingles.
DENSE, CELLS = 32, 1 << 18


def fingerprint(text: str | None, words: int = 4) -> int:
    """Bitwise majority over the XXH64 (seed 42) of the word shingles; no words: 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    n = max(len(parts) - words + 1, 1)
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, n, 1 << 16):
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(lo, min(lo + (1 << 16), n))]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Null text is empty."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return spread(docs.select("doc_id", "text")).select("doc_id", of("text").alias("fp"))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(values.astype("<i8")).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Over all fingerprints: their number, how often each two bits are both set (64 x 64), and how often each byte has each value (8 x 256)."""

    def count(batches):
        both, bytes_, n = np.zeros((BITS, BITS)), np.zeros((8, 256)), 0
        for b in batches:
            x = _bits(b["fp"].to_numpy(np.int64)).astype(np.float32)
            both += x.T @ x
            raw = np.ascontiguousarray(b["fp"].to_numpy("<i8")).view(np.uint8).reshape(-1, 8)
            for k in range(8):
                bytes_[k] += np.bincount(raw[:, k], minlength=256)
            n += len(b)
        flat = np.concatenate([[n], both.ravel(), bytes_.ravel()])
        at = np.flatnonzero(flat)
        yield pd.DataFrame({"at": at.astype(np.int32), "n": flat[at]})

    flat = np.zeros(1 + BITS * BITS + 8 * 256)
    for r in fps.select("fp").mapInPandas(count, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        flat[r["at"]] = r["n"]
    return int(flat[0]), flat[1 : 1 + BITS * BITS].reshape(BITS, BITS), flat[1 + BITS * BITS :].reshape(8, 256)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m groups whose sizes differ by at most one, each begun with the bit of most correlation left and filled with those that go with it."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        pool = sorted(left)
        group = [max(pool, key=lambda b: (corr[b, pool].sum(), -b))]
        while len(group) < size:
            rest = [b for b in pool if b not in group]
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        left -= set(group)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    x = sum(1 << b for b in bits)
    return x - (1 << 64) if x >> 63 else x


def _flips(bits: list[int], most: int) -> list[int]:
    return [_mask(list(c)) for k in range(most + 1) for c in itertools.combinations(bits, k)]


class Estimate:
    """Expected share of fingerprints within a distance of a value of a bit group, from how often each byte's bits of the group have each value, taking bytes as independent."""

    def __init__(self, n: int, bytes_: np.ndarray, groups: list[list[int]], most: int) -> None:
        self.n, self.most, self.tables = n, most, []
        values = np.arange(256)
        for bits in groups:
            per_byte = []
            for k in range(8):
                mask = sum(1 << (b - 8 * k) for b in bits if b // 8 == k)
                if mask:
                    apart = np.array([bin(v).count("1") for v in range(256)])[(values[:, None] ^ values[None, :]) & mask]
                    shares = bytes_[k] / max(n, 1)
                    per_byte.append((k, np.stack([(apart == d) @ shares for d in range(most + 1)], axis=1)))
            self.tables.append(per_byte)

    def __call__(self, fps: np.ndarray) -> np.ndarray:
        """[group, row, t]: candidates expected within t bits."""
        raw = np.ascontiguousarray(fps.astype("<i8")).view(np.uint8).reshape(-1, 8)
        out = []
        for per_byte in self.tables:
            at = np.zeros((len(fps), self.most + 1))
            at[:, 0] = 1.0
            for k, table in per_byte:
                t = table[raw[:, k]]
                new = np.zeros_like(at)
                for i in range(self.most + 1):
                    for j in range(self.most + 1 - i):
                        new[:, i + j] += at[:, i] * t[:, j]
                at = new
            out.append(self.n * np.cumsum(at, axis=1))
        return np.stack(out)


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds [row, group] of sum ``total`` and least cost; costs[group, row, t + 1], where t = -1 costs nothing.

    Dynamic programming over groups; the state is the sum so far, at least -1 for each group seen.
    """
    m, n, width = costs.shape
    top = width - 2
    low = -m
    best = np.full((n, total - low + m * 0 + top * m + 1), np.inf)
    best[:, -low] = 0.0
    choices = []
    for g in range(m):
        new, choice = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for t in range(-1, top + 1):
            moved = np.full_like(best, np.inf)
            if t < 0:
                moved[:, :-1] = best[:, 1:]
            elif t == 0:
                moved = best.copy()
            else:
                moved[:, t:] = best[:, :-t]
            moved = moved + costs[g, :, t + 1][:, None]
            better = moved < new
            new[better], choice[better] = moved[better], t
        best = new
        choices.append(choice)
    state, out = np.full(n, total - low), np.zeros((n, m), np.int8)
    rows = np.arange(n)
    for g in reversed(range(m)):
        out[:, g] = choices[g][rows, state]
        state = state - out[:, g]
    return out


def _plan(n: int, both: np.ndarray, bytes_: np.ndarray, most: int) -> list[list[int]]:
    """The bit groups of the number m that promises least work: probes and candidates for a fingerprint, thresholds spread evenly."""
    best = None
    for m in range(2, most + 2):
        groups = group_bits(n, both, m)
        extra = most - m + 1
        spread = [extra // m + (k < extra % m) for k in range(m)]
        probes = [len(_flips(g, t)) for g, t in zip(groups, spread)]
        cost = sum(p * (PROBE + n / 2.0 ** len(g)) for p, g in zip(probes, groups))
        if best is None or cost < best[0]:
            best = (cost, groups)
    return best[1]


def _forest(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    """Of one block of probes and one of indexed fingerprints: links that connect whatever is linked, one for each fingerprint reached."""
    side = pdf["side"].to_numpy()
    # Unsigned: the bits of a negative number are counted as they are.
    values = [np.unique(pdf["fp"].to_numpy(np.int64)[side == s]).view(np.uint64) for s in (0, 1)]
    left = [v.copy() for v in values]
    out_a, out_b = [], []
    while len(left[0]) and len(left[1]):
        todo = [(0, left[0][0])]
        left[0] = left[0][1:]
        while todo:
            s, x = todo.pop()
            other = left[1 - s]
            if not len(other):
                continue
            near = np.bitwise_count(other ^ x) <= most
            if near.any():
                found = other[near]
                left[1 - s] = other[~near]
                out_a.append(np.full(len(found), x))
                out_b.append(found)
                todo += [(1 - s, y) for y in found]
    if not out_a:
        return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
    return pd.DataFrame({"a": np.concatenate(out_a).astype(np.uint64).view(np.int64), "b": np.concatenate(out_b).astype(np.uint64).view(np.int64)})


def links(fps: DataFrame, most: int = 4) -> DataFrame:
    """(a, b): enough links between distinct fingerprints at ``most`` or fewer bits that components are those of all such links.

    Values of the index with up to HOT fingerprints are joined, verified in the join condition; the
    others are cut into blocks, and each two blocks give a spanning forest of their links. So no
    group of near copies makes all of its pairs, and no bucket is capped.
    """
    n, both, bytes_ = bit_statistics(fps)
    groups = _plan(n, both, bytes_, most)
    m, total = len(groups), most - len(groups) + 1
    estimate = Estimate(n, bytes_, groups, total)
    probes = np.array([[0.0] + [float(len(_flips(g, t))) for t in range(total + 1)] for g in groups])

    @F.pandas_udf("array<int>")
    def thresholds(fp: pd.Series) -> pd.Series:
        if not len(fp):
            return pd.Series([], dtype=object)
        cost = np.concatenate([np.zeros((m, len(fp), 1)), estimate(fp.to_numpy(np.int64))], axis=2)
        return pd.Series(list(allocate(cost + PROBE * probes[:, None, :], total).astype(np.int32)))

    def value(c: Column, g: int) -> Column:
        return c.bitwiseAND(F.lit(_mask(groups[g])))

    fp = F.col("fp")
    index = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(g).alias("part"), value(fp, g).alias("value")) for g in range(m)])).alias("x")).select("fp", "x.*")
    counts = index.groupBy("part", "value").agg(F.count("*").alias("n"))
    tried = fps.select("fp", thresholds("fp").alias("t"))
    per_part = []
    for g in range(m):
        by_t = [F.array(*[F.lit(x) for x in _flips(groups[g], t)]) for t in range(total + 1)]
        masks = F.lit(None)
        for t in range(total + 1):
            masks = F.when(F.element_at("t", g + 1) == t, by_t[t]).otherwise(masks)
        part = tried.select("fp", F.explode(masks).alias("mask"))
        per_part.append(part.select("fp", F.lit(g).alias("part"), value(fp.bitwiseXOR(F.col("mask")), g).alias("value")))
    probing = per_part[0]
    for p in per_part[1:]:
        probing = probing.unionByName(p)
    cold = counts.where(F.col("n") <= HOT).select("part", "value")
    hot = counts.where(F.col("n") > HOT)
    i = index.join(cold, ["part", "value"]).select("part", "value", F.col("fp").alias("other"))
    found = probing.join(i, ["part", "value"]).where((F.col("other") > fp) & (F.bit_count(fp.bitwiseXOR(F.col("other"))) <= most))
    found = found.select(fp.alias("a"), F.col("other").alias("b"))

    sized = hot.select("part", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    ask = probing.join(sized, ["part", "value"]).select("part", "value", "fp", own.alias("p"), F.explode(every).alias("i"), F.lit(0).alias("side"))
    have = index.join(sized, ["part", "value"]).select("part", "value", "fp", F.explode(every).alias("p"), own.alias("i"), F.lit(1).alias("side"))
    dense = ask.unionByName(have).groupBy("part", "value", "p", "i").applyInPandas(lambda pdf: _forest(pdf, most), "a long, b long")
    return found.unionByName(dense.where("a <> b"))


def near_duplicates(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs (doc_id, text).

    Fingerprints link at ``most`` or fewer differing bits; component_id is the smallest doc_id
    reachable by links. Rows of one fingerprint are one node, so copies cost a count, not pairs.
    Null and empty texts have fingerprint zero and link like others. A null doc_id gets a result but
    never names a component, unless its component has no other id. Repeated rows repeat.
    """
    of = stage(fingerprints(docs, words))
    nodes = Staged(of.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    joined = components(links(nodes.df.select("fp"), most))
    classed = nodes.df.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.col("component").alias("class"), F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int").alias("_salt"))
    # Only linked fingerprints need their class's least doc_id; the members of a large class are joined under several keys.
    lowest = classed.where("class is not null").groupBy("class").agg(F.min("rep").alias("component_id")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = classed.where("class is not null").join(lowest, ["class", "_salt"]).select("fp", "component_id")
    named = named.unionByName(classed.where("class is null").select("fp", F.col("rep").alias("component_id")))
    return of.join(named, "fp").select("doc_id", "fp", "component_id")


def _key() -> Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def _brought(small: DataFrame) -> DataFrame:
    """A staged table of narrow rows, to be broadcast where it has at most MOST_BROUGHT of them; beyond that joins shuffle."""
    return F.broadcast(small) if small.count() <= MOST_BROUGHT else small


def _survivors(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One row of docs for each class of classes (key, class): the least by doc_id, nulls last, then text, then the other columns. Columns of docs are kept.

    Who goes is settled on keys and ids alone; whole rows are only moved where several of one id and class are left.
    """
    of = classes.withColumnRenamed("key", "_key")
    # The caller's row is one column, so that no name of its clashes.
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), "doc_id", _key().alias("_key"))
    slim = stage(rows.select("doc_id", "_key").groupBy("doc_id", "_key").agg(F.count("*").alias("n")).join(of, "_key"))
    tally = slim.groupBy("class", "doc_id").agg(F.sum("n").alias("n"))
    best = tally.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("best"), F.sum("n").alias("rows"))
    best = best.where("rows > 1").select("class", F.col("best.doc_id").alias("_id"), F.col("best.n").alias("_n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64("_key", "doc_id"), F.lit(SALTS)).cast("int")
    named = slim.withColumn("_salt", salt).join(best, ["class", "_salt"]).withColumn("_first", F.col("doc_id").eqNullSafe(F.col("_id")))
    moved = stage(named.where("not _first or _n > 1").select(F.col("_key").alias("_k"), F.col("doc_id").alias("_d"), F.when(F.col("_first"), F.col("class")).alias("_class")))
    same = (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d"))
    moved = _brought(moved)
    tied = rows.join(moved.where("_class is not null"), same).groupBy("_class").agg(F.min_by("_row", F.struct("_row.text", F.to_json("_row"))).alias("_row"))
    return rows.join(moved, same, "left_anti").select("_row").unionByName(tied.select("_row")).select("_row.*")


def keep_one(docs: DataFrame, words: int = 4, most: int = 4) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest doc_id (null only where no other is), and of its rows the first by text. Columns of docs are kept."""
    of = stage(fingerprints(docs.select(_key().alias("doc_id"), "text"), words).distinct())
    joined = components(links(of.select("fp").distinct(), most)).withColumnRenamed("node", "fp")
    return _survivors(docs, of.join(joined, "fp", "left").select(F.col("doc_id").alias("key"), F.coalesce("component", "fp").alias("class")))


def _hashes(text: str | None, words: int) -> np.ndarray:
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(len(parts) - words + 1, 1) if parts else 0
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(n)), np.uint64, n)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[lo : lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(key, node, fp, n, parity, bands) of each text: node names its set of shingles, n is the set's size, parity that of the number of shingles in each of 512 cells, bands hash ROWS least values each of the set under seeded orders."""
    odd = np.random.default_rng(5).integers(1, 1 << 63, (BANDS * ROWS, 2), dtype=np.uint64) | np.uint64(1)

    def bands(s: np.ndarray) -> np.ndarray:
        least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
        for lo in range(0, len(s), 1 << 12):
            mixed = s[None, lo : lo + (1 << 12)] * odd[:, :1]
            mixed = (mixed ^ mixed >> np.uint64(32)) * odd[:, 1:]
            least = np.minimum(least, mixed.min(1))
        rows = np.ascontiguousarray(least).reshape(BANDS, ROWS)
        return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], np.uint64).view(np.int64)

    def of(batches):
        for b in batches:
            rows = []
            for key, text in zip(b["key"].tolist(), b["text"].tolist()):
                every = _hashes(text, words)
                s = np.unique(every)
                cells = np.bincount((s >> np.uint64(20) & np.uint64(511)).astype(np.int64), minlength=512) & 1
                parity = np.packbits(cells.astype(np.uint8)).view("<i8")
                rows.append((key, xxhash.xxh3_128_digest(s.tobytes()), _majority(every) if len(s) else 0, len(s), parity, bands(s)))
            yield pd.DataFrame(rows, columns=["key", "node", "fp", "n", "parity", "bands"])

    return spread(docs.select(_key().alias("key"), "text")).mapInPandas(of, "key binary, node binary, fp long, n int, parity array<long>, bands array<long>")


def _similar(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Those of pairs (a, b) whose sets of shingles have Jaccard similarity 0.8 or more; texts (node, text) has at least their nodes."""

    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        known: dict[str, np.ndarray] = {}
        out = []
        for x, y in zip(left, right):
            if x not in known:
                known = {x: np.unique(_hashes(x, words))}
            p, q = known[x], np.unique(_hashes(y, words))
            out.append(9 * len(np.intersect1d(p, q, assume_unique=True)) >= 4 * (len(p) + len(q)))
        return pd.Series(out, dtype=bool)

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_left")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("_right")), "b")
    return both.where(alike("_left", "_right")).select("a", "b")


def _parted(filed: DataFrame) -> DataFrame:
    """Those rows of filed (band, component, ...) whose band has several components; the others have nothing to add."""
    parted = filed.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high").select("band")
    return filed.join(parted, "band")


def _may(pairs: DataFrame) -> DataFrame:
    """(a, b) of the pairs (x, y) of different components whose sizes and parities allow similarity 0.8."""
    x, y = F.col("x"), F.col("y")
    apart = sum((F.bit_count(x["parity"][k].bitwiseXOR(y["parity"][k])) for k in range(8)), F.lit(0))
    may = (x["component"] != y["component"]) & (5 * F.least(x["n"], y["n"]) >= 4 * F.greatest(x["n"], y["n"])) & (9 * apart <= x["n"] + y["n"])
    return pairs.where(may).select(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b"))


def _may_of(pairs: DataFrame, apart: DataFrame) -> DataFrame:
    """``_may`` of pairs (node_x, node_y) of sets in apart (node, component, n, parity)."""
    a, b = (apart.select(F.col("node").alias(f"node_{side}"), F.struct("node", "component", "n", "parity").alias(side)) for side in "xy")
    return _may(stage(pairs).join(a, "node_x").join(b, "node_y"))


def _prefixes(texts: DataFrame, apart: DataFrame, words: int) -> DataFrame:
    """(band, node, component, n, place): each set's rarest shingles, as far as a similar set may share one first; texts (node, text) and apart (node, component, n, parity) have a row for each set.

    With its shingles in one order, rarest first, a set of n has one in common with any similar set
    that is no smaller among its first n / 9, and with any that is no larger among its first n / 5; at
    the first they share, what follows in either must still suffice. Rarity is told by counts of CELLS
    cells, which is only a matter of speed: any order finds the same pairs. Shingles of a template
    come last, so texts that share it alone do not meet.
    """
    cell = lambda s: (s >> np.uint64(40) & np.uint64(CELLS - 1)).astype(np.int64)

    def tally(batches):
        counts = np.zeros(CELLS, np.int64)
        for b in batches:
            for text in b["text"]:
                np.add.at(counts, cell(np.unique(_hashes(text, words))), 1)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": used.astype(np.int32), "sets": counts[used]})

    found = texts.select("text").mapInPandas(tally, "cell int, sets long").groupBy("cell").agg(F.sum("sets").alias("sets")).toArrow()
    common = np.zeros(CELLS, np.int64)
    common[found["cell"].to_numpy()] = found["sets"].to_numpy()

    def first(batches):
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.iloc[lo : lo + 256]
                sets = [np.unique(_hashes(t, words)) for t in part["text"]]
                sizes = np.array([len(s) for s in sets], np.int32)
                lead = [s[np.lexsort((s, common[cell(s)]))][: len(s) // 5 + 1] for s in sets]
                of = [len(s) for s in lead]
                places = np.concatenate([np.arange(k, dtype=np.int32) for k in of])
                yield pd.DataFrame({"node": np.repeat(part["node"].to_numpy(), of), "n": np.repeat(sizes, of), "place": places, "band": np.concatenate(lead).view(np.int64)})

    filed = stage(texts.select("node", "text").mapInPandas(first, "node binary, n int, place int, band long").join(apart.select("node", "component"), "node"))
    return stage(_parted(filed).select("band", "node", "component", "n", "place"))


def _to_plainest(filed: DataFrame, apart: DataFrame) -> DataFrame:
    """(a, b): each set with that set of its band in filed (see ``_prefixes``) in which the band's shingle comes first, where they are in different components and may be similar.

    A shingle comes early where few rarer ones stand before it, so of a template's near copies this is the
    one with the least of its own, which is similar to more of them than any other: rows, not pairs.
    """
    plain = filed.groupBy("band").agg(F.min(F.struct("place", F.xxhash64("node"), "node")).alias("_least")).select("band", F.col("_least.node").alias("node_y"))
    pairs = filed.select("band", F.col("node").alias("node_x")).join(plain, "band").where("node_x <> node_y").select("node_x", "node_y").distinct()
    return _may_of(pairs, apart)


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(component, _now), to be broadcast where it is small: what labels (node, component, ...), a row for each node, become by links (a, b) of nodes.

    Only components that a link joins are in it, so a round over them is small however large they are.
    """
    of = [labels.select(F.col("node").alias(side), F.col("component").alias(f"_{side}")) for side in "ab"]
    brought = F.broadcast if links.count() <= MOST_BROUGHT else lambda t: t
    left = brought(links).join(of[0], "a").select("b", "_a")
    joined = components(brought(left).join(of[1], "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return _brought(joined.select(F.col("node").alias("component"), F.col("component").alias("_now")))


def _renamed(rows: DataFrame, now: DataFrame) -> DataFrame:
    """rows (component, ...) by the components of ``_merged``."""
    return rows.join(now, "component", "left").withColumn("component", F.coalesce("_now", "component")).drop("_now")


def _by_prefix(texts: DataFrame, apart: DataFrame, words: int, confirmed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b): pairs of different components, among them all at similarity 0.8 or more; texts (node, text) and apart (node, component, n, parity) have a row for each set.

    ``confirmed`` gives those of some pairs that are similar. With it, each set meets the plainest one of
    its bands first, and pairs of components that these links join are not looked at: the links stand for them.
    """
    filed, drawn = _prefixes(texts, apart, words), None
    if confirmed is not None:
        drawn = confirmed(_to_plainest(filed, apart))
        now = _merged(apart, drawn)
        apart, filed = stage(_renamed(apart, now)), stage(_parted(_renamed(filed, now)))
    x, y = (filed.select("band", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "place")]) for side in "xy")
    no_larger = "9 * place_x <= n_x and (n_x < n_y or n_x = n_y and node_x < node_y) and 5 * n_x >= 4 * n_y"
    enough = "9 * least(n_x - place_x, n_y - place_y) >= 4 * (n_x + n_y)"
    pairs = x.join(y, (x["band"] == y["band"]) & F.expr(f"component_x <> component_y and {no_larger} and {enough}")).select("node_x", "node_y").distinct()
    found = _may_of(pairs, apart)
    return found if drawn is None else found.unionByName(drawn)


def similar_classes(docs: DataFrame, words: int = 5, most: int = 8) -> DataFrame:
    """(key, class) of each different text: classes are the components of the graph of the pairs at Jaccard similarity 0.8 or more of their word shingles.

    Fingerprints within ``most`` bits (generalised pigeonhole) are candidates first; what exact
    similarity confirms is joined. At 0.8 fingerprints may differ in far more bits than any probe can
    afford, so pairs left in different components are searched by BANDS bands of ROWS least values: a
    pair at 0.8 shares none with probability (1 - 0.8 ** 3) ** 24, 3 in 10 ** 8, one of more similarity
    with less. Of these, pairs whose sizes or parities forbid 0.8 are left out, the others confirmed.
    Where a band holds more than DENSE sets that are still apart (texts of one template, say), its sets
    are searched by prefixes, which miss none. There, too, each first meets one, that with the least of
    its own, and only those still apart meet pair by pair.
    """
    of = stage(_sets(docs, words).dropDuplicates(["key"]))
    nodes = stage(of.groupBy("node").agg(F.min("key").alias("key"), F.any_value(F.struct("fp", "n", "parity", "bands")).alias("x")).select("node", "key", "x.*"))
    text_of = docs.select(_key().alias("key"), "text")

    def texts(named: DataFrame) -> Staged:
        wanted = Staged(nodes.select("node", "key").join(named, "node"))
        found = Staged(text_of.join(_brought(wanted.df), "key").dropDuplicates(["node"]).select("node", F.coalesce("text", F.lit("")).alias("text")))
        wanted.drop()
        return found

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = Staged(pairs.distinct())
        named = texts(pairs.df.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        similar = stage(_similar(pairs.df, named.df, words))
        pairs.drop()
        named.drop()
        return similar

    # Sets of one fingerprint are candidates with the least of them.
    rep = nodes.groupBy("fp").agg(F.min("node").alias("rep"), F.count("*").alias("copies"))
    near = links(rep.select("fp"), most)
    a, b = rep.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), rep.select(F.col("fp").alias("b"), F.col("rep").alias("rb"))
    # One candidate a fingerprint, its least: all pairs of a large group need not be confirmed, and what they would join is found below.
    near = near.groupBy(F.greatest("a", "b").alias("b")).agg(F.min(F.least("a", "b")).alias("a"))
    near = near.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    same = nodes.select("fp", "node").join(rep.where("copies > 1"), "fp").where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    first = confirmed(near.unionByName(same))

    labels = stage(nodes.select("node").join(components(first), "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    filed = nodes.join(labels, "node").select("node", "component", F.explode("bands").alias("band"))
    few = Staged(_parted(filed).join(nodes.select("node", "n", "parity"), "node"))
    # A large group of near copies is drawn together by stars: each set meets one of its band, another one each time.
    for turn in range(STARS):
        center = few.df.groupBy("band").agg(F.min_by(F.struct("node", "component", "n", "parity"), F.xxhash64("node", F.lit(turn))).alias("y"))
        star = few.df.join(center, "band").select(F.struct("node", "component", "n", "parity").alias("x"), "y")
        now = _merged(labels, confirmed(_may(star)))
        labels, before = stage(_renamed(labels, now)), few
        few = Staged(_parted(_renamed(few.df, now)))
        before.drop()
    # What is still apart: pair by pair where a band has few sets, by prefixes where it has many.
    few = stage(few.df.join(few.df.groupBy("band").agg(F.count("*").alias("sets")), "band"))
    x, y = (few.where(F.col("sets") <= DENSE).select("band", F.struct("node", "component", "n", "parity").alias(c)) for c in "xy")
    dense = stage(few.where(F.col("sets") > DENSE).select("node", "component", "n", "parity").dropDuplicates(["node"]))
    rest = _may(x.join(y, "band").where("x.node < y.node"))
    if not dense.isEmpty():
        rest = rest.unionByName(_by_prefix(texts(dense.select("node")).df, dense, words, confirmed))
    final = _renamed(labels, _merged(labels, confirmed(rest)))
    return of.select("key", "node").join(final, "node").select("key", F.col("component").alias("class"))


def keep_one_similar(docs: DataFrame, words: int = 5) -> DataFrame:
    """As keep_one, but groups are those of exact shingle similarity 0.8 or more (see ``similar_classes``)."""
    return _survivors(docs, similar_classes(docs.select("text"), words))
