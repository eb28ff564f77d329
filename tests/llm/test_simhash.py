import random

import numpy as np
import pandas as pd
import pytest
from helpers import TEXTS, documents, groups

import corpus_pipeline
from refinery.llm import common, simhash


def xxh64(data, seed=42):
    """The published algorithm, step by step."""
    m, p = (1 << 64) - 1, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & m
    step = lambda acc, lane: rot((acc + lane * p[1]) & m, 31) * p[0] & m
    at, n = 0, len(data)
    word = lambda i, k: int.from_bytes(data[i : i + k], "little")
    if n >= 32:
        v = [(seed + p[0] + p[1]) & m, (seed + p[1]) & m, seed, (seed - p[0]) & m]
        while at + 32 <= n:
            v = [step(a, word(at + 8 * k, 8)) for k, a in enumerate(v)]
            at += 32
        h = sum(rot(a, r) for a, r in zip(v, (1, 7, 12, 18))) & m
        for a in v:
            h = ((h ^ step(0, a)) * p[0] + p[3]) & m
    else:
        h = (seed + p[4]) & m
    h = (h + n) & m
    while at + 8 <= n:
        h = (rot(h ^ step(0, word(at, 8)), 27) * p[0] + p[3]) & m
        at += 8
    if at + 4 <= n:
        h = (rot(h ^ (word(at, 4) * p[0] & m), 23) * p[1] + p[2]) & m
        at += 4
    while at < n:
        h = rot(h ^ (data[at] * p[4] & m), 11) * p[0] & m
        at += 1
    h = (h ^ (h >> 33)) * p[1] & m
    h = (h ^ (h >> 29)) * p[2] & m
    return h ^ (h >> 32)


@pytest.mark.parametrize("text", [t for t in TEXTS if t is None or len(t) < 1000] + ["İÇ ABC\x0bdef\x1cghi jkl mno"])
def test_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [now] if now else []
            now = ""
        else:
            now += c
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxh64(s.encode()) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) & ((1 << 64) - 1) == want


@pytest.mark.parametrize("hot", [256, 3])
def test_links(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(150)]
    centre = rng.getrandbits(64)
    values += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))) for _ in range(120)]
    x = values[0]
    for _ in range(12):
        x ^= sum(1 << b for b in rng.sample(range(64), 4))
        values.append(x)
    values = sorted(set(values + [0, (1 << 64) - 1]))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    at = {v: i for i, v in enumerate(signed)}
    assert all(bin((r["a"] ^ r["b"]) & ((1 << 64) - 1)).count("1") <= 4 for r in found)
    want = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= 4]
    assert groups(len(values), [(at[r["a"]], at[r["b"]]) for r in found]) == groups(len(values), want)


def test_allocation_is_least():
    rng = np.random.default_rng(0)
    for m, total in ((2, 3), (3, 2), (4, 1), (5, 0)):
        costs = np.concatenate([np.zeros((m, 20, 1)), np.cumsum(rng.random((m, 20, total + 1)), axis=2)], axis=2)
        got = simhash.allocate(costs, total)
        assert (got.sum(1) == total).all() and got.min() >= -1
        import itertools

        for row in range(20):
            best = min(sum(costs[g, row, t + 1] for g, t in enumerate(ts)) for ts in itertools.product(range(-1, total + 1), repeat=m) if sum(ts) == total)
            assert sum(costs[g, row, t + 1] for g, t in enumerate(got[row])) == pytest.approx(best)


def test_groups_cover_all_bits():
    both = np.random.default_rng(0).random((64, 64)) * 10
    for m in range(2, 6):
        parts = simhash.group_bits(100, both + both.T, m)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert max(map(len, parts)) - min(map(len, parts)) <= 1


def test_near_duplicates(spark):
    base = [" ".join(f"t{(i * 7 + k) % 5000}" for k in range(400)) for i in range(0, 300, 30)]
    texts = base + [b.replace("t50", "changed", 1) for b in base] + base[:2] + [None, "", "one", "a b"]
    df = documents(spark, texts)
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == df.count()
    ids = [(r["doc_id"], r["fp"]) for r in df.join(simhash.fingerprints(df), "doc_id").select("doc_id", "fp").distinct().collect() if r["doc_id"] is not None]
    ids.sort()
    links = [(i, j) for i in range(len(ids)) for j in range(i) if bin((ids[i][1] ^ ids[j][1]) & ((1 << 64) - 1)).count("1") <= 4]
    root = groups(len(ids), links)
    want = {d: ids[root[k]][0] for k, (d, _) in enumerate(ids)}
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))


def test_empty(spark):
    df = documents(spark).limit(0)
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_one(df).count() == 0


def test_forest_connects():
    rng = random.Random(0)
    values = [rng.getrandbits(12) for _ in range(60)]
    df = pd.DataFrame({"fp": values * 2, "side": [0] * 60 + [1] * 60})
    out = simhash._forest(df, 2)
    u = sorted(set(values))
    at = {v: i for i, v in enumerate(u)}
    want = [(i, j) for i in range(len(u)) for j in range(i) if bin(u[i] ^ u[j]).count("1") <= 2]
    assert groups(len(u), [(at[a], at[b]) for a, b in zip(out["a"], out["b"])]) == groups(len(u), want)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2300)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = groups(3000, links)
    assert got == {x: root[x] for a, b in links if a != b for x in (a, b)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [common.MOST_LEAST, 0])
def test_components_joined_both_ways(spark, monkeypatch, most):
    """With least neighbours broadcast and shuffled; nodes are bytes, as in near-dedup."""
    monkeypatch.setattr(common, "MOST_LEAST", most)
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1400)]
    of = spark.createDataFrame([(bytes([a >> 8, a & 255]), bytes([b >> 8, b & 255])) for a, b in links], "a binary, b binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["component"], "big") for r in common.components(of).collect()}
    root = groups(1400, links)
    assert got == {x: root[x] for a, b in links if a != b for x in (a, b)}


def test_stars_need_no_round(spark, monkeypatch):
    """Links that are stars around their least nodes are told as such; a round more would write them again to see that nothing changes."""
    written, real = [], common.Staged
    monkeypatch.setattr(common, "Staged", lambda df: written.append(df) or real(df))
    links = [(1, i) for i in range(2, 50)] + [(i, 100) for i in range(101, 103)] + [(103, 100)]
    assert common.components(spark.createDataFrame(links, "a long, b long")).count() == 49 + 4
    assert len(written) == 2


def test_staged_leaves_no_shuffle_files(spark):
    """Deleted when the table is written, not when the driver collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {x.split("/")[-1] for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    before = shuffles()
    common.Staged(spark.range(1000).groupBy("id").count())
    assert not shuffles() - before
    assert spark.conf.get(common.CLEANUP) == "false"


def similar_groups(texts):
    """Component (smallest index) of each text by exact Jaccard similarity of five-word shingles, and the pairs below 1."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    by = {}
    for i, s in enumerate(sets):
        for x in s or {None}:
            by.setdefault(x, []).append(i)
    pairs = {(i, j) for ids in by.values() for i in ids for j in ids if i < j}
    links = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return groups(len(texts), links), [(i, j) for i, j in links if sets[i] != sets[j]]


@pytest.mark.parametrize("dense", [simhash.DENSE, 0])
def test_similar_documents_are_one(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(3)
    for t in rng.sample([t for t in texts if len(t.split()) > 100], 40):
        w = t.split()
        for at in rng.sample(range(len(w)), max(len(w) // 60, 1)):
            w[at] = "changed"
        texts.append(" ".join(w))
    texts += [None, "", "one two", "one two", "One two three four five six"]
    root, links = similar_groups(texts)
    assert len(links) > 30
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, class string")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


@pytest.mark.parametrize("keep", [simhash.keep_one, simhash.keep_one_similar])
def test_each_group_keeps_one_row_whatever_the_ids(spark, keep):
    text = lambda k: " ".join(f"t{k}x{i}" for i in range(60))
    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (4, text(2)), (None, text(2)), (5, text(3)), (5, text(4)), (3, text(4)), (6, text(5)), (6, text(5))]
    got = keep(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(0, text(0)), (0, text(1)), (4, text(2)), (5, text(3)), (3, text(4)), (6, text(5))])


def test_prefixes_find_all_similar_sets_and_no_pairs_of_a_template(spark):
    rng = random.Random(8)
    template = [f"t{i}" for i in range(84)]
    texts = [" ".join(template + [f"own{k}x{i}" for i in range(20)]) for k in range(600)]
    # Changes at one place and at the ends: on both sides of 0.8, of different sizes.
    for k in range(0, 200):
        w = texts[k].split()
        at = rng.randrange(len(w) - 12)
        w[at : at + rng.randrange(1, 12)] = [f"new{k}x{i}" for i in range(rng.randrange(0, 12))]
        texts.append(" ".join(w))
    texts += ["", "a b", "a b c d e f"]
    root, links = similar_groups(texts)
    rows = []
    for i, t in enumerate(texts):
        s = np.unique(simhash._hashes(t, 5))
        cells = np.bincount((s >> np.uint64(20) & np.uint64(511)).astype(int), minlength=512) & 1
        node = i.to_bytes(16, "big")
        rows.append((node, t, node, len(s), np.packbits(cells.astype(np.uint8)).view("<i8").tolist()))
    df = spark.createDataFrame(rows, "node binary, text string, component binary, n int, parity array<long>")
    found = simhash._by_prefix(df.select("node", "text"), df.drop("text"), 5).collect()
    pairs = {(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for r in found}
    assert 100 < len(links) < 400 and set(links) <= pairs
    assert len(pairs) < 3 * len(links)
    kept = simhash.keep_one_similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_prefixes_of_no_sets(spark):
    none = spark.createDataFrame([], "node binary, text string, component binary, n int, parity array<long>")
    assert simhash._by_prefix(none.select("node", "text"), none.drop("text"), 5).count() == 0


def test_near_copies_of_a_template_meet_its_plainest_first(spark, tmp_path):
    # Each has one to five changed words of 150: some are similar to the one without a change, few to each other.
    rng = random.Random(4)
    template = [f"t{i}" for i in range(150)]
    texts = [" ".join(template)]
    for k in range(400):
        w = list(template)
        for j, at in enumerate(rng.sample(range(5, 145), 1 + k % 5)):
            w[at] = f"own{k}x{j}"
        texts.append(" ".join(w))
    root, links = similar_groups(texts)
    rows = []
    for i, t in enumerate(texts):
        s = np.unique(simhash._hashes(t, 5))
        cells = np.bincount((s >> np.uint64(20) & np.uint64(511)).astype(int), minlength=512) & 1
        node = i.to_bytes(16, "big")
        rows.append((node, t, node, len(s), np.packbits(cells.astype(np.uint8)).view("<i8").tolist()))
    df = spark.createDataFrame(rows, "node binary, text string, component binary, n int, parity array<long>")
    df.write.parquet(f"{tmp_path}/sets")
    df = spark.read.parquet(f"{tmp_path}/sets")
    texts_of, apart = df.select("node", "text"), df.drop("text")
    similar = lambda pairs: simhash.stage(simhash._similar(simhash.stage(pairs.distinct()), texts_of, 5))
    every = simhash._by_prefix(texts_of, apart, 5).count()
    looked_at = simhash._by_prefix(texts_of, apart, 5, similar)
    found = [(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for r in similar(looked_at).collect()]
    assert groups(len(texts), found) == root and len(set(root)) > 80
    assert every > 10 * len(texts) and looked_at.count() < 2 * len(texts)
