"""Phrase collocations against a plain version."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, documents

from refinery.llm import phrases, queries


def plain(rows, least, longest=4, top=2000, percent=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out, longer = {}, Counter()
    for (lang, v), b in often.items():
        for part in {v[i : i + k] for k in range(2, len(v)) for i in range(len(v) - k + 1)}:
            longer[lang, part] = max(longer[lang, part], b)
    for (lang, w), a in often.items():
        if longer.get((lang, w), 0) * 100 >= percent * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


SHORTER = " ".join(LONG.split()[:3000])
TEXTS = ["The cat sat. the cat\tsat, on THE mat", "the  cat sat on\nthe mat\x0bthe cat", "a a a a a a a", "É é É é, é é É", "x.y!z?x;y:z", None, "", " \t\n", "one", SHORTER, "no " * 5000 + "end", "a" * 1_500_000 + " b"]


def rows_of(spark):
    df = documents(spark, TEXTS * 3)
    more = [(100 + k, t, lang, None, None, "kept", 0.5, 7) for k, (t, lang) in enumerate([("the cat sat", None), ("the cat sat on", "und"), ("the cat", "fr"), ("le chat. le chat", "fr"), (None, None)] * 5)]
    return df.unionByName(spark.createDataFrame(more, df.schema))


@pytest.mark.parametrize("least, longest, top, percent", [(2, 4, 2000, 80), (3, 4, 5, 80), (6, 3, 3, 50), (2, 6, 2000, 100)])
def test_equals_plain(spark, monkeypatch, least, longest, top, percent):
    # Many shards, and texts that are split in pieces.
    monkeypatch.setattr(phrases, "SHARD_BYTES", 300)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50_000)
    df = rows_of(spark)
    got = phrases.collocations(df, least, longest, top, percent)
    want = plain([(r["lang"], r["text"]) for r in df.collect()], least, longest, top, percent)
    assert sorted(map(tuple, got.collect())) == want and want


def test_chunks_keep_words_and_pieces():
    data = b"ab cd\nef  gh\n\nij " * 50 + b"k" * 400 + b" l"
    before = phrases.CHUNK_BYTES
    for size in (1, 2, 7, 64):
        try:
            phrases.CHUNK_BYTES = size
            parts = list(phrases.chunks(data))
        finally:
            phrases.CHUNK_BYTES = before
        assert b"".join(parts) == data
        tokens = [w for p in parts for w in p.replace(b"\n", b" \n ").split(b" ") if w]
        assert tokens == [w for w in data.replace(b"\n", b" \n ").split(b" ") if w]


@pytest.mark.parametrize("places", [1 << 20, 700, 50])
def test_levels_by_brute_force(monkeypatch, places):
    monkeypatch.setattr(phrases, "PLACES", places)
    rng = np.random.default_rng(5)
    seq = rng.integers(0, 6, 4000).astype(np.int32)
    usable = np.array([False, False, True, True, True, True])
    found = {}
    for size, at, n in phrases.levels(seq, 6, usable, 4, lambda size, at, n: n >= 20):
        found |= {tuple(seq[a : a + size].tolist()): int(c) for a, c in zip(at, n)}
    want = Counter(tuple(seq[i : i + k].tolist()) for k in (2, 3, 4) for i in range(len(seq) - k + 1))
    assert found == {p: c for p, c in want.items() if c >= 20 and min(p) > 1} and len(found) > 20


def test_shards_mine_completely(spark, monkeypatch):
    """What one shard lacks is made up for by its gap: a phrase spread evenly is a candidate, whatever the number of shards."""
    rows = [(k, "even spread here. " + f"rare{k} word") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'en' as lang", "text")
    for size in (10, 100, 10_000):
        monkeypatch.setattr(phrases, "SHARD_BYTES", size)
        got = phrases.collocations(df, 40).collect()
        assert [(r["phrase"], r["a"], r["n"]) for r in got] == [("even spread here", 40, 200)]


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**15
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1)], "lang string, phrase string, f long")
    found = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, size int, a long")
    assert [tuple(r) for r in phrases.scored(found, words).collect()] == [("en", "a b", 2, big - 1, big, big + 1, 2_000_000 * (big - 1) // (2 * big + 1))]


def test_no_rows(spark):
    assert phrases.collocations(rows_of(spark).limit(0)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string"), 1).count() == 0


def test_query_equals_plain(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain(rows, 30)
    assert sorted(map(tuple, queries.op13_collocations(spark, sf).collect())) == want and len(want) > 10


def test_a_shard_reports_a_row_for_each_range_and_no_count_is_lost(spark):
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    batches, bound = [], {}
    # Two languages; the second is in one of three shards only.
    for tongue, gap, of in ((5, 1, pool[:300]), (5, 2, pool[:300]), (7, 0, pool[300:]), (5, 0, pool[:300])):
        h = rng.choice(of, 150, replace=False)
        n = rng.integers(gap + 1, 12, 150)
        found = list(phrases._reports(tongue, h, n, gap, 4))
        assert sum(b.num_rows for b in found) <= 5
        batches += found
        for x, k in zip(h.view(np.int64).tolist(), n.tolist()):
            bound[tongue, x] = bound.get((tongue, x), 0) + k - gap
    batches += phrases._reports(9, np.array([], np.uint64), np.array([], np.int64), 29, 4)
    mined = spark.createDataFrame(pa.Table.from_batches(batches))
    got = sorted(r["hash"] for r in phrases._likely(mined, 12).collect())
    assert 20 < len(got) < 400 and got == sorted(h for (tongue, h), b in bound.items() if b + {5: 3, 7: 0}[tongue] >= 12)
