import hashlib
import random

import numpy as np
import pytest

from refinery.llm import queries, substrings, suffix


def brute(rows, length=50):
    first = {}
    for doc, text in rows:
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < doc:
                gone[p : p + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.setdefault((doc, len(b)), (sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def _hashes(found):
    return {int(w): int(h) for _, at, n, h in zip(*found) for w in range(at, at + n)}


def texts():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(n)) for n in (9, 12, 30, 200)]
    rows = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randrange(1, 25))) for _ in range(rng.randrange(0, 6))]
        rows.append(" ".join(parts))
    rows += ["q" + "=" * 400 + "z", "=" * 300 + "r", "ab=" * 200, "zab=" + "ab=" * 150 + "=ab", passages[2][:20] * 40, "!" + passages[2][:20] * 30 + "?", "k" + passages[3][:37] * 20, passages[3][:37] * 25]
    rows += [None, "", "x" * 49, "x" * 50, "x" * 120, "x" * 120, rows[3], rows[3] + "!", "ab" * 5000, "y" + "ab" * 5000, "日本語" * 30, "日本語" * 31]
    return rows


@pytest.mark.parametrize("hot", [50_000, 2, 0])
def test_repeats(spark, monkeypatch, tmp_path, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    rows = list(enumerate(texts()))
    rows += [(3, rows[3][1]), (7, "a different text of an id that is there twice, long enough to hold a window " + rows[2][1])]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows] + [(None, rows[3][1], "clash")], "doc_id long, text string, bucket string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(rows)
    got = queries.op3_suffix_dedup(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0 and r["n_bytes"] == len(rows[3][1].encode())
        else:
            assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[(r["doc_id"], r["n_bytes"])]


def test_empty_table(spark):
    assert substrings.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text_is_read_in_chunks(monkeypatch):
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = substrings.minimizers(buf, np.array([0, 3000]), np.array([3000, 2000]), 50)
    monkeypatch.setattr(substrings, "CHUNK", 512)
    parts = substrings.minimizers(buf, np.array([0, 3000]), np.array([3000, 2000]), 50)
    assert _hashes(whole) == _hashes(parts)


def test_spans_of_periods():
    rng = np.random.default_rng(0)
    for _ in range(300):
        p, n = int(rng.integers(1, 36)), int(rng.integers(257, 400))
        flag = rng.random(p) < 0.2
        want = np.zeros(n + 49, bool)
        for j in range(n):
            if flag[j % p]:
                want[j : j + 50] = True
        got = np.zeros(n + 49, bool)
        for _, a, size in zip(*substrings._spans(flag, np.array([p]), np.array([n]), 50)):
            got[a : a + size] = True
        assert (got == want).all()


@pytest.mark.parametrize("unit", ["x", "ab", "abc", "the quick brown fox jumps over a dog."])
def test_long_periodic_texts(spark, unit):
    size = 3_000_000
    text = (unit * (size // len(unit) + 1))[:size]
    rows = [(1, text), (2, "+" + text), (3, "no repeat here"), (4, text + "-")]
    got = {r["doc_id"]: r for r in substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(r["start"], r["end"]) for r in got[2]["spans"]] == [(1, size + 1)] and bytes(got[2]["kept"]) == b"+"
    assert bytes(got[1]["kept"]) == text.encode() and bytes(got[3]["kept"]) == b"no repeat here" and bytes(got[4]["kept"]) == b"-"


def test_strings_that_may_repeat():
    rng = np.random.default_rng(4)
    for _ in range(40):
        core = bytes(rng.integers(97, 123, 16).astype(np.uint8))
        gram = int(substrings._grams(substrings._words(np.frombuffer(core, np.uint8)))[0] >> np.uint64(16))
        side = lambda n: bytes(rng.choice([97, 98], n).astype(np.uint8))
        strings = list({side(int(rng.integers(0, 35))) + core + side(int(rng.integers(0, 35))) for _ in range(300)} | {b"a" * 34 + core, b"b" + b"a" * 30 + core + b"a" * 5})
        strings = [s for s in strings if len(s) >= 50]
        size = np.array([len(s) for s in strings])
        begin = np.cumsum(size) - size
        kept = substrings.may_repeat(np.frombuffer(b"".join(strings), np.uint8), begin, size, np.full(len(size), gram, np.uint64), 50)
        owners = {}
        for n, s in enumerate(strings):
            for i in range(len(s) - 49):
                owners.setdefault(s[i : i + 50], set()).add(n)
        needed = {n for x in owners.values() if len(x) > 1 for n in x}
        assert needed <= set(np.flatnonzero(kept).tolist())
    assert len(needed) < len(strings)


def test_little_is_sent_of_periodic_texts():
    for unit in ("x", "ab", "abcdefghijklmnopqrstuvwxyz012345678"):
        buf = np.frombuffer((unit * 100_000).encode(), np.uint8)
        _, at, n, _ = substrings.minimizers(buf, np.array([0]), np.array([len(buf)]), 50)
        sent = substrings.one_period(buf, at, n, 50) + 49
        assert n.sum() == len(buf) - 49 and sent.sum() < 100 * (len(at) + 1) and len(at) < 10


def test_suffix_array():
    rng = np.random.default_rng(0)
    for trial in range(400):
        n, k = int(rng.integers(0, 60)), int(rng.integers(1, 5))
        t = rng.integers(0, k, n)
        if trial % 3 == 0 and n > 3:
            t[n // 2 :] = t[: n - n // 2]
        if trial % 5 == 0:
            t = t * 5000
        if trial % 7 == 0:
            t, n = np.repeat(t, 3), 3 * n
        sa = suffix.suffix_array(t)
        assert sa.tolist() == sorted(range(n), key=lambda i: tuple(t[i:]))
        lcp = suffix.common_prefixes(t, sa)
        for j in range(1, n):
            a, b = t[sa[j - 1] :].tolist(), t[sa[j] :].tolist()
            assert lcp[j] == next((x for x, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))


def test_substrings_are_sorted_recursively(monkeypatch):
    """A text of real size is named and sorted again, level by level, whatever the number of names."""
    rng, depth = np.random.default_rng(2), []
    words = ["".join(map(chr, rng.integers(97, 123, int(rng.integers(2, 9))))) for _ in range(3000)]
    t = np.frombuffer(" ".join(words[k] for k in rng.zipf(1.3, 120_000) % 3000).encode(), np.uint8)
    inner = suffix.suffix_array

    def counted(x):
        depth.append((len(x), int(x.max()) + 1))
        return inner(x)

    monkeypatch.setattr(suffix, "suffix_array", counted)
    sa = counted(t)
    assert len(depth) > 3 and depth[1][1] > 2048
    lcp = suffix.common_prefixes(t, sa)
    a, b = sa[:-1] + lcp[1:], sa[1:] + lcp[1:]
    inside = a < len(t)
    assert sorted(sa.tolist()) == list(range(len(t))) and (b < len(t)).all() and (t[a[inside]] < t[b[inside]]).all()


def test_long_text_behind_a_short_one():
    buf = np.random.default_rng(1).integers(97, 123, (1 << 24) + 300_000).astype(np.uint8)
    hash_of = lambda x, by: np.repeat(x[3], x[2])[np.argsort(np.repeat(x[1] - by, x[2]) + np.concatenate([np.arange(n) for n in x[2]]), kind="stable")]
    alone = substrings.minimizers(buf[100:], np.array([0]), np.array([len(buf) - 100]), 50)
    behind = substrings.minimizers(buf, np.array([0, 100]), np.array([100, len(buf) - 100]), 50)
    mine = behind[0] == 1
    assert (hash_of(alone, 0) == hash_of(tuple(x[mine] for x in behind), 100)).all()


@pytest.mark.parametrize("small", [0, 1 << 30])
def test_suffixes_moved_one_by_one_or_many_at_once_are_in_order(monkeypatch, small):
    monkeypatch.setattr(suffix, "SMALL", small)
    rng = np.random.default_rng(6)
    for n in (2, 3, 8, 60, 300):
        for symbols in (1, 2, 3, 40):
            t = rng.integers(0, symbols, n)
            t[n // 2 :] = t[: n - n // 2]
            assert suffix.suffix_array(t).tolist() == sorted(range(n), key=lambda i: t[i:].tolist())


def test_small_buckets_take_no_step_of_many_arrays_each(monkeypatch):
    passes = []
    monkeypatch.setattr(suffix, "_pass", lambda *a, f=suffix._pass: passes.append(len(a[0])) or f(*a))
    words = np.random.default_rng(7).integers(0, 5000, 40_000)
    t = np.concatenate([words, words])
    assert len(suffix.suffix_array(t)) == len(t) and not passes
