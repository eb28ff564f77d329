import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from refinery.llm import packing
from refinery.llm.queries import tokenizer

ENCODER = packing.Encoder(tokenizer())


def slow(text):
    return ENCODER.slow.encode(text, add_special_tokens=False).ids


@given(st.text(max_size=60) | st.text(alphabet="abcdé'’ \n\t1.-ßŒ ", max_size=80))
@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
def test_ids_agree(text):
    assert ENCODER(text).tolist() == slow(text)


@pytest.mark.parametrize("text", ["", " ", "a<|endoftext|>b", "It's I'LL we've", "x" * 5000, " \n\n  a\r\n", "ab " * 3000, "12345 6789 ½ ²"])
def test_ids_agree_on_odd_texts(text):
    assert ENCODER(text).tolist() == slow(text)


@pytest.mark.parametrize("text", [" " * 3_000_000, "y" + " \t" * 600_000 + "x", "\n" * 1_200_000 + "end.", "\xa0" * 100_000 + " " * 100_000, "a" * 3_000_000, "日" + " " * 200_000, "x " + " " * (packing.MOST_SPACE - 1) + "é"])
def test_ids_agree_on_long_runs(text):
    assert ENCODER(text).tolist() == slow(text)


def test_other_files_are_read_by_their_library(tmp_path):
    import json

    spec = json.load(open(tokenizer(), encoding="utf-8"))
    assert packing.is_plain(spec)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}):
        assert not packing.is_plain(spec | change)
        path = tmp_path / "t.json"
        path.write_text(json.dumps(spec | change), encoding="utf-8")
        other = packing.Encoder(str(path))
        assert other.fast is None and other("It's A  test").tolist() == other.slow.encode("It's A  test", add_special_tokens=False).ids


def test_failures_of_the_faster_library(monkeypatch):
    monkeypatch.setattr(packing, "MOST_SPACE", 1 << 40)
    assert ENCODER("a" + " " * 1_500_000).tolist() == slow("a" + " " * 1_500_000)


def test_large_ids_with_nulls(spark):
    ids = [2**60 + i for i in range(50)] + [None]
    df = spark.createDataFrame([(i, "some text") for i in ids], "doc_id long, text string")
    assert {r["doc_id"] for r in packing.pieces(df, tokenizer()).collect()} == set(ids)


def check(rows, capacity=1024):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_packing(spark):
    df = documents(spark)
    rows = packing.pack(packing.pieces(df, tokenizer())).collect()
    check(rows)
    want = Counter()
    for r in df.collect():
        ids = np.array([*slow(r["text"] or ""), 2], dtype="<u4")
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes()), tuple(ids[a:b].tolist()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in rows) == want
    assert packing.pack(packing.pieces(df.limit(0), tokenizer())).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_plan_covers_exactly(histogram):
    plan = packing.plan(histogram, 64)
    got = Counter()
    for lengths, n in plan:
        assert n > 0 and sum(lengths) <= 64
        for s in lengths:
            got[s] += n
    assert got == Counter(histogram)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(0)
    histogram = dict(Counter(rng.integers(1, 1025, 30_000).tolist()))
    bins = sum(n for _, n in packing.plan(histogram))
    assert bins <= 1.01 * sum(s * n for s, n in histogram.items()) / 1024 + 1


def test_knapsack():
    values = np.zeros(11)
    values[[3, 4, 7]] = [3.0, 4.5, 7.2]
    assert packing.best_value(values, 10) in ({3: 2, 4: 1}, {7: 1, 3: 1}) and sum(values[k] * n for k, n in packing.best_value(values, 10).items()) == 10.5


def test_hot_length(spark):
    rows = spark.createDataFrame([(i, 0, 300 if i % 3 else 724) for i in range(3000)], "doc_id long, piece int, length long")
    # Each 724 takes one 300 along; three of those left fit together.
    assert check(packing.pack(rows).collect()) == 1000 + 334
