from fractions import Fraction

import pytest
from helpers import documents
from pyspark.sql import functions as F

from refinery.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3)):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        level = Fraction(left, sum(weight[s] for s in names if s not in capped) or 1)
        over = {s for s in names if s not in capped and level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s] if s in capped else level * weight[s]) for s in names}
        capped |= over


def sainte_lague(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(votes), key=lambda s: Fraction(votes[s], 2 * won[s] + 1))
        won[best] += 1
    return won


@pytest.fixture(params=[100_000, 0])
def in_task(request, monkeypatch):
    """All in one task, or dealt by ranges."""
    monkeypatch.setattr(mixing, "MOST_IN_TASK", request.param)


@pytest.mark.usefixtures("in_task")
@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, None: 5}, {"a": 1000, "b": 1, "c": 0, "d": 3}, {None: 9}, {"é": 4, "z": 4, "A": 400, "B": 30, "C": 2}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.usefixtures("in_task")
@pytest.mark.parametrize("votes", [{"a": 10, "b": 7, "c": 3}, {"a": 5, "b": 5, "c": 5, "d": 5}, {"a": 1000, "b": 1, "c": 1}, {"a": 0, "b": 3}])
@pytest.mark.parametrize("seats", [0, 1, 7, 50])
def test_apportionment(spark, votes, seats):
    df = spark.createDataFrame(list(votes.items()), "name string, votes long")
    got = {r["name"]: r["quota"] for r in mixing.apportion(df, "votes", F.lit(seats), [], [F.col("name").asc()]).collect()}
    assert got == sainte_lague(votes, seats)


def corpus(spark, n=4000):
    rows = [(i, "w " * (1 + i * i % 97), f"s{i % 7 if i % 3 else 0}") for i in range(n)] + [(n, "x y", None), (n + 1, None, "s1"), (n + 2, "", "s2")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.usefixtures("in_task")
def test_mix(spark):
    df = corpus(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(brute_targets(sizes))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(48, 0.01 * t)
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(df.repartition(7)).collect()), key=str)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_IN_TASK", 50)
    sizes = {f"s{i}": 1 + i * i % 101 for i in range(400)} | {None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    votes = {f"v{i:03d}": 1 + i * i % 101 for i in range(300)}
    df = spark.createDataFrame(list(votes.items()), "name string, votes long")
    assert {r["name"]: r["quota"] for r in mixing.apportion(df, "votes", F.lit(999), [], [F.col("name").asc()]).collect()} == sainte_lague(votes, 999)


def test_word_count(spark):
    df = spark.createDataFrame([("a\x0bb\tc d  e\n",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == [4, 0, 0]


def test_odd_tables(spark):
    df = documents(spark)
    assert mixing.mix(df).count() == df.count()
    assert mixing.mix(df.limit(0)).count() == 0
    out = mixing.apply_mix(df)
    assert out.columns == df.columns


def test_apply_mix(spark):
    df = corpus(spark, 500).unionByName(corpus(spark, 500).where("doc_id = 3"))
    want = {}
    for r in mixing.mix(df).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + (int(r["taken"] / r["size"] + 0.5) if r["size"] else 0)
    got = {}
    for r in mixing.apply_mix(df).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in want.items() if v}
