import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from refinery.operators import batch, cdc, graph, marts, matching, partitioning, quality, routing


def naive(text, keys):
    """Leftmost-longest, non-overlapping: (found, rest)."""
    found, rest, at = [], "", 0
    text = text or ""
    while at < len(text):
        best = max((k for k in keys if k and " " not in k and text.startswith(k, at)), key=len, default=None)
        if best:
            found.append(best)
            at += len(best)
        else:
            rest += text[at]
            at += 1
    return found, rest


def test_match_equals_naive(spark):
    rng = random.Random(5)
    keys = ["ab", "abc", "c", "bca", "가나", "나다라", "a b", "😀a", "dd"]
    texts = ["".join(rng.choice("abcd가나다라 😀") for _ in range(rng.randrange(0, 40))) for _ in range(60)] + ["", None, "zzz", "abcab" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    dictionary = spark.createDataFrame([(k, k.upper() + "!") for k in keys], "key string, standard string")
    for r in matching.match(docs, dictionary, "t").collect():
        found, rest = naive(r["t"], keys)
        assert r["matches"] == [k.upper() + "!" for k in found] and r["residual"] == rest
    for r in matching.match_small(docs, [k for k in keys if " " not in k], "t").collect():
        assert (r["matches"], r["residual"]) == naive(r["t"], keys)


def test_match_of_repeated_ids_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(matching, "PIECE", 7)
    monkeypatch.setattr(matching, "MOST_STARTS", 3)
    keys = ["abcdefghij", "bc", "cdefghijk", "가나다"]
    texts = ["xxabcdefghijkbc" * 5, "가나다abc가나", "bcbcbc", "zz"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (None, texts[1]), (None, texts[3]), (2, texts[0]), (2, texts[0])]
    got = matching.match(spark.createDataFrame([(*r, "clash") for r in rows], "id long, t string, at string"), spark.createDataFrame([(k, k) for k in keys], "key string, standard string"), "t").collect()
    assert sorted((str(r["id"]), r["t"], r["matches"], r["residual"]) for r in got) == sorted((str(i), t, *naive(t, keys)) for i, t in rows)


def test_match_of_a_long_text(spark):
    text = "some words ab" * 80_000
    r = matching.match(spark.createDataFrame([(1, text)], "id long, t string"), spark.createDataFrame([("words", "W"), ("ab", "AB")], "key string, standard string"), "t").first()
    assert len(r["matches"]) == 160_000 and r["residual"] == "some  " * 80_000


def test_match_of_touching_hits_is_linear(spark):
    """One letter, with keys of two and three: every hit overlaps the next. Four times the text takes about four times as long."""
    keys = spark.createDataFrame([("aa", "2"), ("aaa", "3")], "key string, standard string")
    took = []
    for n in (100_001, 1_000_001, 4_000_001):
        hits = spark.range(1, n).select(F.lit(1).alias("h"), F.lit(2).alias("g"), F.col("id").cast("int").alias("at"), F.least(F.lit(3), n - F.col("id")).cast("int").alias("n"), F.lit("3").alias("standard")).where("n > 1")
        began = time.time()
        r = matching.leftmost(hits).select(F.size("taken").alias("n"), F.element_at("taken", -1)["until"].alias("last")).first()
        took.append(time.time() - began)
        assert r["n"] == -(-(n - 1) // 3) - ((n - 1) % 3 == 1) and r["last"] == n - ((n - 1) % 3 == 1)
    assert took[2] < 10 * took[1] + 5
    r = matching.match(spark.createDataFrame([(1, "a" * 300_002)], "id long, t string"), keys, "t").first()
    assert r["matches"] == ["3"] * 100_000 + ["2"] and r["residual"] == ""


def test_match_without_keys(spark):
    docs = spark.createDataFrame([(1, "abc")], "id long, t string")
    r = matching.match(docs, spark.createDataFrame([], "key string, standard string"), "t").first()
    assert r["matches"] == [] and r["residual"] == "abc"


def test_dictionary(spark):
    rows = [(1, "1,2-글리콜", None), (2, "물 분자", "정제수"), (3, "새물", "정제수"), (4, "  ", "x")]
    d = {r["key"]: r["standard"] for r in matching.build_dictionary(spark.createDataFrame(rows, "n int, std string, old string"), "std", ["old"], "n").collect()}
    assert d == {"1_C_2-글리콜": "1,2-글리콜", "물 분자": "물 분자", "물분자": "물 분자", "정제수": "새물", "새물": "새물"}
    base = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, standard string")
    custom = spark.createDataFrame([("a", "X", "add"), ("b", "Y", "override"), ("c d", "Z", "add")], "raw string, standard string, action string")
    got = {r["key"]: r["standard"] for r in matching.overlay(base, custom).collect()}
    assert got == {"a": "A", "b": "Y", "c d": "Z", "cd": "Z"}


def test_usage_keeps_total_apart(spark):
    df = spark.createDataFrame([("TOTAL", ["aa", "bb"]), (None, ["aa", None, "1", "22"]), ("x", None), ("x", [])], "c string, items array<string>")
    counts = {(r[0], r[1], r[3]): r[2] for r in marts.usage(df, "c", "items").collect()}
    assert counts == {("TOTAL", "aa", False): 1, ("TOTAL", "bb", False): 1, (None, "aa", False): 1, (None, "aa", True): 2, (None, "bb", True): 1}
    top = marts.top_per_category(marts.usage(df, "c", "items"), 1).collect()
    assert len(top) == 3


def test_merged_sketches_against_exact_counts(spark, tmp_path):
    """The given tables in five batches that share owners: each item's count within four standard errors, most within one."""
    sf = "/root/testdata/sf0.01"
    line = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey").join(spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey as l_partkey", "p_type"), "l_partkey")
    for n in range(5):
        # Each order is in two batches.
        some = line.where((F.col("l_orderkey") % 5 == n) | (F.col("l_orderkey") % 5 == (n + 1) % 5))
        marts.usage_sketches(some, "p_type", "l_orderkey").write.parquet(str(tmp_path / f"batch={n}"))
    merged = {r[0]: r[1] for r in marts.merged_usage(spark.read.parquet(*[str(tmp_path / f"batch={n}") for n in range(5)])).collect()}
    exact = {r[0]: r[1] for r in marts.distinct_usage(line, "p_type", "l_orderkey").collect()}
    assert merged.keys() == exact.keys() and max(exact.values()) > 1000
    error = [abs(merged[k] - v) / v for k, v in exact.items()]
    assert max(error) < 4 * 1.04 / 2**7 and sorted(error)[len(error) // 2] < 1.04 / 2**7


def test_routing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    got = df.select("id", routing.first_failure([("NULL", F.col("t").isNull()), ("ONE", F.col("id") == 1)]).alias("error_type"))
    assert [r[1] for r in got.orderBy("id").collect()] == ["ONE", "NULL"]
    same = spark.createDataFrame([("b", "xx", 2), ("b", "yy", 1), ("b", "zzz", 0)], "k string, t string, u int")
    best = routing.keep_best(same, [F.col("k")], [F.length("t"), F.col("u")]).where("is_best").collect()
    assert [r["t"] for r in best] == ["yy"]
    both = spark.createDataFrame([(["m"], "left over"), ([], "ab"), ([], "residue")], "matches array<string>, residual string")
    ok, bad = routing.after_match(both)
    assert ok.count() == 1 and bad.count() == 2


def test_keep_best_by_brute_force(spark):
    """One key holds half of the rows, nulls and equal rows among them, columns named as the operator's own, and a map."""
    rng = random.Random(8)
    rows = [(rng.choice([None, "hot", "hot", "hot", rng.choice("abcdef")]), rng.choice([None, "x", "yy", "zzz"]), rng.choice([None, 1, 2]), rng.choice([None, {"p": "1"}, {}])) for _ in range(600)]
    df = spark.createDataFrame(rows, "k0 string, row string, _best int, place map<string, string>").repartition(5)
    out = routing.keep_best(df, [F.col("k0")], [F.length("row"), F.col("_best")])
    got = [tuple(r) for r in out.collect()]
    assert out.columns == [*df.columns, "is_best"] and sorted(map(str, (r[:4] for r in got))) == sorted(map(str, rows))
    low = lambda x: (x is not None, x or 0)
    best = {}
    for k, t, u, _ in rows:
        here = (low(None if t is None else len(t)), low(u))
        best[k] = min(best.get(k, here), here)
    kept = [r for r in got if r[4]]
    assert sorted((str(k), (low(None if t is None else len(t)), low(u))) for k, t, u, *_ in kept) == sorted((str(k), v) for k, v in best.items())
    again = routing.keep_best(df.repartition(3), [F.col("k0")], [F.length("row"), F.col("_best")]).where("is_best")
    assert sorted(map(str, map(tuple, again.collect()))) == sorted(map(str, kept))
    assert sorted(r["k0"] for r in routing.first_per_key(df, "k0", [F.col("_best")]).collect()) == sorted(k for k in best if k)


def test_keep_best_deals_a_hot_key(spark):
    """Half of the rows have one key: what is kept takes no exchange of rows, and rejected rows of that key are dealt."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert "Window" not in routing.keep_best(df, [F.col("k")], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rejected = routing.rejected_rows(df, [F.col("k")], [F.col("v")])
        per = [r["count"] for r in rejected.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per) == 9_999 and max(per) < 0.5 * 9_999


HISTORY = "product_id string, b int, items array<string>, rating double, m map<string, map<string, string>>"


def test_change_log(spark):
    nan = float("nan")
    rows = [
        ("gone", 1, ["a"], 1.0, {}),
        ("back", 1, ["a"], 1.0, {}),
        ("back", 3, ["a"], 1.0, {}),
        ("order", 2, ["a", "b"], 1.0, {}),
        ("order", 3, ["b", "a"], 1.0, {}),
        ("maps", 2, [], 1.0, {"x": {"p": "1", "q": "2"}, "y": {}}),
        ("maps", 3, [], 1.0, {"y": {}, "x": {"q": "2", "p": "1"}}),
        ("nulls", 2, None, nan, None),
        ("nulls", 3, None, nan, None),
        ("new", 3, [], 0.0, {}),
        ("removed", 2, [], 0.0, {}),
    ]
    history = spark.createDataFrame(rows, HISTORY)
    fields = ("items", "rating", "m")
    got = {(r["product_id"], r["change_type"]) for r in cdc.change_log(history, "b", "product_id", fields).collect()}
    assert got == {("order", "CHANGED"), ("new", "NEW"), ("removed", "REMOVED")}
    again = {(r["product_id"], r["change_type"]) for r in cdc.change_log(history, "b", "product_id", fields, reappear_as_new=True).collect()}
    assert again == got | {("back", "NEW")}
    first = history.where("b = 1")
    assert cdc.change_log(first, "b", "product_id", fields).count() == 0
    assert cdc.change_log(first, "b", "product_id", fields, initial_as_new=True).count() == 2
    assert cdc.change_counts(cdc.change_log(history, "b", "product_id", fields)).first().asDict() == {"new_count": 1, "removed_count": 1, "changed_count": 1}


def test_graph(spark):
    nodes = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "id string, name string")
    edges = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "id string, target string")
    changes = spark.createDataFrame(
        [("a", 1, "CHANGED", "A2", ["Y", "nope"]), ("b", 1, "REMOVED", "B", None), ("d", 1, "NEW", "D", ["X"]), ("e", 1, "CHANGED", "E", ["X"]), ("c", 1, "REMOVED", "C", None), ("c", 2, "NEW", "C2", ["X"])],
        "id string, b int, change_type string, name string, items array<string>",
    )
    lookup = spark.createDataFrame([("X", "x"), ("Y", "y")], "name string, target string")
    for _ in range(2):
        nodes, edges = graph.apply(nodes, edges, changes, lookup, "id", "b", ["name"], "items")
        assert {tuple(r) for r in nodes.collect()} == {("a", "A2"), ("c", "C2"), ("d", "D")}
        assert {tuple(r) for r in edges.collect()} == {("a", "y"), ("c", "x"), ("d", "x")}
    row = graph.checkpoint_row(changes, "b", F.lit("2024-01-01").cast("timestamp")).first()
    assert (row["batch_job"], row["new_count"], row["removed_count"], row["changed_count"]) == (2, 2, 2, 2)
    assert graph.checkpoint_row(changes.limit(0), "b", F.current_timestamp()).count() == 0
    marks = spark.createDataFrame([("j1", 1), ("j2", 2)], "batch_job string, synced_at int")
    assert graph.last_checkpoint(marks) == "j2" and graph.last_checkpoint(marks.limit(0)) is None
    assert graph.pending(changes, None, "b").count() == 6 and graph.pending(changes, 1, "b").count() == 1


def sequential(nodes, edges, changes, lookup):
    """The changes one after the other."""
    nodes, edges = dict(nodes), set(edges)
    for key, _, kind, name, items in sorted(changes, key=lambda c: (c[1], c[2])):
        if kind == "REMOVED" or (kind == "CHANGED" and key in nodes):
            edges = {e for e in edges if e[0] != key}
        if kind == "REMOVED":
            nodes.pop(key, None)
        elif kind == "NEW" or key in nodes:
            nodes[key] = name
            edges |= {(key, lookup[i]) for i in items or [] if lookup.get(i)}
    return nodes, edges


def test_graph_over_batches_equals_one_by_one(spark):
    rng = random.Random(2)
    lookup = {"X": "x", "Y": "y", "Z": "z", "N": None}
    keys = [f"k{i}" for i in range(40)]
    start = {k: "old" for k in keys if rng.random() < 0.5}
    old = {(k, rng.choice("xyz")) for k in start}
    changes = [(k, b, rng.choice(["NEW", "REMOVED", "CHANGED"]), f"{k}-{b}", rng.choice([None, [], rng.sample(["X", "Y", "Z", "N", "?"], 2)])) for k in keys for b in range(1, 6) if rng.random() < 0.5]
    want = sequential(start, old, changes, lookup)
    nodes = spark.createDataFrame(list(start.items()), "id string, name string")
    edges = spark.createDataFrame(sorted(old), "id string, target string")
    change_rows = spark.createDataFrame([*changes, (None, 1, "NEW", "nobody", ["X"])], "id string, b int, change_type string, name string, items array<string>")
    names = spark.createDataFrame(list(lookup.items()), "name string, target string")
    for _ in range(2):
        nodes, edges = graph.apply(nodes, edges, change_rows, names, "id", "b", ["name"], "items")
        assert {tuple(r) for r in nodes.collect()} == set(want[0].items())
        assert {tuple(r) for r in edges.collect()} == want[1]


def test_quality(spark):
    routed = spark.createDataFrame([("E",), (None,), (None,)], "error_type string")
    wide = quality.stage_metrics(routed)
    assert wide.first().asDict() == {"loaded": 3, "ok": 2, "error": 1, "error_rate": 0.3333}
    assert quality.stage_metrics(routed.limit(0)).first()["error_rate"] == 0.0
    mart = spark.createDataFrame([("a", "A"), ("a", "A2"), ("b", None)], "i string, inci string")
    assert quality.mapping_metrics(mart, "i", "inci").first().asDict() == {"ingredients_unique": 2, "matched": 1, "unmatched": 1, "match_rate": 0.5}
    long = quality.long_form(wide, "s", "r", F.lit("2024-01-01").cast("timestamp"), "t", F.current_timestamp())
    assert {(r["metric_name"], r["metric_value"]) for r in long.collect()} == {("loaded", 3.0), ("ok", 2.0), ("error", 1.0), ("error_rate", 0.3333)}
    assert quality.drill_down(long, spark.createDataFrame([(datetime.datetime(2024, 1, 1),), (datetime.datetime(2024, 1, 2),)], "batch_date timestamp")).count() == 1
    assert quality.try_write(lambda: None) and not quality.try_write(lambda: 1 / 0)


def test_batch(spark):
    assert batch.batch_date("2024-05-06", "x_20240101_000000") == datetime.date(2024, 5, 6)
    assert batch.batch_date(None, "x_20240101_000000") == datetime.date(2024, 1, 1)
    assert batch.batch_date(None, None, datetime.datetime(2020, 2, 2)) == datetime.date(2020, 2, 2)
    rows = spark.createDataFrame([("t", n) for n in range(5)], "t string, at int")
    assert sorted(r["at"] for r in batch.retention_candidates(rows, "t", "at", F.lit(2)).collect()) == [0, 1]


@pytest.mark.parametrize("initial", [False, True])
def test_latest_two(spark, initial):
    rows = spark.createDataFrame([(1,)] if initial else [(1,), (3,), (2,), (3,)], "b int")
    assert cdc.latest_two(rows, "b") == (None if initial else (2, 3))


def test_large_files_are_not_dealt_again(spark, tmp_path):
    path = str(tmp_path / "a b%20c")
    spark.range(200_000).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(path)
    shuffled = lambda df: "Exchange RoundRobin" in partitioning.spread(df)._jdf.queryExecution().executedPlan().toString()
    assert shuffled(spark.read.parquet(path)) and shuffled(spark.range(3))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert not shuffled(spark.read.parquet(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_changes_of_all_batches_are_those_of_each_pair(spark):
    rng = random.Random(11)
    batches = [3, 5, 6, 9]
    rows = [(k, b, rng.choice([["a"], ["a", "b"], None])) for k in [None, *map(str, range(40))] for b in [*batches, None] if rng.random() < 0.6]
    history = spark.createDataFrame(rows, "k string, b int, items array<string>")
    at_once = cdc.change_history(history, "b", "k", ("items",), batches)
    apart = cdc.change_log(history.where("b = 3"), "b", "k", ("items",), initial_as_new=True)
    for pair in zip(batches, batches[1:]):
        before, now = (history.where(F.col("b") == b) for b in pair)
        of = cdc.new_rows(now, before, "k").withColumn("change_type", F.lit("NEW"))
        of = of.unionByName(cdc.removed_rows(before, now, "k").withColumn("change_type", F.lit("REMOVED")))
        of = of.unionByName(cdc.changed_rows(before, now, "k", ("items",)).withColumn("change_type", F.lit("CHANGED")))
        one = cdc.changes_between(before, now, before, "k", ("items",), reappear_as_new=True)
        assert sorted(map(str, one.collect())) == sorted(map(str, of.collect()))
        apart = apart.unionByName(of.withColumn("b", F.lit(pair[1])))
    assert sorted(map(str, at_once.collect())) == sorted(map(str, apart.collect()))
    assert cdc.change_history(history, "b", "k", ("items",), []).count() == 0
    # One look at each row: no join, however many batches there are.
    assert "Join" not in at_once._jdf.queryExecution().optimizedPlan().toString()


def test_graph_takes_few_sorts_and_reads_lines_once(spark):
    """A task holds a sort's memory for each of its tables: before, twenty and more at once."""
    from refinery.plans import catalogue

    for name in ("graph_apply", "graph_apply_nodes"):
        plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "l_partkey" not in plan
        assert plan.count("Join") <= 10, plan.count("Join")


def test_residual_keeps_every_character(spark):
    """Marks of byte order, characters beyond two bytes and null characters stay as they are, at the start of a piece too; texts stay in the JVM."""
    texts = ["﻿ab﻿x😀ab😀", "ab￾\u0000ab", "ababab", "﻿", "xabcab가" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    keys = ["ab", "abc", "bca"]
    found = matching.match(docs, spark.createDataFrame([(k, k) for k in keys], "key string, standard string"), "t")
    assert {r["id"]: (r["matches"], r["residual"]) for r in found.collect()} == {n: naive(t, keys) for n, t in enumerate(texts)}
    plan = found.select("residual")._jdf.queryExecution().optimizedPlan().toString()
    assert "without(" not in plan and plan.count("ArrowEvalPython") == 1


def test_matches_of_silver_and_errors_are_found_once(spark):
    from refinery.plans import products

    plan = products.silver_and_errors(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "ArrowEvalPython" not in plan
