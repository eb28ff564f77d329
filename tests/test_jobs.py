"""Two invented crawls through all jobs, and reading and writing."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from refinery import schemas
from refinery.operators import graph, marts, routing
from refinery.plans import jobs
from refinery.sources import files
from refinery.sources.sinks import BatchStore, export_csv, export_graph_csv
from refinery.sources.snapshots import SnapshotLog
from refinery.streaming import changes as streaming


def product(name, ingredients, **other):
    return {"name": name, "brand": "B", "url": f"u/{name}", "ingredients": ingredients, "main_category": "스킨케어", "sub_category": "크림", "goods_no": "1", "crawled_at": "2024-01-01 00:00:00", "rating": "4.5", "review_count": "10.0", "review_stats": {"s": {"a": "1"}}} | other


def crawl(root, run, main, sub, rows):
    folder = root / main / sub / f"run_id={run}"
    folder.mkdir(parents=True)
    (folder / "part_0.json").write_text("\n".join([json.dumps(r, ensure_ascii=False) for r in rows] + ["{broken"]))


def load(spark, root):
    found = files.latest_runs(files.listing(spark, str(root)))
    return files.read_json(spark, [r["path"] for r in found.collect()], schemas.BRONZE), files.source_run(found)


def test_end_to_end(spark, tmp_path):
    dictionary = spark.createDataFrame([("정제수", "정제수"), ("글리세린", "글리세린"), ("1_C_2-헥산다이올", "1,2-헥산다이올")], "key string, standard string")
    metadata = spark.createDataFrame([("WATER", "정제수"), ("GLYCERIN", "글리세린")], "inci_name string, kor_name string")
    first = [
        product("수분 크림", "정제수, 글리세린"),
        product("수분크림", "정제수, 글리세린, 향료없음"),
        product("남는 크림", "정제수, 모르는성분"),
        product("없는 크림", "모르는성분"),
        product("조용한 크림", "."),
        product("빈 크림", " "),
        product("크림 2종 택1", "정제수"),
        product("null", "정제수"),
        product("묶음 크림", "[본품] 정제수 [본품] 글리세린"),
        product("숨은 크림", "글리세린, 1,2-헥산다이올, 글리세린"),
    ]
    crawl(tmp_path / "one", "shop_20240101_000000", "스킨케어", "크림", first)
    bronze, run = load(spark, tmp_path / "one")
    day = F.lit("2024-01-01").cast("timestamp")
    out = jobs.refine(bronze, dictionary, jobs.CleaningRules(), run, day, core="글리세린")
    errors = sorted((r["product_name_raw"], r["error_type"]) for r in out.errors.collect())
    assert errors == sorted(
        [
            ("수분크림", routing.DUPLICATE),
            ("남는 크림", routing.RESIDUAL),
            ("없는 크림", routing.RESIDUAL),
            ("빈 크림", routing.INCOMPLETE),
            ("크림 2종 택1", routing.OPTIONS),
            ("null", routing.METADATA),
            ("묶음 크림", routing.BUNDLE),
            ("숨은 크림", routing.HIDDEN),
        ]
    )
    silver = {r["product_name"]: r["product_ingredients"] for r in out.silver.collect()}
    assert silver == {"수분 크림": ["정제수", "글리세린"], "남는 크림": ["정제수"]}
    assert {r["metric_name"]: r["metric_value"] for r in out.metrics().collect()} == {"loaded": 10.0, "ok": 2.0, "error": 8.0, "error_rate": 0.8, "rows_both": 1.0, "rows_dropped": 1.0}

    store = BatchStore.of(spark, str(tmp_path / "store"), schemas.TABLES["silver"])
    dead, measured = (BatchStore.of(spark, str(tmp_path / "store"), schemas.TABLES[n]) for n in ("silver_error", "dq_metrics"))
    assert store.batches() == [] and store.current().count() == 0
    again = jobs.refine(bronze, dictionary, jobs.CleaningRules(), run, day, core="글리세린")
    assert again.write(store, dead, measured, "20240101")
    assert {r["metric_name"]: r["metric_value"] for r in measured.current().collect()} == {r["metric_name"]: r["metric_value"] for r in out.metrics().collect()}
    assert (store.current().count(), dead.current().count()) == (2, 8)
    assert not store.append(out.silver.limit(0), "20240102")
    assert jobs.to_gold(store, metadata, "g1", day)["change_log"].count() == 0

    out.release()
    assert not any(df.storageLevel.useMemory for df in out.kept)

    second = [product("수분 크림", "정제수", rating="3"), product("새 크림", "글리세린")]
    crawl(tmp_path / "two", "shop_20240102_000000", "스킨케어", "크림", second)
    bronze, run = load(spark, tmp_path / "two")
    day = F.lit("2024-01-02").cast("timestamp")
    store.append(jobs.refine(bronze, dictionary, jobs.CleaningRules(), run, day).silver, "20240102")
    gold = jobs.to_gold(store, metadata, "g2", day)
    log = gold["change_log"].persist()
    assert sorted((r["product_name"], r["change_type"]) for r in log.collect()) == [("남는 크림", "REMOVED"), ("새 크림", "NEW"), ("수분 크림", "CHANGED")]
    assert {(r["category_id"], r["ingredient_name"], r["usage_count"]) for r in gold["frequency"].collect()} == {("크림", "정제수", 1), ("크림", "글리세린", 1), ("TOTAL", "정제수", 1), ("TOTAL", "글리세린", 1)}
    assert {(r["ingredient_name"], r["inci_name"]) for r in gold["mart"].collect()} == {("정제수", "WATER"), ("글리세린", "GLYCERIN")}

    old = store.read("20240101")
    names = {"product_id": "product_id", "product_name": "product_name", "product_brand": "product_brand", "category": "category_id", "goods_no": "goods_no"}
    nodes = old.select(*[F.col(a).alias(b) for a, b in names.items()])
    lookup = metadata.select(F.col("kor_name").alias("name"), F.col("inci_name").alias("target"))
    edges = marts.edges(old.select("product_id", F.explode("product_ingredients").alias("i")), lookup, "product_id", "i", "name", "target")
    after_nodes, after_edges, mark = jobs.sync_graph(nodes, edges, log, metadata, None, F.current_timestamp())
    now = store.current()
    full = marts.edges(now.select("product_id", F.explode("product_ingredients").alias("i")), lookup, "product_id", "i", "name", "target")
    assert {tuple(r) for r in after_edges.collect()} == {tuple(r) for r in full.collect()}
    assert {r["product_id"] for r in after_nodes.collect()} == {r["product_id"] for r in now.collect()}
    assert mark.first()["new_count"] == 1

    log.write.parquet(str(tmp_path / "log"))
    seen = []
    stream = streaming.change_stream(spark, str(tmp_path / "log"), schemas.CHANGE_LOG)
    for _ in range(2):
        streaming.apply_available(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "mark")).awaitTermination()
    assert sum(seen) == 3


def test_batches_are_written_once(spark, tmp_path):
    table = schemas.TABLES["silver_error"]
    rows = spark.createDataFrame([("a", "X", None), ("b", "Y", ""), ("c", None, "r")], "product_id string, error_type string, residual_text string")
    store = BatchStore.of(spark, str(tmp_path), table)
    assert store.create() and not store.create() and store.batches() == [] and store.current().count() == 0
    for _ in range(2):
        assert store.append(rows, "b1")
        assert store.current().count() == 3 and store.history().count() == 3
    for _ in range(2):
        store.overwrite(rows.limit(2), "b1")
        assert store.current().count() == 2
    assert store.current().columns == table.schema.names
    assert (tmp_path / "silver_error" / "_batch=b1").is_dir() and any("error_type=X" in str(p) for p in (tmp_path / "silver_error").rglob("*"))
    assert not store.append(rows.limit(0), "b2") and store.batches() == ["b1"]
    store.overwrite(rows.limit(0), "b3")
    assert store.batches() == ["b3", "b1"] and store.current().count() == 0 and store.read("b1").count() == 2
    # Files without a commit do not count.
    rows.write.parquet(str(tmp_path / "silver_error" / "_batch=b9" / "_snapshot=x"))
    assert store.batches() == ["b3", "b1"]
    with pytest.raises(ValueError):
        store.append(rows, "../b")
    assert store.create(replace=True) and store.batches() == []
    log = BatchStore.of(spark, str(tmp_path), schemas.TABLES["change_log"])
    log.append(spark.createDataFrame([("a", "NEW")], "product_id string, change_type string").withColumn("batch_date", F.lit("2024-01-02 03:04:05").cast("timestamp")), "g1")
    assert log.current().columns == schemas.CHANGE_LOG.names and any("_batch_date_day=2024-01-02" in str(p) for p in (tmp_path / "change_log").rglob("*"))


KV = "k string, v int"


def kv_store(spark, path):
    return BatchStore(spark, str(path), spark.createDataFrame([], KV).schema)


def test_a_failed_rewrite_loses_nothing(spark, tmp_path):
    store = kv_store(spark, tmp_path / "t")
    store.append(spark.createDataFrame([("a", 1), ("b", 2)], KV), "b1")
    good = store.latest_two() or store.log.live()[-1]
    # Dies in the last rows, after other files of the write are there.
    broken = spark.range(0, 400, numPartitions=4).select(F.lit("z").alias("k"), F.when(F.col("id") < 399, F.col("id").cast("int")).otherwise(F.raise_error(F.lit("killed")).cast("int")).alias("v"))
    for write in (store.overwrite, store.append):
        with pytest.raises(Exception, match="killed"):
            write(broken, "b1")
        assert sorted(map(tuple, store.read("b1").collect())) == [("a", 1), ("b", 2)]
    # Dies between the files and the commit.
    snapshot_id, folder, rows = store._write(spark.createDataFrame([("z", 0)], KV), "b1")
    assert rows == 1 and [s.snapshot_id for s in store.log.snapshots()] == [good.snapshot_id]
    assert {tuple(r) for r in store.current().collect()} == {("a", 1), ("b", 2)}
    # A table may be rewritten from itself.
    store.overwrite(store.read("b1").withColumn("v", F.col("v") + 1), "b1")
    assert {tuple(r) for r in store.current().collect()} == {("a", 2), ("b", 3)}
    assert {tuple(r) for r in store.read_snapshot(good.snapshot_id).collect()} == {("a", 1), ("b", 2)}


def test_newest_is_by_commit(spark, tmp_path):
    store = kv_store(spark, tmp_path / "t")
    assert store.latest_two() is None
    for n, batch in enumerate(("2024-01", "2024-02", "2023-12", "2024-02")):
        store.append(spark.createDataFrame([(batch, n)], KV), batch)
    assert store.batches() == ["2024-02", "2023-12", "2024-01"]
    before, now = store.latest_two()
    assert (before.batch, now.batch, now.rows) == ("2023-12", "2024-02", 1) and before.committed_ms < now.committed_ms
    assert store.current().first()["v"] == 3 and sorted(r["v"] for r in store.history().collect()) == [0, 2, 3]
    assert sorted(r["v"] for r in store.history(version=3).collect()) == [0, 1, 2]
    rows = {(r["batch"], r["superseded"]) for r in store.log.frame().collect()}
    assert ("2024-02", True) in rows and ("2024-02", False) in rows and len(rows) == 4
    with pytest.raises(ValueError, match="no snapshot"):
        store.read_snapshot("nothing")


def test_commits_do_not_replace_each_other(spark, tmp_path):
    """Two writers that saw the same last commit: each gets a number."""
    a, b = SnapshotLog(spark, str(tmp_path)), SnapshotLog(spark, str(tmp_path))
    assert a._put({"version": 1, "committed_ms": 5}) and not b._put({"version": 1, "committed_ms": 6})
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: (a if n % 2 else b).add(f"s{n}", f"b{n}", n, f"f{n}"), range(12)))
    entries = a.entries()
    assert [e["version"] for e in entries] == list(range(1, 14)) and sorted(e["rows"] for e in entries[1:]) == list(range(12))
    assert all(x["committed_ms"] < y["committed_ms"] for x, y in zip(entries, entries[1:]))


def test_expiry(spark, tmp_path):
    store = kv_store(spark, tmp_path / "t")
    for n, batch in enumerate(("b1", "b2", "b2", "b3", "b4")):
        store.append(spark.createDataFrame([(batch, n)], KV), batch)
    failed = store._write(spark.createDataFrame([("z", 0)], KV), "b5")[1]
    long_ago, later = datetime(2000, 1, 1), datetime.now(timezone.utc) + timedelta(days=1)
    assert store.log.expire(long_ago).count() == 0
    report = store.log.expire(later)
    assert sorted((r["batch"], r["kind"], r["superseded"]) for r in report.collect()) == [("b1", "expired", False), ("b2", "expired", False), ("b2", "expired", True), ("b5", "orphan", True)]
    # Nothing went.
    assert len(store.log.snapshots()) == 5 and (tmp_path / "t" / failed).is_dir()
    gone = [s for s in store.log.snapshots() if s.batch in ("b1", "b2")]
    assert store.log.expire(later, dry_run=False).count() == 4
    assert store.batches() == ["b4", "b3"] and store.history().count() == 2
    assert not any((tmp_path / "t" / s.folder).exists() for s in gone) and not (tmp_path / "t" / failed).exists()
    assert store.log.expire(later, dry_run=False).count() == 0 and store.batches() == ["b4", "b3"]


def test_rules_from_tables(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    plain = spark.createDataFrame([("a", "b")], "raw string, fix string")
    typos = files.sync_rules(plain, plain, spark.createDataFrame([("x.", "y", "simple")], "raw string, fix string, match_type string"), at)
    words = files.sync_keywords(spark.createDataFrame([("exact", "null"), ("exact", "null"), ("contains", "<div"), ("regex", "x"), ("exact", " ")], "match_type string, keyword string"), at)
    by = jobs.CleaningRules.of(typos, words)
    assert (by.exact, by.contains, by.names) == (["null"], ["<div"], [("x\\.", "y")]) and by.boundary[0]["raw"] == by.plain[0]["raw"] == "a"
    custom = files.sync_custom(spark.createDataFrame([("a", "A", "override", "r"), ("b", "B", None, None), (" ", "C", "add", None)], "raw string, standard string, action string, reason string"), at)
    assert sorted((r["raw"], r["action"]) for r in custom.collect()) == [("a", "override"), ("b", "add")] and custom.columns == schemas.CUSTOM.names
    with pytest.raises(Exception, match="unknown action"):
        files.sync_custom(spark.createDataFrame([("a", "A", "drop", "r")], "raw string, standard string, action string, reason string"), at).collect()


def test_streams(spark, tmp_path):
    """ST1: the graph from a stream of changes, batch by batch; ST2: new crawl files are read once, broken rows skipped."""
    fields = "product_id string, batch int, change_type string, name string, items array<string>"
    lookup = spark.createDataFrame([("X", "x"), ("Y", "y")], "name string, target string")
    state = {"nodes": spark.createDataFrame([], "product_id string, name string"), "edges": spark.createDataFrame([], "product_id string, target string")}

    def put(df, number):
        nodes, edges = graph.apply(state["nodes"], state["edges"], df, lookup, "product_id", "batch", ["name"], "items")
        # Written, so that the next batch does not lean on this one's stream.
        for name, out in (("nodes", nodes), ("edges", edges)):
            path = str(tmp_path / f"{name}-{number}")
            out.write.mode("overwrite").parquet(path)
            state[name] = spark.read.parquet(path)

    (tmp_path / "log").mkdir()
    stream = streaming.change_stream(spark, str(tmp_path / "log"), spark.createDataFrame([], fields).schema)
    for rows in ([("a", 1, "NEW", "A", ["X"]), ("b", 1, "NEW", "B", ["X", "Y"])], [("a", 2, "REMOVED", "A", None), ("b", 2, "CHANGED", "B2", ["Y"])], [("a", 3, "NEW", "A3", ["Y"])]):
        spark.createDataFrame(rows, fields).write.mode("append").parquet(str(tmp_path / "log"))
        streaming.apply_available(stream, put, str(tmp_path / "mark")).awaitTermination()
    assert {tuple(r) for r in state["nodes"].collect()} == {("a", "A3"), ("b", "B2")}
    assert {tuple(r) for r in state["edges"].collect()} == {("a", "y"), ("b", "y")}

    seen = []
    for n in range(2):
        crawl(tmp_path / "crawl", f"shop_2024010{n + 1}_000000", "m", "s", [product(f"p{n}", "x")])
        stream = streaming.crawl_stream(spark, str(tmp_path / "crawl" / "*" / "*" / "*"), schemas.BRONZE)
        streaming.apply_available(stream, lambda df, _: seen.extend(r["name"] for r in df.collect()), str(tmp_path / "crawl_mark")).awaitTermination()
    assert seen == ["p0", "p1"]


def test_latest_runs_by_main(spark):
    paths = [("x/a/s/run_id=1/p.json",), ("x/b/s/run_id=2/p.json",), ("x/a/s/run_id=0/p.json",), ("x/other.json",)]
    df = spark.createDataFrame(paths, "path string")
    assert [r["path"] for r in files.latest_runs(df).collect()] == ["x/a/s/run_id=1/p.json", "x/b/s/run_id=2/p.json"]
    assert [r["path"] for r in files.latest_runs(df, by_main=False).collect()] == ["x/b/s/run_id=2/p.json"]
    with pytest.raises(ValueError):
        files.read_json(spark, [], schemas.BRONZE)


def test_rules_and_exports(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"raw": "a", "fix": "b"}]))
    (tmp_path / "k.json").write_text(json.dumps({"exact": ["x"], "contains": ["y", "z"]}))
    rules = files.read_rules(spark, str(tmp_path / "r.json"))
    table = files.sync_rules(rules, rules, rules, F.current_timestamp())
    assert sorted((r["match_type"], r["apply_to"]) for r in table.collect()) == [("regex", "product_name"), ("regex_boundary", "ingredient"), ("simple", "ingredient")]
    assert files.read_keywords(spark, str(tmp_path / "k.json")).count() == 3
    dim = {r["category_id"] for r in files.category_dimension(spark, files.CATEGORIES).collect()}
    assert len(dim) == 20 and "더모코스메틱_스킨케어" in dim and "스킨케어_에센스-세럼-앰플" in dim
    df = spark.sql("select array('a', 'b') as l, map('k', 1) as m, 'x' as s")
    nested = spark.sql("select array(1, 2) as l, array(map('a', 1)) as k, named_struct('x', 1) as m, 1.5 as s")
    to = export_csv(nested, str(tmp_path / "out"), "20240131_120000")
    assert to.endswith("/20240131_120000") and files.read_csv_text(spark, to).first().asDict() == {"l": "1|2", "k": '{"a":1}', "m": '{"x":1}', "s": "1.5"}
    export_csv(df, str(tmp_path / "csv"))
    assert files.read_csv_text(spark, str(tmp_path / "csv")).first().asDict() == {"l": "a|b", "m": '{"k":1}', "s": "x"}
    export_graph_csv(df.select("s"), ["id:ID"], str(tmp_path / "g"))
    assert spark.read.csv(str(tmp_path / "g" / "header")).first()[0] == "id:ID"
    months = spark.createDataFrame([("d/batch=2024-01/f.csv",), ("d/batch=2024-03/f.csv",)], "path string")
    assert files.latest_month(months).first()["batch"] == "2024-03"
