"""The graph's store, its runner and streams: restarts at every point give the same tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from refinery import schemas
from refinery.operators import cdc, graph
from refinery.plans import jobs
from refinery.sources import files
from refinery.sources.sinks import BatchStore
from refinery.streaming import changes as streaming
from refinery.streaming import runs

DAY = datetime(2024, 1, 1)


def change_rows(spark, rows):
    """(product, batch, kind, name, items) as rows of the change log."""
    slim = spark.createDataFrame([(p, DAY + timedelta(days=b), k, n, i, f"job{b}") for p, b, k, n, i in rows], "product_id string, batch_date timestamp, change_type string, product_name string, product_ingredients array<string>, batch_job string")
    return schemas.conform(slim, schemas.CHANGE_LOG)


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame([("X", "x"), ("Y", "y"), ("Y2", "y")], "inci_name string, kor_name string")


BATCHES = [
    [("a", 1, "NEW", "A", ["x"]), ("b", 1, "NEW", "B", ["x", "y"])],
    [("a", 2, "REMOVED", "A", None), ("b", 2, "CHANGED", "B2", ["y", "none"])],
    [("a", 3, "NEW", "A3", ["y"]), ("c", 3, "CHANGED", "C", ["x"])],
]
NODES, EDGES = {("a", "A3"), ("b", "B2")}, {("a", "Y2"), ("b", "Y2")}


def holds(store):
    nodes, edges = store.read()
    return {(r["product_id"], r["product_name"]) for r in nodes.collect()}, {tuple(r) for r in edges.collect()}


def test_runner_from_checkpoint_to_graph(spark, tmp_path, metadata, monkeypatch):
    log = BatchStore.of(spark, str(tmp_path), schemas.TABLES["change_log"])
    store = jobs.graph_store(spark, str(tmp_path / "graph"))
    assert store.mark() is None and holds(store) == (set(), set()) and store.checkpoints().count() == 0
    assert not jobs.run_sync(store, log.history(), metadata)
    log.append(change_rows(spark, BATCHES[0]), "1")
    assert jobs.run_sync(store, log.history(), metadata) and not jobs.run_sync(store, log.history(), metadata)
    first = store.log.snapshots()[-1]
    log.append(change_rows(spark, BATCHES[1]), "2")
    log.append(change_rows(spark, BATCHES[2]), "3")

    # Dies after the files and before the commit: nothing is seen of it, and the next run does it all.
    with monkeypatch.context() as m:
        m.setattr(store.log, "add", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_sync(store, log.history(), metadata)
    assert holds(store) == ({("a", "A"), ("b", "B")}, {("a", "X"), ("b", "X"), ("b", "Y2")})
    assert jobs.run_sync(store, log.history(), metadata) and holds(store) == (NODES, EDGES)
    marks = [tuple(r)[2:] + (r["batch_job"],) for r in store.checkpoints().orderBy("synced_at").collect()]
    assert marks == [(2, 0, 0, "job1"), (1, 1, 2, "job3")] and graph.last_checkpoint(store.checkpoints()) == "job3"
    assert {r["product_name"] for r in store.read(first.snapshot_id)[0].collect()} == {"A", "B"}


def test_stream_is_applied_once_wherever_it_stops(spark, tmp_path, metadata, monkeypatch):
    """Each batch fails before its writes, between writes and commit, and after the commit, before the stream knows of it."""
    (tmp_path / "log").mkdir()
    store = jobs.graph_store(spark, str(tmp_path / "graph"))
    stream = streaming.change_stream(spark, str(tmp_path / "log"), schemas.CHANGE_LOG)
    run = lambda: streaming.sync_available(stream, store, metadata, str(tmp_path / "mark")).awaitTermination()
    put, add = store.put, store.log.add

    def fails(f):
        def wrapped(*a, **k):
            f(*a, **k)
            raise RuntimeError("stopped")

        return wrapped

    for n, rows in enumerate(BATCHES):
        change_rows(spark, rows).write.mode("append").parquet(str(tmp_path / "log"))
        for target, name, how in ((store, "put", lambda *a: None), (store.log, "add", lambda *a: None), (store.log, "add", add)):
            with monkeypatch.context() as m:
                m.setattr(target, name, fails(how))
                with pytest.raises(Exception, match="stopped"):
                    run()
        assert len(store.log.snapshots()) == n + 1
        run()
        run()
        assert len(store.log.snapshots()) == n + 1 and store.applied("changes") == n
    assert holds(store) == (NODES, EDGES)
    assert sum(r["new_count"] for r in store.checkpoints().collect()) == 3


def batch_operator(spark, paths):
    found = files.latest_runs(spark.createDataFrame([(p,) for p in paths], "path string"))
    return {(r["main"], r["sub"], r["run_id"], r["path"].rpartition("/crawl/")[2]) for r in found.collect()}


def test_newest_runs_of_a_stream_out_of_order(spark, tmp_path):
    """Files of several runs arrive in any order over several batches, some twice under other names."""
    rng = random.Random(4)
    names = [f"m{m}/s{s}/run_id=shop_2024010{r}/part_{p}.json" for m in range(2) for s in range(3) for r in range(1, 5) for p in range(2)] + ["loose.json", "m0/s0/other/part.json"]
    rng.shuffle(names)
    root = tmp_path / "crawl"
    store = BatchStore(spark, str(tmp_path / "runs"), spark.createDataFrame([], "main string, sub string, run_id string, path string").schema)
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    root.mkdir()
    for k in range(0, len(names), 13):
        for name in names[k : k + 13]:
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_text("{}")
        runs.keep_newest(stream.load(str(root)).select("path"), store, str(tmp_path / "mark")).awaitTermination()
        got = {(r["main"], r["sub"], r["run_id"], r["path"].rpartition("/crawl/")[2]) for r in store.current().collect()}
        assert got == batch_operator(spark, [f"/crawl/{n}" for n in names[: k + 13]])
    before = len(store.log.entries())
    # A batch that is given again is passed over.
    again = spark.createDataFrame([("m0", "s0", "zzz", "/crawl/x", True)], runs.RUNS)
    assert not runs.put_runs(store, again, 0, "crawl") and len(store.log.entries()) == before
    assert runs.put_runs(store, again, 99, "crawl") and store.current().where("sub = 's0' and main = 'm0'").count() == 1


def test_late_rerun_of_an_old_batch_is_the_newest(spark, tmp_path, metadata):
    """Changes follow the order of commits: the batch that was written last is compared with the one before it."""
    store = BatchStore.of(spark, str(tmp_path), schemas.TABLES["silver"])
    rows = lambda ids: schemas.conform(spark.createDataFrame([(i, ["x"]) for i in ids], "product_id string, product_ingredients array<string>"), schemas.SILVER)
    for batch, ids in (("2024-01", "ab"), ("2024-02", "bc"), ("2024-01", "cd")):
        store.append(rows(ids), batch)
    log = jobs.to_gold(store, metadata, "g", F.lit(DAY))["change_log"]
    assert sorted((r["product_id"], r["change_type"]) for r in log.collect()) == [("b", "REMOVED"), ("d", "NEW")]


def silver_rows(spark, batch, n, seed):
    """Products with maps, nulls and both zeros; a third changes from batch to batch, some come and go."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rng.random() < 0.8:
            stats = {f"s{k}": {"a": str(rng.choice([1, 1, 2])), "b": None} for k in rng.sample(range(3), 3)}
            rows.append((f"p{i}", rng.choice([None, ["x", None], [None, "x"], ["x"]]), rng.choice([None, 0.0, -0.0, float("nan"), 4.5]), rng.choice([None, 3]), rng.choice([None, stats, stats]), batch))
    return schemas.conform(spark.createDataFrame(rows, "product_id string, product_ingredients array<string>, rating double, review_count int, review_stats map<string, map<string, string>>, batch_job string"), schemas.SILVER)


def test_digests_registry_and_buckets_give_the_same_changes(spark, tmp_path, metadata):
    plain = BatchStore.of(spark, str(tmp_path / "plain"), schemas.TABLES["silver"])
    stores = [jobs.silver_store(spark, str(tmp_path / "digests")), jobs.silver_store(spark, str(tmp_path / "buckets"), buckets=3)]
    registry = jobs.key_registry(spark, str(tmp_path))
    for n in range(4):
        rows = silver_rows(spark, f"b{n}", 60 + 10 * n, n).persist()
        for store in (plain, *stores):
            store.append(rows, f"b{n}")
    assert jobs.record_keys(registry, stores[0]) == 4 and jobs.record_keys(registry, stores[0]) == 0
    every = {r["product_id"] for r in plain.history().select("product_id").distinct().collect()}
    assert sorted(r["product_id"] for r in registry.history().collect()) == sorted(every)

    def log(store, **options):
        return sorted((r["product_id"], r["change_type"], str(r["review_stats"]), str(r["rating"])) for r in jobs.to_gold(store, metadata, "g", F.lit(DAY), **options)["change_log"].collect())

    want = log(plain)
    assert {kind for _, kind, _, _ in want} == {"NEW", "REMOVED", "CHANGED"}
    for store in stores:
        assert log(store) == log(store, registry=registry) == log(store, exact=True) == want
        assert "_digest" not in store.current().columns
    assert stores[1].history().count() == plain.history().count()


def test_bucketed_snapshots_are_joined_without_a_shuffle(spark, tmp_path):
    store = jobs.silver_store(spark, str(tmp_path), buckets=4)
    for n in range(2):
        store.append(silver_rows(spark, f"b{n}", 50, n), f"b{n}")
    before, now = (store.read_snapshot(s.snapshot_id, derived=True) for s in store.latest_two())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = cdc.changes_between(before, now, before, "product_id", digests=jobs.DIGEST)
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        assert changes.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
