"""Registered queries that write the given tables through the stores, exports and streams, and read them back.

Files lie below spark.checkpoint.dir, since what a query returns is read from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery import schemas
from refinery.operators import cdc, matching, quality
from refinery.plans import jobs
from refinery.plans.catalogue import DICT_SQL, GRAPH_SQL, SNAPSHOT_SQL, event_files, history, newest_days, register, table, yearly
from refinery.plans.products import all_changes
from refinery.sources import files
from refinery.sources.scratch import new_folder, staged
from refinery.sources.sinks import BatchStore, export_csv, export_graph_csv
from refinery.streaming import changes as streaming
from refinery.streaming import runs

# ---- snapshots: K1 to K3, K5, K13, K14, S8, W5


@register(
    """with o as (select *, left(o_orderpriority, 1) as p from orders)
select 'first of 2' as what, count(*) as n, sum(o_orderkey)::bigint as keys from o where p = '2'
union all select 'all', count(*), sum(o_orderkey)::bigint from o where p in ('1', '3') or (p = '2' and o_orderstatus = 'F')
union all select 'before', count(*), sum(o_orderkey)::bigint from o where p = '3'
union all select 'now', count(*), sum(o_orderkey)::bigint from o where p = '2' and o_orderstatus = 'F'
union all select 'version 2', count(*), sum(o_orderkey)::bigint from o where p in ('1', '2')"""
)
def snapshot_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities as batches; the second is written again after the third, which makes it the newest. An empty batch is skipped, and one that fails leaves no trace."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("p"))
    store = BatchStore(spark, new_folder(spark), orders.schema)
    for p in "123":
        store.append(orders.where(F.col("p") == p), p)
    store.append(orders.where("p = 'none'"), "4")
    replaced = next(s for s in store.log.live() if s.batch == "2")
    store.overwrite(orders.where("p = '2' and o_orderstatus = 'F'"), "2")
    before, now = store.latest_two()
    parts = {"first of 2": store.read_snapshot(replaced.snapshot_id), "all": store.history(), "before": store.read_snapshot(before.snapshot_id), "now": store.read_snapshot(now.snapshot_id), "version 2": store.history(version=2)}
    out = None
    for what, df in parts.items():
        row = df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(what).alias("what"), "n", "keys")
        out = row if out is None else out.unionByName(row)
    return out


@register("select event_id::varchar as product_id, ts::date as day, event_type as change_type from events where event_type <> 'error' and ts::date >= date '2024-01-10'")
def stored_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared table with files parted by day, whose key must be there; reading some days reads their files."""
    events = table(spark, sf_dir, "events")
    rows = events.select(F.col("event_id").alias("product_id"), F.col("event_type").alias("change_type"), F.col("ts").alias("batch_date"))
    store = BatchStore.of(spark, new_folder(spark), schemas.TABLES["change_log"])
    store.create()
    store.overwrite(rows, "run")
    store.overwrite(rows.where("change_type <> 'error'"), "run")
    return store.current().where("batch_date >= '2024-01-10'").select("product_id", F.to_date("batch_date").alias("day"), "change_type")


@register("select user_id as who, count(*) as n, count(distinct event_type) as kinds from events group by 1")
def expired_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 over the library's own snapshots: a table that was written twice, whose first writing has expired with its files, still holds all its rows."""
    from datetime import datetime, timedelta, timezone

    events = table(spark, sf_dir, "events").select("user_id", "event_type")
    store = BatchStore(spark, new_folder(spark), events.schema)
    for kind in (events.where("user_id is null"), events):
        store.overwrite(kind, "all")
    store.log.expire(datetime.now(timezone.utc) + timedelta(days=1), dry_run=False)
    return store.current().groupBy(F.col("user_id").alias("who")).agg(F.count("*").alias("n"), F.countDistinct("event_type").alias("kinds"))


# ---- files: K11, K12, S2, S5, S9, M2


@register("select c_custkey::varchar as c_custkey, c_name || '|' || c_mktsegment as names, '{\"nation\":' || c_nationkey || '}' as place from customer")
def csv_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays joined, structs as JSON, all read back as text."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.array("c_name", "c_mktsegment").alias("names"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"))
    return files.read_csv_text(spark, export_csv(rows, new_folder(spark), "20240131_235959")).select("c_custkey", "names", "place")


@register("select r_regionkey::varchar as id, r_name as name from region union all select ':ID', 'name'")
def graph_csv_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header's row beside the rows."""
    to = new_folder(spark)
    export_graph_csv(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), [":ID", "name"], to)
    return spark.read.schema("id string, name string").csv([f"{to}/header", f"{to}/data"])


@register("select event_id::varchar as name, event_type as brand, value::varchar as rating from events where event_id % 5 <> 0")
def json_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl's lines, every fifth of them broken."""
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("name"), F.col("event_type").alias("brand"), F.col("value").cast("string").alias("rating")))
    to = new_folder(spark)
    table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{broken "), line)).otherwise(line)).write.text(to)
    return files.read_json(spark, [to], schemas.BRONZE).select("name", "brand", "rating")


@register("select distinct p_name as raw, p_brand as fix, 'regex_boundary' as match_type, 'ingredient' as apply_to from part where p_size = 1")
def rules_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules from a JSON list; the parts of one size stand for a list kept by hand."""
    rules = table(spark, sf_dir, "part").where("p_size = 1").select(F.col("p_name").alias("raw"), F.col("p_brand").alias("fix")).distinct()
    to = new_folder(spark)
    rules.agg(F.to_json(F.collect_list(F.struct("raw", "fix")))).coalesce(1).write.text(to)
    found = files.read_rules(spark, to, "regex_boundary", "ingredient")
    return found.select("raw", "fix", "match_type", "apply_to")


@register(f"with {DICT_SQL} select key, standard from dict")
def dict_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the dictionary from a CSV of names."""
    to = new_folder(spark)
    export_csv(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), to)
    names = files.read_csv_text(spark, to).withColumn("p_partkey", F.col("p_partkey").cast("long"))
    return matching.build_dictionary(names, "p_name", ["p_brand"], "p_partkey")


# ---- metrics and streams: Q4, ST1, ST2


@register("select 'loaded' as metric_name, count(*)::double as metric_value from events union all select 'ok', count(*)::double from events where event_type <> 'error' union all select 'error', count(*)::double from events where event_type = 'error' union all select 'error_rate', round(count(*) filter (event_type = 'error') / count(*), 4) from events union all select 'failed writes', 1.0")
def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, Q3, Q4: metrics as they are written; a write that fails is counted and is no failure of the job."""
    routed = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", "E").alias("error_type"))
    rows = quality.long_form(quality.stage_metrics(routed), "clean", "run", F.lit("2024-01-01").cast("timestamp"), "events", F.current_timestamp())
    store = BatchStore.of(spark, new_folder(spark), schemas.TABLES["dq_metrics"])
    failed = sum(not quality.try_write(lambda name=name: store.append(rows, name)) for name in ("run", "../not a batch"))
    wrong = rows.limit(1).select(F.lit("failed writes").alias("metric_name"), F.lit(float(failed)).alias("metric_value"))
    return store.current().select("metric_name", "metric_value").unionByName(wrong)


@register(
    """with f as (select distinct '/crawl/main/' || event_type || '/run_id=' || strftime(ts, '%Y%m%d') || '/part_' || (event_id % 7)::varchar || '.json' as path, event_type as sub, strftime(ts, '%Y%m%d') as run_id from events)
select path, 'main' as main, sub, run_id from f qualify run_id = max(run_id) over (partition by sub)"""
)
def stream_newest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, S1: a crawl's files in a stream, those of the last days first; the state drops what is older."""
    found = event_files(spark, sf_dir)
    to = new_folder(spark)
    store = BatchStore(spark, f"{to}/runs", spark.createDataFrame([], "main string, sub string, run_id string, path string").schema)
    late = F.regexp_extract("path", r"run_id=(\d+)", 1) >= "20240115"
    for part in (late, ~late):
        found.where(part).write.mode("append").parquet(f"{to}/files")
        stream = spark.readStream.schema(found.schema).parquet(f"{to}/files")
        runs.keep_newest(stream, store, f"{to}/mark").awaitTermination()
    return store.current().select("path", "main", "sub", "run_id")


@register(f"with {GRAPH_SQL} select product_id::varchar as product_id, target from now")
def stream_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, G3 to G9: the log of all years in a stream, applied once to the graph's store. The last batch is given twice."""
    log = all_changes(staged(yearly(spark, sf_dir))).select(F.col("product_id").cast("string").alias("product_id"), "change_type", F.col("items").alias("product_ingredients"), F.make_date("batch", F.lit(1), F.lit(1)).cast("timestamp").alias("batch_date"), F.col("batch").cast("string").alias("batch_job"))
    metadata = table(spark, sf_dir, "part").select(F.col("p_brand").alias("kor_name"), F.col("p_brand").alias("inci_name")).distinct()
    to = new_folder(spark)
    schemas.conform(log, schemas.CHANGE_LOG).write.parquet(f"{to}/log")
    store = jobs.graph_store(spark, f"{to}/graph")
    stream = streaming.change_stream(spark, f"{to}/log", schemas.CHANGE_LOG)
    for mark in ("mark", "mark of a lost checkpoint"):
        streaming.sync_available(stream, store, metadata, f"{to}/{mark}").awaitTermination()
    return store.read()[1]


@register(f"with {SNAPSHOT_SQL} select product_id, change_type from log")
def stored_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 to C3, J4 to J6, K13 by way of the stores: snapshots in buckets of their key, compared by digests made when they were written; new keys from the registry."""
    rows, tracked = history(spark, sf_dir), ("rating", "review_count", "review_stats")
    before, now = newest_days(spark, sf_dir)
    fields = rows.drop("day")
    to = new_folder(spark)
    key = ("product_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    store = BatchStore(spark, f"{to}/silver", fields.schema, buckets=key, derived={jobs.DIGEST: cdc.digest(fields, tracked)})
    registry = jobs.key_registry(spark, to)
    for name, part in (("earlier", F.col("day") < before), ("before", F.col("day") == before), ("now", F.col("day") == now)):
        store.overwrite(rows.where(part), name)
    jobs.record_keys(registry, store)
    old, new = (store.read_snapshot(s.snapshot_id, derived=True) for s in store.latest_two())
    known = new.select("product_id").join(registry.read("now"), "product_id", "left_anti")
    return cdc.changes_between(old, new, known, "product_id", tracked, digests=jobs.DIGEST).select("product_id", "change_type")
