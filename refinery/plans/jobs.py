"""The batch jobs from crawl to graph, as plans over the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import schemas
from refinery.functions import text as X
from refinery.operators import batch, cdc, graph, marts, matching, quality, routing, rules
from refinery.sources.graph_store import GraphStore
from refinery.sources.sinks import BatchStore

REQUIRED = ("name", "brand", "url", "ingredients", "main_category", "sub_category", "crawled_at")


@dataclass
class CleaningRules:
    """names: (pattern, fix) of product names; boundary, plain: typo rules of ingredients; exact, contains: names of crawl leftovers."""

    names: list[tuple[str, str]] = ()
    boundary: list[dict] = ()
    plain: list[dict] = ()
    exact: list[str] = field(default_factory=lambda: list(routing.GARBAGE_EXACT))
    contains: list[str] = field(default_factory=lambda: list(routing.GARBAGE_CONTAINS))

    @classmethod
    def of(cls, typos: DataFrame, keywords: DataFrame) -> CleaningRules:
        """The rules of the synced tables, which are lists kept by hand and so small."""
        rows = [r.asDict() for r in typos.select("raw", "fix", "match_type", "apply_to").collect()]
        words = keywords.select("match_type", "keyword").collect()
        of = lambda kind: [r for r in rows if r["apply_to"] == "ingredient" and r["match_type"] == kind]
        names = X.name_rules([r for r in rows if r["apply_to"] == "product_name"])
        return cls(names, of("regex_boundary"), of("simple"), *([r["keyword"] for r in words if r["match_type"] == kind] for kind in ("exact", "contains")))


@dataclass
class Refined:
    """Silver and dead letters of a crawl. Their metrics are gathered while the two are written, by no job of their own."""

    silver: DataFrame
    errors: DataFrame
    run: tuple[str, Column]
    seen: tuple[Observation, Observation]
    kept: tuple[DataFrame, ...] = ()

    def metrics(self) -> DataFrame:
        """To be asked for once silver and errors have been written or otherwise run whole; waits for that."""
        matched, failed = self.seen[0].get, self.seen[1].get["error"]
        ok, both, dropped = matched["ok"], matched["rows_both"], matched["rows_dropped"]
        # Each row is in silver or among the errors, in both or in neither.
        values = {"loaded": ok + failed - both + dropped, "ok": ok, "error": failed, "rows_both": both, "rows_dropped": dropped}
        wide = self.silver.sparkSession.createDataFrame([tuple(values.values())], ", ".join(f"{c} long" for c in values))
        wide = wide.withColumn("error_rate", X.rate(F.col("error"), F.col("ok") + F.col("error")))
        batch_job, batch_date = self.run
        return quality.long_form(wide, "bronze_to_silver", batch_job, batch_date, "silver_current", F.current_timestamp())

    def write(self, silver: BatchStore, errors: BatchStore, metrics: BatchStore, batch: str) -> bool:
        """Appends all three as the batch and lets go of what was kept. Metrics that cannot be written are no failure; whether they were."""
        try:
            silver.append(self.silver, batch)
            errors.append(self.errors, batch)
            return quality.try_write(lambda: metrics.append(self.metrics(), batch))
        finally:
            self.release()

    def release(self) -> None:
        """Lets go of what was kept for the outputs, once they are written."""
        for df in self.kept:
            df.unpersist()


def clean(bronze: DataFrame, by: CleaningRules) -> DataFrame:
    """Cleaned columns and error_type (the first failing rule, else null) of each crawled row."""
    strings = {c: X.text(F.col(c)) for c in ("name", "brand", "url", "ingredients", "main_category", "sub_category", "goods_no")}
    df = bronze.withColumns(strings | {"crawled_at": X.safe_timestamp(F.col("crawled_at")), "rating": X.safe_double(F.col("rating")).cast("float"), "review_count": X.safe_int(F.col("review_count"))})
    fields = {c: (F.col(c).isNull() if c == "crawled_at" else X.blank(F.col(c))) for c in REQUIRED}
    df = df.withColumn("missing", X.missing_fields(fields))
    df = df.withColumn("clean_name", X.clean_name(F.col("name"), list(by.names)))
    df = df.withColumn("_text", X.fix_typos(X.drop_notices(X.unify_separators(F.col("ingredients"))), list(by.boundary), list(by.plain)))
    df = df.withColumn("_headers", X.header_count(F.col("_text")))
    df = df.withColumn("clean_text", X.drop_concentrations(X.strip_header(F.col("_text"))))
    checks = [
        (routing.INCOMPLETE, F.size("missing") > 0),
        (routing.OPTIONS, F.col("name").rlike(X.OPTION_BUNDLE)),
        (routing.METADATA, X.exact_keyword(F.col("name"), by.exact) | X.holds_keyword(F.col("name"), by.contains)),
        (routing.BUNDLE, (X.main_item_count(F.col("_text")) >= 2) | (F.col("_headers") >= 2)),
    ]
    df = df.withColumn("error_type", routing.first_failure(checks))
    early = F.col("error_type").isin(routing.INCOMPLETE, routing.OPTIONS, routing.METADATA)
    named = F.when(early, F.col("name")).otherwise(F.col("clean_name"))
    return df.withColumns({"product_id": X.stable_id(F.col("brand"), named), "category": rules.classify(F.col("clean_name"), F.col("main_category"), F.col("sub_category"), F.col("name"))})


def error_row(df: DataFrame, reason: Column) -> DataFrame:
    """The dead-letter columns of a row."""
    named = df.withColumns({"product_brand": F.col("brand"), "product_name_raw": F.col("name"), "product_name": F.col("clean_name"), "product_ingredients_raw": F.col("ingredients"), "product_url": F.col("url"), "residual_text": reason})
    return schemas.conform(named, schemas.SILVER_ERROR)


def refine(bronze: DataFrame, dictionary: DataFrame, by: CleaningRules, batch_job: str, batch_date: Column, core: str | None = None) -> Refined:
    """Bronze to silver and dead letters. The routed frame is kept for the two, so the text rules run once; ``release`` lets it go."""
    cleaned = batch.stamp(clean(bronze, by), batch_job, batch_date).persist()
    ok, bad = routing.split(cleaned)
    order = [F.length("clean_text"), F.col("url"), F.col("ingredients")]
    ranked = routing.keep_best(ok, [F.col("brand"), X.despace(F.col("clean_name"))], order)
    duplicates = ranked.where("not is_best").withColumn("error_type", F.lit(routing.DUPLICATE))
    best = ranked.where("is_best").withColumn("_search", matching.prepared(F.col("clean_text")))
    matched = matching.match(best, dictionary, "_search").persist()
    hidden = matching.repeats(F.col("matches"), core) if core else F.lit(False)
    bundles = matched.where(hidden).withColumn("error_type", F.lit(routing.HIDDEN))
    seen, failed = Observation(), Observation()
    plain = matched.where(~hidden)
    with_hits, _ = routing.after_match(plain.observe(seen, F.count_if(F.size("matches") > 0).alias("ok"), *routing.ends()))
    leftover = routing.after_match(plain)[1]
    silver = with_hits.withColumns(
        {"product_brand": F.col("brand"), "product_name": F.col("clean_name"), "product_name_raw": F.col("name"), "product_ingredients": matching.ordered_distinct(F.col("matches")), "product_ingredients_raw": F.col("ingredients"), "product_url": F.col("url"), "review_stats": schemas.stats(F.col("review_stats"))}
    )
    silver = schemas.conform(silver, schemas.SILVER)
    errors = error_row(bad, F.when(F.col("error_type") == routing.INCOMPLETE, F.array_join("missing", ", ")).otherwise(F.col("name")))
    errors = errors.unionByName(error_row(duplicates, F.col("clean_text"))).unionByName(error_row(bundles, F.array_join("matches", ", "))).unionByName(error_row(leftover, X.unmask(F.col("residual"))))
    return Refined(silver, errors.observe(failed, F.count(F.lit(1)).alias("error")), (batch_job, batch_date), (seen, failed), (cleaned, matched))


DIGEST = "_digest"


def silver_store(spark: SparkSession, root: str, buckets: int | None = None) -> BatchStore:
    """Silver with digests of the tracked fields, and laid out by product_id in so many buckets."""
    table = schemas.TABLES["silver"]
    made = {DIGEST: cdc.digest(spark.createDataFrame([], table.schema))}
    if buckets:
        return BatchStore(spark, f"{root}/{table.name}", table.schema, [F.col("product_id")], buckets=("product_id", buckets), derived=made)
    return BatchStore(spark, f"{root}/{table.name}", table.schema, [F.col(c).asc_nulls_last() for c in table.sort], table.by(), derived=made)


def record_keys(registry: BatchStore, silver: BatchStore) -> int:
    """Adds to the registry, batch by batch in the order of commits, the keys that each batch of silver had first; batches it has are passed over. How many batches were added.

    The registry has one row for each key ever seen. A batch costs its own keys, those of the batch before and
    the registry's hits, however long the history is.
    """
    done, added = set(registry.batches()), 0
    batches = silver.log.live()
    for n, s in enumerate(batches):
        if s.batch not in done:
            now = silver.read_snapshot(s.snapshot_id).select("product_id")
            before = silver.read_snapshot(batches[n - 1].snapshot_id).select("product_id") if n else now.limit(0)
            registry.append(cdc.first_seen(now, before, registry.history(), "product_id"), s.batch, skip_empty=False)
            added += 1
    return added


def key_registry(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, f"{root}/seen_keys", T.StructType([T.StructField("product_id", T.StringType())]), [F.col("product_id")])


def to_gold(store: BatchStore, metadata: DataFrame, batch_job: str, batch_date: Column, registry: BatchStore | None = None, **options) -> dict[str, DataFrame]:
    """Silver history to change log, frequency mart and enrichment mart of the newest batch.

    With a ``registry`` that has the newest batch, NEW comes from it and not from the keys of all history. A
    store with digests is compared by them.
    """
    now = store.current()
    if pair := store.latest_two():
        before, newest = pair
        by = DIGEST if DIGEST in store.derived else None
        old, new = store.read_snapshot(before.snapshot_id, bool(by)), store.current(bool(by))
        earlier = store.history().where(F.col("_batch") != newest.batch)
        if registry:
            # Keys of the batch that were there before it.
            earlier = now.select("product_id").join(registry.read(newest.batch), "product_id", "left_anti")
        changes = cdc.changes_between(old, new, earlier, "product_id", digests=by, **{k: v for k, v in options.items() if k != "initial_as_new"})
    else:
        changes = cdc.change_log(store.history(), "_batch", "product_id", **options)
    top = marts.top_per_category(marts.usage(now, "category", "product_ingredients"))
    items = now.select("product_id", F.explode("product_ingredients").alias("ingredient_name")).where(F.col("ingredient_name").isNotNull())
    counts = marts.distinct_usage(items, "ingredient_name", "product_id")
    return {
        "change_log": cdc.log_rows(changes, batch_job, batch_date),
        "frequency": schemas.conform(batch.stamp(top, batch_job, batch_date), schemas.FREQUENCY),
        "mart": schemas.conform(batch.stamp(marts.enrich(counts, metadata, "kor_name"), batch_job, batch_date), schemas.MART),
    }


#: Properties of the graph's nodes besides their key.
NODE = ["product_name", "product_brand", "category_id", "goods_no"]


def _targets(metadata: DataFrame) -> DataFrame:
    """(name, target): of several INCI names of one name the last in the metadata's order."""
    return matching.last_wins(metadata.select(F.col("kor_name").alias("name"), F.col("inci_name").alias("target"), F.monotonically_increasing_id().alias("_o")), "name", "target", "_o")


def sync_graph(nodes: DataFrame, edges: DataFrame, changes: DataFrame, metadata: DataFrame, mark, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, checkpoint row) after the change-log batches beyond the mark."""
    waiting = graph.pending(changes, mark, "batch_date")
    after = graph.apply(nodes, edges, waiting, _targets(metadata), "product_id", "batch_date", NODE, "product_ingredients")
    return after[0], after[1], graph.checkpoint_row(waiting, "batch_job", now)


def graph_store(spark: SparkSession, path: str) -> GraphStore:
    """The store of the graph of products and INCI names."""
    fields = {f.name: f for f in schemas.CHANGE_LOG.fields}
    nodes = T.StructType([fields[c] for c in ("product_id", *NODE)])
    return GraphStore(spark, path, nodes, T.StructType([fields["product_id"], T.StructField("target", T.StringType())]))


def _put_changes(store: GraphStore, waiting: DataFrame, metadata: DataFrame, notes: dict, batch: str | None = None) -> bool:
    """Applies ``waiting`` to the newest snapshot and commits the result with the mark and counts; False where nothing waits and ``notes`` need no commit."""
    of = graph.checkpoint_row(waiting, "batch_job", F.current_timestamp()).first()
    if of is None and not notes:
        return False
    if of:
        latest = waiting.agg(F.unix_micros(F.max("batch_date"))).first()[0]
        notes = notes | {"batch_job": of["batch_job"], "mark_us": latest, "new": of["new_count"], "removed": of["removed_count"], "changed": of["changed_count"]}
    nodes, edges = store.read()
    after = graph.apply(nodes, edges, waiting, _targets(metadata), "product_id", "batch_date", NODE, "product_ingredients")
    store.put(*after, batch or of["batch_job"], notes)
    return True


def run_sync(store: GraphStore, changes: DataFrame, metadata: DataFrame) -> bool:
    """G3 to G8 from the store's last checkpoint: applies the change-log batches beyond it, in their order, and commits nodes, edges and
    checkpoint together. Again after a failure, or without new batches, it changes nothing. Whether anything was applied."""
    return _put_changes(store, graph.pending(changes, store.mark(), "batch_date"), metadata, {})


def apply_stream_batch(store: GraphStore, changes: DataFrame, number: int, source: str, metadata: DataFrame) -> bool:
    """ST1, G8: one batch of the change stream ``source``, exactly once: its number is part of the commit, and a number that was committed is passed over."""
    if number <= store.applied(source):
        return False
    return _put_changes(store, changes, metadata, {"source": source, "number": number}, f"{source}-{number}")
