"""The registered queries over the given tables, each with its SQL counterpart.

Stand-ins: an order with its parts' names is a product with ingredients, the order's priority its
category; a day of events is a batch, a user its entity; documents are free text, words of the
benchmark texts the dictionary.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions import text as X
from refinery.operators import batch, cdc, graph, marts, matching, quality, routing, rules
from refinery.operators.partitioning import dealt
from refinery.schemas import conform, stats
from refinery.sources import files
from refinery.sources.scratch import staged


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_all: dict[str, Query] = {}


def register(sql: str | None = None):
    def add(run):
        _all[run.__name__] = Query(run, sql)
        return run

    return add


def _complete() -> None:
    # Registers its own queries when it is read.
    from refinery.plans import products, stored  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _complete()
    return {name: q.run for name, q in _all.items()}


def oracle_sql() -> dict[str, str]:
    _complete()
    return {name: q.sql for name, q in _all.items() if q.sql}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return files.read_table(spark, f"{sf_dir}/{name}.parquet")


# ---- frequency, enrichment and edges

ITEMS_SQL = "select o_orderpriority as category_id, p_name as ingredient_name from lineitem join part on l_partkey = p_partkey join orders on o_orderkey = l_orderkey where length(p_name) > 1 and not regexp_full_match(p_name, '[0-9]+')"
TOP_SQL = f"""
with items as ({ITEMS_SQL}),
counts as (
  select category_id, ingredient_name, count(*) as usage_count, false as total from items group by 1, 2
  union all select null, ingredient_name, count(*), true from items group by 2),
ranked as (select *, row_number() over (partition by total, category_id order by usage_count desc, ingredient_name) as rank from counts)
select case when total then 'TOTAL' else category_id end as category_id, ingredient_name, usage_count, rank::int as rank from ranked where rank <= {{k}}
"""


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return line.join(part, "l_partkey")


@register(TOP_SQL.format(k=50))
def topk_items_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    rows = line_items(spark, sf_dir).select("l_orderkey", "p_name").join(orders, "l_orderkey")
    return marts.top_per_category(marts.usage(rows, "o_orderpriority", "p_name"), 50)


@register(TOP_SQL.format(k=10))
def topn_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.read_back(topk_items_per_category(spark, sf_dir), n=10)


@register("select o_orderkey as product_id, list_sort(list(p_name)) as items from lineitem join part on l_partkey = p_partkey join orders on o_orderkey = l_orderkey group by 1")
def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_items(spark, sf_dir).groupBy(F.col("l_orderkey").alias("product_id")).agg(F.sort_array(F.collect_list("p_name")).alias("items"))


@register("select p_name as ingredient_name, count(distinct l_orderkey) as usage_count from lineitem join part on l_partkey = p_partkey group by 1")
def item_usage_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_usage(line_items(spark, sf_dir), "p_name", "l_orderkey")


@register(
    """with u as (select p_name as ingredient_name, count(distinct l_orderkey) as usage_count from lineitem join part on l_partkey = p_partkey group by 1),
m as (select distinct p_name as kor_name, p_brand as brand, p_type as status from part)
select ingredient_name, usage_count, brand, status from u left join m on ingredient_name = kor_name"""
)
def enriched_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    metadata = part.select(F.col("p_name").alias("kor_name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("status")).distinct()
    return marts.enrich(item_usage_distinct(spark, sf_dir), metadata, "kor_name").drop("kor_name")


@register("select distinct l_orderkey as product_id, p_brand as target from lineitem join part on l_partkey = p_partkey where p_brand is not null")
def edges_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product_id"), "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("target"))
    return marts.edges(line, part, "product_id", "l_partkey", "p_partkey", "target")


@register("select c_custkey as id, c_name as name, c_mktsegment as category from customer where c_custkey is not null qualify row_number() over (partition by c_custkey order by c_name) = 1")
def nodes_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nodes(table(spark, sf_dir, "customer"), "c_custkey", {"c_custkey": "id", "c_name": "name", "c_mktsegment": "category"}, [F.col("c_name")])


@register("select distinct o_orderpriority as category_id from orders")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category_id")).distinct()


# ---- selection of runs


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the files of a crawl: one for each type and day."""
    day = F.date_format("ts", "yyyyMMdd")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("/crawl/main/"), F.col("event_type"), F.lit("/run_id="), day, F.lit("/part_"), (F.col("event_id") % 7).cast("string"), F.lit(".json")).alias("path")).distinct()


@register(
    """with f as (select distinct '/crawl/main/' || event_type || '/run_id=' || strftime(ts, '%Y%m%d') || '/part_' || (event_id % 7)::varchar || '.json' as path, event_type as sub, strftime(ts, '%Y%m%d') as run_id from events)
select path, 'main' as main, sub, run_id from f qualify run_id = max(run_id) over (partition by sub)"""
)
def latest_run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.latest_runs(event_files(spark, sf_dir))


@register("select e.event_id, e.event_type from events e join (select event_type, max(ts::date) as d from events group by 1) m on e.event_type = m.event_type and e.ts::date = m.d")
def latest_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("run"))
    newest = events.groupBy("event_type").agg(F.max("run").alias("run"))
    return events.join(newest, ["event_type", "run"]).select("event_id", "event_type")


@register("select 'dict/batch=' || max(strftime(ts, '%Y-%m')) || '/names.csv' as path, max(strftime(ts, '%Y-%m')) as batch from events")
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = table(spark, sf_dir, "events").select(F.concat(F.lit("dict/batch="), F.date_format("ts", "yyyy-MM"), F.lit("/names.csv")).alias("path")).distinct()
    return files.latest_month(months)


# ---- changes between batches

SNAPSHOT_SQL = """
per as (select user_id::varchar || ':' || coalesce(json_extract_string(props, '$.k'), '') as product_id, ts::date as day, event_type, count(*) as n, sum(value) as total from events group by 1, 2, 3),
history as (select product_id, day, sum(n)::bigint as review_count, round(sum(total), 3) as rating,
  list_sort(list(event_type || '=' || n)) as types from per group by 1, 2),
pair as (select max(day) as now, max(day) filter (day < (select max(day) from history)) as before from history),
now as (select h.* from history h, pair where h.day = pair.now), old as (select h.* from history h, pair where h.day = pair.before),
earlier as (select distinct product_id from history h, pair where h.day < pair.now),
new as (select product_id, review_count, rating, 'NEW' as change_type from now where product_id not in (select product_id from earlier)),
removed as (select product_id, review_count, rating, 'REMOVED' as change_type from old where product_id not in (select product_id from now)),
changed as (select n.product_id, n.review_count, n.rating, 'CHANGED' as change_type from now n join old o using (product_id)
  where n.review_count is distinct from o.review_count or n.rating is distinct from o.rating or n.types is distinct from o.types),
log as (select * from new union all select * from removed union all select * from changed)
"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, day, rating, review_count, review_stats) of each user and kind of event, by day; review_stats is a map by type."""
    events = table(spark, sf_dir, "events")
    entity = F.concat_ws(":", F.col("user_id"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("")))
    per = events.groupBy(entity.alias("product_id"), F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    entries = F.map_from_entries(F.collect_list(F.struct("event_type", F.col("n").cast("string"))))
    return per.groupBy("product_id", "day").agg(F.sum("n").alias("review_count"), F.round(F.sum("total"), 3).alias("rating"), entries.alias("review_stats"))


def newest_days(spark: SparkSession, sf_dir: str) -> tuple:
    return cdc.latest_two(table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")), "day")


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.change_log(history(spark, sf_dir), "day", "product_id", ("rating", "review_count", "review_stats"), pair=newest_days(spark, sf_dir))


@register(f"with {SNAPSHOT_SQL} select * from log")
def cdc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_changes(spark, sf_dir).select("product_id", "review_count", "rating", "change_type")


@register(f"with {SNAPSHOT_SQL} select product_id from new")
def cdc_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_changes(spark, sf_dir).where("change_type = 'NEW'").select("product_id")


@register(f"with {SNAPSHOT_SQL} select product_id from removed")
def cdc_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_changes(spark, sf_dir).where("change_type = 'REMOVED'").select("product_id")


@register(f"with {SNAPSHOT_SQL} select n.product_id from now n join old o using (product_id) where n.types is distinct from o.types")
def cdc_map_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir)
    before, now = (rows.where(F.col("day") == F.lit(d)) for d in newest_days(spark, sf_dir))
    return cdc.changed_rows(before, now, "product_id", ("review_stats",)).select("product_id")


@register(f"with {SNAPSHOT_SQL} select count(*) filter (change_type = 'NEW') as new_count, count(*) filter (change_type = 'REMOVED') as removed_count, count(*) filter (change_type = 'CHANGED') as changed_count from log")
def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.change_counts(user_changes(spark, sf_dir))


@register("select day::date as day from (select distinct ts::date as day from events order by 1 desc limit 2)")
def latest_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"))
    return days.distinct().orderBy(F.desc("day")).limit(2)


# ---- cleaning


@register("select doc_id, trim(regexp_replace(translate(regexp_replace(regexp_replace(text, '\\[.*?\\]|\\(.*?\\)', ' ', 'g'), '[\\r\\n\\t]', '', 'g'), '@|', ',,'), '\\s+', ' ', 'g')) as clean from documents")
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.collapse(X.unify_separators(F.regexp_replace("text", X.NAME_BRACKET, " "))).alias("clean"))


@register("select doc_id, regexp_replace(regexp_replace(text, '([A-Za-z0-9]),([A-Za-z0-9])', '\\1_C_\\2', 'g'), '([A-Za-z0-9]),([A-Za-z0-9])', '\\1_C_\\2', 'g') as masked from documents")
def mask_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.mask_commas(F.col("text")).alias("masked"))


TYPOS = [{"raw": "tionnt", "fix": "tion"}, {"raw": "eaux", "fix": "eau"}, {"raw": "thth", "fix": "th"}, {"raw": "nt.", "fix": "nd."}]


@register("select doc_id, replace(replace(replace(replace(text, 'tionnt', 'tion'), 'eaux', 'eau'), 'thth', 'th'), 'nt.', 'nd.') as fixed from documents")
def typo_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.fix_typos(F.col("text"), [], TYPOS).alias("fixed"))


NORMS = [{"raw": r"(\w+)\s+\1", "fix": "twice", "match_type": "simple"}, {"raw": r"[aeiou]{2,}", "fix": "o"}, {"raw": " ", "fix": "_", "match_type": "simple"}]


@register("select p_partkey, replace(regexp_replace(p_name, '[aeiou]{2,}', 'o', 'g'), ' ', '_') as norm from part")
def name_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.replace_all(F.col("p_name"), X.name_rules(NORMS)).alias("norm"))


@register("select doc_id, len(regexp_extract_all(text, '<[^>]+>|■\\s*[^:■]+:\\s*|\\|')) as headers from documents")
def header_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.header_count(F.col("text"), r"(?U)<[^>]+>|■\s*[^:■]+:\s*|\|").cast("long").alias("headers"))


@register(
    f"""with h as (select p_partkey, sha1(unhex('{X.NAMESPACE.hex}') || encode(p_brand || '||' || p_name)) as s from part)
select p_partkey, substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || translate(substr(s, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(s, 18, 3) || '-' || substr(s, 21, 12) as product_id from h"""
)
def stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.stable_id(F.col("p_brand"), F.col("p_name")).alias("product_id"))


@register("select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as double), 0.0) as as_double, coalesce(try_cast(trunc(try_cast(json_extract_string(props, '$.k') as double)) as int), 0) as as_int from events")
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", X.safe_double(k).alias("as_double"), X.safe_int(k).alias("as_int"))


@register("select event_id, coalesce(json_extract_string(props, '$.k'), '') as leaf, [event_type] as kinds from events")
def norm_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = stats(F.create_map(F.col("event_type"), F.from_json("props", "map<string, string>")))
    leaf = F.coalesce(F.element_at(F.element_at(nested, F.col("event_type")), "k"), F.lit(""))
    return table(spark, sf_dir, "events").select("event_id", leaf.alias("leaf"), F.array("event_type").alias("kinds"))


EVENT_SCHEMA = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("event_id", T.LongType()), T.StructField("goods_no", T.StringType()), T.StructField("value", T.FloatType())])


@register("select user_id::varchar as user_id, event_id, null::varchar as goods_no, value::float as value from events")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events"), EVENT_SCHEMA)


# ---- routing and dedup

ROUTE_SQL = """
labelled as (select d.*, l.quality, l.toxic from documents d left join labels l using (doc_id)),
routed as (select doc_id, case
  when text is null or regexp_full_match(text, '\\s*(nan)?\\s*') or quality is null then 'INCOMPLETE_DATA_REJECTED'
  when regexp_matches(text, '[0-9]+\\s*(ml|kg)') then 'OPTION_BUNDLE_REJECTED'
  when contains(text, 'http://') or contains(text, 'https://') or contains(text, '<div') then 'INVALID_METADATA_REJECTED'
  when len(regexp_extract_all(text, '\\|')) >= 2 then 'HETEROGENEOUS_BUNDLE_REJECTED' end as error_type from labelled)
"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    checks = [
        (routing.INCOMPLETE, X.blank(text) | F.col("quality").isNull()),
        (routing.OPTIONS, text.rlike(r"[0-9]+\s*(ml|kg)")),
        (routing.METADATA, X.holds_keyword(text, ["http://", "https://", "<div"])),
        (routing.BUNDLE, X.header_count(text, r"\|") >= 2),
    ]
    return labelled(spark, sf_dir).select("doc_id", routing.first_failure(checks).alias("error_type"))


@register(f"with {ROUTE_SQL} select * from routed")
def route_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed(spark, sf_dir)


@register(f"with {ROUTE_SQL} select error_type, count(*) as n from routed where error_type is not null group by 1")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.split(routed(spark, sf_dir))[1].groupBy("error_type").agg(F.count("*").alias("n"))


@register(
    f"""with {ROUTE_SQL}, m as (select count(*)::double as loaded, count(*) filter (error_type is null)::double as ok, count(error_type)::double as error, round(count(error_type) / count(*), 4) as error_rate from routed)
select metric_name, metric_value, 'clean' as stage, 'silver' as target_table from (unpivot m on loaded, ok, error, error_rate into name metric_name value metric_value)"""
)
def dq_eav(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = quality.stage_metrics(routed(spark, sf_dir))
    rows = quality.long_form(wide, "clean", "run", F.lit("2024-01-31").cast("timestamp"), "silver", F.lit("2024-01-31").cast("timestamp"))
    return rows.select("metric_name", "metric_value", "stage", "target_table")


@register("select doc_id, array_to_string(list_filter([case when quality is null then 'quality' end, case when toxic is null then 'toxic' end, case when text is null or regexp_full_match(text, '\\s*(nan)?\\s*') then 'text' end], lambda x: x is not null), ',') as missing from documents left join labels using (doc_id)")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"quality": F.col("quality").isNull(), "toxic": F.col("toxic").isNull(), "text": X.blank(F.col("text"))}
    return labelled(spark, sf_dir).select("doc_id", F.array_join(X.missing_fields(fields), ",").alias("missing"))


DEDUP_SQL = "select doc_id, lang, row_number() over (partition by lang, replace(text, ' ', '') order by n_chars, doc_id) as turn from documents"


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", X.despace(F.col("text")).alias("norm"))
    return routing.keep_best(docs, [F.col("lang"), F.col("norm")], [F.col("n_chars"), F.col("doc_id")])


@register(f"select doc_id, lang from ({DEDUP_SQL}) where turn = 1")
def dedup_keep_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(spark, sf_dir).where("is_best").select("doc_id", "lang")


@register(f"select doc_id, 'DUPLICATE_PRODUCT_REJECTED' as error_type from ({DEDUP_SQL}) where turn > 1")
def dedup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(spark, sf_dir).where("not is_best").select("doc_id", F.lit(routing.DUPLICATE).alias("error_type"))


# ---- dictionary matching

WORDS_SQL = "words as (select distinct unnest(regexp_extract_all(text, '[A-Za-z]{6,}')) as key from benchmark)"


def word_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark")
    words = bench.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{6,}"), F.lit(0))).alias("key")).distinct()
    return words.select("key", F.upper("key").alias("standard"))


MATCH_SQL = f"with {WORDS_SQL}, p as (select string_agg(key, '|' order by length(key) desc, key) as p from words)"


@register(f"{MATCH_SQL} select doc_id, list_transform(regexp_extract_all(coalesce(text, ''), p), lambda x: upper(x)) as matches from documents, p")
def dict_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.match(table(spark, sf_dir, "documents").select("doc_id", "text"), word_dictionary(spark, sf_dir), "text")
    return found.select("doc_id", "matches")


@register(f"{MATCH_SQL} select doc_id, regexp_replace(coalesce(text, ''), p, '', 'g') as residual from documents, p")
def dict_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.match(table(spark, sf_dir, "documents").select("doc_id", "text"), word_dictionary(spark, sf_dir), "text")
    return found.select("doc_id", "residual")


@register("select doc_id, len(regexp_extract_all(text, 'tionthe|tion')) as n, len(list_filter(regexp_extract_all(text, 'tionthe|tion'), lambda x: x = 'tion')) >= 2 as repeated from documents")
def core_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.match_small(table(spark, sf_dir, "documents").select("doc_id", "text"), ["tion", "tionthe"], "text")
    return found.select("doc_id", F.size("matches").cast("long").alias("n"), matching.repeats(F.col("matches"), "tion").alias("repeated"))


DICT_SQL = """
names as (select p_partkey, unnest([p_name, p_brand]) as name, unnest([1, 2]) as place, p_name as standard from part),
keys as (select standard, p_partkey, place, unnest([replace(trim(name), ',', '_C_'), replace(replace(trim(name), ',', '_C_'), ' ', '')]) as key, unnest([1, 2]) as form from names),
dict as (select key, arg_max(standard, (p_partkey, place, form, standard)) as standard from keys group by 1)
"""


def part_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.build_dictionary(table(spark, sf_dir, "part"), "p_name", ["p_brand"], "p_partkey")


@register(f"with {DICT_SQL} select key, standard from dict")
def dict_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_dictionary(spark, sf_dir)


@register(f"with {DICT_SQL}, s as (select distinct r_name as raw from region), over as (select p_brand as raw, max(p_type) as standard from part group by 1) select d.key, coalesce(o.standard, d.standard) as standard from dict d left join (select replace(raw, ' ', '') as key, standard from over union select raw, standard from over) o using (key) union all select key, 'REGION' from (select raw as key from s union select replace(raw, ' ', '') from s) where key not in (select key from dict)")
def dict_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = table(spark, sf_dir, "region").select(F.col("r_name").alias("raw"), F.lit("REGION").alias("standard"), F.lit("add").alias("action")).distinct()
    forced = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("raw")).agg(F.max("p_type").alias("standard")).withColumn("action", F.lit("override"))
    return matching.overlay(part_dictionary(spark, sf_dir), added.unionByName(forced))


@register("select p_name as name, max_by(p_brand, (p_partkey, p_brand)) as inci from part group by 1")
def lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("inci"), "p_partkey")
    return matching.last_wins(rows, "name", "inci", "p_partkey")


@register("select p_partkey, case when p_size > 40 then case when p_name ilike '%blue%' then 'blue' when p_name ilike '%red%' then 'red' else 'large' end when p_size <= 10 then 'small' else 'other' end as class from part")
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    choices = {("part", "large"): rules.Choice(("blue", "red"), "large"), ("part", "small"): rules.Choice((), "small")}
    sub = F.when(F.col("p_size") > 40, "large").when(F.col("p_size") <= 10, "small").otherwise("middle")
    found = rules.classify(F.col("p_name"), F.lit("part"), sub, None, choices, {"blue": "blue", "red": "red"}, "other")
    return table(spark, sf_dir, "part").select("p_partkey", found.alias("class"))


# ---- graph, retention and dimensions


@register(f"with {SNAPSHOT_SQL} select product_id, change_type from log where change_type <> 'REMOVED'")
def pending_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = user_changes(spark, sf_dir).withColumn("applied", F.when(F.col("change_type") == "REMOVED", F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")))
    return graph.pending(stamped, "2024-01-01", "applied").select("product_id", "change_type")


GRAPH_SQL = """
sales as (select o_custkey as product_id, year(o_orderdate) as y, p_brand as target from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey),
years as (select max(y) as now from sales),
now as (select distinct product_id, target from sales, years where y = now)
"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, batch, items): the brands that each customer bought in each year."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("product_id"), F.year("o_orderdate").alias("batch"))
    return dealt(line_items(spark, sf_dir).select("l_orderkey", "p_brand"), "l_orderkey").join(orders, "l_orderkey").groupBy("product_id", "batch").agg(F.sort_array(F.collect_set("p_brand")).alias("items"))


def graph_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The graph of the year before, after the newest year's changes. Customers that come back after a gap are new."""
    pair = cdc.latest_two(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("batch")), "batch")
    sales = staged(yearly(spark, sf_dir).where(F.col("batch").isin(*pair)))
    changes = cdc.change_log(sales, "batch", "product_id", ("items",), pair=pair, reappear_as_new=True)
    lookup = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_brand").alias("target")).distinct()
    before = sales.where(F.col("batch") == F.lit(pair[0]))
    old_edges = before.select("product_id", F.explode("items").alias("target"))
    return graph.apply(before.select("product_id"), old_edges, changes, lookup, "product_id", "batch", [], "items")


@register(f"with {GRAPH_SQL} select product_id, target from now")
def graph_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_after(spark, sf_dir)[1]


@register(f"with {GRAPH_SQL} select distinct product_id from now")
def graph_apply_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_after(spark, sf_dir)[0]


@register("with s as (select distinct event_type as table_name, ts::date as taken from events), r as (select *, row_number() over (partition by table_name order by taken desc) as n from s) select table_name, taken from r where n > 2 and taken < date '2024-01-20'")
def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = table(spark, sf_dir, "events").select(F.col("event_type").alias("table_name"), F.to_date("ts").alias("taken")).distinct()
    return batch.retention_candidates(snapshots, "table_name", "taken", F.lit("2024-01-20").cast("date"))


@register("select replace(replace(r_name || '_' || n_name, ' ', ''), '/', '-') as category_id, r_name as main_category, n_name as sub_category from nation join region on n_regionkey = r_regionkey")
def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("main_category"))
    rows = table(spark, sf_dir, "nation").join(region, "n_regionkey").select("main_category", F.col("n_name").alias("sub_category"))
    return rows.select(files.category_id(F.col("main_category"), F.col("sub_category")).alias("category_id"), "main_category", "sub_category")
