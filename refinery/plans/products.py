"""Registered queries over products: orders with their parts' names as ingredient lists, parts as product names.

The product columns, their brackets, notices and sizes are made from the columns of the tables; the
cleaning rules that run over them are the library's own. SQL has no look-around, so its patterns name what
stands before or after a match and put it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery import schemas
from refinery.functions import text as X
from refinery.operators import batch, cdc, graph, marts, matching, quality, routing, rules
from refinery.operators.partitioning import dealt
from refinery.plans import jobs
from refinery.plans.catalogue import DEDUP_SQL, GRAPH_SQL, MATCH_SQL, SNAPSHOT_SQL, TOP_SQL, history, line_items, newest_days, ranked_documents, register, table, user_changes, word_dictionary, yearly
from refinery.sources import files
from refinery.sources.scratch import staged

# ---- product names: T1 to T6, T8, W4, P7, P9, R1, E6

#: How a part's columns become a name as a shop writes it, by p_size; the same text in SQL below.
NAME_SQL = """case p_size % 7
  when 0 then '[' || p_brand || '] ' || p_name || ' ' || p_size || 'ml'
  when 1 then p_name || ' 크림 ' || p_size || 'ml+' || p_size || 'ml 기획 세트'
  when 2 then p_name || ' (단독) 토너 - ' || p_size || '매'
  when 3 then p_brand || ' ' || p_name || ' 세럼 ' || p_size || ' * '
  when 4 then p_name || ' * / 앰플 , 리필 ' || p_size || 'g 증정'
  when 5 then p_name || ' ' || p_size || '종 중 택1'
  else 'Document' end"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, p_brand, name)."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    forms = [
        F.concat(F.lit("["), "p_brand", F.lit("] "), "p_name", F.lit(" "), size, F.lit("ml")),
        F.concat("p_name", F.lit(" 크림 "), size, F.lit("ml+"), size, F.lit("ml 기획 세트")),
        F.concat("p_name", F.lit(" (단독) 토너 - "), size, F.lit("매")),
        F.concat("p_brand", F.lit(" "), "p_name", F.lit(" 세럼 "), size, F.lit(" * ")),
        F.concat("p_name", F.lit(" * / 앰플 , 리필 "), size, F.lit("g 증정")),
        F.concat("p_name", F.lit(" "), size, F.lit("종 중 택1")),
        F.lit("Document"),
    ]
    name = F.element_at(F.array(*forms), F.col("p_size") % 7 + 1)
    return part.select("p_partkey", "p_brand", name.alias("name"))


# The patterns of names.
CLEAN_NAME_SQL = rf"""
named as (select p_partkey, p_brand, {NAME_SQL} as name from part),
t1 as (select *, regexp_replace(name, '\[.*?\]|\(.*?\)', ' ', 'g') as a from named),
t2 as (select *, regexp_replace(a, '(?i)(?:[0-9]+(?:\.[0-9]+)?\s*[+xX*]\s*[0-9]+.*|[0-9]+(?:\.[0-9]+)?\s*(?:ml|㎖|l|ℓ|g|매|호|ea|개입|입|p|종)(?:[^a-zA-Z가-힣].*|$)|\b[0-9]+(?:\.[0-9]+)?$).*', ' ', 'g') as b from t1),
t3 as (select *, regexp_replace(b, '(?i)기획|증정|단독|1\+1|본품|추가|대용량|세트|듀오|트리플|한정|리필팩|리필|단품|구성|트래블\s*키트|캡슐\s*키트|스틱포|더블\s*(기획|세트|구성|[0-9]+입|[0-9]+\s*(ml|g|㎖))', ' ', 'g') as c from t2),
t4 as (select *, regexp_replace(regexp_replace(regexp_replace(c, '[\s*/\-.,]+$', ' ', 'g'), '(\s)[*/\-,.]+(\s|$)', '\1 \2', 'g'), '(\s)[*/\-,.]+(\s|$)', '\1 \2', 'g') as d from t3),
cleaned as (select p_partkey, p_brand, name, trim(regexp_replace(d, '\s+', ' ', 'g')) as clean from t4)
"""


@register(f"with {CLEAN_NAME_SQL} select p_partkey, name, clean from cleaned")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products(spark, sf_dir).select("p_partkey", "name", X.clean_name(F.col("name")).alias("clean"))


@register(f"""with {CLEAN_NAME_SQL} select p_partkey,
  case when regexp_matches(name, '[0-9]+\\s*[종가지]\\s*(?:(?:택|중|중\\s*[0-9]+)\\s*(?:1|일|택|선택))?|\\b(?:택|선택)\\s*[0-9]+\\b') then 'OPTION_BUNDLE_REJECTED'
       when name = 'Document' then 'INVALID_METADATA_REJECTED' end as error_type from cleaned""")
def route_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option bundles and crawl leftovers by name."""
    name = F.col("name")
    checks = [(routing.OPTIONS, name.rlike(X.OPTION_BUNDLE)), (routing.METADATA, X.exact_keyword(name, routing.GARBAGE_EXACT) | X.holds_keyword(name, routing.GARBAGE_CONTAINS))]
    return products(spark, sf_dir).select("p_partkey", routing.first_failure(checks).alias("error_type"))


@register(f"""with {CLEAN_NAME_SQL} select p_partkey, case p_partkey % 3
  when 0 then case when regexp_matches(clean, '세럼') then '세럼' when regexp_matches(clean, '앰플') then '앰플' when regexp_matches(name, '세럼') then '세럼' when regexp_matches(name, '앰플') then '앰플' else '에센스' end
  when 1 then '크림' else '토너' end as category from cleaned""")
def classify_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 with the real rules: over cleaned names, then over raw ones."""
    sub = F.when(F.col("p_partkey") % 3 == 0, "에센스/세럼/앰플").when(F.col("p_partkey") % 3 == 1, "크림").otherwise("스킨/토너")
    return products(spark, sf_dir).select("p_partkey", rules.classify(X.clean_name(F.col("name")), F.lit("스킨케어"), sub, F.col("name")).alias("category"))


UUID_SQL = "substr(s, 1, 8) || '-' || substr(s, 9, 4) || '-5' || substr(s, 14, 3) || '-' || translate(substr(s, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(s, 18, 3) || '-' || substr(s, 21, 12)"


@register(f"""with {CLEAN_NAME_SQL}, h as (select p_partkey, sha1(unhex('{X.NAMESPACE.hex}') || encode(p_brand || '||' || case when name = 'Document' then name else clean end)) as s from cleaned)
select p_partkey, {UUID_SQL} as product_id from h""")
def product_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of early rejects by the raw name, of others by the cleaned one."""
    early = X.exact_keyword(F.col("name"), routing.GARBAGE_EXACT)
    named = F.when(early, F.col("name")).otherwise(X.clean_name(F.col("name")))
    return products(spark, sf_dir).select("p_partkey", X.stable_id(F.col("p_brand"), named).alias("product_id"))


EDGES = [{"raw": "the", "fix": "DIE"}, {"raw": "an", "fix": "one$1"}, {"raw": "of the", "fix": "OF-THE"}]


def _alone(c: str, raw: str, fix: str) -> str:
    once = f"regexp_replace({{}}, '(^|[^가-힣a-zA-Z./0-9-]){raw}($|[^가-힣a-zA-Z./0-9-])', '\\1{fix}\\2', 'g')"
    return once.format(once.format(c))


@register(f"select doc_id, {_alone(_alone(_alone('text', 'of the', 'OF-THE'), 'the', 'DIE'), 'an', 'one$1')} as fixed from documents")
def typo_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for words that stand alone, the longest first."""
    return table(spark, sf_dir, "documents").select("doc_id", X.fix_typos(F.col("text"), EDGES, []).alias("fixed"))


# ---- ingredient lists: T7, T10 to T16, P13, M7, M8

LIST_SQL = """
lists as (select l_orderkey as product_id, string_agg(p_name, ', ' order by l_linenumber, p_name) as items, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1),
written as (select product_id, case product_id % 8
  when 0 then '전성분: ' || items
  when 1 then '[본품] ' || items || ' [본품] ' || n
  when 2 then items || ' * 유기농 원료 사용 [세트] ' || n
  when 3 then '<ILN' || (n + 100) || '>' || items || ' (' || n || '*)'
  when 4 then items || ' (' || n || 'ppm)' || ' ※ 무첨가 성분 : ' || items
  when 5 then '■ 토너 : ' || items
  when 6 then '[크림] ' || items || ' 1,2-' || n || ' A,' || n
  else items || ' 제공된 성분은 ' || n || ' 1) 크림 ' || items end as text from lists)
"""


def ingredient_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, text)."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    # The patterns run in the tasks that gather the lists.
    rows = dealt(line.join(part, "l_partkey").drop("l_partkey"), "l_orderkey").groupBy(F.col("l_orderkey").alias("product_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "p_name"))).alias("x"))
    items, n = F.array_join(F.col("x")["p_name"], ", "), F.size("x")
    count = n.cast("string")
    forms = [
        F.concat(F.lit("전성분: "), items),
        F.concat(F.lit("[본품] "), items, F.lit(" [본품] "), count),
        F.concat(items, F.lit(" * 유기농 원료 사용 [세트] "), count),
        F.concat(F.lit("<ILN"), (n + 100).cast("string"), F.lit(">"), items, F.lit(" ("), count, F.lit("*)")),
        F.concat(items, F.lit(" ("), count, F.lit("ppm)"), F.lit(" ※ 무첨가 성분 : "), items),
        F.concat(F.lit("■ 토너 : "), items),
        F.concat(F.lit("[크림] "), items, F.lit(" 1,2-"), count, F.lit(" A,"), count),
        F.concat(items, F.lit(" 제공된 성분은 "), count, F.lit(" 1) 크림 "), items),
    ]
    return rows.select("product_id", F.element_at(F.array(*forms), (F.col("product_id") % 8 + 1).cast("int")).alias("text"))


def without_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, clean): a column of its own, as what follows names it several times and each mention would run its patterns again."""
    return ingredient_lists(spark, sf_dir).select("product_id", X.drop_notices(F.col("text")).alias("clean"))


def stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product_id, clean), without header and concentrations."""
    return without_notices(spark, sf_dir).select("product_id", X.drop_concentrations(X.strip_header(F.col("clean"))).alias("clean"))


# The patterns of section headers.
HEADER = r"<[^>]+>|■\s*[^:■]+:\s*|[가-힣a-zA-Z0-9]+\s*-\s*\[전성분|\[(?:[^Ii\]][^\]]*|[Ii](?:[^Ll\]][^\]]*)?|[Ii][Ll](?:[^Nn\]][^\]]*)?)\]|(?:^|\s)[0-9]{1,2}\)\s*[가-힣a-zA-Z]+|[가-힣a-zA-Z0-9\s]+(?:볼|앰플|세럼|크림|토너|로션)\s*[):]\s*[가-힣]"
# The patterns of notices.
NOTICES_SQL = rf"""
{LIST_SQL},
n1 as (select product_id, regexp_replace(text, '^전성분(?:명)?\s*:?\s*', '') as a from written),
n2 as (select product_id, regexp_replace(a, '(?is)[*※]?\s*무첨가\s*성분\s*:.*$', '', 'g') as b from n1),
n3 as (select product_id, regexp_replace(b, '(?:(?:※|\*|\+)\s*(?:표시\s*:|자연\s*유래|식물\s*유래|유기농|ILN[0-9]+)|(?:※|\*|\+)?\s*(?:제공된\s*성분은|ILN[0-9]+\s*성분\s*목록은)).*?(\[|<|(?:^|\s)[0-9]{{1,2}}\)\s*[가-힣a-zA-Z]|$)', '\1', 'g') as c from n2),
n4 as (select product_id, regexp_replace(regexp_replace(regexp_replace(c, '(?i)[<\[]?ILN[0-9]+[>\]]?', '', 'g'), '\([^)]*[*※+][^)]*\)', '', 'g'), '[*※+]', '', 'g') as clean from n3)
"""


@register(f"with {NOTICES_SQL} select product_id, clean from n4")
def drop_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10."""
    return without_notices(spark, sf_dir)


@register(f"with {NOTICES_SQL} select product_id, len(regexp_extract_all(clean, '\\[본품\\]')) as mains, len(regexp_extract_all(clean, '{HEADER}')) as headers from n4")
def section_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that tell bundles, with the real patterns."""
    text = F.col("clean")
    return without_notices(spark, sf_dir).select("product_id", X.main_item_count(text).cast("long").alias("mains"), X.header_count(text).cast("long").alias("headers"))


# The pattern of concentrations.
#: SQL writes the last alternative of CONCENTRATION_BRACKET out: it needs the end of the text before a bracket, so never holds.
CONCENTRATION = r"\([^)]*(?:ppm|PPM|ppb|PPB|%|mg|mG|G|g|ml|mL|IU|NON\s*GMO|CI\s*[0-9]+|BHA|AHA|산\s*|전성분|전성분명|성분|유래|추출물|아쿠아).*?\)"
STRIPPED_SQL = f"""{NOTICES_SQL},
h1 as (select product_id, case when len(regexp_extract_all(clean, '{HEADER}')) = 1 then regexp_replace(clean, '{HEADER}', '', 'g') else clean end as a from n4),
h2 as (select product_id, regexp_replace(a, '{CONCENTRATION}', '', 'g') as b from h1)"""


@register(f"with {STRIPPED_SQL} select product_id, b as clean from h2")
def clean_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One header goes, and brackets of concentrations."""
    return stripped(spark, sf_dir)


@register(f"""with {STRIPPED_SQL}, m as (select product_id, replace(regexp_replace(regexp_replace(b, '([A-Za-z0-9]),([A-Za-z0-9])', '\\1_C_\\2', 'g'), '([A-Za-z0-9]),([A-Za-z0-9])', '\\1_C_\\2', 'g'), ' ', '') as s from h2)
select product_id, s as searched, trim(replace(s, '_C_', ',')) as shown, length(trim(replace(s, '_C_', ','))) > 2 and regexp_matches(replace(s, '_C_', ','), '[가-힣a-zA-Z0-9]') as means from m""")
def searched_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is searched for names, how it is shown, and whether it means something."""
    searched = stripped(spark, sf_dir).select("product_id", matching.prepared(F.col("clean")).alias("searched"))
    shown = searched.select("product_id", "searched", X.unmask(F.col("searched")).alias("shown"))
    return shown.select("product_id", "searched", "shown", X.significant(F.col("shown")).alias("means"))


# ---- matches: E2 to E4, M8, A1

ENDS_SQL = f"""{MATCH_SQL}, found as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), p) as m, regexp_replace(coalesce(text, ''), p, '', 'g') as r from documents, p),
ends as (select doc_id, m, r, len(m) > 0 as hit, length(trim(r, ' ' || chr(9) || chr(10) || chr(13))) > 2 and regexp_matches(r, '[가-힣a-zA-Z0-9]') as rest from found)"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(table(spark, sf_dir, "documents").select("doc_id", "text"), word_dictionary(spark, sf_dir), "text")


@register(f"{ENDS_SQL} select count(*) filter (hit and rest) as rows_both, count(*) filter (not hit and not rest) as rows_dropped from ends")
def both_and_neither(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4."""
    return routing.both_and_neither(matched(spark, sf_dir))


@register(f"{ENDS_SQL} select doc_id, list_transform(list_distinct(m), lambda x: upper(x)).list_sort() as names, null::varchar as error_type from ends where hit union all select doc_id, null, 'UNMAPPED_RESIDUAL' from ends where rest")
def silver_and_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with matches, and, of the same rows or others, what is left over."""
    ok, bad = routing.after_match(staged(matched(spark, sf_dir)))
    silver = ok.select("doc_id", F.sort_array(matching.ordered_distinct(F.col("matches"))).alias("names"), F.lit(None).cast("string").alias("error_type"))
    return silver.unionByName(bad.select("doc_id", F.lit(None).cast("array<string>").alias("names"), "error_type"))


@register(f"select doc_id as product_id, null::varchar as brand, lang as category, 'DUPLICATE_PRODUCT_REJECTED' as error_type, n_chars::varchar as residual_text from (select d.doc_id, d.lang, d.n_chars from documents d join ({DEDUP_SQL}) r on d.doc_id = r.doc_id where r.turn > 1)")
def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losers of the dedup in the dead letters' columns, as the job makes them."""
    losers = ranked_documents(spark, sf_dir).where("not is_best")
    absent = {c: F.lit(None).cast("string") for c in ("brand", "name", "clean_name", "ingredients", "url")}
    rows = losers.withColumns(absent | {"product_id": F.col("doc_id"), "category": F.col("lang"), "error_type": F.lit(routing.DUPLICATE)})
    out = jobs.error_row(rows, F.col("n_chars"))
    return out.select(F.col("product_id").cast("long").alias("product_id"), F.col("product_brand").alias("brand"), "category", "error_type", "residual_text")


@register(TOP_SQL.format(k=20).replace("length(p_name) > 1", "length(p_name) > 1 and o_orderstatus = 'F'"))
def topk_of_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the frequency mart from products with arrays of items; one without items gives no rows."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus")
    items = line_items(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list("p_name").alias("items"))
    rows = orders.join(items, "l_orderkey", "left").withColumn("items", F.when(F.col("o_orderstatus") == "F", F.col("items")))
    return marts.top_per_category(marts.usage(rows, "o_orderpriority", "items"), 20)


@register("with c as (select p_type as category_id, p_name as ingredient_name, count(*) as usage_count from part group by 1, 2), r as (select *, row_number() over (partition by category_id order by usage_count desc, ingredient_name) as rank from c) select category_id, ingredient_name, usage_count, rank::int as rank from r where rank <= 3 and category_id = (select min(p_type) from part)")
def topn_of_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read-back of one category."""
    part = table(spark, sf_dir, "part")
    top = marts.top_per_category(marts.usage(part, "p_type", "p_name"), 5)
    return marts.read_back(top, part.agg(F.min("p_type")).first()[0], 3)


# ---- metrics: Q2, Q5, A6, P15

MAPPED_SQL = """
used as (select distinct p_name as i from lineitem join part on l_partkey = p_partkey),
known as (select distinct p_name as k, p_brand from part where p_size > 25)
"""


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of sold parts with the brands of large ones: several rows for some names, none for others."""
    used = line_items(spark, sf_dir).select(F.col("p_name").alias("ingredient_name")).distinct()
    known = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_name").alias("k"), F.col("p_brand").alias("inci")).distinct()
    return marts.enrich(used, known, "k")


@register(f"with {MAPPED_SQL}, u as (select i, max(case when k is not null then 1 else 0 end) as hit from used left join known on i = k group by 1) select count(*) as ingredients_unique, sum(hit)::bigint as matched, (count(*) - sum(hit))::bigint as unmatched, round(sum(hit) / count(*), 4) as match_rate from u")
def mapping_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mapping_metrics(mapped(spark, sf_dir), "ingredient_name", "inci")


@register("select count(*) as n, count(quality) as matched, round(count(quality) / count(*), 4) as share from documents left join labels using (doc_id)")
def share_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return marts.share(docs, F.col("quality"))


@register("select event_id, 'run' as batch_job, ts::date as batch_date from events where ts::date = (select max(ts::date) from events)")
def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the batches that metrics name, both stamped with the batch's date."""
    events = table(spark, sf_dir, "events")
    rows = batch.stamp(events.select("event_id", "ts"), "run", F.to_date("ts"))
    newest = rows.agg(F.max("batch_date").alias("batch_date"), F.count("*").cast("double").alias("loaded"))
    metrics = quality.long_form(newest.select("loaded"), "clean", "run", F.lit(newest.first()["batch_date"]), "silver", F.current_timestamp())
    return quality.drill_down(metrics, rows).select("event_id", "batch_job", "batch_date")


# ---- values and schemas: P1, P2, K7 to K9, S10, T20, A8

@register("select event_id, coalesce(user_id::varchar, '') as who, strftime(case when event_id % 3 <> 1 then ts end, '%Y-%m-%d') as day from events")
def coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of any value, and timestamps that cannot be read as null."""
    written = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, F.concat(F.lit("on "), "event_type")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").select("event_id", X.text(F.col("user_id")).alias("who"), F.date_format(X.safe_timestamp(written), "yyyy-MM-dd").alias("day"))


@register("select event_id, [event_type] as kinds, case when event_id % 2 = 0 then [user_id::varchar, event_id::varchar] end as ids from events")
def norm_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: a scalar as one text, an array as texts, null as null."""
    ids = F.when(F.col("event_id") % 2 == 0, F.array(F.col("user_id").cast("long"), F.col("event_id").cast("long")))
    return table(spark, sf_dir, "events").select("event_id", schemas.texts(F.col("event_type"), T.StringType()).alias("kinds"), schemas.texts(ids, T.ArrayType(T.LongType())).alias("ids"))


@register("select s_suppkey as key, s_name as name, null::varchar as segment, s_acctbal as balance from supplier union all select c_custkey, c_name, c_mktsegment, null from customer")
def evolved_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of unlike columns as one; the balance under whichever of its names a table has."""
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    old = supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col(schemas.resolve_column(supplier, ["balance", "s_acctbal"])).alias("balance"))
    new = customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return schemas.evolve(old, new).select("key", "name", "segment", "balance")


@register("select max(strftime(ts, '%Y%m%d')) as run_id, max(ts::date) as batch_date from events")
def newest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run of all files, and its date."""
    day = F.date_format("ts", "yyyyMMdd")
    found = table(spark, sf_dir, "events").select(F.concat(F.lit("/crawl/main/"), "event_type", F.lit("/run_id="), day, F.lit("/part_0.json")).alias("path")).distinct()
    run = files.source_run(files.latest_runs(found))
    return spark.range(1).select(F.lit(run).alias("run_id"), F.lit(batch.batch_date(None, run)).alias("batch_date"))


@register("""select p_name as raw, p_brand as fix, 'regex_boundary' as match_type, 'ingredient' as apply_to from (select distinct p_name, p_brand from part where p_size = 1)
union all select p_brand, p_type, 'simple', 'ingredient' from (select distinct p_brand, p_type from part where p_size = 2)
union all select p_type, p_name, case when p_type < 'M' then 'simple' else 'regex' end, 'product_name' from (select distinct p_type, p_name from part where p_size = 3)""")
def typo_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lists of rules as one table."""
    part = table(spark, sf_dir, "part")
    pairs = lambda size, raw, fix: part.where(F.col("p_size") == size).select(F.col(raw).alias("raw"), F.col(fix).alias("fix")).distinct()
    names = pairs(3, "p_type", "p_name").withColumn("match_type", F.when(F.col("raw") < "M", "simple"))
    return files.sync_rules(pairs(1, "p_name", "p_brand"), pairs(2, "p_brand", "p_type"), names, F.current_timestamp()).drop("synced_at")


@register("select distinct case when p_size % 2 = 0 then 'exact' else 'contains' end as match_type, p_name as keyword from part where p_size <= 8")
def garbage_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K15."""
    kind = F.when(F.col("p_size") > 8, "regex").when(F.col("p_size") % 2 == 0, "exact").otherwise("contains")
    rows = table(spark, sf_dir, "part").select(kind.alias("match_type"), F.col("p_name").alias("keyword"))
    return files.sync_keywords(rows, F.current_timestamp()).drop("synced_at")


@register("select distinct p_name as raw, p_brand as standard, case when p_size = 1 then 'override' else 'add' end as action, null::varchar as reason from part where p_size <= 2")
def custom_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry without an action is added."""
    rows = table(spark, sf_dir, "part").where("p_size <= 2").select(F.col("p_name").alias("raw"), F.col("p_brand").alias("standard"), F.when(F.col("p_size") == 1, "override").alias("action")).distinct()
    return files.sync_custom(rows, F.current_timestamp()).drop("synced_at")


# ---- changes and graph: C4, C5, A9, G7 to G9

LOG_SQL = f"with {SNAPSHOT_SQL} select product_id, change_type, null::varchar as category_id, rating::float as rating, review_count::int as review_count, 'g1' as batch_job from log"


@register(LOG_SQL)
def change_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: changes in the log's columns."""
    changes = user_changes(spark, sf_dir).drop("review_stats").withColumn("category", F.lit(None).cast("string"))
    rows = cdc.log_rows(changes, "g1", F.lit(newest_days(spark, sf_dir)[1]).cast("timestamp"))
    return rows.select("product_id", "change_type", "category_id", "rating", "review_count", "batch_job")


@register(f"with {SNAPSHOT_SQL} select 'NEW' as change_type, count(*) as n from history where day = (select min(day) from history)")
def first_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch alone gives no changes, or, where asked, all of its rows as new."""
    rows = history(spark, sf_dir)
    first = rows.where(F.col("day") == F.lit(rows.agg(F.min("day")).first()[0]))
    none = cdc.change_log(first, "day", "product_id", ("rating",))
    every = cdc.change_log(first, "day", "product_id", ("rating",), initial_as_new=True)
    return none.unionByName(every).groupBy("change_type").agg(F.count("*").alias("n"))


@register(f"with {SNAPSHOT_SQL} select max(case change_type when 'REMOVED' then 'b' else 'c' end) as batch_job, count(*) filter (change_type = 'NEW')::int as new_count, count(*) filter (change_type = 'REMOVED')::int as removed_count, count(*) filter (change_type = 'CHANGED')::int as changed_count from log having count(*) > 0")
def checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8."""
    job = F.when(F.col("change_type") == "REMOVED", "b").otherwise("c")
    return graph.checkpoint_row(user_changes(spark, sf_dir).withColumn("batch_job", job), "batch_job", F.current_timestamp()).drop("synced_at")


@register("select arg_max(event_type, (ts, event_id)) as batch_job from events")
def last_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of the newest sync."""
    marks = table(spark, sf_dir, "events").select(F.col("event_type").alias("batch_job"), F.struct("ts", "event_id").alias("synced_at"))
    return spark.range(1).select(F.lit(graph.last_checkpoint(marks)).alias("batch_job"))


def all_changes(sales: DataFrame) -> DataFrame:
    """The changes from each year to the next, customers that are back as new; the first year's are all new."""
    years = [r[0] for r in sales.where("batch is not null").select("batch").distinct().orderBy("batch").collect()]
    return cdc.change_history(sales, "batch", "product_id", ("items",), years)


@register(f"with {GRAPH_SQL} select product_id, target from now")
def graph_of_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of all years at once, with customers that go and come back, over an empty graph."""
    sales = staged(yearly(spark, sf_dir))
    lookup = table(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_brand").alias("target")).distinct()
    nodes, edges = sales.select("product_id").limit(0), sales.select("product_id", F.lit("").alias("target")).limit(0)
    return graph.apply(nodes, edges, all_changes(sales), lookup, "product_id", "batch", [], "items")[1]


@register("select distinct p_brand as target from lineitem join part on l_partkey = p_partkey")
def item_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingredient nodes are those that an edge names."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product_id"), "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("target"))
    return graph.item_nodes(marts.edges(line, part, "product_id", "l_partkey", "p_partkey", "target"))
