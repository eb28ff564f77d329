"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import chat, clusters, html, lines, mixing, packing, phrases, secrets, simhash, substrings, topk, toxicity, vectors
from refinery.llm.common import table


OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 64)) as v from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
"""

OP5 = """
with speakers as (select distinct conv_id, coalesce(role, '') as speaker from conversations),
turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as n
  from conversations),
rendered as (
  select t.conv_id, s.speaker as perspective, t.n, t.turn, t.role as author,
    case when t.role = s.speaker then 'assistant' else 'user' end as as_role, t.role = s.speaker as trained,
    case when t.role = s.speaker then '<|assistant|>' || chr(10) else '<|user name="' || replace(replace(replace(replace(t.role, '&', '&amp;'), '<|', '<&#124;'), '|>', '&#124;>'), '"', '&#34;') || '"|>' || chr(10) end as head,
    replace(replace(replace(t.text, '&', '&amp;'), '<|', '<&#124;'), '|>', '&#124;>') || '<|end|>' || chr(10) as body
  from turns t join speakers s on s.conv_id is not distinct from t.conv_id),
placed as (
  select *, coalesce(sum(length(head) + length(body)) over (partition by conv_id, perspective order by n rows between unbounded preceding and 1 preceding), 0) as place
  from rendered)
select conv_id, perspective, n::bigint as n, turn, author, as_role, head || body as segment, trained, place::bigint as start,
  (place + length(head))::bigint as mask_start,
  case when trained then (place + length(head) + length(body) - 1)::bigint else (place + length(head))::bigint end as mask_end
from placed
"""


def _op11(k: int, rounds: int) -> str:
    """Lloyd's rounds, one after the other."""

    def assigned(centroids: str) -> str:
        return f"""(select n, vec_id, v, cluster, d from (
      select p.*, c.cluster, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from points p, {centroids} c)
    qualify row_number() over (partition by n order by d, cluster) = 1)"""

    def means(number: int) -> str:
        return f"""a{number} as materialized {assigned(f"c{number}")},
m{number} as (
  select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v
  from (select cluster, i, sum(v[i]) as s, count(*)::hugeint as n from (select cluster, v, unnest(range(1, 65)) as i from a{number}) group by cluster, i) group by cluster),
c{number + 1} as materialized (select cluster, coalesce(m{number}.v, c{number}.v) as v from c{number} left join m{number} using (cluster))"""

    turns = ",\n".join(means(n) for n in range(rounds))
    return f"""
with points as materialized (
  select row_number() over () as n, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as cluster, v from points where vec_id is not null
  qualify row_number() over (order by sha256('2:' || vec_id), v) <= {k}),
{turns},
done as materialized {assigned(f"c{rounds}")}
select vec_id, cluster::int as cluster, d as distance, sum(d) over (partition by cluster)::bigint as cluster_inertia, sum(d) over ()::bigint as inertia,
  sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from done join c{rounds} using (cluster)
"""


OP11 = _op11(40, 5)

OP12 = r"""
with lines as (
  select doc_id, at, lines[at] as line,
    translate(trim(lines[at], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as at
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))),
often as (select key from lines where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(o.key) as n_dropped,
  sha256(coalesce(string_agg(case when o.key is null then line end, chr(10) order by at), '')) as kept_sha256
from lines left join often o using (key) group by doc_id
"""


OP13 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
split as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, k, phrase, count(*) as f
  from (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from split, (values (1), (2), (3), (4)) as t(k)))
  group by all),
totals as (select lang, sum(f) as n from grams where k = 1 group by lang),
often as (select * from grams where f >= 30),
candidates as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from often where k >= 2),
cuts as (
  select c.lang, c.k, c.phrase, c.a, cut, l.f as l, r.f as r, (2000000::hugeint * c.a::hugeint) // (l.f::hugeint + r.f::hugeint) as score
  from (select *, unnest(range(1, k)) as cut from candidates) c
  join often l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.cut], ' ')
  join often r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, k - m + 2)) as i from candidates, (values (2), (3)) as t(m) where m < k)
  group by all),
kept as (
  select s.* from lowest s left join inside i on i.lang = s.lang and i.phrase = s.phrase
  where i.longer is null or 100::hugeint * i.longer::hugeint < 80::hugeint * s.a::hugeint),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _of_kind(kind: str):
    return lambda x: F.when(x["kind"] == kind, True)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.integers(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.search(rows.where("id % 20 = 0"), rows, 20)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("secrets", lambda x: x["kind"].isin(kinds))
    count = {f"n_{k}": F.size(F.array_compact(F.transform("secrets", _of_kind(k)))).cast("long") for k in kinds}
    found = found.withColumns(count | {"base_sha256": F.sha2(secrets.listed(base), 256), "spans": secrets.listed(F.col("secrets"))})
    return found.select("doc_id", *count, "base_sha256", "spans")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), 50)
    removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), tokenizer(), with_ids=False)
    packed = packing.pack(parts)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.assess(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_ns_bounds_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed="2")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_frequent(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def queries() -> dict:
    found = (op1_topk, op2_secret_scan, op3_suffix_dedup, op4_mixing, op5_chat_formatting, op6_simhash, op7_best_fit_packing, op8_cover_tree, op9_toxicity, op10_html_extraction, op11_ns_bounds_clustering, op12_line_dedup, op13_collocations)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk": OP1, "op5_chat_formatting": OP5, "op11_ns_bounds_clustering": OP11, "op12_line_dedup": OP12, "op13_collocations": OP13}
