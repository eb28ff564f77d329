"""Reading crawls, rules and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions import text as X
from refinery.schemas import CUSTOM, KEYWORDS, conform

RUN = r"/([^/]+)/([^/]+)/run_id=([^/]+)/[^/]+$"
MONTH = r"batch=(\d{4}-\d{2})"


def listing(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """(path) of the files below root; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")


def latest_runs(files: DataFrame, by_main: bool = True) -> DataFrame:
    """Files of the newest run of each (main, sub) category, in order of path; by sub alone with ``by_main=False``."""
    parts = files.select("path", *[X.path_part(F.col("path"), RUN, n).alias(c) for n, c in enumerate(("main", "sub", "run_id"), 1)]).where("run_id <> ''")
    newest = Window.partitionBy(*(["main", "sub"] if by_main else ["sub"]))
    return parts.withColumn("_newest", F.max("run_id").over(newest)).where("run_id = _newest").drop("_newest").orderBy("path")


def source_run(files: DataFrame) -> str | None:
    """S3, A8."""
    return files.agg(F.max("run_id")).first()[0]


def latest_month(files: DataFrame) -> DataFrame:
    """The one file of the newest monthly batch."""
    return files.withColumn("batch", X.path_part(F.col("path"), MONTH)).where("batch <> ''").orderBy(F.desc("batch"), F.desc("path")).limit(1)


def read_json(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Rows that do not parse are skipped; no paths is an error."""
    if not paths:
        raise ValueError("no input files")
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", False).json(paths)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column is a string."""
    return spark.read.option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S6, S7."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_rules(spark: SparkSession, path: str, match_type: str | None = None, apply_to: str | None = None) -> DataFrame:
    """A JSON list of objects, tagged."""
    df = spark.read.option("multiLine", True).json(path)
    tags = {n: F.lit(v) for n, v in (("match_type", match_type), ("apply_to", apply_to)) if v and n not in df.columns}
    return df.withColumns(tags) if tags else df


def read_keywords(spark: SparkSession, path: str, kinds: tuple[str, ...] = ("exact", "contains")) -> DataFrame:
    """An object of lists as (match_type, keyword)."""
    df = spark.read.option("multiLine", True).json(path)
    parts = [df.select(F.lit(k).alias("match_type"), F.explode(k).alias("keyword")) for k in kinds if k in df.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sync_rules(boundary: DataFrame, plain: DataFrame, names: DataFrame, synced_at) -> DataFrame:
    """Three rule lists as one table with match_type, apply_to and synced_at."""
    parts = (boundary.select("raw", "fix", F.lit("regex_boundary").alias("match_type"), F.lit("ingredient").alias("apply_to")), plain.select("raw", "fix", F.lit("simple").alias("match_type"), F.lit("ingredient").alias("apply_to")))
    kind = F.col("match_type") if "match_type" in names.columns else F.lit("regex")
    named = names.select("raw", "fix", F.coalesce(kind, F.lit("regex")).alias("match_type"), F.lit("product_name").alias("apply_to"))
    return parts[0].unionByName(parts[1]).unionByName(named).withColumn("synced_at", synced_at)


def sync_keywords(keywords: DataFrame, synced_at: Column) -> DataFrame:
    """Names of crawl leftovers (match_type, keyword) as their table; of the kinds exact and contains, each once."""
    rows = keywords.where(F.col("match_type").isin("exact", "contains") & ~X.blank(F.col("keyword"))).select("match_type", "keyword").distinct()
    return conform(rows.withColumn("synced_at", synced_at), KEYWORDS)


def sync_custom(entries: DataFrame, synced_at: Column) -> DataFrame:
    """Dictionary entries made by hand (raw, standard, action, reason) as their table; actions but add and override are an error."""
    action = F.coalesce(F.col("action"), F.lit("add"))
    known = F.when(action.isin("add", "override"), action).otherwise(F.raise_error(F.concat(F.lit("unknown action "), action)).cast("string"))
    return conform(entries.where(~X.blank(F.col("raw"))).withColumns({"action": known, "synced_at": synced_at}), CUSTOM)


def category_id(main: Column, sub: Column) -> Column:
    return F.replace(F.replace(F.concat_ws("_", main, sub), F.lit(" "), F.lit("")), F.lit("/"), F.lit("-"))


def category_dimension(spark: SparkSession, categories: dict[str, list[str]]) -> DataFrame:
    """(category_id, main_category, sub_category); the id is main_sub without spaces, / as -."""
    pairs = F.array(*[F.struct(F.lit(m).alias("main_category"), F.lit(s).alias("sub_category")) for m, subs in categories.items() for s in subs])
    rows = spark.range(1).select(F.inline(pairs))
    return rows.select(category_id(F.col("main_category"), F.col("sub_category")).alias("category_id"), "main_category", "sub_category")


# The shop's categories.
CATEGORIES = {
    "스킨케어": ["스킨/토너", "에센스/세럼/앰플", "크림", "로션", "미스트/오일"],
    "마스크팩": ["시트팩", "패드", "페이셜팩", "코팩", "패치"],
    "클렌징": ["클렌징폼/젤", "오일/밤", "워터/밀크", "필링&스크럽"],
    "더모 코스메틱": ["스킨케어", "바디케어", "클렌징", "선케어", "마스크팩"],
    "맨즈케어": ["스킨케어"],
}
