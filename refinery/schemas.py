"""Table schemas, and conforming a frame to one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, F32, I32, I64, TS = T.StringType(), T.FloatType(), T.IntegerType(), T.LongType(), T.TimestampType()
TEXTS = T.ArrayType(S, True)
STATS = T.MapType(S, T.MapType(S, S, True), True)


def _schema(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields.items()])


# Names, types and order of the tables' columns.
BRONZE = _schema(name=S, brand=S, url=S, ingredients=S, main_category=S, sub_category=S, goods_no=S, crawled_at=S, rating=S, review_count=S, review_stats=STATS)
SILVER = _schema(
    ("product_id",), category=S, main_category=S, sub_category=S, product_id=S, product_brand=S, product_name=S, product_name_raw=S, product_ingredients=TEXTS, product_ingredients_raw=S,
    rating=F32, review_count=I32, review_stats=STATS, product_url=S, crawled_at=TS, batch_job=S, batch_date=TS, goods_no=S,
)
SILVER_ERROR = _schema(
    ("product_id",), category=S, main_category=S, sub_category=S, product_id=S, product_brand=S, product_name_raw=S, product_name=S, product_ingredients_raw=S, product_url=S, crawled_at=TS,
    error_type=S, residual_text=S, batch_job=S, batch_date=TS, goods_no=S,
)
FREQUENCY = _schema(category_id=S, ingredient_name=S, usage_count=I64, rank=I32, batch_job=S, batch_date=TS)
CHANGE_LOG = _schema(
    ("product_id",), batch_date=TS, product_id=S, category_id=S, change_type=S, product_name=S, product_brand=S, product_ingredients=TEXTS, rating=F32, review_count=I32, review_stats=STATS, batch_job=S, goods_no=S,
)
CHECKPOINT = _schema(("batch_job",), batch_job=S, synced_at=TS, new_count=I32, removed_count=I32, changed_count=I32)
MART = _schema(inci_name=S, kor_name=S, eng_name=S, cosing_functions=S, status=S, cosmetic_restriction=S, other_restrictions=S, ingredient_name=S, usage_count=I64, batch_job=S, batch_date=TS)
CATEGORY = _schema(("category_id",), category_id=S, main_category=S, sub_category=S)
RULES = _schema(raw=S, fix=S, match_type=S, apply_to=S, synced_at=TS)
KEYWORDS = _schema(match_type=S, keyword=S, synced_at=TS)
CUSTOM = _schema(raw=S, standard=S, action=S, reason=S, synced_at=TS)
METRICS = _schema(batch_date=TS, run_id=S, stage=S, metric_name=S, metric_value=T.DoubleType(), target_table=S, created_at=TS)


@dataclass(frozen=True)
class Table:
    """A table's name, schema, the columns that part its files (K13; a timestamp by day) and the order within them."""

    name: str
    schema: T.StructType
    parts: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()

    def by(self) -> dict[str, Column | None]:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        return {f"{c}_day" if kinds[c] == TS else c: F.to_date(c) if kinds[c] == TS else None for c in self.parts}


# The tables, and what parts and orders their files.
TABLES = {
    t.name: t
    for t in (
        Table("silver", SILVER, ("category",), ("product_brand", "product_id")),
        Table("silver_error", SILVER_ERROR, ("error_type",), ("product_id",)),
        Table("ingredient_frequency", FREQUENCY, ("batch_date",), ("category_id", "rank")),
        Table("change_log", CHANGE_LOG, ("batch_date",), ("change_type", "product_id")),
        Table("product_ingredients", MART, (), ("ingredient_name",)),
        Table("sync_checkpoint", CHECKPOINT),
        Table("category_master", CATEGORY, (), ("category_id",)),
        Table("typo_map", RULES, ("apply_to",)),
        Table("garbage_keywords", KEYWORDS),
        Table("custom_dictionary", CUSTOM),
        Table("dq_metrics", METRICS, ("batch_date",)),
    )
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K4: the schema's columns in its order, cast; missing ones null, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """K6."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def enforce_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K5: the job fails on a null in a required column, when the row is read."""
    for f in schema.fields:
        if not f.nullable:
            df = df.withColumn(f.name, F.coalesce(F.col(f.name), F.raise_error(F.lit(f"null in required column {f.name}")).cast(f.dataType)))
    return df


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """K7: columns that either side lacks are null there."""
    return old.unionByName(new, allowMissingColumns=True)


def resolve_column(df: DataFrame, candidates: list[str]) -> str:
    """The first candidate that is a column."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {candidates} in {df.columns}")


def texts(c: Column, kind: T.DataType) -> Column:
    """K9: arrays to arrays of strings, a scalar to one element, null stays null."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: x.cast("string"))
    return F.when(c.isNotNull(), F.array(c.cast("string")))


def stats(c: Column) -> Column:
    """Null stays null, a null inner map is empty, a null leaf is ''."""
    empty = F.expr("cast(map() as map<string, string>)")
    return F.transform_values(c, lambda k, v: F.coalesce(F.transform_values(v, lambda a, b: F.coalesce(b, F.lit(""))), empty))
