"""Routing rows to the table or, with a reason, to dead letters; keep-best dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import text as X

# Error codes, and the names that are crawl leftovers.
INCOMPLETE = "INCOMPLETE_DATA_REJECTED"
OPTIONS = "OPTION_BUNDLE_REJECTED"
METADATA = "INVALID_METADATA_REJECTED"
BUNDLE = "HETEROGENEOUS_BUNDLE_REJECTED"
DUPLICATE = "DUPLICATE_PRODUCT_REJECTED"
HIDDEN = "HIDDEN_BUNDLE_REJECTED"
RESIDUAL = "UNMAPPED_RESIDUAL"
GARBAGE_EXACT = ["Document", "Responsive Image", "Loading...", "null", "undefined", "이미지 확대보기", "준비중", "상품명", "듀이트리 상세", "IOPE XMD PDP"]
GARBAGE_CONTAINS = ["herbloom", "javascript:", "onclick", "http://", "https://", "<script", "<div", "JS로"]

#: Tasks among which the rows of a key with several are dealt.
SALTS = 32


def first_failure(checks: list[tuple[str, Column]]) -> Column:
    """The code of the first check that holds, else null."""
    out = F.lit(None).cast("string")
    for code, holds in reversed(checks):
        out = F.when(F.coalesce(holds, F.lit(False)), F.lit(code)).otherwise(out)
    return out


def split(df: DataFrame, error: str = "error_type") -> tuple[DataFrame, DataFrame]:
    """(rows without error, rows with one)."""
    return df.where(F.col(error).isNull()), df.where(F.col(error).isNotNull())


def _place(df: DataFrame, order: list[Column]) -> Column:
    """Where a row stands in its key: by ``order``, each ascending with nulls first, and then by 128 bits of the row, so that only equal rows tie."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    plain = [F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(f"`{c}`") for c in df.columns]
    return F.struct(*[c.alias(f"o{n}") for n, c in enumerate(order)], F.xxhash64(*plain).alias("h"), F.xxhash64(F.lit(1), *plain).alias("g"))


def _keyed(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """(row, place, k0, k1, ...): the rows as one column, so that no name of theirs clashes."""
    return df.select(F.struct(*[f"`{c}`" for c in df.columns]).alias("row"), _place(df, order).alias("place"), *[k.alias(f"k{n}") for n, k in enumerate(keys)])


def best_rows(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The row of each key that stands first. Tasks send on one row for each of their keys, so a key may have any number of rows."""
    names = [f"k{n}" for n in range(len(keys))]
    return _keyed(df, keys, order).groupBy(*names).agg(F.min_by("row", "place").alias("row")).select("row.*")


def rejected_rows(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """All rows but ``best_rows``. Of keys with several rows the first's place goes to SALTS tasks, among which the key's rows are dealt; of equal first rows all but one are rejected."""
    names = [f"k{n}" for n in range(len(keys))]
    rows = _keyed(df, keys, order)
    several = rows.groupBy(*names).agg(F.min("place").alias("_best"), F.count("*").alias("_rows")).where("_rows > 1")
    several = several.select(*[F.col(k).alias(f"_{k}") for k in names], "_best", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    same = F.pmod(F.col("place.h"), F.lit(SALTS)) == F.col("_salt")
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    met = rows.join(several, same)
    firsts = met.where("place = _best").groupBy("_best", *names).agg(F.count("*").alias("n"), F.first("row").alias("row"))
    copies = firsts.where("n > 1").select("row", F.explode(F.expr("sequence(2, n)")).alias("_copy"))
    return met.where("place <> _best").select("row.*").unionByName(copies.select("row.*"))


def keep_best(df: DataFrame, keys: list[Column], order: list[Column], flag: str = "is_best") -> DataFrame:
    """Flags the one row of each key that stays, the first by ``order`` (ascending, nulls first); rows that tie are told by what they hold, so reruns agree."""
    best = best_rows(df, keys, order).withColumn(flag, F.lit(True))
    return best.unionByName(rejected_rows(df, keys, order).withColumn(flag, F.lit(False)))


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows with a key, one for each: the first by ``order``, as in ``keep_best``."""
    return best_rows(df.where(F.col(key).isNotNull()), [F.col(key)], order)


def after_match(df: DataFrame, matches: str = "matches", residual: str = "residual") -> tuple[DataFrame, DataFrame]:
    """(rows with matches, rows whose residual means something). A row may be in both or in neither."""
    return df.where(F.size(matches) > 0), df.where(X.significant(X.unmask(F.col(residual)))).withColumn("error_type", F.lit(RESIDUAL))


def ends(matches: str = "matches", residual: str = "residual") -> list[Column]:
    """rows_both and rows_dropped as aggregates: the rows that ``after_match`` gives twice and those it gives not at all."""
    hit, rest = F.size(matches) > 0, X.significant(X.unmask(F.col(residual)))
    return [F.count_if(hit & rest).alias("rows_both"), F.count_if(~hit & ~rest).alias("rows_dropped")]


def both_and_neither(df: DataFrame, matches: str = "matches", residual: str = "residual") -> DataFrame:
    """One row with ``ends``."""
    return df.agg(*ends(matches, residual))
