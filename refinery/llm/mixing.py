"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Only DataFrame operations. One pass over the texts counts words; all else works on
(id, source, size) rows and on one row for each source or (source, shard).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import partitions, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that are put in one order within one task; documents of a shard.
MOST_IN_TASK = 100_000
DOCS_IN_SHARD = 1024
MOST_SHARDS = 8192


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds each row's place (from 1) in the order of all rows.

    More rows than fit a task are dealt by ranges of the order; a range's places start after those of
    the ranges before it.
    """
    if df.count() <= MOST_IN_TASK:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
    dealt = stage(df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("_range", F.spark_partition_id()))
    # One row for each range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.join(F.broadcast(starts), "_range").withColumn(name, inside + F.col("_before")).drop("_range", "_before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. A
    target stops at ``cap`` times its source's size; what is above is shared again by weight, until
    no source is above. Each round is one sum over the sources' rows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = numbered(per, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    per = stage(per.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")))
    full_at = F.col("most") / F.col("weight")
    total, share = per.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (total or 0) / (share or 1.0), -1
    while share:
        # Sources below the level are full; the level of the others rises with what these leave.
        below = full_at < level
        n, taken, rest = per.agg(F.count_if(below), F.sum(F.when(below, F.col("most"))), F.sum(F.when(~below, F.col("weight")))).first()
        if n == full:
            break
        full, level = n, (total - (taken or 0.0)) / rest if rest else float("inf")
    return per.select("source", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, votes: str, seats: Column, within: list[str], order: list[Column]) -> DataFrame:
    """Adds ``quota``: of ``seats`` seats (the same for all rows of ``within``), those won by the
    highest quotients votes / (2k - 1), ties by ``order``.

    Rounding votes by a divisor gives a sum within half a seat for each party of the quotient, so
    two divisors bracket the result: seats below the lower one are won for certain, and only the few
    seats between the two are ranked.
    """
    df = parties.withColumn("_seats", seats)
    if within:
        group = Window.partitionBy(*within)
        df = df.withColumns({"_all": F.sum(votes).over(group), "_slack": F.count("*").over(group) / 2 + 1})
    else:
        # One row beside all others.
        df = df.join(F.broadcast(parties.agg(F.sum(votes).alias("_all"), (F.count("*") / 2 + 1).alias("_slack"))), F.lit(True))
    share = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all")).otherwise(0.0)
    df = df.withColumn("_low", F.greatest(F.floor(share * (F.col("_seats") - F.col("_slack")) + 0.5), F.lit(0)).cast("long"))
    df = df.withColumn("_high", F.greatest(F.floor(share * (F.col("_seats") + F.col("_slack")) + 0.5), F.col("_low")).cast("long"))
    if within:
        df = df.withColumn("_left", F.col("_seats") - F.sum("_low").over(group))
    else:
        df = df.join(F.broadcast(df.agg(F.sum("_low").alias("_lows"))), F.lit(True)).withColumn("_left", F.col("_seats") - F.col("_lows")).drop("_lows")
    keep = [c for c in df.columns if c not in ("_seats", "_all", "_slack", "_high")]
    contested = df.select(*keep, F.explode(F.expr("array_append(if(_high > _low, sequence(_low + 1, _high), cast(array() as array<bigint>)), null)")).alias("_seat"))
    quotient = F.when(F.col("_seat").isNotNull() & (F.col(votes) > 0), F.col(votes) / (2 * F.col("_seat") - 1))
    contested = contested.withColumn("_quotient", quotient)
    by = [F.col("_quotient").desc_nulls_last(), *order]
    contested = contested.withColumn("_rank", F.row_number().over(Window.partitionBy(*within).orderBy(*by))) if within else numbered(contested, by, "_rank")
    won = F.sum(F.when(F.col("_quotient").isNotNull() & (F.col("_rank") <= F.col("_left")), 1).otherwise(0))
    names = parties.columns
    return contested.groupBy(*names, "_low").agg(won.alias("_won")).select(*names, (F.col("_low") + F.col("_won")).alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, block: int = 32, seed: int = 7, also: tuple[str, ...] = ()) -> DataFrame:
    """What a mix of ``docs`` (doc_id, text, source) takes of each row.

    Sources get blocks of ``block`` words by highest quotients, and each source's blocks go to its
    shards (rows dealt by a seeded hash of doc_id and text) in the same way. A shard's rows, in seeded order,
    are cut into blocks; its quota is that many blocks, taken from the front of that order, going
    round again where it has more blocks than the shard: a whole pass takes every row once.

    Returns doc_id, source, size (words), source_size, target (of the source), taken (words, repeats
    counted, at most ``cap`` times size). Null text has size 0, null source is a source of its own,
    repeated rows are rows like others, an empty table gives an empty one. Other columns are ignored, but for those named in ``also``.
    """
    key = F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed))
    sizes = stage(docs.select("doc_id", "source", *also, word_count(F.col("text")).alias("size"), key.alias("_key")))
    n = sizes.count()
    shards = min(max(-(-n // DOCS_IN_SHARD), 1), MOST_SHARDS)
    sizes = sizes.withColumn("_shard", F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int"))
    goal = targets(sizes, weights, cap)
    order = F.col("source").asc_nulls_last()
    words = sizes.agg(F.sum("size")).first()[0] or 0
    goal = stage(apportion(goal, "target", F.lit(words // block).cast("long"), [], [order]))
    goal = goal.withColumnRenamed("quota", "source_blocks")
    cells = sizes.groupBy("source", "_shard").agg(F.sum("size").alias("words"))
    small = goal.select(F.col("source").alias("_source"), *[c for c in goal.columns if c != "source"])
    cells = cells.join(small, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    cells = apportion(cells, "words", F.col("source_blocks"), ["source"], [F.col("_shard").asc()])
    cells = cells.withColumn("take", F.least(F.col("quota") * block, F.floor(F.col("words") * cap)).cast("long"))
    cells = cells.select(F.col("source").alias("_source"), F.col("_shard").alias("_cell"), "words", "source_size", "target", "take")
    front = Window.partitionBy("source", "_shard").orderBy("_key", "doc_id", "size", *also)
    placed = sizes.withColumn("start", F.sum("size").over(front.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(cells, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_cell")))
    passes = F.when(F.col("words") > 0, F.floor(F.col("take") / F.col("words"))).otherwise(0)
    rest = F.col("take") - passes * F.col("words")
    taken = passes * F.col("size") + F.greatest(F.least(rest - F.col("start"), F.col("size")), F.lit(0))
    return placed.select("doc_id", "source", *also, "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them: each row as often as its taken words hold it, rounded; those never taken go.

    Columns of docs are kept, whatever their names. Rows of equal doc_id, text and source share what is taken of
    them evenly; which of them get one more is told by their other columns, so reruns agree.
    """
    names = {c: F.xxhash64(F.lit(n), "doc_id", "text", "source") for n, c in enumerate(("_k0", "_k1"))}
    # The caller's row is one column, so that no name of its clashes.
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), *[h.alias(c) for c, h in names.items()])
    slim = docs.select("doc_id", "text", "source", *[h.alias(c) for c, h in names.items()])
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("long")
    taken = mix(slim, also=tuple(names), **options).groupBy(*names).agg(F.sum(times).alias("_times"), F.count("*").alias("_rows")).where("_times > 0")
    joined = rows.join(taken, list(names))
    # The join has dealt rows by these keys already.
    place = F.row_number().over(Window.partitionBy(*names).orderBy(F.when(F.col("_rows") > 1, F.to_json("_row"))))
    share = F.floor(F.col("_times") / F.col("_rows")) + (place <= F.col("_times") % F.col("_rows")).cast("int")
    copies = joined.withColumn("_share", share.cast("int")).where("_share > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_share"))))
    return copies.select("_row.*")
