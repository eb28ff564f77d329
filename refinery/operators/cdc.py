"""Changes between two batches of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.schemas import CHANGE_LOG, conform, resolve_column

#: Keys that are broadcast to the registry; more are joined by shuffling.
MOST_BROUGHT = 1_000_000
TRACKED = ("product_ingredients", "rating", "review_count", "review_stats")


def latest_two(batches: DataFrame, batch: str) -> tuple | None:
    """(previous, newest) of a small list of batches, or None where there are not two."""
    found = [r[0] for r in batches.select(batch).distinct().orderBy(F.desc(batch)).limit(2).collect()]
    return (found[1], found[0]) if len(found) == 2 else None


def comparable(c: Column, kind: T.DataType) -> Column:
    """Maps as sorted entries, also inside maps and arrays, so that <=> compares them whatever their order."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: comparable(x, kind.elementType))
    return c


def new_rows(now: DataFrame, earlier: DataFrame, key: str) -> DataFrame:
    """Rows of the newest batch whose key no earlier batch has. Pass only the previous batch to count returning keys as new."""
    return now.where(F.col(key).isNotNull()).join(earlier.select(key).distinct(), key, "left_anti")


def removed_rows(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Rows of the previous batch that are gone."""
    return before.where(F.col(key).isNotNull()).join(now.select(key), key, "left_anti")


def digest(df: DataFrame, tracked: tuple[str, ...] = TRACKED) -> Column:
    """128 bits of the tracked fields, the same where ``changed_rows`` finds no difference: made once, when a row is written."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def plain(c: str) -> Column:
        # Both zeros are equal, and are written unlike.
        return F.when(F.col(c) == 0, F.lit(0).cast(kinds[c])).otherwise(F.col(c)) if isinstance(kinds[c], (T.FloatType, T.DoubleType)) else comparable(F.col(c), kinds[c])

    return F.unhex(F.md5(F.to_json(F.struct(*[plain(c).alias(c) for c in tracked]), {"ignoreNullFields": "false"})))


def changed_rows(before: DataFrame, now: DataFrame, key: str, tracked: tuple[str, ...] = TRACKED, digests: str | None = None, exact: bool = False) -> DataFrame:
    """Rows of the newest batch where a tracked field differs from before; null equals null, arrays by order, maps whatever the order.

    ``digests`` names a column with the ``digest`` of each row: then only digests are read of the batch before,
    and no map is sorted. With ``exact`` fields are compared too where digests agree.
    """
    if digests:
        old = before.select(F.col(key), F.col(digests).alias("_old"), *([F.struct(*tracked).alias("_fields")] if exact else []))
        met = now.join(old, key)
        differ = ~F.col(digests).eqNullSafe(F.col("_old"))
        if exact:
            differ = differ | _differ(now, tracked, lambda c: F.col("_fields")[c])
        return met.where(differ).select(*now.columns)
    old = before.select(F.col(key), *[F.col(c).alias("_old_" + c) for c in tracked])
    return now.join(old, key).where(_differ(now, tracked, lambda c: F.col("_old_" + c))).select(*now.columns)


def _differ(now: DataFrame, tracked: tuple[str, ...], old, new=F.col) -> Column:
    kinds = {f.name: f.dataType for f in now.schema.fields}
    out = F.lit(False)
    for c in tracked:
        out = out | ~comparable(new(c), kinds[c]).eqNullSafe(comparable(old(c), kinds[c]))
    return out


def _pair_changes(before: DataFrame, now: DataFrame, key: str, tracked: tuple[str, ...], digests: str | None, exact: bool) -> DataFrame:
    """The changes from one batch to the next, where nothing else is looked at: one join for all three kinds."""
    old, new = (df.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.struct(*df.columns).alias(name)) for df, name in ((before, "_before"), (now, "_now")))
    was, is_ = F.col("_before"), F.col("_now")
    differ = ~is_[digests].eqNullSafe(was[digests]) if digests else F.lit(False)
    if exact or not digests:
        differ = differ | _differ(now, tracked, lambda c: was[c], lambda c: is_[c])
    kind = F.when(was.isNull(), "NEW").when(is_.isNull(), "REMOVED").when(differ, "CHANGED")
    both = {c: F.when(is_.isNull(), was[c]).otherwise(is_[c]) if c in before.columns else is_[c] for c in now.columns}
    # A row that is there in both batches has no values in columns of the one before alone.
    more = [F.when(is_.isNull(), was[c]).alias(c) for c in before.columns if c not in now.columns]
    changes = new.join(old, "_key", "full").withColumn("change_type", kind).where(F.col("change_type").isNotNull())
    return changes.select(*[v.alias(c) for c, v in both.items()], "change_type", *more)


def first_seen(now: DataFrame, before: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key) of the rows of the newest batch whose key is neither in the batch before nor among the known keys of the registry.

    What the batch before has is taken off first; only the few keys that are left are looked up, and only the
    registry's hits travel.
    """
    left = now.select(key).where(F.col(key).isNotNull()).join(before.select(key), key, "left_anti").distinct()
    few = left.count() <= MOST_BROUGHT
    hits = known.select(key).join(F.broadcast(left) if few else left, key, "left_semi").distinct()
    return left.join(hits, key, "left_anti")


def changes_between(before: DataFrame, now: DataFrame, earlier: DataFrame, key: str, tracked: tuple[str, ...] = TRACKED, reappear_as_new: bool = False, digests: str | None = None, exact: bool = False) -> DataFrame:
    """change_type and the row's values, from the previous and the newest batch and all earlier ones, of which only keys are read. ``digests`` and ``exact``: see ``changed_rows``."""
    if reappear_as_new:
        return _pair_changes(before, now, key, tracked, digests, exact)
    found = new_rows(now, earlier, key).withColumn("change_type", F.lit("NEW"))
    found = found.unionByName(removed_rows(before, now, key).withColumn("change_type", F.lit("REMOVED")), allowMissingColumns=True)
    return found.unionByName(changed_rows(before, now, key, tracked, digests, exact).withColumn("change_type", F.lit("CHANGED")), allowMissingColumns=True)


def change_log(history: DataFrame, batch: str, key: str, tracked: tuple[str, ...] = TRACKED, pair: tuple | None = None, initial_as_new: bool = False, reappear_as_new: bool = False) -> DataFrame:
    """``changes_between`` the two newest batches of a history with a batch column.

    With fewer than two batches there are no changes, unless ``initial_as_new``.
    """
    pair = pair or latest_two(history, batch)
    if pair is None:
        rows = history if initial_as_new else history.limit(0)
        return rows.withColumn("change_type", F.lit("NEW"))
    before, now = history.where(F.col(batch) == F.lit(pair[0])), history.where(F.col(batch) == F.lit(pair[1]))
    return changes_between(before, now, history.where(F.col(batch) < F.lit(pair[1])), key, tracked, reappear_as_new=reappear_as_new)


def change_history(history: DataFrame, batch: str, key: str, tracked: tuple[str, ...], batches: list) -> DataFrame:
    """The changes of all ``batches``, in their order, at once, each stamped with the batch it leads to: those of ``change_log`` over each pair
    with ``reappear_as_new``, before them the first batch as new. A key must have one row a batch; its rows are looked at once, in order."""
    if not batches:
        return history.limit(0).withColumn("change_type", F.lit("NEW"))
    names = [c for c in history.columns if c != batch]
    every = F.array(*[F.lit(b) for b in batches])
    in_order = Window.partitionBy(key).orderBy("_turn")
    rows = history.withColumn("_turn", F.array_position(every, F.col(batch)).cast("int")).where((F.col("_turn") > 0) & (F.col(key).isNotNull() | (F.col("_turn") == 1)))
    rows = rows.withColumns({"_old": F.lag(F.struct("_turn", *tracked)).over(in_order), "_next": F.lead("_turn").over(in_order)})
    turn = F.col("_turn")
    met = F.coalesce(F.col("_old._turn") == turn - 1, F.lit(False))
    kind = F.when(~met, "NEW").when(_differ(history, tracked, lambda c: F.col("_old")[c]), "CHANGED")
    gone = (turn < len(batches)) & F.col(key).isNotNull() & ~F.coalesce(F.col("_next") == turn + 1, F.lit(False))
    found = F.array(F.struct(kind.alias("kind"), F.col(batch).alias("to")), F.struct(F.when(gone, "REMOVED").alias("kind"), F.get(every, turn).alias("to")))
    changes = rows.select(*names, F.explode(F.filter(found, lambda x: x["kind"].isNotNull())).alias("_x"))
    return changes.select(*[F.col("_x.to").alias(batch) if c == batch else F.col(c) for c in history.columns], F.col("_x.kind").alias("change_type"))


def log_rows(changes: DataFrame, batch_job: str, batch_date: Column) -> DataFrame:
    """C4: changes in the log's columns, stamped with the batch; the category under either of its names."""
    category = resolve_column(changes, ["category_id", "category"])
    stamped = changes.withColumns({"category_id": F.col(category), "batch_job": F.lit(batch_job), "batch_date": batch_date})
    return conform(stamped, CHANGE_LOG)


def change_counts(changes: DataFrame) -> DataFrame:
    """A7."""
    return changes.agg(*[F.count_if(F.col("change_type") == kind).alias(f"{kind.lower()}_count") for kind in ("NEW", "REMOVED", "CHANGED")])
