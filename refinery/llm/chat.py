"""Chat formatting by rotating the perspective over the participants.

Each dialogue is rendered once for every participant: that speaker as the assistant, the others as
users with their names; only the speaker's own words are to be learned. A rendering is kept as its
segments with their places, so a dialogue of any length is spread over tasks; ``whole`` joins them.

Names and texts cannot forge a mark: in both, a bar after ``<`` or before ``>`` is written ``&#124;``, in names
quotation marks too, and an ampersand of either ``&amp;``; so a rendering can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import stage

#: Turns of a dialogue that are numbered and added up together.
RUN = 64
END = "<|end|>\n"


#: Keys under which the speakers of one dialogue are joined to its turns.
SALTS = 8


def escaped(text: Column) -> Column:
    """A text that holds no mark; ``unescaped`` gives it back."""
    c = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("<&#124;"))
    return F.replace(c, F.lit("|>"), F.lit("&#124;>"))


def escaped_name(name: Column) -> Column:
    return F.replace(escaped(name), F.lit('"'), F.lit("&#34;"))


def unescaped(text: Column) -> Column:
    c = F.replace(F.replace(text, F.lit("&#34;"), F.lit('"')), F.lit("&#124;"), F.lit("|"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def head(author: Column, mine: Column) -> Column:
    return F.when(mine, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit('<|user name="'), escaped_name(author), F.lit('"|>\n')))


def perspectives(turns: DataFrame) -> DataFrame:
    """One row for each (conv_id, perspective, turn of the dialogue) of turns (conv_id, turn, role, text).

    n: the turn's place from 1, by turn (null first), role, text; segment: its rendering, with names and text escaped; start: the
    segment's place in the rendered dialogue, in code points; trained: whether perspective speaks;
    mask_start, mask_end: the code points to learn (its words and the end mark; empty for others).
    Null roles and texts are empty strings; null conv_id is a dialogue of its own; repeated rows are
    turns of their own. The segments of a (conv_id, perspective) in order of n are the rendering.

    Places are sums in two steps: within runs of turn numbers, then over a dialogue's runs, so that
    one very long dialogue does not land in one task.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("author"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stage(rows.withColumn("_run", F.floor(F.col("turn") / RUN)))
    speakers = rows.select(F.col("conv_id").alias("_conv"), F.col("author").alias("perspective")).distinct()
    speakers = speakers.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("turn", "author", "text"), F.lit(SALTS)).cast("int")
    mine = F.col("author") == F.col("perspective")
    every = rows.withColumn("_salt", salt).join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_salt") == F.col("_part"))).drop("_conv", "_salt", "_part")
    every = every.withColumns({"trained": mine, "_head": head(F.col("author"), mine), "_body": F.concat(escaped(F.col("text")), F.lit(END))})
    every = every.withColumn("_size", F.length("_head") + F.length("_body"))
    key = ["conv_id", "perspective", "_run"]
    tally = every.groupBy(*key).agg(F.count("*").alias("_rows"), F.sum("_size").alias("_sum"))
    before = Window.partitionBy("conv_id", "perspective").orderBy(F.col("_run").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    base = tally.select(*[F.col(c).alias("_k" + c) for c in key], F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_n"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_at"))
    order = Window.partitionBy(*key).orderBy(F.col("turn").asc_nulls_first(), "author", "text")
    inside = every.withColumns({"_k": F.row_number().over(order), "_before": F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")})
    joined = inside.join(base, F.col("conv_id").eqNullSafe(F.col("_kconv_id")) & (F.col("perspective") == F.col("_kperspective")) & F.col("_run").eqNullSafe(F.col("_k_run")))
    start = F.col("_at") + F.col("_before")
    mask_start = start + F.length("_head")
    mask_end = F.when(F.col("trained"), start + F.col("_size") - 1).otherwise(mask_start)
    return joined.select(
        "conv_id", "perspective", (F.col("_n") + F.col("_k")).cast("long").alias("n"), "turn", "author", F.when(F.col("trained"), "assistant").otherwise("user").alias("as_role"),
        F.concat("_head", "_body").alias("segment"), "trained", start.cast("long").alias("start"), mask_start.cast("long").alias("mask_start"), mask_end.cast("long").alias("mask_end"),
    )


def whole(segments: DataFrame) -> DataFrame:
    """(conv_id, perspective, text, masks): each rendering as one text with the spans to learn, for dialogues that fit a row."""
    ordered = F.array_sort(F.collect_list(F.struct("n", "segment", "trained", "mask_start", "mask_end")))
    found = segments.groupBy("conv_id", "perspective").agg(ordered.alias("_s"))
    masks = F.transform(F.filter("_s", lambda x: x["trained"]), lambda x: F.struct(x["mask_start"].alias("start"), x["mask_end"].alias("end")))
    return found.select("conv_id", "perspective", F.array_join(F.transform("_s", lambda x: x["segment"]), "").alias("text"), masks.alias("masks"))
