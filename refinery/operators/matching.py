"""Dictionary matching: leftmost-longest, non-overlapping, as a join on candidate substrings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import text as X
from refinery.operators.partitioning import spread

#: Characters of a text that are looked at together (a look at one copies them all), and beginnings of keys that are told by a set.
PIECE, MOST_STARTS = 256, 4096


def build_dictionary(names: DataFrame, standard: str, others: list[str], order: str) -> DataFrame:
    """M1, M2: (key, standard): each name gives a key with masked commas and one without spaces; nulls and blanks go; for equal keys the last by ``order`` stays."""
    each = names.select(F.col(standard).alias("standard"), F.col(order).alias("_o"), F.posexplode(F.array(*[F.col(c) for c in [standard, *others]])).alias("_p", "name"))
    each = each.where(~X.blank(F.col("name")) & ~X.blank(F.col("standard")))
    masked = F.replace(X.strip(F.col("name")), F.lit(","), F.lit(X.COMMA_MASK))
    keys = each.select("standard", "_o", "_p", F.posexplode(F.array(masked, X.despace(masked))).alias("_k", "key"))
    return keys.groupBy("key").agg(F.max_by("standard", F.struct("_o", "_p", "_k", "standard")).alias("standard"))


def overlay(dictionary: DataFrame, custom: DataFrame) -> DataFrame:
    """M3: custom (raw, standard, action): add counts only for absent keys, override always; both get the masked and the despaced key."""
    masked = F.replace(X.strip(F.col("raw")), F.lit(","), F.lit(X.COMMA_MASK))
    rows = custom.where(~X.blank(F.col("raw"))).select("standard", "action", F.explode(F.array_distinct(F.array(masked, X.despace(masked)))).alias("key"))
    forced = rows.where("action = 'override'").groupBy("key").agg(F.max("standard").alias("_forced"))
    added = rows.where("action = 'add'").groupBy("key").agg(F.max("standard").alias("_added"))
    both = dictionary.join(forced, "key", "full_outer").join(added, "key", "full_outer")
    return both.select("key", F.coalesce("_forced", "standard", "_added").alias("standard"))


def prepared(c: Column) -> Column:
    """The text that is searched."""
    return X.despace(X.mask_commas(c))


def wide(c: Column) -> Column:
    """Four bytes for each character, so that a piece of a long text is found without reading what stands before it."""
    return F.encode(c, "UTF-32")


def _starts(keys: DataFrame, shortest: int) -> tuple[int, list[int]]:
    """How many characters to look at before anything is joined, and the hashes of the keys' beginnings of that length; 0 where even one character gives too many."""
    sizes = range(1, min(shortest, 8) + 1)
    counts = keys.agg(*[F.countDistinct(F.xxhash64(F.substring("_key", 1, 4 * b))).alias(str(b)) for b in sizes]).first()
    size = max((b for b in sizes if counts[str(b)] <= MOST_STARTS), default=0)
    return size, [r[0] for r in keys.select(F.xxhash64(F.substring("_key", 1, 4 * size))).distinct().collect()] if size else []


def hits(docs: DataFrame, dictionary: DataFrame, text_col: str) -> DataFrame:
    """M4: (h, g, at, n, standard) of the longest key at each place of each different text, before overlaps are resolved. Places are from 1; h and g are the text's hashes.

    Texts are read in pieces of PIECE characters. Within a piece a place goes on only if the characters
    there begin some key, by a set of at most MOST_STARTS hashes; what goes on is a row of its own, and
    its substrings of the lengths that such keys have are joined with the keys. So the dictionary may be
    of any size, and rows are made for places that look like hits, not for all.
    """
    keys = dictionary.where("key <> '' and instr(key, ' ') = 0").select("key", "standard", F.length("key").alias("_n"), wide(F.col("key")).alias("_key"))
    shortest, longest = keys.agg(F.min("_n"), F.max("_n")).first()
    if longest is None:
        return docs.select(F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("g"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit("").alias("standard")).limit(0)
    begin, some = _starts(keys, shortest)
    lengths = keys.groupBy(F.substring("_key", 1, 4 * min(shortest, 8)).alias("_begin")).agg(F.collect_set("_n").alias("_lengths"))
    t = spread(docs.select(F.col(text_col).alias("_t"))).select(*text_key(F.col("_t")), wide(F.col("_t")).alias("_t")).where(F.octet_length("_t") > 0)
    turns = F.explode(F.sequence(F.lit(0), ((F.octet_length("_t") / 4 - 1) / PIECE).cast("int")))
    pieces = t.select("h", "g", "_t", turns.alias("_turn")).select("h", "g", (F.col("_turn") * PIECE).alias("_base"), F.substring(F.col("_t"), F.col("_turn") * (4 * PIECE) + 1, F.lit(4 * (PIECE + longest - 1))).alias("_piece"))
    look = f"xxhash64(substring(_piece, 4 * i - 3, {4 * begin})) in ({','.join(map(str, some))})" if begin else "true"
    places = pieces.select("h", "g", "_base", "_piece", F.explode(F.expr(f"filter(sequence(1, least({PIECE}, cast(octet_length(_piece) / 4 as int))), i -> {look})")).alias("_i"))
    first = F.col("_i") * 4 - 3
    places = places.select("h", "g", (F.col("_base") + F.col("_i")).alias("at"), F.substring(F.col("_piece"), first, F.lit(longest * 4)).alias("_piece"))
    likely = places.withColumn("_begin", F.substring("_piece", 1, 4 * min(shortest, 8))).join(lengths, "_begin").select("h", "g", "at", "_piece", F.explode("_lengths").alias("n"))
    tried = likely.where(F.octet_length("_piece") >= F.col("n") * 4).select("h", "g", "at", "n", F.substring(F.col("_piece"), F.lit(1), F.col("n") * 4).alias("_key"))
    found = tried.join(keys.select("standard", "_key"), "_key")
    return found.groupBy("h", "g", "at").agg(F.max("n").alias("n"), F.max_by("standard", "n").alias("standard"))


def text_key(c: Column) -> list[Column]:
    """128 bits that name a text: equal texts have equal hits, whatever their rows' ids."""
    return [F.xxhash64(c).alias("h"), F.xxhash64(F.lit(1), c).alias("g")]


def leftmost(found: DataFrame) -> DataFrame:
    """M4's choice: (h, g, taken) with the hits that are taken from the left, in order, as (at, until, standard).

    A text's hits are in one row, in order; which are taken is told by one look at each. Only places of texts with hits that overlap leave the JVM.
    """
    rows = found.groupBy("h", "g").agg(F.array_sort(F.collect_list(F.struct("at", (F.col("at") + F.col("n")).alias("until"), "standard"))).alias("_hits"))
    at, until = F.col("_hits")["at"], F.col("_hits")["until"]
    overlap = F.exists(F.zip_with(F.slice(at, 2, F.size("_hits")), F.slice(until, 1, F.size("_hits") - 1), lambda a, u: a < u), lambda x: x)
    rows = rows.withColumn("_overlap", overlap)
    none = F.lit(None).cast("array<int>")
    taken = F.pandas_udf(free_places, "array<int>")(F.when(F.col("_overlap"), at).otherwise(none), F.when(F.col("_overlap"), until).otherwise(none))
    return rows.select("h", "g", F.when(F.col("_overlap"), F.transform(taken, lambda i: F.get("_hits", i))).otherwise(F.col("_hits")).alias("taken"))


def free_places(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Numbers of the intervals that are taken from the left: each that starts where the last one taken has ended, or later; null for null. Linear in their number."""
    out = []
    for at, until in zip(starts, ends):
        if at is None:
            out.append(None)
            continue
        taken, free = [], 0
        for n, (a, b) in enumerate(zip(at.tolist(), until.tolist())):
            if a >= free:
                taken.append(n)
                free = b
        out.append(np.array(taken, np.int32))
    return pd.Series(out, dtype=object)


def match(docs: DataFrame, dictionary: DataFrame, text_col: str) -> DataFrame:
    """M4 to M6: adds matches (standard names in order) and residual (the text without what matched; all of it if nothing did) to docs."""
    per = leftmost(hits(docs, dictionary, text_col)).select(F.col("h").alias("_h"), F.col("g").alias("_g"), F.col("taken").alias("_taken"))
    h, g = text_key(F.col(text_col))
    joined = docs.withColumns({"_hh": h, "_gg": g}).join(per, (F.col("_hh") == F.col("_h")) & (F.col("_gg") == F.col("_g")), "left")
    none = F.expr("cast(array() as array<struct<at: int, until: int, standard: string>>)")
    joined = joined.withColumn("_taken", F.coalesce("_taken", none))
    t = F.coalesce(F.col(text_col), F.lit(""))
    residual = F.when(F.size("_taken") == 0, t).otherwise(without(t, F.col("_taken")["at"], F.col("_taken")["until"]))
    return joined.select(*docs.columns, F.col("_taken")["standard"].alias("matches"), residual.alias("residual"))


#: The mark that UTF-32 begins with; what follows is read as it stands.
BYTE_ORDER = "0000FEFF"


def without(text: Column, starts: Column, ends: Column) -> Column:
    """M5: the text without the characters from each start to before its end (from 1, in order). Of the text in four bytes for each character every piece is taken without reading the others; no text leaves the JVM."""

    def rest(w: Column) -> Column:
        begins, stops = F.concat(F.array(F.lit(1)), ends), F.concat(starts, F.array((F.octet_length(w) / 4).cast("int") + 1))
        piece = lambda a, b: F.decode(F.concat(F.unhex(F.lit(BYTE_ORDER)), F.substring(w, a * 4 - 3, (b - a) * 4)), "UTF-32")
        return F.array_join(F.zip_with(begins, stops, piece), "")

    # As an element the wide text is made once, not for each piece.
    return F.get(F.transform(F.array(wide(text)), rest), F.lit(0))


def match_small(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """M4 for a short list of keys: one pattern, longest alternatives first; matches are keys."""
    pattern = "|".join(X.literal_pattern(k) for k in sorted(set(keys), key=lambda k: (-len(k), k)))
    t = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("matches", F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).withColumn("residual", F.regexp_replace(t, F.lit(pattern), F.lit("")))


def repeats(matches: Column, core: str, least: int = 2) -> Column:
    """M7."""
    return F.size(F.filter(matches, lambda x: x == core)) >= least


def ordered_distinct(matches: Column) -> Column:
    """M8."""
    return F.array_distinct(matches)


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """D4."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))
