"""Line dedup: hashes of lines dealt by ranges, first occurrences read in order, bitmaps of what stays.

Only DataFrame operations. Texts are read once for the hashes of their lines, which travel without the
lines, and once more where the lines that stay are put together. The hashes are dealt by ranges of
(hash, document), sorted by position within, so that a line that very many documents hold is spread
over as many ranges as it fills; a range counts its documents as it streams by, and only one row for
each line of a range goes on to be added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import partitions, stage

#: White space that is stripped at the ends of a line.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent lines that are broadcast; more are joined by shuffling the hashes.
MOST_BROUGHT = 200_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case. Plain ASCII takes the faster way to the same."""
    line = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def occurrences(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h, g, doc_id, t, pos) of each line whose key has ``least_chars`` code points: h and g name the key, doc_id and t the document."""
    lines = docs.select("doc_id", _text_key(F.col("text")).alias("t"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "t", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= max(least_chars, 1))
    return keys.select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"), "doc_id", "t", "pos")


def frequent(found: DataFrame, least_docs: int) -> DataFrame:
    """(h, g, n_docs, first) of the lines that ``least_docs`` documents hold; first is the place (doc_id, t, pos) of the first occurrence."""
    ranges = found.repartitionByRange(partitions(found.sparkSession), "h", "g", "doc_id", "t").sortWithinPartitions("h", "g", "doc_id", "t", "pos")
    # Neither shuffles nor sorts again: the ranges hold a document's occurrences of a line side by side.
    inside = Window.partitionBy("h", "g", "doc_id", "t").orderBy("pos")
    firsts = ranges.withColumn("_turn", F.row_number().over(inside)).where("_turn = 1")
    counted = firsts.groupBy("h", "g").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "t", "pos")).alias("first"))
    return counted.where(F.col("n_docs") >= least_docs)


def _dropped(docs: DataFrame, least_docs: int, least_chars: int, keep_first: bool) -> DataFrame:
    """(doc_id, t, starts, ends) of documents that lose lines: places, from 0, where runs of dropped lines start and where they end."""
    found = stage(occurrences(docs, least_chars))
    often = stage(frequent(found, least_docs))
    hit = found.join(F.broadcast(often) if often.count() <= MOST_BROUGHT else often, ["h", "g"])
    if keep_first:
        hit = hit.where(~F.struct("doc_id", "t", "pos").eqNullSafe(F.col("first")))
    per = hit.groupBy("doc_id", "t").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    starts = F.filter("at", lambda p, i: (i == 0) | (F.get(F.col("at"), i - 1) != p - 1))
    ends = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get(F.col("at"), i + 1) != p + 1))
    return stage(per.select("doc_id", "t", starts.alias("starts"), ends.alias("ends")))


def _with_bitmap(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Adds n_dropped and keep to rows (doc_id, t, n_lines and others)."""
    # Bitmaps grow with the documents: the join is the same at every size, and moves the rows once.
    small = dropped.hint("merge").select(F.col("doc_id").alias("_id"), F.col("t").alias("_t"), "starts", "ends")
    joined = rows.join(small, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left")
    # A kept and a dropped run for each run that is dropped, then what is left.
    kept = F.transform("starts", lambda s, i: s - F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("ends"), i - 1) + 1))
    gone = F.zip_with("starts", "ends", lambda s, e: e - s + 1)
    runs = F.flatten(F.zip_with(kept, gone, lambda k, d: F.array(k, d)))
    rest = F.array(F.col("n_lines") - 1 - F.element_at("ends", -1))
    keep = F.when(F.col("starts").isNull(), F.array(F.col("n_lines"))).otherwise(F.concat(runs, rest))
    n_dropped = F.coalesce(F.aggregate(gone, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return joined.withColumns({"n_dropped": n_dropped, "keep": keep}).select(*rows.columns, "n_dropped", "keep")


def keep_bitmaps(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """Which lines of docs (doc_id, text) stay: doc_id, t, n_lines, n_dropped and keep, without texts.

    Lines (split at \\n) are the same if they agree without white space at their ends and with A-Z in
    lower case. Those of ``least_chars`` code points at least that stand in ``least_docs`` documents lose
    all their lines, or with ``keep_first`` all but the first by (doc_id, text's hash t, position).

    keep is a compressed bitmap: lengths of runs of lines, in turn kept and dropped, from a kept one,
    which may be empty. A null or empty text is one empty line, which stays. Rows of one doc_id and text are
    one document, each with a row of its own; rows without doc_id are told by their texts. An empty table
    gives an empty one. Other columns are ignored.
    """
    dropped = _dropped(docs.select("doc_id", "text"), least_docs, least_chars, keep_first)
    rows = docs.select("doc_id", _text_key(F.col("text")).alias("t"), F.size(lines_of(F.col("text"))).alias("n_lines"))
    return _with_bitmap(rows, dropped).withColumn("n_lines", F.col("n_lines").cast("long"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that the bitmap keeps, joined by \\n. Linear in the number of lines."""
    flags = F.flatten(F.transform(keep, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    return F.array_join(F.zip_with(lines, flags, lambda line, stays: F.when(stays, line)), "\n")


def drop_frequent(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, keep, kept) with the text of the lines that stay, for each row of docs; see ``keep_bitmaps``."""
    slim = docs.select("doc_id", "text")
    dropped = _dropped(slim, least_docs, least_chars, keep_first)
    rows = slim.withColumns({"t": _text_key(F.col("text")), "n_lines": F.size(lines_of(F.col("text")))})
    marked = _with_bitmap(rows, dropped)
    # Texts that lose nothing are not taken apart.
    kept = F.when(F.col("n_dropped") == 0, F.coalesce("text", F.lit(""))).otherwise(kept_lines(lines_of(F.col("text")), F.col("keep")))
    return marked.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", "keep", kept.alias("kept"))
