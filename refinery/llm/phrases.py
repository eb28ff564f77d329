"""Phrase collocations by SON partitioning: shards mined at lowered support, candidates counted exactly.

A shard is a run of texts of about SHARD_BYTES within a partition. Three passes go over the texts:

1. Words are counted, which gives each language's number of words and the words that are frequent.
2. Each shard is mined completely, level by level, at the support lowered to its share of its
   language's words: a phrase that is frequent overall is so in one shard at least. What a shard does
   not report occurs there less often than its support, so reported counts and these gaps bound every
   phrase's count from above; phrases whose bound stays below the support are no candidates. Shards
   of a large corpus have a support of one, so pairs of words are mined in a pass of their own, and longer
   phrases only where all their pairs are candidates. Reports are hashes, not phrases.
3. Candidates are counted in all texts.

Words and candidates reach the tasks as bitmaps of their hashes, of one size whatever their number; a
phrase that only looks like a candidate is counted too, and its count is as exact as any.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import stage
from refinery.operators.partitioning import spread

#: Bytes of text of a shard (more only where one text is longer), and of text that is split into words at a time.
SHARD_BYTES, CHUNK_BYTES = 40 << 20, 1 << 20
#: Bits of a bitmap of hashes: 8 MB.
BITS = 1 << 26
#: Groups in which a language's phrases are ranked before they are ranked together.
SALTS = 64
ROWS = 20_000
#: Places of a shard whose phrases are sorted together.
PLACES = 1 << 19
#: Languages that are broadcast; more are joined by shuffling.
MOST_BROUGHT = 100_000
#: A-Z in lower case, ends of pieces as \n, white space within pieces as a space.
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
END, EMPTY = 0, 1


class Shard:
    """Words of some texts as numbers, a sequence for each language: END between pieces, words from 2."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.vocabulary[b"\n"], self.vocabulary[b""]
        self.parts: dict[str, list[np.ndarray]] = defaultdict(list)
        self.totals: dict[str, int] = {}
        self.bytes = 0

    def add(self, lang: str, text: str, total: int) -> None:
        data = text.encode("utf-8", "surrogatepass").translate(TABLE)
        self.bytes += len(data)
        self.totals[lang] = total
        for part in chunks(data):
            tokens = part.replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int32, len(tokens))
            self.parts[lang].append(ids[ids != EMPTY])
        self.parts[lang].append(np.array([END], np.int32))

    def sequences(self) -> Iterator[tuple[str, np.ndarray, int]]:
        """Each language once; its parts go as they are put together."""
        while self.parts:
            lang, parts = self.parts.popitem()
            yield lang, np.concatenate(parts), self.totals[lang]

    def words(self) -> np.ndarray:
        return np.array(list(self.vocabulary), dtype=object)


def chunks(data: bytes) -> Iterator[bytes]:
    """data in pieces of about CHUNK_BYTES, cut before a space or the end of a piece."""
    at = 0
    while len(data) - at > CHUNK_BYTES:
        to = at + CHUNK_BYTES
        cut = max(data.rfind(b" ", at + 1, to), data.rfind(b"\n", at + 1, to))
        if cut < 0:
            cut = min((c for c in (data.find(b" ", to), data.find(b"\n", to)) if c >= 0), default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def hashes(words: np.ndarray, lang: str) -> np.ndarray:
    """A hash of each word in its language."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(of_words: np.ndarray, seq: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of each phrase of ``size`` words that begins at a place of ``at``."""
    h = np.full(len(at), size, np.uint64)
    for k in range(size):
        h = _mixed(h * np.uint64(0xC2B2AE3D27D4EB4F) + of_words[seq[at + k]])
    return h


def seen(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(BITS - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _listed_words(bitmap: np.ndarray, of_words: np.ndarray) -> np.ndarray:
    numbers = np.arange(len(of_words))
    return seen(bitmap, phrase_hashes(of_words, numbers, numbers, 1))


def levels(seq: np.ndarray, n_words: int, usable: np.ndarray, longest: int, stays: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first places, counts) of phrases of two words and more whose parts all stay; those of one size come in several portions.

    ``usable`` says which words may be part of a phrase, ``stays`` which phrases of a size (given by
    first places and counts) do.
    """
    # Places where a phrase of the last size begins that stays, and its number.
    at = np.flatnonzero(usable[seq]).astype(np.int32)
    number = seq[at]
    for size in range(2, longest + 1):
        follows = np.flatnonzero(at[1:] == at[:-1] + 1).astype(np.int32)
        if not len(follows):
            return
        # Equal phrases have equal first numbers: some of these at a time, so that sorting takes little room.
        parts = -(-len(follows) // PLACES)
        part = (number[follows] % parts).astype(np.int16)
        of, n_stay = np.full(len(follows), -1, np.int32), 0
        for p in range(parts):
            here = np.flatnonzero(part == p).astype(np.int32)
            if not len(here):
                continue
            places = at[follows[here]]
            code = number[follows[here]].astype(np.int64) * n_words + seq[places + (size - 1)]
            _, first, which, counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
            good = stays(size, places[first], counts)
            yield size, places[first[good]], counts[good]
            of[here] = np.where(good, n_stay + np.cumsum(good) - 1, -1)[which]
            n_stay += int(good.sum())
        at, number = at[follows[of >= 0]], of[of >= 0]


def _texts(words: np.ndarray, seq: np.ndarray, at: np.ndarray, size: int) -> list[str]:
    columns = [words[seq[at + k]] for k in range(size)]
    return [b" ".join(w).decode("utf-8", "surrogatepass") for w in zip(*columns)]


COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("hash", pa.int64()), ("count", pa.int64())])
REPORTED = pa.schema([("tongue", pa.int64()), ("part", pa.int32()), ("gap", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
COUNTED_SQL, REPORTED_SQL = "lang string, phrase string, size int, hash long, count long", "tongue long, part int, gap long, hashes binary, counts binary"


def _counts(lang: str, words: np.ndarray, of_words: np.ndarray, seq: np.ndarray, at: np.ndarray, size: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the phrases that begin at the places of ``at``, some at a time, since texts take room."""
    for lo in range(0, len(at), ROWS):
        part, n = at[lo : lo + ROWS], counts[lo : lo + ROWS]
        columns = [[lang] * len(part), _texts(words, seq, part, size), np.full(len(part), size, np.int32), phrase_hashes(of_words, seq, part, size).view(np.int64), n.astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTED)], schema=COUNTED)


def _reports(tongue: int, h: np.ndarray, counts: np.ndarray, gap: int, parts: int) -> Iterator[pa.RecordBatch]:
    """A row for each range of the hashes, with what the shard reports there; that of part -1 names the gap alone."""
    part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(part, kind="stable")
    part, h, n = part[by], h[by].astype("<u8"), np.minimum(counts[by], 1 << 30).astype("<i4")
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.array([], np.int64)
    ends = np.append(first[1:], len(part))
    rows = [(tongue, -1, gap, b"", b""), *((tongue, int(part[lo]), gap, h[lo:hi].tobytes(), n[lo:hi].tobytes()) for lo, hi in zip(first.tolist(), ends.tolist()))]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), REPORTED)], schema=REPORTED)


def _over_shards(of: Callable[[Shard], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task over batches of (lang, text, total): cuts them into shards and gives what ``of`` finds in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for row in zip(*(c for c in batch.columns)):
                shard.add(*(v.as_py() for v in row))
                if shard.bytes >= SHARD_BYTES:
                    yield from of(shard)
                    shard = Shard()
        if shard.bytes:
            yield from of(shard)

    return run


def _count_words(shard: Shard) -> Iterator[pa.RecordBatch]:
    words = shard.words()
    numbers = np.arange(len(words))
    for lang, seq, _ in shard.sequences():
        counts = np.bincount(seq, minlength=len(words))
        counts[END] = 0
        ids = np.flatnonzero(counts)
        yield from _counts(lang, words, hashes(words, lang), numbers, ids, 1, counts[ids])


def _mine(least: int, shortest: int, longest: int, parts: int, frequent, pairs=None) -> Callable[[Shard], Iterator[pa.RecordBatch]]:
    """What a shard reports: hashes of its phrases of lowered support, from ``shortest`` to ``longest`` words, and the support less one as the gap of all others (count 0)."""

    def of(shard: Shard) -> Iterator[pa.RecordBatch]:
        words = shard.words()
        for lang, seq, total in shard.sequences():
            counts = np.bincount(seq, minlength=len(words))
            counts[END] = 0
            support = max(-(-least * int(counts.sum()) // total), 1)
            of_words = hashes(words, lang)
            tongue = int(np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))).astype(np.int64))
            usable = (counts >= support) & _listed_words(frequent.value, of_words)

            def stays(size: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
                enough = n >= support  # noqa: B023
                return enough if size >= shortest else enough & seen(pairs.value, phrase_hashes(of_words, seq, at, size))  # noqa: B023

            found = [(phrase_hashes(of_words, seq, at, size), n) for size, at, n in levels(seq, len(words), usable, longest, stays) if size >= shortest]
            h = np.concatenate([np.array([], np.uint64), *(x for x, _ in found)])
            yield from _reports(tongue, h, np.concatenate([np.array([], np.int64), *(n for _, n in found)]), support - 1, parts)

    return of


def _count(longest: int, frequent, candidates) -> Callable[[Shard], Iterator[pa.RecordBatch]]:
    def of(shard: Shard) -> Iterator[pa.RecordBatch]:
        words = shard.words()
        for lang, seq, _ in shard.sequences():
            of_words = hashes(words, lang)
            usable = _listed_words(frequent.value, of_words)
            usable[[END, EMPTY]] = False
            listed = lambda size, at, n: seen(candidates.value, phrase_hashes(of_words, seq, at, size))  # noqa: B023, E731
            for size, at, n in levels(seq, len(words), usable, longest, listed):
                yield from _counts(lang, words, of_words, seq, at, size, n)

    return of


def _bits(found: DataFrame) -> np.ndarray:
    """The bits of all hashes: BITS / 8 bytes, whatever the number of rows."""
    bit = F.col("hash").bitwiseAND(BITS - 1) + 1
    rows = found.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("bit"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        part = np.frombuffer(r["bits"], np.uint8)
        out[(r["bucket"] - 1) * len(part) :][: len(part)] = part
    return out


def _likely(mined: DataFrame, least: int) -> DataFrame:
    """(hash) of the phrases that may have ``least`` occurrences: a shard that does not report one holds it its gap times at most. A task sums up one range of hashes."""
    mined = stage(mined)
    gaps = stage(mined.where("part < 0").groupBy("tongue").agg(F.sum("gap").alias("gaps")).where("gaps > 0"))
    if gaps.count() <= MOST_BROUGHT:
        gaps = F.broadcast(gaps)
    known = mined.where("part >= 0").join(gaps, "tongue", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)))

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        h = [np.frombuffer(x, "<u8") for x in rows["hashes"]]
        size = [len(x) for x in h]
        over = np.concatenate([np.frombuffer(x, "<i4").astype(np.int64) - gap for x, gap in zip(rows["counts"], rows["gap"])])
        h, gaps = np.concatenate(h), np.repeat(rows["gaps"].to_numpy(), size)
        by = np.argsort(h)
        h, over, gaps = h[by], over[by], gaps[by]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        good = first[np.add.reduceat(over, first) + gaps[first] >= least]
        return pd.DataFrame({"hash": h[good].view(np.int64)})

    return known.select("part", "gap", "gaps", "hashes", "counts").groupBy("part").applyInPandas(total, "hash long")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, hash, f) of every word."""
    rows = docs.select("lang", "text", F.lit(0).cast("long").alias("total"))
    found = rows.mapInArrow(_over_shards(_count_words), COUNTED_SQL)
    return found.groupBy("lang", "phrase").agg(F.first("hash").alias("hash"), F.sum("count").alias("f"))


def counted(docs: DataFrame, words: DataFrame, totals: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, size, a): every phrase of 2 to ``longest`` words with ``least`` occurrences or more, counted exactly."""
    context = docs.sparkSession.sparkContext
    frequent = context.broadcast(_bits(words.where(F.col("f") >= least)))
    size = words.agg(F.sum(F.col("f") * (F.octet_length("phrase") + 1))).first()[0] or 0
    # Larger shards have a higher support; there are two for each core at least.
    shards = max(2 * context.defaultParallelism, -(-int(size) // SHARD_BYTES))
    texts = docs.join(totals.select("lang", F.col("n").alias("total")), "lang").select("lang", "text", "total").coalesce(shards)
    bits = _bits(_likely(texts.mapInArrow(_over_shards(_mine(least, 2, 2, shards, frequent)), REPORTED_SQL), least))
    if longest > 2:
        pairs = context.broadcast(bits)
        bits = bits | _bits(_likely(texts.mapInArrow(_over_shards(_mine(least, 3, longest, shards, frequent, pairs)), REPORTED_SQL), least))
    candidates = context.broadcast(bits)
    found = texts.mapInArrow(_over_shards(_count(longest, frequent, candidates)), COUNTED_SQL)
    return stage(found.groupBy("lang", "phrase", "size").agg(F.sum("count").alias("a")).where(F.col("a") >= least))


def _whole(c: Column) -> Column:
    """Whole numbers whose products do not overflow."""
    return c.cast("decimal(19,0)")


def _words(first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of the lowest-scoring cut, ties to the shortest first part."""
    # Each part of a frequent phrase is frequent too.
    parts = words.select("lang", "phrase", "f").unionByName(phrases.select("lang", "phrase", F.col("a").alias("f")))
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"_first": _words(F.lit(1), F.col("cut")), "_rest": _words(F.col("cut") + 1, F.col("size") - F.col("cut"))})
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l")), ["lang", "_first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["lang", "_rest"])
    cuts = cuts.withColumns({"_above": F.lit(2_000_000).cast("decimal(7,0)") * _whole(F.col("a")), "_below": _whole(F.col("l")) + _whole(F.col("r"))})
    cuts = cuts.withColumn("score", F.expr("_above div _below"))
    lowest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_cut"))
    return lowest.select("lang", "phrase", "size", "a", "_cut.l", "_cut.r", "_cut.score")


def held_by_longer(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """(lang, phrase) of the phrases that one longer phrase holds in ``percent`` of their occurrences."""
    spans = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for n in range(2, 16) for i in range(1, 17 - n)])
    inside = F.filter(spans, lambda s: (s["n"] < F.col("size")) & (s["i"] + s["n"] <= F.col("size") + 1))
    parts = phrases.where("size > 2").select("lang", "phrase", F.col("a").alias("longer"), F.explode(inside).alias("s"))
    most = parts.select("lang", _words(F.col("s.i"), F.col("s.n")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return phrases.join(most, ["lang", "phrase"]).where(_whole(F.col("longer")) * 100 >= _whole(F.col("a")) * percent).select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, percent: int = 80) -> DataFrame:
    """The first ``top`` phrases of each language of docs (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z) are pieces, split at ``.,;:!?`` and line ends, of words, split at spaces and tabs.
    a counts a phrase's occurrences within pieces; of its cuts into two parts, which occur l and r times,
    the one of the lowest score 2000000 a / (l + r), rounded down, counts. Phrases that a longer one holds in
    ``percent`` of their occurrences are left out. Ranked by score, a (both descending) and phrase in byte order.

    A null lang is und, a null or empty text has no words, repeated rows count as often as they stand there,
    docs without phrases give no rows. Other columns are ignored. ``longest`` is 16 at most. A task holds one
    shard: some ten times SHARD_BYTES.
    """
    if not 2 <= longest <= 16:
        raise ValueError("phrases have 2 to 16 words")
    rows = spread(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")))
    words = stage(word_counts(rows))
    # Some rows: where the file is small, it is broadcast to the texts, whose size then does not matter.
    totals = stage(words.groupBy("lang").agg(F.sum("f").alias("n")))
    phrases = counted(rows, words, totals, least, longest)
    known = scored(phrases, stage(words.where(F.col("f") >= least)))
    known = known.join(held_by_longer(phrases, percent), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # No task ranks all phrases of a language: the first of each group, then the first of these.
    some = Window.partitionBy("lang", "_salt").orderBy(*order)
    known = known.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("_turn", F.row_number().over(some)).where(F.col("_turn") <= top)
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
