"""Removal of long repeated substrings by suffix arrays over shards.

Every window of ``length`` bytes is filed under its minimizer, the 16-byte gram of least hash in it,
so equal windows lie in one shard wherever their documents are. Minimizers that only one document
has cannot belong to a repeat; the others' stretches of text go to shards. A shard drops equal
stretches, sorts the suffixes of the rest by induced sorting, and reads runs of common prefixes of
``length`` bytes or more: the windows of a run are equal, and those of a larger doc_id than the
run's smallest are repeats.

Windows in a row under one hash are one stretch, and a stretch that repeats itself with a short
period is sent as one period of windows with their number. Minimizers of very many occurrences are
not sent at all: each bucket of texts sends the different windows under them once, with its least
doc_id, and gets the least of all buckets back.

Between steps travel packed arrays (many documents or minimizers in a row), not a row for each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import partitions
from refinery.llm.suffix import common_prefixes, ranges, suffix_array
from refinery.operators.partitioning import spread

GRAM = 16
#: Bytes handled at once; positions within fit 24 bits.
CHUNK = 1 << 20
TEXT_IN_BUCKET, TEXT_IN_SHARD = 4 << 20, 4 << 20
#: A minimizer that occurs more often than this is settled by the windows' hashes of 128 bits.
HOT = 50_000
#: Keys that the copies of one text are dealt under.
SALTS = 32
#: Runs of more windows than this are looked at for a period.
LONG_RUN = 256
LOW24 = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def _pack48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _many(column, dtype) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, dtype) for b in column]) if len(column) else np.array([], dtype)


def _words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number."""
    return np.ndarray((max(len(buf) - 7, 0),), "<u8", np.ascontiguousarray(buf), strides=(1,))


def _grams(w: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each place on."""
    h = w[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= (w[8:] + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def may_repeat(buf: np.ndarray, begin: np.ndarray, size: np.ndarray, h: np.ndarray, length: int) -> np.ndarray:
    """Which of different strings, each of windows with minimizer h, may share a window with another one.

    Equal windows have the minimizer at one place. Besides it a window has length - GRAM bytes, so half of
    these agree on its left or on its right. Strings that hold their minimizer more than once are all kept.
    """
    half = (length - GRAM) // 2
    keep = np.zeros(len(begin), bool)
    if len(buf) < GRAM or half < 8:
        return ~keep
    w = _words(buf)
    of = np.repeat(np.arange(len(begin)), np.maximum(size - GRAM + 1, 0))
    at = ranges(begin, np.maximum(size - GRAM + 1, 0))
    hit = _grams(w)[at] >> np.uint64(16) == h[of]
    of, at = of[hit], at[hit]
    times = np.bincount(of, minlength=len(begin))
    keep |= times != 1
    once = times[of] == 1
    of, at = of[once], at[once]
    for left in (True, False):
        room = at - begin[of] >= half if left else begin[of] + size[of] - at - GRAM >= half
        o, first = of[room], at[room] - half if left else at[room] + GRAM
        key = h[o]
        for k in [*range(0, half - 8, 8), half - 8]:
            key = (key ^ w[first + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        _, same, n = np.unique(key, return_inverse=True, return_counts=True)
        keep[o[n[same] > 1]] = True
    return keep


def minimizers(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int):
    """Runs of windows whose minimizers have one hash: (text number, first window's place in buf, windows, hash of 48 bits)."""
    found = []
    lo = 0
    while lo < len(starts):
        # Texts that end within a chunk go together; any longer one is alone.
        hi = int(max(np.searchsorted(starts + sizes, starts[lo] + CHUNK, side="right"), lo + 1))
        s, size = starts[lo:hi], sizes[lo:hi]
        base, end = int(s[0]), int(s[-1] + size[-1])
        # A text longer than a chunk is read in overlapping chunks.
        for at in range(base, max(end - length + 1, base + 1), CHUNK if hi == lo + 1 else end - base + 1):
            part = buf[at : min(at + CHUNK + length - 1, end) if hi == lo + 1 else end]
            if len(part) < length:
                continue
            w = _words(part)
            g = len(part) - GRAM + 1
            h = _grams(w)
            key = (h & ~LOW24) | np.arange(g, dtype=np.uint64)
            span, have = length - GRAM + 1, 1
            while have * 2 <= span:
                key = np.minimum(key[:-have], key[have:])
                have *= 2
            if have < span:
                key = np.minimum(key[: len(key) - (span - have)], key[span - have :])
            if hi == lo + 1:
                windows = np.arange(len(part) - length + 1)
                text = np.full(len(windows), lo)
            else:
                count = np.maximum(size - length + 1, 0)
                windows, text = ranges(s - at, count), np.repeat(np.arange(lo, hi), count)
            if not len(windows):
                continue
            hashes = h[(key[windows] & LOW24).astype(np.int64)] >> np.uint64(16)
            first = np.concatenate([[0], np.flatnonzero((hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])) + 1])
            runs = np.diff(np.append(first, len(hashes)))
            found.append((text[first], windows[first] + at, runs, hashes[first]))
        lo = hi
    if not found:
        return np.array([], np.int64), np.array([], np.int64), np.array([], np.int64), np.array([], np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def one_period(buf: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Of runs of n windows from place ``at``: how many of them have all that differ. Fewer than n where the run repeats itself within the span of one window."""
    out = n.copy()
    for k in np.flatnonzero(n > LONG_RUN).tolist():
        run = buf[at[k] : at[k] + n[k] + length - 1]
        for p in range(1, length - GRAM + 2):
            if (run[p : p + LONG_RUN] == run[:LONG_RUN]).all() and (run[p:] == run[:-p]).all():
                out[k] = p
                break
    return out


def _rows(by: np.ndarray, parts: int, **arrays) -> pd.DataFrame:
    """One row for each value of ``by`` that occurs, with the packed parts of the arrays."""
    order = np.argsort(by, kind="stable")
    cuts = np.searchsorted(by[order], np.arange(parts + 1))
    has = np.flatnonzero(np.diff(cuts))
    out: dict = {"bucket": has.astype(np.int32)}
    for name, a in arrays.items():
        a = a[order]
        pack = _pack48 if name == "h" else (lambda x: x.tobytes())
        out[name] = [pack(a[cuts[k] : cuts[k + 1]]) for k in has]
    return pd.DataFrame(out)


def _bucket(doc: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(doc) % np.uint64(parts)).astype(np.int32)


def _texts(rows: pd.DataFrame):
    """Of packed texts: doc, row key, sizes, starts, buffer."""
    unzip = zstandard.ZstdDecompressor()
    doc, row, size = _many(rows["doc"], "<i8"), _many(rows["row"], "<u8"), _many(rows["size"], "<i8")
    buf = np.frombuffer(b"".join(unzip.decompress(x) for x in rows["body"]), np.uint8)
    return doc, row, size, np.cumsum(size) - size, buf


def _copies(rows: pd.DataFrame) -> np.ndarray:
    """Row keys of a bucket's copies, in order."""
    return np.sort(_many(rows["row"], "<u8")) if len(rows) else np.array([], np.uint64)


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    return some[np.minimum(np.searchsorted(some, keys), len(some) - 1)] == keys if len(some) else np.zeros(len(keys), bool)


def _windows(buf: np.ndarray, at: np.ndarray, n: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs of windows: (their windows' hashes (two numbers), least doc, the run that each was seen in first), equal runs and windows once."""
    seen: dict[bytes, tuple[int, int]] = {}
    for k, (a, m, d) in enumerate(zip(at.tolist(), n.tolist(), doc.tolist())):
        s = buf[a : a + m + length - 1].tobytes()
        known = seen.get(s)
        seen[s] = (k, d) if known is None else (known[0], min(known[1], d))
    best: dict[bytes, tuple[int, int]] = {}
    for s, (k, d) in seen.items():
        for i in range(len(s) - length + 1):
            w = xxhash.xxh3_128_digest(s[i : i + length])
            known = best.get(w)
            best[w] = (k, d) if known is None else (known[0], min(known[1], d))
    names = np.frombuffer(b"".join(best), "<u8").reshape(-1, 2)
    both = np.array(list(best.values()), np.int64).reshape(-1, 2)
    return names, both[:, 1], both[:, 0]


def _spans(flag: np.ndarray, windows: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs with ``windows`` flags each, which stand for n windows: (run, first byte, bytes) of what the flagged windows cover."""
    of = np.repeat(np.arange(len(windows)), windows)
    at = np.concatenate([[0], np.flatnonzero((flag[1:] != flag[:-1]) | (of[1:] != of[:-1])) + 1]) if len(flag) else np.array([], np.int64)
    size = np.diff(np.append(at, len(flag)))
    at, size = at[flag[at]], size[flag[at]]
    run = of[at]
    begin = np.cumsum(windows) - windows
    first, last = at - begin[run], at - begin[run] + size - 1
    # In a run with a period, a flagged window comes again each period: all between the first and the last is covered.
    period, left = windows[run], n[run] - 1
    turns, rest = left // period, left % period
    again = np.where(rest >= first, turns * period + np.minimum(last, rest), (turns - 1) * period + last)
    last = np.where(period < n[run], again, last)
    return run, first, last - first + length


def repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of docs (doc_id, text): spans are the maximal runs of removed bytes, as array<struct<start, end>>, kept the bytes left.

    A byte goes if a ``length``-byte string that covers it also starts in a document of smaller
    doc_id; strings are judged on the input. Null text is empty. Rows with a null doc_id are returned
    whole and take no part; rows with one doc_id do not count as each other's copies. Ties cannot
    occur otherwise; an empty table gives an empty one.
    """
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    nobody = every.where("doc_id is null").select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.expr("cast(array() as array<struct<start: long, end: long>>)").alias("spans"), F.col("body").alias("kept"))
    body = every.where("doc_id is not null")
    total = body.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    least = partitions(docs.sparkSession)
    buckets, shards = max(least, -(-total // TEXT_IN_BUCKET)), max(least, -(-total // TEXT_IN_SHARD))
    body = spread(body)

    def marks(batches):
        for b in batches:
            row = b["k"].to_numpy(np.int64).view(np.uint64) ^ _mixed(b["doc_id"].to_numpy(np.int64))
            yield _rows(_bucket(row, buckets), buckets, row=row)

    def packed(batches):
        for b in batches:
            doc, texts = b["doc_id"].to_numpy(np.int64), b["body"].tolist()
            row = np.array([xxhash.xxh64_intdigest(x, 42) for x in texts], np.uint64) ^ _mixed(doc)
            size = np.array([len(x) for x in texts], np.int64)
            by = _bucket(row, buckets)
            order = np.argsort(by, kind="stable")
            cuts = np.searchsorted(by[order], np.arange(buckets + 1))
            squeeze = zstandard.ZstdCompressor(level=1)
            for k in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[k] : cuts[k + 1]]
                yield pd.DataFrame({"bucket": [int(k)], "doc": [doc[at].astype("<i8").tobytes()], "row": [row[at].tobytes()], "size": [size[at].astype("<i8").tobytes()], "body": [squeeze.compress(b"".join(texts[i] for i in at))]})

    def anchors(texts: pd.DataFrame, copies: pd.DataFrame) -> pd.DataFrame:
        """The bucket's minimizers, each once: least doc, how often, and whether in several documents."""
        names = ["bucket", "doc", "h", "n", "origin"]
        if texts.empty:
            return pd.DataFrame({c: [] for c in names})
        doc, row, size, start, buf = _texts(texts)
        text, _, _, h = minimizers(buf, start, np.where(_among(row, _copies(copies)), 0, size), length)
        order = np.argsort(h, kind="stable")
        h, d = h[order], doc[text[order]]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[: len(h)])
        if not len(first):
            return pd.DataFrame({c: [] for c in names})
        low, high = np.minimum.reduceat(d, first), np.maximum.reduceat(d, first)
        often = np.minimum(np.diff(np.append(first, len(h))), (1 << 15) - 1)
        h = h[first]
        out = _rows((h % np.uint64(shards)).astype(np.int32), shards, doc=low.astype("<i8"), h=h, n=(often * 2 + (low < high)).astype("<u2"))
        return out.assign(origin=np.int32(texts["bucket"].iloc[0]))

    def shared(rows: pd.DataFrame) -> pd.DataFrame:
        doc, n, h = _many(rows["doc"], "<i8"), _many(rows["n"], "<u2").astype(np.int64), np.concatenate([_unpack48(x) for x in rows["h"]])
        origin = np.repeat(rows["origin"].to_numpy(np.int32), rows["n"].map(len).to_numpy() // 2)
        order = np.argsort(h, kind="stable")
        doc, n, h, origin = doc[order], n[order], h[order], origin[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        several = (np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)) | (np.bitwise_or.reduceat(n & 1, first) > 0)
        often = np.add.reduceat(n >> 1, first)
        each = np.diff(np.append(first, len(h)))
        several, often = np.repeat(several, each), np.repeat(often, each)
        return _rows(origin[several], buckets, h=h[several], hot=(often[several] > HOT).astype(np.uint8))

    def known_runs(texts, some: np.ndarray, skip: np.ndarray):
        """The texts' runs under the minimizers ``some`` (in order), and of each its place in that list."""
        doc, row, size, start, buf = texts
        text, at, n, h = minimizers(buf, start, np.where(skip, 0, size), length)
        place = np.minimum(np.searchsorted(some, h), len(some) - 1)
        hit = some[place] == h
        return text[hit], at[hit], n[hit], h[hit], place[hit]

    def stretches(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "doc", "row", "start", "size", "n", "h", "body", "origin"]
        copies = _copies(known[known["row"].notna()])
        known = known[known["row"].isna()]
        if texts.empty or known.empty:
            return pd.DataFrame({c: [] for c in names})
        doc, row, size, start, buf = unpacked = _texts(texts)
        asked, hot = np.concatenate([_unpack48(x) for x in known["h"]]), _many(known["hot"], np.uint8)
        order = np.argsort(asked)
        asked, hot = asked[order], hot[order]
        text, at, n, h, place = known_runs(unpacked, asked, _among(row, copies))
        differ, is_hot = one_period(buf, at, n, length), hot[place] > 0
        out = []
        if is_hot.any():
            windows, low, seen = _windows(buf, at[is_hot], differ[is_hot], doc[text[is_hot]], length)
            shard = (windows[:, 0] % np.uint64(shards)).astype(np.int64)
            for k in np.unique(shard):
                s = shard == k
                out.append((int(k), low[s].astype("<i8").tobytes(), windows[s].tobytes(), None, None, None, _pack48(h[is_hot][seen[s]]), None))
        text, at, n, h, differ = (x[~is_hot] for x in (text, at, n, h, differ))
        shard = (h // np.uint64(7) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        text, at, n, h, differ, shard = text[order], at[order], n[order], h[order], differ[order], shard[order]
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        for k in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[k], cuts[k + 1])
            whole = differ[s] + length - 1
            out.append((int(k), doc[text[s]].astype("<i8").tobytes(), row[text[s]].tobytes(), (at[s] - start[text[s]]).astype("<i8").tobytes(), whole.astype("<i4").tobytes(), n[s].astype("<i4").tobytes(), _pack48(h[s]), buf[ranges(at[s], whole)].tobytes()))
        return pd.DataFrame(out, columns=names[:-1]).assign(origin=np.int32(texts["bucket"].iloc[0]))

    def judge_windows(rows: pd.DataFrame) -> pd.DataFrame:
        """To each bucket that has them: windows that some other document has too, with the least doc of all."""
        windows, low = _many(rows["row"], "<u8").reshape(-1, 2), _many(rows["doc"], "<i8")
        h = np.concatenate([_unpack48(x) for x in rows["h"]])
        origin = np.repeat(rows["origin"].to_numpy(np.int32), rows["doc"].map(len).to_numpy() // 8)
        order = np.lexsort((windows[:, 1], windows[:, 0]))
        windows, low, h, origin = windows[order], low[order], h[order], origin[order]
        first = np.flatnonzero(np.concatenate([[True], (windows[1:] != windows[:-1]).any(1)]))
        least_doc = np.repeat(np.minimum.reduceat(low, first), np.diff(np.append(first, len(low))))
        return _rows(origin, buckets, window=windows, start=least_doc.astype("<i8"), h=h)

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        hot = rows["body"].isna()
        out = [judge_windows(rows[hot])] if hot.any() else []
        rows = rows[~hot]
        if len(rows):
            out.append(judge_stretches(rows))
        return pd.concat(out).reindex(columns=["bucket", "row", "start", "size", "window", "h"])

    def judge_stretches(rows: pd.DataFrame) -> pd.DataFrame:
        doc, row, start, n = _many(rows["doc"], "<i8"), _many(rows["row"], "<u8"), _many(rows["start"], "<i8"), _many(rows["n"], "<i4").astype(np.int64)
        size = _many(rows["size"], "<i4").astype(np.int64)
        text = b"".join(rows["body"])
        ends = np.cumsum(size)
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(text[e - n : e], len(seen)) for e, n in zip(ends.tolist(), size.tolist())], np.int64)
        strings = list(seen)
        lowest = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(lowest, which, doc)
        lengths = np.array([len(s) for s in strings], np.int64)
        begin = np.cumsum(lengths + 1) - lengths - 1
        earliest = np.repeat(lowest, lengths + 1)
        h = np.concatenate([_unpack48(x) for x in rows["h"]])[np.unique(which, return_index=True)[1]]
        _, same, times = np.unique(h, return_inverse=True, return_counts=True)
        # Windows of a stretch that is alone under its minimizer have no equal elsewhere.
        some = np.flatnonzero(times[same] > 1)
        if len(some):
            at = np.cumsum(lengths[some]) - lengths[some]
            some = some[may_repeat(np.frombuffer(b"".join([strings[k] for k in some]), np.uint8), at, lengths[some], h[some], length)]
        if len(some):
            # Symbol 0 parts the strings; bytes are one higher.
            sub = lengths[some]
            t = np.zeros(int(sub.sum()) + len(some), np.uint16)
            at = np.cumsum(sub + 1) - sub - 1
            t[ranges(at, sub)] = np.frombuffer(b"".join([strings[k] for k in some]), np.uint8).astype(np.uint16) + 1
            sa = suffix_array(t)
            group = np.cumsum(common_prefixes(t, sa) < length)
            owner = np.repeat(np.arange(len(some)), sub + 1)
            whole = sa + length <= (at + sub)[owner[sa]]
            sa, group = sa[whole], group[whole]
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            least_doc = np.repeat(np.minimum.reduceat(lowest[some][owner[sa]], first), np.diff(np.append(first, len(sa))))
            earliest[sa - at[owner[sa]] + begin[some][owner[sa]]] = least_doc
        windows = size - length + 1
        flag = earliest[ranges(begin[which], windows)] < np.repeat(doc, windows)
        run, first, covered = _spans(flag, windows, n, length)
        return _rows(_bucket(row[run], buckets), buckets, row=row[run], start=(start[run] + first).astype("<i8"), size=covered.astype("<i8"))

    def cut(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        doc, row, size, start, buf = unpacked = _texts(texts)
        copied = _among(row, _copies(found[found["start"].isna()])) & (size >= length)
        found = found[found["start"].notna()]
        edge = np.zeros(len(buf) + 1, np.int64)
        hot = found[found["window"].notna()]
        found = found[found["window"].isna()]
        if len(hot):
            least_of = {w: d for x, low in zip(hot["window"], hot["start"]) for w, d in zip([x[i : i + 16] for i in range(0, len(x), 16)], np.frombuffer(low, "<i8").tolist())}
            some = np.unique(np.concatenate([_unpack48(x) for x in hot["h"]]))
            text, at, n, _, _ = known_runs(unpacked, some, copied)
            differ = one_period(buf, at, n, length)
            made: dict[bytes, np.ndarray] = {}
            flags = []
            for a, m, d in zip(at.tolist(), differ.tolist(), doc[text].tolist()):
                s = buf[a : a + m + length - 1].tobytes()
                if s not in made:
                    made[s] = np.array([least_of[xxhash.xxh3_128_digest(s[i : i + length])] for i in range(m)], np.int64)
                flags.append(made[s] < d)
            run, first, covered = _spans(np.concatenate(flags) if flags else np.array([], bool), differ, n, length)
            np.add.at(edge, at[run] + first, 1)
            np.add.at(edge, at[run] + first + covered, -1)
        if len(found):
            by = np.argsort(row, kind="stable")
            r, a, n = _many(found["row"], "<u8"), _many(found["start"], "<i8"), _many(found["size"], "<i8")
            lo, hi = np.searchsorted(row[by], r), np.searchsorted(row[by], r, side="right")
            at = by[ranges(lo, hi - lo)]
            a, n = np.repeat(a, hi - lo), np.repeat(n, hi - lo)
            np.add.at(edge, start[at] + a, 1)
            np.add.at(edge, start[at] + a + n, -1)
        np.add.at(edge, start[copied], 1)
        np.add.at(edge, start[copied] + size[copied], -1)
        gone = np.cumsum(edge[:-1]) > 0
        out = []
        for d, s, n in zip(doc.tolist(), start.tolist(), size.tolist()):
            mask = gone[s : s + n]
            step = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
            spans = [{"start": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]
            out.append((d, n, spans, buf[s : s + n][~mask].tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])

    texts = body.mapInPandas(packed, "bucket int, doc binary, row binary, size binary, body binary").groupBy("bucket")
    named = body.select("doc_id", F.xxhash64("body").alias("k"), F.sha2("body", 256).alias("sha"))
    least_of = named.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("sha", "least")
    # The copies of one text are dealt under several keys.
    salted = least_of.select("sha", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    named = named.withColumn("_salt", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SALTS)).cast("int"))
    copies = named.join(salted, ["sha", "_salt"]).where("doc_id > least").select("doc_id", "k").mapInPandas(marks, "bucket int, row binary")
    marked = texts.cogroup(copies.groupBy("bucket")).applyInPandas(anchors, "bucket int, doc binary, h binary, n binary, origin int")
    marked = marked.groupBy("bucket").applyInPandas(shared, "bucket int, h binary, hot binary")
    marked = marked.unionByName(copies, allowMissingColumns=True)
    parts = texts.cogroup(marked.groupBy("bucket")).applyInPandas(stretches, "bucket int, doc binary, row binary, start binary, size binary, n binary, h binary, body binary, origin int")
    found = parts.groupBy("bucket").applyInPandas(judge, "bucket int, row binary, start binary, size binary, window binary, h binary")
    found = found.unionByName(copies, allowMissingColumns=True)
    done = texts.cogroup(found.groupBy("bucket")).applyInPandas(cut, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
    return done.unionByName(nobody)
