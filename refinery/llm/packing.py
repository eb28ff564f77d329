"""Packing token sequences: a configuration linear program over the length histogram.

Lengths are at most the capacity, so the histogram has at most that many rows whatever the corpus
is; it alone comes to the driver. The program's columns are configurations (lengths that share a
sequence), priced by a knapsack over multiplicative weights; it is rounded down, solved again for
what is left, and the last few pieces are placed by best fit. The plan, a bounded table, is joined
to the pieces by their rank within their length.
"""

from __future__ import annotations

import base64
import json
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import stage
from refinery.operators.partitioning import spread

#: Texts with other characters than these, or with a special token's string, take the slower library.
COMMON = re.compile(r"[^\x00-ɏ‐-‧]")
#: White space of COMMON letters. Longer runs than this go to the faster library as one piece, past its regex, which keeps a stack of them.
SPACE, MOST_SPACE = "[\\t-\\r \x85\xa0]", 1 << 16
RUN = re.compile(f"(?<!{SPACE}){SPACE}{{{MOST_SPACE},}}")
# Fixed value: the splitting pattern of byte-level pre-tokenizers.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 4
PRICINGS = 250
STEP = 0.15
PIECES_IN_BUCKET = 1024
MOST_BUCKETS = 65536


def is_plain(spec: dict) -> bool:
    """Whether a tokenizer file is what the faster library does: byte-level BPE with the usual split, no normalizer, and merges in order of their ids."""
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or model.get("type", "BPE") != "BPE":
        return False
    if any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    vocab = model["vocab"]
    made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    single = [vocab.get(c, -1) for c in _byte_letters().values()]
    return min(single) >= 0 and [max(single), *made] == sorted({max(single), *made}) and len(vocab) - len(made) - 256 <= len(spec.get("added_tokens", ()))


class Encoder:
    """Ids of a byte-level BPE tokenizer file, special tokens' strings read as the file says.

    The same vocabulary runs in the faster of two libraries for texts in common letters, where the
    two agree (tests compare them), and in the file's own library for all others, for files that are
    not plain byte-level BPE, and wherever the faster one gives up.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.fast = None
        if is_plain(spec):
            byte_of = {c: b for b, c in _byte_letters().items()}
            ranks = {bytes(byte_of[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in special}
            self.fast = tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or COMMON.search(text) or (self.special and self.special.search(text)):
            return self._by_file(text)
        try:
            return self._by_pieces(text)
        except BaseException as e:
            # The library's own failures are no Exception.
            if isinstance(e, Exception) or type(e).__name__ == "PanicException":
                return self._by_file(text)
            raise

    def _by_file(self, text: str) -> np.ndarray:
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _by_pieces(self, text: str) -> np.ndarray:
        if len(text) < MOST_SPACE:
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        out, at = [], 0
        for m in RUN.finditer(text):
            # All of the run but its last character is one piece, unless the text ends with it.
            end = m.end() - (m.end() < len(text))
            out.append(np.array(self.fast.encode_ordinary(text[at : m.start()]), dtype="<u4"))
            out.append(np.array(self.fast._encode_single_piece(text[m.start() : end].encode()), dtype="<u4"))
            at = end
        out.append(np.array(self.fast.encode_ordinary(text[at:]), dtype="<u4"))
        return np.concatenate(out)


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself where printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of docs (doc_id, text).

    A document is its ids and then ``end_id``. One longer than ``capacity`` is cut into full pieces,
    but for the first, which holds the rest. Null text is empty: one piece of one id.
    """

    def cut(batches):
        encode = Encoder(tokenizer)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                n = -(-len(ids) // capacity)
                first = len(ids) - capacity * (n - 1)
                for k in range(n):
                    lo, hi = (0, first) if k == 0 else (first + capacity * (k - 1), first + capacity * k)
                    part = ids[lo:hi]
                    rows.append((doc, k, lo, hi - lo, zlib.crc32(part.tobytes())) + ((part.astype(np.int32),) if with_ids else ()))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    # Ids travel as text: in a batch with a null, numbers would pass through doubles.
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    out = spread(docs.select(F.col("doc_id").cast("string"), "text")).mapInPandas(cut, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def best_value(values: np.ndarray, capacity: int) -> dict[int, int]:
    """The knapsack: how many of each length (index; 0 unused) have most value together within the capacity."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int32)
    sizes = np.flatnonzero(values > 0)
    worth = values[sizes]
    for room in range(1, capacity + 1):
        k = np.searchsorted(sizes, room, side="right")
        best[room] = best[room - 1]
        if k:
            with_one = best[room - sizes[:k]] + worth[:k]
            at = int(with_one.argmax())
            if with_one[at] > best[room]:
                best[room], last[room] = with_one[at], sizes[at]
    out: dict[int, int] = {}
    room = capacity
    while room > 0:
        if last[room]:
            out[int(last[room])] = out.get(int(last[room]), 0) + 1
            room -= int(last[room])
        else:
            room -= 1
    return out


def fractional(counts: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Configurations and how often each is used, covering no length more often than it occurs."""
    weight = np.where(counts > 0, 1.0, 0.0)
    covered, used = np.zeros(len(counts)), {}
    safe = np.maximum(counts, 1)
    for _ in range(PRICINGS):
        config = best_value(weight / safe, capacity)
        if not config:
            break
        sizes = np.array(list(config), dtype=np.int64)
        times = np.array(list(config.values()), dtype=float)
        often = float((counts[sizes] / times).min())
        key = tuple(sorted(config.items(), reverse=True))
        used[key] = used.get(key, 0.0) + often
        gain = times * often / counts[sizes]
        covered[sizes] += gain
        weight[sizes] *= np.exp(-STEP * gain)
        weight /= weight.max()
    most = covered.max() if used else 1.0
    return {k: v / most for k, v in used.items()}


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, over equal sequences at once: (lengths, how many such sequences)."""
    by_room: dict[int, dict[tuple, int]] = {}
    for size in range(len(counts) - 1, 0, -1):
        left = int(counts[size])
        while left:
            room = min((r for r in by_room if r >= size), default=None)
            if room is None:
                fit = capacity // size
                for take, n in ((fit, left // fit), (left % fit, 1)):
                    if take and n:
                        group = by_room.setdefault(capacity - take * size, {})
                        key = (size,) * take
                        group[key] = group.get(key, 0) + n
                break
            key, n = next(iter(by_room[room].items()))
            take = min(n, left)
            by_room[room][key] -= take
            if not by_room[room][key]:
                del by_room[room][key]
                if not by_room[room]:
                    del by_room[room]
            new = key + (size,)
            group = by_room.setdefault(room - size, {})
            group[new] = group.get(new, 0) + take
            left -= take
    return [(key, n) for group in by_room.values() for key, n in group.items()]


def plan(histogram: dict[int, int], capacity: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), covering the histogram exactly."""
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    out = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    for _ in range(ROUNDS):
        if counts.sum() < 4 * capacity:
            break
        before = counts.sum()
        for config, often in sorted(fractional(counts, capacity).items(), key=lambda x: -x[1]):
            n = min([int(often + 1e-9), *(int(counts[s]) // k for s, k in config)])
            if n:
                out.append((tuple(s for s, k in config for _ in range(k)), n))
                for s, k in config:
                    counts[s] -= k * n
        if counts.sum() > 0.95 * before:
            break
    return out + best_fit(counts, capacity)


def pack(parts: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to ``parts`` (doc_id, piece, length, ...), length from 1 to ``capacity``.

    Sequences hold at most ``capacity`` ids without gaps. Equal rows get places of their own; nulls
    in doc_id are allowed; an empty table gives an empty one.
    """
    rows = stage(parts)
    sizes = rows.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in sizes.collect()}
    buckets = min(max(-(-sum(histogram.values()) // PIECES_IN_BUCKET), 1), MOST_BUCKETS)
    segments, at, used = [], 0, dict.fromkeys(histogram, 0)
    for lengths, n in plan(histogram, capacity):
        offset = 0
        for size in lengths:
            segments.append((size, used[size], used[size] + n, at, offset))
            used[size] += n
            offset += size
        at += n
    # Bounded by the number of configurations, which does not depend on the rows.
    places = rows.sparkSession.createDataFrame(segments, "_length long, _from long, _to long, _first long, offset long")
    # Dealt by the whole row, so that a repeated or null doc_id is no group of its own.
    names = [c for c in parts.columns if c != "ids"]
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    tally = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    tally = tally.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*names)) - 1)
    ranked = ranked.join(tally, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.col("_rank"))
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(F.broadcast(places), here).withColumn("sequence_id", F.col("_first") + F.col("_rank") - F.col("_from"))
    return placed.select(*parts.columns, "sequence_id", "offset")
