"""Toxicity: a learned lexicon, searched with Levenshtein automata, and scores of the context.

Terms and stems are learned from labelled rows; a token is looked up by walking the lexicon trie
with the states of the token's Levenshtein automaton, whose sets are memoised, so that most tokens
end after a few letters. Each hit is weighed by its window: quoted and reported words count apart
from words said to somebody. A logistic regression over these sums gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import stage
from refinery.operators.partitioning import spread

TOKEN = re.compile(r"[^\W_]+")
#: Bounds of the labelled sample, of the lexicon and of the memo of looked-up words.
MOST_TOXIC, MOST_CLEAN, MOST_TERMS, MOST_WORDS = 4000, 12000, 2000, 500_000
WINDOW = 8
#: Toxic texts, copies aside, that a term must be in.
LEAST_DOCS = 3
#: Clean texts taken for granted.
PRIOR = 20
#: How many times as often as by chance the words of a beginning are toxic, the most toxic of them left out.
STEM_LIFT = 15
# Words around a quotation, and words that speak to somebody.
REPORTS = frozenset("said says wrote writes quoted quote called term word dit écrit cité mot sagte schrieb zitiert wort dijo escribió citó palabra".split())
SECOND = frozenset("you your you're u tu te toi vous ton ta du dich dir ihr euch dein tú usted ustedes vosotros".split())
QUOTES = re.compile("[\"“”„«»‹›]")
NAMES = ("abuse", "exact", "fuzzy", "quoted", "rate", "any", "peak")


class Lexicon:
    """Terms (word, weight, stem) as a trie, walked with Levenshtein states. A stem stands for every word that begins with it."""

    def __init__(self, terms: list[tuple[str, float, bool]]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.term: list[tuple[float, int] | None] = [None]
        self.stem: list[float | None] = [None]
        self.room = [0]
        for word, weight, stem in terms:
            edits = 0 if stem or len(word) < 5 else 1 if len(word) < 8 else 2
            at = 0
            self.room[0] = max(self.room[0], edits)
            for ch in word:
                if ch not in self.next[at]:
                    self.next[at][ch] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.room.append(0)
                at = self.next[at][ch]
                self.room[at] = max(self.room[at], edits)
            if stem:
                self.stem[at] = weight
            else:
                self.term[at] = (weight, edits)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[float, int] | None] = []
        self.start = self._state(self._closed({0: 0}))
        self.memo: dict[str, tuple[float, int] | None] = {}

    def _closed(self, reached: dict[int, int]) -> frozenset:
        todo = list(reached)
        while todo:
            node = todo.pop()
            e = reached[node] + 1
            for child in self.next[node].values():
                if e <= self.room[child] and e < reached.get(child, 99):
                    reached[child] = e
                    todo.append(child)
        return frozenset(reached.items())

    def _state(self, key: frozenset) -> int:
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            hits = [(self.term[n][0], e) for n, e in key if self.term[n] and e <= self.term[n][1]]
            hits += [(self.stem[n], 0) for n, e in key if self.stem[n] is not None and e == 0]
            self.ends.append(min(hits, key=lambda h: (h[1], -h[0])) if hits else None)
        return self.states[key]

    def _step(self, state: int, ch: str) -> int:
        reached: dict[int, int] = {}
        for node, e in self.sets[state]:
            if self.stem[node] is not None and e == 0:
                reached[node] = 0
            if e + 1 <= self.room[node]:
                reached[node] = min(reached.get(node, 99), e + 1)
            for c, child in self.next[node].items():
                cost = e + (c != ch)
                if cost <= self.room[child]:
                    reached[child] = min(reached.get(child, 99), cost)
        to = self._state(self._closed(reached)) if reached else -1
        self.moves[state][ch] = to
        return to

    def find(self, word: str) -> tuple[float, int] | None:
        """(weight, edits) of the closest term, or None."""
        if word in self.memo:
            return self.memo[word]
        state = self.start
        for ch in word:
            to = self.moves[state].get(ch)
            state = self._step(state, ch) if to is None else to
            if state < 0:
                break
        hit = self.ends[state] if state >= 0 else None
        if len(self.memo) >= MOST_WORDS:
            self.memo.clear()
        self.memo[word] = hit
        return hit

    def features(self, text: str | None) -> list[float]:
        low = (text or "").lower()
        words = TOKEN.findall(low)
        hits = [(i, h) for i, h in enumerate(map(self.find, words)) if h]
        if not hits:
            return [0.0] * len(NAMES)
        spans = [m.span() for m in TOKEN.finditer(low)]
        at = [i for i, _ in hits]
        sums = dict.fromkeys(NAMES, 0.0)
        lo = 0
        for k, (i, (weight, edits)) in enumerate(hits):
            while at[lo] < i - WINDOW:
                lo += 1
            near = words[max(0, i - WINDOW) : i + WINDOW + 1]
            begin = spans[max(0, i - 4 * WINDOW)][0]
            begin = max(begin, low.rfind("\n", begin, spans[i][0]) + 1)
            quoted = len(QUOTES.findall(low, begin, spans[i][0])) % 2 == 1 or not REPORTS.isdisjoint(near)
            said_to = not SECOND.isdisjoint(near)
            score = weight * (0.6**edits) * (0.3 if quoted else 1.0) * (1.0 + 0.25 * said_to + 0.25 * (k - lo))
            sums["abuse"] += score
            sums["peak"] = max(sums["peak"], score)
            sums["quoted" if quoted else "fuzzy" if edits else "exact"] += 1
        sums["rate"] = 100.0 * sums["abuse"] / len(words)
        sums["any"] = 1.0 if sums["exact"] + sums["fuzzy"] else 0.0
        return [math.log1p(sums[n]) for n in NAMES]


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic): at most MOST_TOXIC toxic and MOST_CLEAN other labelled rows outside the held-out part, those of least hash; of rows that share an id the first text."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out()).withColumn("_h", F.xxhash64("doc_id", F.lit(11)))
    some = known.where("toxic = 1").orderBy("_h").limit(MOST_TOXIC).unionByName(known.where("toxic <> 1").orderBy("_h").limit(MOST_CLEAN))
    # The sample's ids are bounded by the limits above.
    found = docs.select("doc_id", "text").join(F.broadcast(some.select("doc_id", "toxic")), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn_lexicon(sample: DataFrame) -> list[tuple[str, float, bool]]:
    """Words, and beginnings of words, that toxic rows use far more often.

    What counts is in how many different contexts (the word before and the word after) a word is
    used, so that copies of one text do not make its rare words look toxic.
    """

    def uses(batches):
        for b in batches:
            found = set()
            for doc, text, toxic in zip(b["doc_id"], b["text"], b["toxic"]):
                words = TOKEN.findall((text or "").lower())
                found.update((w, p, n, int(toxic == 1), doc) for p, w, n in zip(["", *words], words, [*words[1:], ""]) if 3 <= len(w) <= 40)
            yield pd.DataFrame(list(found), columns=["word", "before", "after", "toxic", "doc"])

    sample = sample.select(F.xxhash64("doc_id").alias("doc_id"), "text", "toxic")
    seen = sample.mapInPandas(uses, "word string, before string, after string, toxic int, doc long")
    # A context that copies share belongs to one of them.
    seen = seen.groupBy("word", F.xxhash64("before", "after").alias("context"), "toxic").agg(F.min("doc").alias("doc"))
    bad_doc = F.when(F.col("toxic") == 1, F.col("doc"))
    counted = stage(seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"), F.collect_set(bad_doc).alias("docs")))
    bad, good = counted.agg(F.sum("bad"), F.sum("good")).first()
    if not bad:
        return []
    share = bad / (bad + (good or 0))

    def telling(df: DataFrame) -> DataFrame:
        expected = (F.col("bad") + F.col("good")) * share
        more = F.col("bad") / F.greatest(expected, F.lit(1e-9))
        return df.withColumn("g", 2 * F.col("bad") * F.log(more)).where(F.col("bad") * (1 - share) > 4 * share * F.col("good"))

    words = telling(counted).where((F.col("g") >= 20) & (F.size("docs") >= LEAST_DOCS)).orderBy(F.desc("g"), "word").limit(MOST_TERMS).collect()
    stems: dict[str, float] = {}
    for size in (4, 5, 6, 7):
        part = counted.where(F.length("word") > size).groupBy(F.substring("word", 1, size).alias("word"))
        part = part.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("forms"), F.max("bad").alias("top"), F.size(F.array_distinct(F.flatten(F.collect_list("docs")))).alias("docs"))
        # A beginning has to tell by many words, not by one of them.
        pure = telling(part).where((F.col("g") >= 25) & (F.col("docs") >= LEAST_DOCS) & (F.col("forms") >= 5) & ((F.col("bad") - F.col("top")) * (1 - share) > STEM_LIFT * share * F.col("good")))
        stems |= {r["word"]: r["g"] for r in pure.orderBy(F.desc("g"), "word").limit(MOST_TERMS // 8).collect()}
    # Of beginnings that continue each other the most telling one, the shorter of equal ones.
    for s in sorted(stems, key=lambda s: (stems[s], -len(s))):
        if any(t != s and (t.startswith(s) or s.startswith(t)) for t in stems):
            del stems[s]
    scale = math.log1p(max([r["g"] for r in words] + [*stems.values(), 1.0]))
    return [(r["word"], math.log1p(r["g"]) / scale, False) for r in words] + [(s, math.log1p(g) / scale, True) for s, g in sorted(stems.items())]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    """A lexicon and the weights of its features; small and bounded, so it goes along with the tasks."""

    def __init__(self, terms: list[tuple[str, float, bool]], weights: np.ndarray) -> None:
        self.terms, self.weights = terms, weights

    def score(self, docs: DataFrame, into: str = "score") -> DataFrame:
        """Adds the score of column text."""
        terms, weights = self.terms, self.weights

        @F.pandas_udf("double")
        def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            lexicon = Lexicon(terms)
            for texts in batches:
                x = np.array([lexicon.features(t) for t in texts], dtype=float).reshape(-1, len(NAMES))
                z = x @ weights[:-1] + weights[-1]
                yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return spread(docs).withColumn(into, of("text"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = training_sample(docs, labels)
    terms = learn_lexicon(sample)

    def rows(batches):
        lexicon = Lexicon(terms)
        for b in batches:
            yield pd.DataFrame({"x": [lexicon.features(t) for t in b["text"]], "toxic": (b["toxic"] == 1).astype(float)})

    known = sample.mapInPandas(rows, "x array<double>, toxic double").toPandas()
    if known.empty:
        return Model([], np.array([0.0] * len(NAMES) + [-3.0]))
    x, y = np.array(known["x"].tolist(), dtype=float).reshape(-1, len(NAMES)), known["toxic"].to_numpy()
    # Some clean texts without a hit, so that a handful of labels does not make every text toxic.
    return Model(terms, fit(np.vstack([x, np.zeros((PRIOR, len(NAMES)))]), np.append(y, np.zeros(PRIOR))))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds score (0 to 1) and held_out to docs (doc_id, text, ...).

    Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2; the score is a
    function of the text alone. Null and empty texts have no hit and get the score of such texts.
    Without any labelled rows every score is that of a fixed low prior. Repeated rows repeat; several
    labels of one document count as toxic if one is.
    """
    return train(docs, labels).score(docs).withColumn("held_out", held_out())
