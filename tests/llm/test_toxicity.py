import random
import time
import zlib

import numpy as np
import pytest
from helpers import documents

from refinery.llm import toxicity
from refinery.llm.common import table



def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lexicon_equals_distance():
    rng = random.Random(0)
    terms = ["idiot", "worthless", "scum", "clowns", "pathetic", "abcde", "abcdf"]
    lexicon = toxicity.Lexicon([(t, 1.0, False) for t in terms] + [("stem", 0.5, True)])
    words = list(terms)
    for t in terms * 60:
        w = list(t)
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(0, len(w) + 1)
            op = rng.randrange(3)
            if op == 0:
                w.insert(k, rng.choice("abcdeistwx"))
            elif k < len(w):
                w[k : k + 1] = [] if op == 1 else [rng.choice("abcdeistwx")]
        words.append("".join(w))
    for w in words + ["stemming", "stem", "ste", ""]:
        limit = lambda t: 0 if len(t) < 5 else 1 if len(t) < 8 else 2
        best = min((distance(w, t) for t in terms if distance(w, t) <= limit(t)), default=None)
        if w.startswith("stem"):
            best = 0
        hit = lexicon.find(w)
        assert (hit and hit[1]) == best, w


def test_context():
    lexicon = toxicity.Lexicon([("idiot", 1.0, False)])
    said, quoted, reported = (dict(zip(toxicity.NAMES, lexicon.features(t))) for t in ("you are an idiot", 'the word "idiot" is old', "she said he was an idiot"))
    assert said["quoted"] == 0 and said["exact"] > 0
    assert quoted["quoted"] > 0 and reported["quoted"] > 0
    assert said["abuse"] > quoted["abuse"]
    assert lexicon.features(None) == lexicon.features("") == lexicon.features("calm words") == [0.0] * len(toxicity.NAMES)
    assert lexicon.features("1diot")[toxicity.NAMES.index("fuzzy")] > 0


@pytest.mark.parametrize("size, wrong", [("sf0.01", 0.02), ("sf0.1", 0.01)])
def test_held_out_accuracy(spark, size, wrong):
    sf = f"/root/testdata/{size}"
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    scored = toxicity.assess(docs, labels)
    rows = scored.drop("text").join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    bad = np.array([r["score"] for r in held if r["toxic"] == 1])
    good = np.array([r["score"] for r in held if r["toxic"] == 0])
    assert (bad[:, None] > good[None, :]).mean() + 0.5 * (bad[:, None] == good[None, :]).mean() > 0.95
    assert (good >= 0.3).mean() < wrong and (bad >= 0.3).mean() >= 0.9


def test_beginnings_are_learned_by_many_words(spark):
    """Toxic words of one beginning, each rare, count together; a beginning that one word makes toxic does not."""
    rng = random.Random(3)
    calm = [f"calm{k}" for k in range(300)]
    rows = []
    for n in range(240):
        words = [rng.choice(calm) for _ in range(30)]
        if n % 6 == 0:
            for k in range(0, 30, 6):
                words[k] = f"vexor{rng.choice('abcdefghijklmnop')}{rng.choice('abcdefghijklmnop')}"
                words[k + 1] = "slurrer"
        elif n % 6 == 1:
            words[3] = f"slurr{rng.choice('abcdefgh')}{rng.choice('abcdefgh')}"
        rows.append((n, " ".join(words), int(n % 6 == 0)))
    terms = toxicity.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    stems = [w for w, _, stem in terms if stem]
    assert len(stems) == 1 and "vexor".startswith(stems[0])
    assert "slurrer" in [w for w, _, stem in terms if not stem]


def test_odd_tables(spark):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, None), (4, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = documents(spark)
    rows = toxicity.assess(df.select("doc_id", "text"), labels).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert toxicity.assess(df.select("doc_id", "text"), labels.limit(0)).count() == df.count()
    assert toxicity.assess(df.select("doc_id", "text").limit(0), labels).count() == 0


def test_one_long_line_in_linear_time():
    lexicon = toxicity.Lexicon([("idiot", 1.0, False)])
    took = []
    for n in (10_000, 40_000):
        began = time.time()
        assert lexicon.features("what an idiot he is, they said of him once more " * n)[0] > 0
        took.append(time.time() - began)
    assert took[1] < 8 * took[0] + 1
