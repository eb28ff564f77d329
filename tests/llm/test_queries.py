"""Queries with SQL against DuckDB, and the pipeline stage by stage."""

import glob
import os
import re
from collections import Counter

import duckdb
import pytest
from helpers import TEXTS, documents, groups
from test_mixing import brute_targets

import corpus_pipeline
from refinery.llm import queries, secrets
from refinery.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    df = queries.queries()[name](spark, SF)
    cur = c.execute(queries.oracle_sql()[name])
    cols = sorted(d[0] for d in cur.description)
    order = [[d[0] for d in cur.description].index(k) for k in cols]
    assert sorted(df.columns) == cols
    assert sorted(str([r[k] for k in cols]) for r in df.collect()) == sorted(str([r[k] for k in order]) for r in cur.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def jaccard_groups(texts):
    """Components of all pairs whose sets of five-word shingles have similarity 0.8 or more."""
    sets = []
    for t in texts:
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    alike = lambda a, b: a == b if not a or not b else len(a & b) >= 0.8 * len(a | b)
    return groups(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])])


def test_pipeline_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.first()
    # Null and repeated ids, a near copy among them.
    odd = [(None, "a text of nobody, and not long", "en", "s", None), (None, first["text"], "en", "s", None), (first["doc_id"], "another text of the first one's id", "en", "s", None), (10**12, first["text"] + " more", "en", "s", None)]
    docs = stage(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, f in corpus_pipeline.STAGES:
        out = stage(f(spark, docs, SF))
        before, after = docs.collect(), out.collect()
        if name == "toxicity":
            gone = Counter(map(tuple, before)) - Counter(map(tuple, after))
            assert sum(gone.values()) == len(before) - len(after) > 0
            assert sum(toxic.get(r[0]) == 1 for r in gone) >= 0.8 * sum(r[0] in toxic for r in gone)
            # A few labels teach no words of the rarer languages.
            assert sum(toxic.get(r["doc_id"]) == 1 for r in after) <= 0.4 * sum(toxic.values())
        elif name == "simhash_near_dedup":
            root = jaccard_groups([r["text"] for r in before])
            members = {}
            for k, r in enumerate(root):
                members.setdefault(r, []).append(before[k])
            key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
            assert len(members) < len(before)
            assert Counter(map(tuple, after)) == Counter(tuple(min(rows, key=key)) for rows in members.values())
        elif name == "secrets":
            flags = {"assign": re.I | re.A}
            want = []
            for r in before:
                found = [m.span() for x in secrets.BASE + secrets.ADDED for m in re.finditer(x.pattern, r["text"] or "", flags.get(x.kind, re.A)) if len(m[x.group]) >= x.least]
                text, at = "", 0
                for a, b in sorted(found):
                    if a >= at:
                        text += (r["text"] or "")[at:a] + "[SECRET]"
                    at = max(at, b)
                want.append((r["doc_id"], text + r["text"][at:] if found else r["text"]))
            assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in after)
            assert all(r["n_chars"] is None or r["n_chars"] == len(r["text"]) for r in after if "[SECRET]" in (r["text"] or ""))
        elif name == "mixing":
            times = Counter(map(tuple, after))
            assert set(times) <= set(map(tuple, before))
            size = {tuple(r): len(re.findall("[^\x20\x09-\x0d]+", r["text"] or "")) for r in before}
            per = Counter()
            for r in before:
                per[r["source"]] += size[tuple(r)]
            target, half = brute_targets(dict(per)), Counter()
            for r in before:
                half[r["source"]] += 1
            for s, t in target.items():
                words = sum(size[r] * n for r, n in times.items() if r[3] == s)
                # Whole documents: each may be off by half of its words, and only the one that is cut is.
                assert abs(words - t) <= 64 + max(size[tuple(r)] for r in before if r["source"] == s)
            assert all(n <= 3 * Counter(map(tuple, before))[r] for r, n in times.items())
        else:
            plain = Tokenizer.from_file(queries.tokenizer())
            sizes = sorted(len(plain.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before)
            parts = Counter()
            for r in after:
                parts[r["doc_id"], r["start"], r["length"], r["ids_crc32"]] += 1
            assert sum(r["length"] for r in after) == sum(sizes)
            assert sorted(r["start"] + r["length"] for r in after if (r["start"] + r["length"]) in sizes and r["piece"] == 0)[-1] <= 1024
            assert sum(r["piece"] == 0 for r in after) == len(before)
            assert len({r["sequence_id"] for r in after}) <= 1.05 * sum(sizes) / 1024 + 1
        if name != "packing":
            assert out.columns == docs.columns
        docs = out


LONG_RUNS = ["a" + " " * 3_000_000 + "b", "\n" * 1_200_000, "x" * 3_000_000]


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, tmp_path, empty):
    """Each stage keeps what it has no cause to drop, long runs of one character among it."""
    labels = spark.createDataFrame([(0, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    df = documents(spark, TEXTS + LONG_RUNS)
    df = stage(df.limit(0) if empty else df)
    rows = {name: stage(f(spark, df, str(tmp_path))) for name, f in corpus_pipeline.STAGES}
    counts = {name: out.count() for name, out in rows.items()}
    assert all(out.columns == df.columns for name, out in rows.items() if name != "packing")
    if empty:
        assert set(counts.values()) == {0}
        return
    assert counts["toxicity"] == counts["secrets"] == df.count()
    # Copies, and texts without words, are one each; the longest text and the one with a word more are near copies.
    assert counts["simhash_near_dedup"] == len(set(jaccard_groups([r["text"] for r in df.collect()])))
    assert 0 < counts["mixing"] <= 3 * df.count()
    assert rows["packing"].where("piece = 0").count() == df.count()
