"""Every column of the operators' queries against plain versions, over whole small tables with odd rows added."""

import hashlib
import re
import zlib
from fractions import Fraction
from html.parser import HTMLParser

import numpy as np
import pytest
import xxhash
from helpers import groups
from test_mixing import brute_targets, sainte_lague
from test_topk_vectors import odd_rows

from refinery.llm import html, mixing, queries

SF = "/root/testdata/sf0.001"
ODD = [(10**15, None, "en", None, None), (10**15 + 1, "", "en", None, 0), (10**15 + 2, "\x0b \t\n", "en", "s", 4), (10**15 + 3, "x" + " " * 1_100_000 + "y", "en", "s", 1_100_002), (10**15 + 4, "É É É é", "fr", "é", 7), (10**15 + 5, "token=abcdefgh AKIA" + "Z" * 16 + " " + "0123456789abcdef" * 3, "en", "s", 80)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    for name in ("labels", "pages", "benchmark", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(root / f"{name}.parquet"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.unionByName(spark.createDataFrame(ODD, docs.schema)).write.parquet(str(root / "documents.parquet"))
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    odd = spark.createDataFrame([(10**15 + k, v, 0) for k, (_, v, _) in enumerate(odd_rows(60, d=len(vectors.first()["embedding"]))[-8:])], vectors.schema)
    vectors.unionByName(odd).write.parquet(str(root / "embeddings.parquet"))
    return str(root)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").collect()


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_op2(spark, folder, docs):
    kinds = {"assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, re.I | re.A), "access": ("AKIA[A-Z0-9]+", 0, 16, 0), "hex": ("[0-9a-f]+", 0, 32, 0)}
    want = {}
    for r in docs:
        spans = []
        for turn, (kind, (pattern, group, least, flags)) in enumerate(kinds.items()):
            spans += [(m.start(), turn, kind, m.end()) for m in re.finditer(pattern, r["text"] or "", flags) if len(m[group]) >= least]
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        want[r["doc_id"]] = (*(sum(k == kind for _, _, k, _ in spans) for kind in kinds), hashlib.sha256(listed.encode()).hexdigest(), set(listed.split(",")) - {""})
    got = queries.op2_secret_scan(spark, folder).collect()
    assert len(got) == len(docs) and sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got) >= 3
    for r in got:
        *counts, sha, base = want[r["doc_id"]]
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] == [*counts, sha] and base <= set(r["spans"].split(","))


def test_op4(spark, folder, docs):
    size = {r["doc_id"]: len(words(r["text"])) for r in docs}
    per = {}
    for r in docs:
        per[r["source"]] = per.get(r["source"], 0) + size[r["doc_id"]]
    target, rows = brute_targets(per), queries.op4_mixing(spark, folder).collect()
    assert len(rows) == len(docs)
    source = {r["doc_id"]: r["source"] for r in docs}
    taken = {}
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"], r["target"]) == (size[r["doc_id"]], per[s], pytest.approx(target[s])) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    names = sorted(s for s in per if s is not None) + [s for s in per if s is None]
    votes = {f"{n:03d}": Fraction(target[s]) for n, s in enumerate(names)}
    seats = sainte_lague(votes, sum(per.values()) // 32)
    # One shard here: each source takes its blocks of 32 words, as far as three times its words go.
    assert taken == {s: min(32 * seats[f"{n:03d}"], 3 * per[s]) for n, s in enumerate(names)}
    again = queries.op4_mixing(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and mixing.DOCS_IN_SHARD > len(docs)


def test_op6(spark, folder, docs):
    prints = {}
    for r in docs:
        w = words(lower(r["text"]))
        hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(len(w) - 3, 1))] if w else []
        prints[r["doc_id"]] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    root = groups(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (prints[ids[i]] ^ prints[ids[j]]).bit_count() <= 4])
    want = {d: (f"{prints[d]:016x}", ids[root[k]]) for k, d in enumerate(ids)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, folder).collect()}
    assert got == want and len(set(root)) < len(ids)


def test_op7(spark, folder, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer())
    want = {}
    for r in docs:
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want |= {(r["doc_id"], k): (a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))}
    rows = queries.op7_best_fit_packing(spark, folder).collect()
    assert len(rows) == len(want) and {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert len(held) <= 1.02 * sum(n for _, n, _ in want.values()) / 1024 + 2


def test_op8(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    good = [(r["vec_id"], np.array(r["embedding"], float)) for r in rows if r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and np.any(r["embedding"])]
    links = [(i, j) for i in range(len(good)) for j in range(i) if len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] / np.sqrt((good[i][1] @ good[i][1]) * (good[j][1] @ good[j][1])) >= 0.95]
    root, n = groups(len(good), links), np.bincount(np.array(links, int).ravel(), minlength=len(good))
    low = {}
    for k, r in enumerate(root):
        low[r] = min(low.get(r, 1 << 62), good[k][0])
    want = {r["vec_id"]: (0, r["vec_id"]) for r in rows} | {v: (int(n[k]), low[root[k]]) for k, (v, _) in enumerate(good)}
    got = queries.op8_cover_tree(spark, folder).collect()
    assert len(got) == len(rows) and {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_op9(spark, folder, docs):
    got = {r["doc_id"]: r for r in queries.op9_toxicity(spark, folder).collect()}
    assert set(got) == {r["doc_id"] for r in docs}
    by_text = {}
    for r in docs:
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.3)
        by_text.setdefault(r["text"] or "", set()).add(g["score"])
    assert all(len(s) == 1 for s in by_text.values())
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    right = [got[d]["predicted"] == t for d, t in toxic.items() if d in got and not got[d]["held_out"]]
    assert np.mean(right) > 0.9


class Article(HTMLParser):
    """The text of the article's blocks, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.hidden, self.blocks, self.now = 0, 0, [], ""

    def flush(self):
        if self.now.strip():
            self.blocks.append(" ".join(self.now.split()))
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in html.BLOCK:
            self.flush()
        self.inside += tag == "article"
        self.hidden += tag in ("script", "style")
        if tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag in html.BLOCK:
            self.flush()
        self.inside -= tag == "article"
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.now += data


def test_op10(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op10_html_extraction(spark, folder).collect()}
    assert len(got) == len(pages)
    for p in pages:
        plain = Article()
        plain.feed(p["html"])
        plain.close()
        plain.flush()
        r = got[p["page_id"]]
        assert r["text"] == "\n".join(plain.blocks) and r["n_chars"] == len(r["text"]) and r["url"] == p["url"]
