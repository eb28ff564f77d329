import hashlib
import re

import pytest
from helpers import documents
from pyspark.sql import functions as F

from refinery.llm import secrets

KEY = "AKIA" + "ABCDEFGH12345678"
TEXTS = [
    f"password = 'hunter2hunter2' and {KEY} end",
    'API_KEY: "short" token=longenough123; Secret:abcdefgh',
    "😀 passwd=ñabcdefgh deadbeefdeadbeefdeadbeefdeadbeef0 x " + "0" * 31,
    "password=token=secretsecret",
    None,
    "",
    "eyJabcdefghi.eyJabcdefghi.abcdefghijk ghp_" + "a" * 36,
    "-----BEGIN RSA PRIVATE KEY-----",
    "pass word = nothing here",
    ("password=abcdefgh1 " * 300) + "e",
]


def brute(text):
    out = []
    for n, r in enumerate(secrets.BASE + secrets.ADDED):
        out += [(m.start(), n, m.end(), r.kind) for m in re.finditer(r.pattern, text or "", re.A) if len(m.group(r.group)) >= r.least]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def test_scan(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x"), (None, TEXTS[1], "x")], "doc_id long, text string, kinds string")
    rows = secrets.scan(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        assert [tuple(s) for s in r["secrets"]] == brute(r["text"])
        assert r["kinds"] == "x"


def test_base_patterns_as_asked():
    got = [(k, a, b) for k, a, b in brute("PassWD:\x20\x20\"abcd/EFG=. x") if k == "assign"]
    assert got == [("assign", 0, 20)]
    assert not [k for k, *_ in brute("AKIAABCDEFGH123") if k == "access"]


@pytest.mark.parametrize("rule", secrets.BASE + secrets.ADDED, ids=lambda r: r.kind)
def test_queries_hold_wherever_the_rule_matches(rule):
    query = secrets.trigram_query(rule.pattern)
    for text in TEXTS:
        if re.search(rule.pattern, text or "", re.A):
            low = text.lower()
            assert any(all(g in low for g in alternative) for alternative in query)


def test_which_rules_scan_fully():
    full = [r.kind for r in secrets.BASE + secrets.ADDED if frozenset() in secrets.trigram_query(r.pattern)]
    assert full == ["hex"]
    assert secrets.trigram_query("abcd|xyz+") == frozenset([frozenset(["abc", "bcd"]), frozenset(["xyz"])]) or secrets.trigram_query("abcd|xyz+") == secrets.ALWAYS
    assert secrets.trigram_query("ab?cde") == frozenset([frozenset(["abc", "bcd", "cde"]), frozenset(["acd", "cde"])])
    assert secrets.trigram_query("(foo)*") == secrets.ALWAYS


def test_digest_and_redaction(spark):
    df = spark.createDataFrame([(0, TEXTS[0]), (1, "nothing"), (2, None)], "doc_id long, text string")
    out = secrets.scan(df)
    out = out.select("doc_id", secrets.listed(F.col("secrets")).alias("spans"), secrets.redact(F.col("text"), F.col("secrets")).alias("clean"), F.sha2(secrets.listed(F.col("secrets")), 256).alias("h"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute(TEXTS[0]))
    assert rows[0]["clean"] == "[SECRET]' and [SECRET] end"
    assert rows[1]["clean"] == "nothing" and rows[1]["h"] == hashlib.sha256(b"").hexdigest()
    assert rows[2]["clean"] is None and rows[2]["spans"] == ""


def test_odd_tables(spark):
    assert secrets.scan(documents(spark, [None])).count() == 3
    assert secrets.scan(documents(spark), into="_s").count() == documents(spark).count()
    assert secrets.scan(documents(spark).limit(0)).count() == 0
