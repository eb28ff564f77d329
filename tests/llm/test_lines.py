"""Line dedup against a plain version."""

import hashlib

import pytest
from helpers import LONG, documents

from refinery.llm import lines, queries


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def plain(rows, least_docs, least_chars=1, keep_first=False):
    """(doc_id, n_lines, n_dropped, kept) of each row (doc_id, text); the first occurrence only where ids tell documents apart."""
    holders, first = {}, {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for at, x in enumerate((t or "").split("\n")):
            holders.setdefault(key(x), set()).add((d, t))
            first.setdefault(key(x), (d, t, at))
    often = {k for k, v in holders.items() if len(k) >= max(least_chars, 1) and len(v) >= least_docs}
    out = []
    for d, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for at, x in enumerate(all_lines) if key(x) not in often or (keep_first and first[key(x)] == (d, t, at))]
        out.append((d, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


TEXTS = [
    "Menu\nfirst own line\n menu \nMENU\x0b\n\nend",
    "menu\n\n\n",
    None,
    "",
    "\n",
    " \t\n\r\n",
    "É\nÉ x\né",
    "É\nmenu",
    "é\nown",
    LONG + "\nmenu\n" + LONG,
    "menu\r\nÄ own\nI\nİ\nı",
    "i\nmenu" * 3,
    "last\x85\nmenu \nmenu",
    "menu\n" * 70_000 + "tail",
]


def rows_of(spark, extra=()):
    df = documents(spark, TEXTS)
    more = [(100 + k, f"common\nline {k % 7}\n{'x' * (k % 5)}", "en", None, None, "kept", 0.5, 7) for k in range(200)]
    return df.unionByName(spark.createDataFrame([*more, *extra], df.schema))


@pytest.mark.parametrize("least_docs, least_chars, keep_first", [(2, 1, False), (3, 4, False), (2, 1, True), (10, 1, True), (1, 1, False)])
def test_equals_plain(spark, least_docs, least_chars, keep_first):
    df = rows_of(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = lines.drop_frequent(df, least_docs, least_chars, keep_first).collect()
    want = plain(rows, least_docs, least_chars, keep_first)
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"])) for r in got)


def test_bitmaps(spark):
    """Runs in turn kept and dropped; no texts travel with them."""
    df = rows_of(spark)
    got = {r["doc_id"]: r for r in lines.keep_bitmaps(df, 2).where("doc_id is not null").collect()}
    assert got[0]["keep"] == [0, 1, 1, 2, 2] and got[0]["n_lines"] == 6 and got[0]["n_dropped"] == 3
    assert got[2]["keep"] == [1] and got[4]["keep"] == [2]
    assert got[13]["keep"] == [0, 70_000, 1]
    assert "text" not in lines.keep_bitmaps(df, 2).columns
    assert all(sum(r["keep"]) == r["n_lines"] for r in got.values())


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    df = rows_of(spark)
    before = sorted(map(str, lines.drop_frequent(df, 2).collect()))
    monkeypatch.setattr(lines, "MOST_BROUGHT", 0)
    assert sorted(map(str, lines.drop_frequent(df, 2).collect())) == before


def test_ranges_are_dealt_once(spark):
    """Counting needs no exchange but the ranges' own and that of one row for each line and range."""
    found = spark.createDataFrame([(1, 2, 3, 4, 5)], "h long, g long, doc_id long, t long, pos int")
    plan = lines.frequent(found, 2)._jdf.queryExecution().executedPlan().toString()
    above, ranges = plan.split("Exchange rangepartitioning")
    # What is added up above is one row for each line and range.
    assert above.count("Exchange ") == 1 and above.count("Sort [") == 2 and "Exchange " not in ranges and "Python" not in plan


def test_no_rows_and_repeated_rows(spark):
    df = rows_of(spark).limit(0)
    assert lines.drop_frequent(df).count() == lines.keep_bitmaps(df).count() == 0
    # Repeated rows are one document, so nine of them and another one are two.
    rows = [(1, "a\nb")] * 9 + [(2, "A"), (None, "a\nb"), (None, "a\nb")]
    got = lines.drop_frequent(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert sorted((r["doc_id"] or 0, r["n_lines"], r["kept"]) for r in got) == sorted([(1, 2, "b")] * 9 + [(2, 1, "")] + [(0, 2, "b")] * 2)


def test_query_has_no_python(spark):
    plan = queries.op12_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_plain(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(rows, 10)}
    got = queries.op12_line_dedup(spark, sf).collect()
    assert len(got) == len(rows) and {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == want
    assert sum(k for _, k, _ in want.values()) > 0
