import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from refinery import schemas
from refinery.functions import text as X
from refinery.operators import rules


def one(spark, fn, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{n} string" for n in range(len(values))))
    return df.select(fn(*[F.col(c) for c in df.columns])).first()[0]


@pytest.mark.parametrize(("value", "want"), [(None, True), ("", True), ("  　", True), ("nan", True), (" nan ", True), ("None", False), ("x", False)])
def test_blank(spark, value, want):
    assert one(spark, X.blank, value) is want


@pytest.mark.parametrize(("value", "as_double", "as_int"), [("3.9", 3.9, 3), ("-3.9", -3.9, -3), ("x", 0.0, 0), (None, 0.0, 0), ("1e99", 1e99, 0)])
def test_safe_numbers(spark, value, as_double, as_int):
    assert one(spark, X.safe_double, value) == as_double
    assert one(spark, X.safe_int, value) == as_int


def test_safe_int_nan(spark):
    assert one(spark, X.safe_int, "NaN") == 0


def test_safe_timestamp(spark):
    assert one(spark, lambda c: X.safe_timestamp(c).cast("string"), "2024-01-01T09:00:00+09:00") == "2024-01-01 00:00:00"
    assert one(spark, X.safe_timestamp, "soon") is None


def test_clean_name(spark):
    assert one(spark, X.clean_name, "[기획] 수분 크림 150ml 대용량") == "수분 크림"
    assert one(spark, X.clean_name, "진정  토너 (단독) 3+1") == "진정 토너"
    assert one(spark, X.clean_name, "[기획]") == ""


def test_name_rules_are_ordered_and_literal_dollar(spark):
    found = X.name_rules([{"raw": "오\\s+떼르말", "fix": "오떼르말"}, {"raw": "a.b", "fix": "$1\\", "match_type": "simple"}])
    assert one(spark, lambda c: X.replace_all(c, found), "오  떼르말 a.b axb") == "오떼르말 $1\\ axb"


def test_typos(spark):
    boundary = [{"raw": "글리세", "fix": "글리세린"}]
    assert one(spark, lambda c: X.fix_typos(c, boundary, []), "글리세, 글리세린, a-글리세") == "글리세린, 글리세린, a-글리세"
    assert one(spark, lambda c: X.fix_typos(c, [], [{"raw": "ab", "fix": "x"}, {"raw": "abc", "fix": "y"}]), "abc ab") == "y x"


def test_notices(spark):
    assert one(spark, X.drop_notices, "전성분: 물, 글리세린* ※무첨가 성분: 향료").strip() == "물, 글리세린"
    assert one(spark, X.drop_notices, "<ILN123>물") == "물"


def test_separators_and_masks(spark):
    assert one(spark, X.unify_separators, "a@b|c\r\n\td") == "a,b,cd"
    assert one(spark, X.mask_commas, "1,2-헥산다이올, 물") == "1_C_2-헥산다이올, 물"
    assert one(spark, X.unmask, " 1_C_2 ") == "1,2"
    assert one(spark, X.despace, "a b c") == "ab c"


def test_headers(spark):
    assert one(spark, X.header_count, "<A> x [B] y [ILN1]") == 2
    assert one(spark, X.strip_header, "[본품] 물") == " 물"
    assert one(spark, X.main_item_count, "[본품]a[본품]") == 2


def test_brackets(spark):
    assert one(spark, X.drop_concentrations, "나이아신아마이드(5%), 물(정제수)") == "나이아신아마이드, 물(정제수)"


@pytest.mark.parametrize(("residual", "want"), [("ab", False), ("abc", True), ("  ,. - ", False), ("가나다", True)])
def test_significant(spark, residual, want):
    assert one(spark, X.significant, residual) is want


def test_countable(spark):
    assert [one(spark, X.countable_item, v) for v in ("12", "a", "a1", "물")] == [False, False, True, False]


@pytest.mark.parametrize("name", ["cream", "수분 크림 😀", ""])
def test_stable_id(spark, name):
    assert one(spark, X.stable_id, "브랜드", name) == str(uuid.uuid5(X.NAMESPACE, f"브랜드||{name}"))


@pytest.mark.parametrize(
    ("name", "main", "sub", "raw", "want"),
    [
        ("수분 크림", "스킨케어", "크림", "", "크림"),
        ("진정 앰플 세럼", "스킨케어", "에센스/세럼/앰플", "", "세럼"),
        ("스쿠알란", "스킨케어", "미스트/오일", "[보습오일] 스쿠알란", "페이스오일"),
        ("무엇", "스킨케어", "로션", "", "로션"),
        ("폼", "없음", "없음", "", "기타"),
        ("SKIN pad", "더모 코스메틱", "스킨케어", "", "토너"),
    ],
)
def test_classify(spark, name, main, sub, raw, want):
    assert one(spark, rules.classify, name, main, sub, raw) == want


def test_schemas(spark):
    df = spark.createDataFrame([(1, "x")], "extra int, product_id string")
    out = schemas.conform(df, schemas.SILVER)
    assert out.columns == schemas.SILVER.fieldNames() and out.first()["product_id"] == "x"
    with pytest.raises(Exception, match="product_id"):
        schemas.enforce_not_null(schemas.conform(spark.createDataFrame([(1,)], "a int"), schemas.SILVER), schemas.SILVER).collect()
    with pytest.raises(ValueError):
        schemas.require_columns(df, ["missing"])
    with pytest.raises(ValueError):
        schemas.resolve_column(df, ["a", "b"])
    nested = spark.sql("select map('a', map('x', cast(null as string)), 'b', null) as m, cast(null as map<string, map<string, string>>) as n")
    row = nested.select(schemas.stats(F.col("m")).alias("m"), schemas.stats(F.col("n")).alias("n")).first()
    assert row["m"] == {"a": {"x": ""}, "b": {}} and row["n"] is None


def test_headers_of_long_runs_and_as_before(spark):
    # The pattern without its anchors.
    plain = X.SECTION_HEADER.replace(r"(?:\G|(?<![가-힣a-zA-Z0-9]))", "").replace(r"(?:\G|(?<![가-힣a-zA-Z0-9\s]))", "")
    assert r"\G" not in plain
    rng = random.Random(3)
    parts = ["<", ">", "■", ":", " ", "-", "[전성분", "]", "[", "1", "12)", "크림", "볼", "가", "a", "세럼", ")", ",", "ILN", "\n", " "]
    texts = [None, "", *("".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(20_000))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    count = F.regexp_count("t", F.lit(plain))
    strip = F.when(count == 1, F.regexp_replace("t", plain, "")).otherwise(F.col("t"))
    same = X.header_count(F.col("t")).eqNullSafe(count) & X.strip_header(F.col("t")).eqNullSafe(strip)
    assert rows.where(~same).take(3) == []
    assert rows.where(count > 1).count() > 1000
    # Before, each letter of a run was a start of its own.
    began = time.time()
    long = spark.range(1).select(F.concat(F.repeat(F.lit("가나a "), 50_000), F.lit(":")).alias("t"))
    assert long.select(X.header_count(F.col("t"))).first()[0] == 0
    assert time.time() - began < 20


def test_notices_tried_only_where_they_may_begin(spark):
    """the look at the first characters changes no result."""
    rng = random.Random(7)
    bits = ["무첨가 성분 :", "제공된 성분은", "ILN1 성분목록은", "※표시:", "※", "*", "+", " ", "\u00a0", "\u3000", "\n", "무첨가", "성분", ":", "제공된", "성분은", "표시", "유기농", "자연", "유래", "ILN1", "iln2", "목록은", "[", "<", "1) a", "x", "무", "제", "I"]
    df = spark.createDataFrame([("".join(rng.choice(bits) for _ in range(rng.randrange(14))),) for _ in range(3000)], "t string").repartition(4)
    for pattern, look in ((X.FREE_FROM_TAIL, r"(?=[*※무\s])"), (X.LEGEND, r"(?=[※*+제I\s])")):
        assert look in pattern
        plain = pattern.replace(look, "", 1)
        assert df.where(F.regexp_replace("t", pattern, "|") != F.regexp_replace("t", plain, "|")).count() == 0
        assert df.where(F.regexp_replace("t", plain, "|") != F.col("t")).count() > 20


def test_lists_are_cleaned_once_a_row(spark):
    """each mention of a cleaned text named all its patterns again, sixteen times in searched_lists."""
    from refinery.plans import products

    plan = products.searched_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("성분(?:명)") == 1
