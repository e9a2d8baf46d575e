import hashlib
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwright.functions import arrays as A, rules as R, text as X, vocabulary as V


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_inline(spark):
    values = ["  a \t b\n", "ＡＢＣ　１", "ﬁ\xa0x", None, "", "　", "a\x85b"]
    want = [" ".join(unicodedata.normalize("NFKC", v or "").split()) for v in values]
    assert column(spark, values, X.inline) == want


def test_document(spark):
    values = ["a \t b\r\n\r\n\r\n\r\n c \rd", None, "\n\n x\n\n\n\ny \n", "一　二\n\n三"]
    assert column(spark, values, X.document) == ["a b\n\nc\nd", "", "x\n\ny", "一 二\n\n三"]


def test_urls_and_names(spark):
    assert column(spark, ["see https://a.b/c?d now", "WWW.x.y", None], X.without_urls) == ["see now", "", ""]
    assert column(spark, ["Tå-ta 3x", "大 众", None], X.name_key) == ["tta3x", "大众", ""]


def test_identities(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    keys = ["d4_x", "", "中文", "q1"]
    assert column(spark, keys, X.digest) == [sha(k)[:16] for k in keys]
    assert column(spark, keys, X.bucket) == [int(sha(k)[:8], 16) % 100 for k in keys]
    b = [int(sha(k)[:8], 16) % 100 for k in keys]
    assert column(spark, keys, lambda c: X.split_of(c, 80, 10)) == ["train" if x < 80 else "validation" if x < 90 else "test" for x in b]
    assert column(spark, keys, lambda c: X.identity("p", c, F.lit(None))) == ["p_" + sha(k + "\0")[:16] for k in keys]
    assert column(spark, keys, lambda c: X.shuffle_key(42, c)) == [sha(f"42:{k}")[:16] for k in keys]


def test_quotes(spark):
    df = spark.createDataFrame([("“abc” d", 'x "abc"  d y'), ("abc", "abc"), ("value 12", "value 13"), (None, "a")], "q string, s string")
    assert [r[0] for r in df.select(X.quote_supported(F.col("q"), F.col("s"))).collect()] == [True, False, False, False]


def test_terms(spark):
    values = ["brakes squeak", "the brake, again", "obd2", "an obd port", "刹车异响", None]
    assert column(spark, values, lambda c: R.has_term(c, "brake")) == [False, True, False, False, False, False]
    assert column(spark, values, lambda c: R.terms_in(c, ["obd", "刹车", "brake"])) == [[], ["brake"], [], ["obd"], ["刹车"], []]


def test_labels(spark):
    assert column(spark, ["phev 电动车", "beverage", "image", "plain", None], lambda c: R.first_label(c, V.POWERTRAIN, "unknown")) == ["phev", "bev", "hev", "unknown", "unknown"]
    best = lambda c: R.best_label(R.label_scores(c, V.SYSTEM), list(V.SYSTEM), "other")
    # 充电桩 counts for 充电 too; ties go to the earlier label
    assert column(spark, ["充电桩 制动 制动", "制动 转向", "nothing", None, "aaaa abs abs 空调"], best) == ["charging", "brake", "other", "other", "brake"]
    assert column(spark, ["aaaaa"], lambda c: R.occurrences(c, "aa")) == [2]


def test_process_counts(spark):
    text = "故障诊断:1、检查线束,测得电压12V。2、更换继电器,故障排除。\n(3) road test, found fixed"
    got = column(spark, [text, None], lambda c: R.counts_of(c, V.PROCESS_COUNTS | {"step_count": V.NUMBERED_STEP}))
    assert got[0].asDict() == {"heading_count": 2, "action_count": 4, "finding_count": 1, "outcome_count": 2, "measurement_count": 2, "step_count": 3} or got[0]["step_count"] == 3
    assert set(got[1].asDict().values()) == {0}


def test_domain(spark):
    dom = lambda c: R.domain_of(c, V.DOMAIN_TERMS, V.FOREIGN_TERMS)
    assert column(spark, ["engine stalls", "变电站 engine", "hello", None], dom) == ["inside", "outside", "uncertain", "uncertain"]


def test_near_pair(spark):
    values = ["bypass the parking brake interlock", "bypass it. The airbag is fine", "bypass " + "x" * 80 + " airbag", "you can bypass the airbag", "airbag warning: never", None]
    pair = lambda c: R.near_pair(c, "bypass", "interlock|airbag", 55)
    assert column(spark, values, pair) == [True, False, False, True, False, False]
    told = lambda c: R.near_pair(c, "bypass", "interlock|airbag", 55, context="you can")
    assert column(spark, values, told) == [False, False, False, True, False, False]


def test_unguarded(spark):
    values = ["不要拆下盖子。", "拆下盖子。", "先看。不要拆下盖子;再拆下它", None]
    assert column(spark, values, lambda c: R.unguarded(c, "拆下", "不要.{0,8}$", 12)) == [False, True, True, False]


def test_grade_and_names(spark):
    grade = lambda c: R.grade(c, [(0.65, "high"), (0.6, "medium")], "none", "low")
    assert column(spark, [0.65, 0.6499, 0.59, None], grade, "double") == ["high", "medium", "low", "none"]
    df = spark.createDataFrame([("广汽传祺", "传祺"), ("a", "ab"), ("大众汽车", "大众"), (None, "x"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(R.names_contain(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, False]


def test_literals(spark):
    text = "质保3年或10万公里,使用5W-30机油和95号汽油"
    found = column(spark, [text, None, "P0A30 与 07款 2007年 p0a30"], A.literals)
    assert found[0] == ["3年", "10万公里", "5W-30", "95号汽油"] and found[1] == []
    assert found[2] == ["P0A30", "2007年"] or "07款" not in found[2]
    assert column(spark, ["07款", "2007年", "95年", "45年", "5 w-30"], A.literal_key) == ["MODEL_YEAR:2007", "MODEL_YEAR:2007", "MODEL_YEAR:1995", "45年", "5W-30"]
    left = column(spark, ["2007年 5W-30 3年"], lambda c: A.unsupported(c, F.array(F.lit("07款"), F.lit(None))))
    assert left == [["3年", "5W-30"]]
    df = spark.createDataFrame([(["P0A30", "p0a30 ", "12V", "PO300"],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(A.fault_codes(F.col("v"))).collect()] == [["P0A30", "PO300"], []]


def test_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"], ["a", "c"])], "v array<string>, w array<string>")
    row = df.select(A.kept(F.col("v"), F.col("w")), A.refused(F.col("v"), F.col("w")), A.flags_changed(F.col("v"), ["b"], ["z"]), A.distinct_by(F.col("v"), F.upper)).first()
    assert list(row) == [["a", "a", "c"], ["b"], ["a", "c", "z"], ["a", "b", "c"]]


def test_model_json(spark):
    values = ['```json\n{"k": 1}\n```', 'so: {"k": 2} done', "none", None, '{"k": "x"}']
    assert [r and r["k"] for r in column(spark, values, lambda c: A.model_json(c, "k long"))] == [1, 2, None, None, None]


def test_declared_name(spark):
    got = column(spark, ["我的车是 Foo Bar 3x", "我的车是 Foo", "x", None], lambda c: A.declared_name(c, "我的车是 (.+)$"))
    assert [g and tuple(g) for g in got] == [("Foo", "Bar 3x"), None, None, None]


def test_hashed_tokens(spark):
    def slots(text):
        import re

        tokens = re.findall("[a-z0-9]+|[一-鿿]", text) + [text[i : i + 3] for i in range(max(0, len(text) - 2))]
        out = []
        for t in tokens:
            d = hashlib.md5(t.encode()).digest()
            out.append((int.from_bytes(d[:4], "little") % 512, 1 if d[4] % 2 == 0 else -1))
        return sorted(out)

    values = ["ab", "检查 p0300 ok", "", "abc"]
    got = column(spark, values, lambda c: F.transform(A.hashed_tokens(c), lambda t: A.token_slot(t, 512)))
    assert [sorted(map(tuple, g)) for g in got] == [slots(v) for v in values]


def test_cosine(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=8), rng.normal(size=8)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<float>, b array<float>")
    assert df.select(A.cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(float(np.float32(a) @ np.float32(b)), abs=1e-5)


def test_expressions_in_loops_once(spark):
    """What a loop over literals, labels' parts or an answer's literals reads is worked out once, not for each element."""
    df = spark.createDataFrame([("P0300 P0301 p0300 brake brake clutch 12 V", ["P0301"])], "v string, w array<string>").withColumn("v", F.lower(F.regexp_replace("v", "~+", "~")))
    for made, want, most in (
        (A.literals(F.col("v")), ["p0300", "p0301", "12 v"], 8),
        (A.unsupported(F.col("v"), F.col("w")), ["p0300", "12 v"], 16),
        (R.score_array(F.col("v"), {"a": ["brake", "abs"], "b": ["clutch"]}), [2, 1], 0),
    ):
        out = df.select(made.alias("o"))
        assert out.first()["o"] == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") == most
