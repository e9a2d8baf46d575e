import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from loomwright.llm.lookalike import fold, same_look, same_looks, script_report

CASES = [
    ("Вolt P0А30", "Bolt P0A30"),  # Cyrillic in Latin words and codes
    ("сор", "cop"),  # whole-script twin
    ("рука", "рука"),  # a real Cyrillic word keeps its script
    ("рукa", "рука"),  # ... and takes a Latin letter along
    ("ӧl", "öl"),
    ("４７０.３０ｂａｒ", "470.30bar"),
    ("99㎞", "99km"),
    ("ﬁlter", "filter"),
    ("⻋⻔⻓⻛", "车门长风"),
    ("⼤⼿", "大手"),
    ("B01⁠30​", "B0130"),
    ("a 　 b\t\nc ", "a b\nc"),
    ("a\r\nb\rc", "a\nb\nc"),
    ("résume", "résume"),
    ("10Ω µF", "10Ω μF"),
    ("x² ½ ①", "x² ½ ①"),  # told apart by any reader
    ("ABC abc", "ABC abc"),  # case is kept
    ("νolt ӀD ꓑump օil Ꭺb Ⲟil ɑbc loɡ", "volt ID Pump oil Ab Oil abc log"),  # twins of other scripts and blocks
    ("1∶2 a⁄b", "1:2 a/b"),
    ("α = 5°, σ, l1I|", "α = 5°, σ, l1I|"),  # resembling letters and signs stay
    ("", ""),
    (None, None),
]


@pytest.mark.parametrize("text,form", CASES)
def test_form(text, form):
    assert same_look(text) == form
    assert same_looks([text]) == [form]


ALPHABET = st.text(alphabet="νꓑɑӀ𐐬∶abАВСе оοΩµ１２ａ­​́̈ \t\n\r　ﬁ㎞⻋中文。,.-‐Ⅷ²�é\x00", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHABET, max_size=5))
def test_batch_equals_scalar(texts):
    assert same_looks(texts) == [same_look(t) for t in texts]
    x, bounds = fold(texts)
    for i, t in enumerate(texts):
        want = "".join(c.lower() if len(c.lower()) == 1 else c for c in "".join(same_look(t).split()))
        assert "".join(map(chr, x[bounds[i] : bounds[i + 1]])) == want


@settings(max_examples=200, deadline=None)
@given(ALPHABET)
def test_form_is_stable(text):
    assert same_look(same_look(text)) == same_look(text)


def test_alnum():
    x, bounds = fold(["A-b 1。中!", None, ""], "alnum")
    assert "".join(map(chr, x)) == "ab1中" and bounds.tolist() == [0, 4, 4, 4]
    assert x.dtype == np.uint32


def test_records(spark):
    from loomwright.llm.forms import consistent_forms, same_look_records

    rows = [
        ("a", "Bolt 12 km", ["470bar", "４７０bar"]),
        ("b", "Bоlt 12 km", None),
        ("b", "Bоlt 12 km", None),  # a second row of b
        ("c", "Bolt 12 km", [None, "x", "x"]),
        ("d", None, ["5V", "５V"]),  # null text: never a case
        ("e", "  ", []),
        ("f", "bolt 12 km", ["a"]),
        (None, "Bolt 12 ㎞", ["a"]),
    ]
    df = spark.createDataFrame(rows, "document_id string, text string, literals array<string>").selectExpr("*", "1 as id", "2 as l1")
    found = {tuple(r) for r in same_look_records(df).collect()}
    assert found == {("text", "a", "b"), ("text", "b", "c"), ("literals", "a", "a")}
    forms = consistent_forms(df, ["text"], ["literals"])
    assert forms.columns == df.columns and forms.where("document_id = 'b'").first()["text"] == "Bolt 12 km"
    assert same_look_records(df.limit(0)).count() == 0


def test_signs_beyond_the_table():
    """Late ideographs stay apart, tags and late variation selectors follow the scalar form."""
    texts = ["a\U00030000b", "a\U00031350b", "a\U000e0041b", "中\U000e0100文", "\U0010fffd"]
    assert same_looks(texts) == [same_look(t) for t in texts]
    assert same_looks(texts[:3]) == ["a\U00030000b", "a\U00031350b", "ab"]
    for mode in ("runs", "alnum"):
        x, bounds = fold(texts[:3], mode)
        assert "".join(map(chr, x)) == "a\U00030000ba\U00031350bab" and bounds.tolist() == [0, 3, 6, 8]


@pytest.mark.parametrize("text, report", [("Bоlt and Вольт", (1, 0)), ("сор рука", (0, 1)), ("plain 电阻 ｗｉｄｅ", (0, 0)), ("检查Bоlt", (1, 0)), ("", (0, 0)), (None, (0, 0)), ("rе́sumé", (1, 0))])
def test_script_report(text, report):
    assert script_report(text) == report


def test_confusables_data():
    from loomwright.llm.confusables import prototypes, resolved, twins

    drawn = prototypes()
    assert len(drawn) > 5000 and drawn["о"] == "o" and drawn["Α"] == "A"
    assert all(twins()[c]["Latn"].isascii() for c in twins()) and twins()["с"]["Cyrl"] == "с"
    assert resolved("abc") == {"Latn"} and resolved("aб") == frozenset() and resolved("12") is None and "Jpan" in resolved("漢字かな")


def test_forms_frame(spark):
    from loomwright.llm.forms import consistent_forms, same_look_classes, same_look_records

    rows = [("a", "Bоlt 5", "x", ["\u21261", "\u03a91"], 1), ("b", "Bolt 5", None, None, 2), ("c", "Bolt  5", "y", [], 3), ("d", None, "z", [None, "A"], 4), ("e", "other", "", ["А1", "A1"], None)]
    df = spark.createDataFrame(rows, "document_id string, text string, title string, literals array<string>, mixed_script int")
    got = {r["document_id"]: r for r in consistent_forms(df, ["title", "text"], ["literals"], "text").collect()}
    assert [got[k]["text"] for k in "abcde"] == ["Bolt 5", "Bolt 5", "Bolt 5", None, "other"] and got["d"]["literals"] == [None, "A"]
    assert [got[k]["mixed_script"] for k in "abcde"] == [1, 0, 0, 0, 0] and [got[k]["whole_script"] for k in "abcde"] == [0] * 5
    pairs = sorted(map(tuple, same_look_records(df).collect()))
    assert pairs == [("literals", "a", "a"), ("literals", "e", "e"), ("text", "a", "b"), ("text", "a", "c"), ("text", "b", "c")]
    classes = same_look_classes(df).collect()
    assert len(classes) == 3 and {r["spellings"] for r in classes} == {3} and {r["records"] for r in classes} == {1}
