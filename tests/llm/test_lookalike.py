import pytest

from folioframe.llm import lookalike as A
from folioframe.llm import mojibake

PLAIN = ["How satisfied are you with the service today", "Please name one company you know", "Насколько вы довольны станцией сегодня", "Какую компанию вы знаете лучше", "Πόσο ικανοποιημένοι είστε σήμερα", "Comment évaluez-vous la qualité à côté"]
CASES = [
    ("sеrvice", "service"),
    ("ｓｅｒｖｉｃｅ", "service"),
    ("𝐬𝐞𝐫𝐯𝐢𝐜𝐞", "service"),
    ("ser​vice", "service"),
    ("so\xadviet", "soviet"),
    ("no\xa0break here", "no break here"),
    ("non‑stop", "non-stop"),
    ("café", "café"),
    ("станциeй", "станцией"),
    ("ﬁrst", "first"),
]
FINE = ["", "plain", "Café — “œuvre” №5 €™ ½ m² 1ª…", "Насколько вы довольны", "Πόσο", "Q1\\_2", "\U0001f469‍\U0001f680"]


def run(spark, rows, fields, **options):
    df = spark.createDataFrame([(i, t, c, "s", "en") for i, (t, c) in enumerate([*((p, None) for p in PLAIN * 5), *rows])], "element_id int, label string, code string, source string, lang string")
    first = len(PLAIN) * 5
    return {(r.element_id - first, r.field_name): r.canonical for r in A.normalize_fields(df, fields, keys=["element_id"], **options).collect()}


def test_stand_ins_come_out_in_one_form_and_nothing_else(spark):
    got = run(spark, [(t, None) for t, _ in CASES] + [(t, None) for t in FINE] + [(None, None)], {"label": False})
    assert got == {(i, "label"): w for i, (_, w) in enumerate(CASES)}


def test_codes_are_latin(spark):
    got = run(spark, [(None, "Q1А"), (None, "Ｑ２"), (None, "Q3"), (None, "ВАТ")], {"code": True})
    assert got == {(0, "code"): "Q1A", (1, "code"): "Q2", (3, "code"): "BAT"}


def test_applying_twice_is_applying_once(spark):
    speller = A.Speller(mojibake.PairModel({(None, "е "): 1}))
    for t, _ in CASES:
        once = speller.canonical(t)
        assert speller.canonical(once) == once


def test_garbled_values_are_left_to_the_other_operator(spark):
    bad = PLAIN[5].encode("utf-8").decode("latin-1")
    df = spark.createDataFrame([(i, t, None, "s", "fr") for i, t in enumerate([*PLAIN * 5, bad, bad])], "element_id int, label string, help_text string, source string, lang string")
    fitted = mojibake.learn(df)
    assert A.normalize_fields(df, {"label": False}, keys=["element_id"], source="source", fitted=fitted).count() == 0


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_empty(spark, rows):
    df = spark.createDataFrame(rows, "element_id int, label string")
    assert A.normalize_fields(df, {"label": False}, keys=["element_id"]).count() == 0
