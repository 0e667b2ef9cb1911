import pytest

from folioframe.llm import truncation

THINGS = ["service", "prices", "opening hours", "staff", "parking", "website", "delivery", "returns", "advice", "waiting time"]
PLACES = ["Northgate", "Southport", "Eastham", "Westbrook", "Longmoor", "Ashford", "Brackley", "Cranham", "Dunmere", "Elswick", "Farnley", "Grindon"]
WHOLE = [f"How satisfied are you with the {t} of the shop in {p} today?" for t in THINGS for p in PLACES]


def cut_ids(spark, texts, sources=1):
    rows = [(k, t, f"s{k % sources}") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "element_id int, label string, source string").selectExpr("*", "'en' as lang")
    rows = truncation.values(df, table="partial_elements", key="element_id", text="label", lang="lang", source="source")
    return {r.id for r in truncation.judge(rows).filter("cut").collect()}


@pytest.mark.parametrize("cut, sources", [("How satisfied are you with the", 1), ("How satisfied are you with the serv", 1), ("How satisfied are you with the", 6)])
def test_copies_of_a_cut_value_do_not_vouch_for_each_other(spark, cut, sources):
    texts = WHOLE + [cut] * 120
    assert cut_ids(spark, texts, sources) == set(range(len(WHOLE), len(texts)))


def test_titles_of_many_sources_stay_whole(spark):
    assert cut_ids(spark, WHOLE + ["Satisfaction with the service"] * 50, 6) == set()


def test_defined_results(spark):
    rows = [(k, t, "s", "x") for k, t in enumerate(WHOLE)] + [(900, None, "s", "x"), (901, "", "s", "x"), (902, " \n ", "s", "x"), (903, "zzz", None, "x"), (904, "How satisfied are you with the serv", None, "x"), (904, "How satisfied are you with the serv", None, "x"), (905, "x" * 5000 + " are you with the", "s", "x"), (906, "A whole sentence.\nHow satisfied are you with the…", "s", "x")]
    df = spark.createDataFrame(rows, "element_id int, label string, source string, line string").selectExpr("*", "'en' as lang")
    values = truncation.values(df, table="partial_elements", key="element_id", text="label", lang="lang", source="source")
    judged = truncation.judge(values)
    assert {r.id for r in judged.filter("cut").collect()} == {904, 905, 906}
    rates = {r.source: (r.records, r.cut) for r in truncation.truncation_rates(values, judged).collect()}
    assert rates == {"s": (len(WHOLE) + 2, 2), None: (2, 1)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "element_id int, label string, source string, lang string")
    values = truncation.values(df, table="partial_elements", key="element_id", text="label", lang="lang", source="source")
    assert truncation.judge(values).count() == 0
