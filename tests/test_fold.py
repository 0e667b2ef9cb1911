import json

from pyspark.sql import functions as F

from folioframe.operators import assemble, extract, fold


def run(*steps):
    a, out = fold.Assembly(), []
    for kind, found, *text in steps:
        out += a.feed(text[0] if text else "", kind, found)
    return out + a.close()


def codes(sections):
    return [(s["code"], [e["code"] for e in s["elements"]]) for s in sections]


def test_sections_close_each_other_and_defaults_fill_in():
    got = run(("section_start", {"code": "s1", "label": "One"}), ("element_start", {"code": "e1"}), ("element_start", {}), ("section_start", {}))
    assert codes(got) == [("s1", ["e1", "element_2"]), ("section_2", [])]
    assert got[0]["elements"][0]["label"] == "Untitled Element" and got[0]["elements"][0]["type"] == "CHOICE" and got[1]["label"] == "Untitled Section"


def test_an_element_without_a_section_gets_the_default_one():
    assert codes(run(("element_start", {"code": "e"}))) == [("section_1", ["e"])]


def test_lists_take_only_codes_from_before_the_batch():
    first = {"code": "e", "variables": [{"code": "1"}, {"code": "1"}]}
    more = {"label": "L", "code": None, "variables": [{"code": "1"}, {"code": "2"}, {"code": "2"}]}
    got = run(("section_start", {"code": "s"}), ("element_start", first, "# Section 1"), ("element_continuation", more, "# Section 2"))
    assert [v["code"] for v in got[0]["elements"][0]["variables"]] == ["1", "1", "2", "2"] and got[0]["elements"][0]["label"] == "L"


def test_complete_parts_close_before_the_next_chunk():
    got = run(("section_start", {"code": "s"}, "# Section 1 - x"), ("element_start", {"code": "e"}, "**E**: x"))
    assert codes(got) == [("s", []), ("s", ["e"])]
    held = {"code": "s", "_fragment_metadata": {"ends_incomplete": True}}
    assert codes(run(("section_start", held, "# Section 1 - x"), ("element_start", {"code": "e"}))) == [("s", ["e"])]


def test_unknown_chunks_and_ends():
    got = run(("unknown", None, "raw"), ("unknown", {"code": "u"}, "x"), ("document_end", None), ("section_complete", None))
    assert codes(got) == [("section_1", ["u"])] and got[0]["chars"] == 3
    assert run() == []


def test_fold_over_documents(spark):
    rows = [("a", 1, "", "ELEMENT_START", json.dumps({"code": "e1", "columns": [{"code": 3}], "position": "x"})), ("a", 0, None, "section_start", '{"code": "s"}'), ("b", 0, "x", None, "not json"), (None, 0, "x", "element_complete", '{"code": "n"}')]
    df = spark.createDataFrame(rows, "doc_id string, chunk_index int, chunk string, kind string, extracted string")
    got = {(r.doc_id, r.section_no): (r.code, [(e.code, [c.code for c in e.columns], e.position) for e in r.elements]) for r in fold.fold_sections(df).collect()}
    assert got == {("a", 0): ("s", [("e1", ["3"], None)]), ("b", 0): ("section_1", []), (None, 0): ("section_1", [("n", [], 1)])}
    assert fold.fold_sections(df.limit(0)).count() == 0
    counts = fold.tree_counts(fold.fold_sections(df)).filter("doc_id = 'a'").first()
    assert (counts.sections, counts.elements, counts.variables, counts.columns) == (1, 1, 0, 1)


def test_accumulated_text(spark):
    rows = [(1, 0, "A", "one", None, True, None), (1, 1, "B", "two", "p", False, None), (1, 2, "C", "three", None, True, None), (1, 3, "D", "x", None, True, "failed"), (1, 4, "E", "four", None, None, "")]
    df = spark.createDataFrame(rows, "d int, i int, chunk_type string, content string, partial string, goes_on boolean, error string")
    got = fold.accumulated(df, doc="d", order=["i"], content=F.col("content"), partial=F.col("partial"), goes_on=F.col("goes_on"), error=F.col("error")).orderBy("i").collect()
    assert [r.accumulated for r in got] == ["\none", "p", "p\nthree", ""] and [r.previous_type for r in got] == [None, "A", "B", "C"]


MD = "# Section 100 - Life\n**Q1**: What?\n\\=\\=\\=\n| Code | Label |\n| Q5\\_1 | a |\n| 2 | b |\n\n**COLUMNS TABLE**\n| 1 | c |\n**Q2 \\[YES_NO]**: And?\n\\=\\=\\=\n\n**Q3 \\[ODD]**: bad?\n\\=\\=\\="


def test_rules_to_survey(spark):
    chunks = spark.createDataFrame([(1, 0, MD), (2, 0, "**Q9**: no section\n\\=\\=\\=")], "doc_id int, chunk_index int, chunk string")
    results = extract.rule_extract(chunks)
    rows = assemble.elements(results)
    good, bad = assemble.element_errors(rows, extract.TYPES)
    assert sorted(r.element.code for r in good.collect()) == ["Q1", "Q2", "Q9"] and [r.errors for r in bad.collect()] == [["unknown type ODD"]]
    survey = {r.doc_id: r.sections for r in assemble.survey(results).collect()}
    s = survey[1][0]
    assert s.code == "section_100" and [(e.position, e.code) for e in s.elements] == [(1, "Q1"), (2, "Q2")] and [v.code for v in s.elements[0].variables] == ["1", "2"] and 2 not in survey
    assert [r.doc_id for r in assemble.warnings(rows).collect()] == [2]


def test_providers_isolate_a_bad_chunk_and_feed_the_assembler(spark):
    def picky(texts):
        if "bad" in texts:
            raise ValueError("bad chunk")
        return [{"chunk_type": "SECTION_START", "extracted_sections": [{"code": t, "label": t, "notes": None, "position": None}], "extracted_elements": []} for t in texts]

    extract.PROVIDERS["picky"] = picky
    try:
        chunks = spark.createDataFrame([(1, 0, "a"), (1, 1, "bad"), (1, 2, "c")], "doc_id int, chunk_index int, chunk string").coalesce(1)
        results = extract.with_providers(chunks, ["none", "picky"], keys=["doc_id", "chunk_index"], attempts=1)
        assert [bool(r.result.error) for r in results.orderBy("chunk_index").collect()] == [False, True, False]
        assert [r.code for r in assemble.sections(results).orderBy("section_seq").collect()] == ["a", "c"]
    finally:
        del extract.PROVIDERS["picky"]
