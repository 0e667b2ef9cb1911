import pytest
from pyspark.sql import functions as F

from folioframe.operators import structure as S

CHUNKS = [
    "# A\n**Q1** [YES_NO]: x",
    "| Value Code | Value Label |\n| 1 | a |",
    "| x | y | z |",
    "plain text",
    "**Q2**: y\n**Q3**: z",
    "a | b",
    None,
]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame([(1, i, c) for i, c in enumerate(CHUNKS) if c is not None] + [(2, 0, "# Only"), (2, 1, "")], "doc_id int, chunk_index int, chunk string")


def by_index(df, doc=1):
    return {r.chunk_index: r for r in df.collect() if r.doc_id == doc}


def test_kind_and_priority(chunks):
    m = by_index(S.structure_map(chunks))
    assert [m[i].chunk_type for i in range(6)] == ["section_with_elements", "table_content", "content_fragment", "content_fragment", "elements_only", "content_fragment"]
    assert [m[i].priority for i in range(6)] == ["high", "medium", "medium", "low", "high", "low"]
    assert by_index(S.structure_map(chunks), 2)[0].chunk_type == "section_header_only"


def test_positions_and_footer(chunks):
    e = sorted((r.global_position, r.section_relative_position, r.code, r.type, r.section_title) for r in S.element_positions(chunks).collect())
    assert e == [(1, 1, "Q1", "YES_NO", "A"), (2, 2, "Q2", "CHOICE", "A"), (3, 3, "Q3", "CHOICE", "A")]
    f = by_index(S.footer(S.structure_map(chunks)))
    assert "<!-- Section Title: A -->" in f[0].footer and "<!-- First Element Position: 2 -->" in f[4].footer and "<!-- Next Element Position: 4 -->" in f[4].footer
    assert f[1].footer.endswith("<!-- END METADATA -->") and "Contains Value Table" in f[1].footer and f[3].with_footer.startswith("plain text\n\n<!-- CHUNK METADATA -->")


@pytest.mark.parametrize(
    "text, kind",
    [("## Section 3 x", "SECTION_START"), ("**A** : b", "ELEMENT_START"), (" | a |", "TABLE_DATA"), ("a | b", "MIXED_CONTENT"), ("* **note**", "PROGRAMMING_NOTES"), ("- item", "MIXED_CONTENT"), ("[TABLE_CONTINUATION]\nx", "CONTINUATION"), ("short", "MIXED_CONTENT")],
)
def test_debug_kind(spark, text, kind):
    assert spark.range(1).select(S.debug_kind(F.lit(text))).first()[0] == kind


def test_fallback_and_refined(spark):
    rows = ["intro", "| a |", "# Section", "| a |", "**E**: x", "| 1 |", "text"]
    df = spark.createDataFrame([(1, i, c) for i, c in enumerate(rows)], "doc_id int, chunk_index int, chunk string")
    f = by_index(S.fallback_analysis(df))
    assert [(f[i].kind, f[i].confidence) for i in range(7)] == [("unknown", 0.3), ("unknown", 0.3), ("section_start", 0.8), ("section_continuation", 0.5), ("element_start", 0.7), ("element_continuation", 0.6), ("section_continuation", 0.5)]
    r = by_index(S.refined_analysis(df))
    assert (r[5].kind, r[5].confidence) == ("element_continuation", 1.0) and (r[6].kind, r[6].confidence) == ("section_continuation", 1.0) and (r[0].kind, r[0].confidence) == ("unknown", 0.8)


def test_fragments_and_completion(spark):
    rows = ["lower start", "# x\n| a", "| a | b", "QUESTION_A: x", "** bold", "x | y\nend *", ""]
    df = spark.createDataFrame([(1, i, c) for i, c in enumerate(rows)], "doc_id int, chunk_index int, chunk string")
    f = by_index(S.fragment_flags(df))
    assert [f[i].starts_incomplete for i in range(7)] == [True, False, False, False, False, True, False]
    assert [f[i].ends_incomplete for i in range(7)] == [False, True, False, False, False, False, False]
    assert f[5].continues_table and not f[1].continues_table
    df = spark.createDataFrame([(1, 0, "# Section 3\nx"), (1, 1, "# Title"), (1, 2, "  **Q**: a")], "doc_id int, chunk_index int, chunk string")
    c = by_index(S.completion_flags(df))
    assert [(c[i].new_section, c[i].new_element, c[i].section_complete, c[i].element_complete) for i in range(3)] == [(True, False, True, False), (False, False, False, True), (False, True, False, True)]


@pytest.mark.parametrize(
    "text, marker",
    [("| 1 | a |\n| Variable |", "[VARIABLES_TABLE_CONTINUATION]"), ("| Code |", "[COLUMNS_TABLE_CONTINUATION]"), ("| 1 |", "[TABLE_CONTINUATION]"), ("single answer only", "[ELEMENT_INSTRUCTIONS_CONTINUATION]"), ("some words", "[CONTENT_CONTINUATION]"), ("**Q1**: x", "[ELEMENT_START:Q1]"), ("# Section 12 - a", "[SECTION_START:12]"), ("Note: x", None), ("- item", None), ("", None)],
)
def test_markers(spark, text, marker):
    m, w = spark.range(1).select(S.content_marker(F.lit(text)), S.with_marker(F.lit(text))).first()
    assert m == marker and w == (f"{marker}\n{text}" if marker else text)


def test_found_markers_and_bare_chunk(spark):
    marked = "[ELEMENT_START:Q]\n**Q**: x\n[a]\ny\n[b]\n[too far]"
    got = spark.range(1).select(S.found_markers(F.lit(marked)), S.without_markers(F.lit(marked)), S.without_markers(F.lit("[x]\nplain"))).first()
    assert got[0] == ["[ELEMENT_START:Q]", "[a]", "[b]"] and got[1] == "**Q**: x\ny" and got[2] == "[x]\nplain"


def test_no_chunks(spark):
    empty = spark.createDataFrame([], "doc_id int, chunk_index int, chunk string")
    for f in (S.structure_map, S.element_positions, S.fallback_analysis, S.refined_analysis, S.fragment_flags, S.completion_flags, S.chunk_details, S.carried_codes):
        assert f(empty).count() == 0
