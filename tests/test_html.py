import pytest
from pyspark.sql import functions as F

from folioframe.operators import html as H

BLUE = '<p><font color="#0070c0"><b>{}</b></font></p>'
PAGE = (
    "<html><body><p>before</p><h1>x <font>One </font><b>y</b></h1>" + BLUE.format("Q1: first") + "<p>label</p>" + '<p><font color="#0070C0"><b>Q9: other blue</b></font></p>'
    '<p><strong>Q8: strong</strong><font color="#0070c0">x</font></p>' + "<div>" + BLUE.format("Q7: nested") + "</div>" + BLUE.format("Q2: second") + "<h1></h1><p>lost</p><h1>Two/2</h1><p>end</p></body></html>"
)


def nodes(spark, *pages):
    return H.nodes(spark.createDataFrame(list(enumerate(pages)), "page_id int, html string"))


def test_sections_are_the_bodys_own_headings_with_a_title(spark):
    s = H.sections(nodes(spark, PAGE, "<p>no body</p>", "", None))
    assert sorted({(r.page_id, r.section_no, r.section_title) for r in s.collect()}) == [(0, 0, "One"), (0, 1, "Two/2")]
    assert "lost" not in {r.inner_text for r in s.collect()}


def test_questions_and_mapping(spark):
    s = H.sections(nodes(spark, PAGE))
    q = H.questions(s)
    starts = sorted({(r.question_no, r.question_label) for r in q.collect()})
    assert starts == [(0, "question_0"), (1, "question_1")]
    m = {r.section_no: r for r in H.mapping(s, q).collect()}
    assert m[0].filename == "000_One.html" and [x.filename for x in m[0].questions] == ["000_One__000_question_0.html", "000_One__001_question_1.html"]
    assert m[1].filename == "001_Two_2.html" and m[1].question_count == 0 and m[1].questions == []


@pytest.mark.parametrize("text, want", [("Q305_1", "1"), ("Q305_12 and more", "12"), ("Q12345_1", "Q12345_1"), ("xQ1_1", "xQ1_1"), (None, None)])
def test_prefix_is_taken_from_the_beginning(spark, text, want):
    from folioframe.operators.extract import strip_prefix

    assert spark.createDataFrame([(text,)], "t string").select(strip_prefix(F.col("t"))).first()[0] == want


def test_legacy_chunks(spark):
    page = "<body><p>intro</p><ul><li>a</li></ul><p>Q1 [CHOICE] what</p><p>more</p><p>===</p><p>Extra</p><p>x</p><p>===</p><table></table><p>Q2 [YES_NO]</p></body>"
    got = [(r.code, len(r.node_ids)) for r in H.legacy_chunks(nodes(spark, page)).orderBy("chunk_no").collect()]
    assert got == [("preface", 2), ("Q1", 3), ("Extra", 3), ("Q2", 1), ("epilogue", 1)]
    assert [r.code for r in H.legacy_chunks(nodes(spark, "<body><p>only</p></body>")).collect()] == ["preface"]


def test_cleaner():
    page = (
        '<html><body><p style="color: red; margin: 0" lang="en-US" class="western" width="3"><font size="2">Section 100 - Life</font></p><p>Q1 [CHOICE]</p><p>===</p><p> </p><p>VARIABLES TABLE</p><p>t</p>'
        "<table><tr><td><p><b>Q3_7</b></p></td><td><p>a</p><p>b</p></td><td><p><b>x</b></p></td></tr></table></body></html>"
    )
    out = H.clean_page(page)
    assert "<font" not in out and "margin" not in out and 'style="color: red"' in out and "lang=" not in out and "width" not in out
    assert "[TABLE LABEL: VARIABLES TABLE]" in out and "<td>7</td>" in out and "<td>a b</td>" in out and "<td><b>x</b></td>" in out
    assert 'data-code="Q1" data-type="CHOICE"' in out and '<div id="section-100" class="section">' in out and "<p> </p>" not in out
    assert H.clean_page("") == "" and H.clean_page("no tags & more") == "no tags &amp; more" and H.clean_page(out)


def test_cleaner_keeps_going(spark):
    rows = H.clean_pages(spark.createDataFrame([(1, "<body><p>a"), (2, None), (3, "<<<>>")], "page_id int, html string")).collect()
    assert {r.status for r in rows} == {"ok"} and len(rows) == 3


def test_markdown(spark):
    page = "<h2>T</h2><p>a <b>b</b> <i>c</i></p><ul><li>x</li><li>y</li></ul><table><tr><td>1</td><td>2</td></tr></table><script>no</script>"
    got = H.to_markdown(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")).orderBy("page_id").collect()
    assert got[0].markdown.startswith("## T\n\na **b** *c*") and "- x\n- y" in got[0].markdown and "| 1 | 2 |" in got[0].markdown and "no" not in got[0].markdown
    assert got[1].markdown is None and got[2].markdown == ""


def test_end_lines_stay(spark):
    n = nodes(spark, '<body><p></p><p lang="en-US" class="western" style="line-height: 100%; margin-bottom: 0in"></p><p>x</p></body>')
    assert H.drop_empty_paragraphs(n).filter("tag = 'p'").count() == 2
