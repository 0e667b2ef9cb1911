import pytest
from pyspark.sql import functions as F

from folioframe.llm import residue


def found(spark, texts, **more):
    rows = [(k, t, f"host{k}", f"/in/memo/{k}.md") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, path string")
    return {r.doc_id for r in residue.find_residue(df, **more).collect()}


NOTICES = [
    "Your account may not open this folder. Incident 0abafbbd.",
    "We could not complete your request.",
    "The system did not\n  answer in time.",
    "400 Bad Request",
    "405 Method Not Allowed",
    "410 Gone",
    "Zugriff verweigert",
    "ДОСТУП ЗАПРЕЩЁН",
    "Odmowa dostępu",
    "Erişim engellendi",
    "ERİŞİM ENGELLENDİ",
    "Nie znaleziono strony",
    "Η σελίδα δεν βρέθηκε",
    "ページが見つかりません",
    "  at com.acme.Form.load(Form.java:120)",
    "Interner Fehler",
    "SAYFA BULUNAMADI",
]
PLAIN = ["The respondents opened the folder and went on.", "Who found this text?", "The office was gone by May."]


def test_notices_without_a_subject_word(spark):
    assert found(spark, NOTICES + PLAIN) == set(range(len(NOTICES)))


@pytest.mark.parametrize("parts, pattern", residue.NOTICES)
def test_parts_cover_their_pattern(spark, parts, pattern):
    samples = [*NOTICES, *(f"{a} {b}" for p in parts for a in ("", "404", "JS must be enabled:", "the page", "<title>404") for b in (p, p.upper()))]
    line = residue._folded(F.col("t"))
    df = spark.createDataFrame([(s,) for s in samples], "t string").filter(F.col("t").rlike("(?iu)" + pattern))
    assert df.count() > 0
    assert df.filter(~(residue._has(line, residue._parts(parts)) | F.col("t").rlike(residue.FRAME))).collect() == []


FILLERS = [
    "LOREM IPSUM DOLOR SIT AMET, ",
    "magna nulla porta quis sed ",
    "Sed sit sed sit. ",
    "ASDF ASDF",
    "QWERTY QWERTY",
    "Todo Todo",
    "Comment\nN/N\nend",
    "Sample Text – of the second page",
    "Filler Text – of the second page",
    "Use of DUMMY COPY here",
    "BLINDTEXT",
    "TEXTO DE RELLENO",
    "ÖRNEK METİN",
]


def test_filler_in_capitals_and_title_case(spark):
    assert found(spark, FILLERS + PLAIN) == set(range(len(FILLERS)))


FRAMES = "\n".join(f"  at com.acme.forms.Loader{k}.load(Loader{k}.java:{k})" for k in range(40))
BLOCKS = [
    "java.lang.IllegalStateException: no form\n" + FRAMES,
    "<html><head><style>" + "p { margin: 0 } " * 60 + "</style></head><body>Access denied</body></html>",
    "First part.\r\rPage not found\r\rLast part.",
    "# 404 Not Found",
    "> Access\n> denied",
    "- Access denied",
    "**404 Not Found**",
    "Notice: page not found",
    "First part.\n\n Warning: undefined variable $section on line 93\nFatal error: call on null",
]
TALKED = [
    "| 1 | Page not found |\n| 2 | Access denied |",
    "- Page not found\n- Access denied\n- None of these",
    "Respondent: access denied, that is all I saw.",
    "<!-- access denied -->",
    "The visit was short. " * 60,
]


def test_blocks_of_any_length_and_mark(spark):
    assert found(spark, BLOCKS + TALKED) == set(range(len(BLOCKS)))


def test_a_response_from_several_hosts_under_several_slugs(spark):
    body = "The quality of the delivery was discussed with the buyers of the region in detail."
    odd = "Session closed by the login service"
    rows = [(k, f"# Report {k}\n\n{body}\n\n{odd if k < 4 else 'End of the report'}", f"host{k % 2}", f"/host/{'memo' if k % 3 else 'topline'}/{k}.md") for k in range(12)]
    rows += [(20, f"# Login service\n\nThe login service was judged.\n\n{odd}", "host1", "/host/memo/20.md"), (21, None, None, None), (22, " ", None, None), (23, odd, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, path string")
    got = {r.doc_id: r.mismatch for r in residue.find_residue(df).collect()}
    assert {k for k in got if k < 12} == {0, 1, 2, 3} and all(got.values()) and 20 not in got


def test_empty_table_and_copies(spark):
    assert found(spark, []) == set()
    df = spark.createDataFrame([(1, "Hello {{name}}", "h", "/a/b/1.md")] * 3, "doc_id int, text string, source string, path string")
    rows = residue.find_residue(df).collect()
    assert len(rows) == 1 and rows[0].field and residue.without_residue(df, residue.find_residue(df)).count() == 0
