import pytest
from pyspark.sql import functions as F

from folioframe.operators import chunking as C

TEXT = "intro\n\n# Section 1 - A\n\n**Q1**: one\n\n| a | b |\n| 1 | 2 |\n" + "word " * 900 + "\n\n**Q2**: two\n" + "x" * 3000 + "\n\nend"
TEXTS = [None, "", " \n ", "one", "a\\*\\*\\*b\\*\\*\\* \\*\\*\\*c", "# h1\nx\n# h2\ny", TEXT, TEXT, "é" * 5000, "\n" * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id int, text string, chunk string, chunk_index int")


def test_delimiter_strips_and_drops_blank_chunks(docs):
    got = {r.doc_id: r.c for r in docs.select("doc_id", C.by_delimiter(F.col("text")).alias("c")).collect()}
    assert got[4] == ["a", "b", "c"] and got[3] == ["one"] and got[0] is None and got[1] == [] and got[2] == []


def test_header_split_needs_two_headers(docs):
    got = {r.doc_id: r.c for r in docs.select("doc_id", C.by_header(F.col("text")).alias("c")).collect()}
    assert got[5] == ["# h1\nx", "# h2\ny"] and got[3] is None


@pytest.mark.parametrize("mode", sorted({*C.SPANS, "size", "size_parity", "cascade", "delimiter", "headless", "header"}))
def test_every_mode_takes_all_texts_and_keeps_order(docs, mode):
    rows = C.split_documents(docs, mode, key="doc_id", text="text", size=500, overlap=50).collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.chunk_index)):
        by_doc.setdefault(r.doc_id, []).append(r.chunk)
    assert not {0, 1, 2} & set(by_doc)
    assert all(c.strip() for chunks in by_doc.values() for c in chunks)
    assert by_doc.get(6) == by_doc.get(7)


def test_character_spans_cover_the_text_unless_parity_is_asked_for():
    spans = C._char_spans(TEXT, 500, 50)
    assert spans[0][0] == 0 and spans[-1][1] == len(TEXT) and all(b[0] <= a[1] for a, b in zip(spans, spans[1:]))
    assert all(e - s <= 500 for s, e in spans)
    assert C._char_spans("ab " * 10, 5, 1, parity=True)[1][0] >= 4


def test_boundaries_by_brute_force():
    import re

    def brute(t):
        found = []
        for p, f in ((r"^#+\s+Section\s+\d+", re.M | re.I), (r"^\*\*[^*\n]+\*\*\s*:", re.M), (r"^#+\s+", re.M)):
            found += [m.start() for m in re.finditer(p, t, f) if m.start() not in found]
        for p, gap in ((r"(?m)^\|[^|]*\|[^|]*\|", 50), (r"\n\n+", 20)):
            for m in re.finditer(p, t):
                if all(abs(m.start() - b) >= gap for b in found):
                    found.append(m.start())
        return sorted(set(found))

    for t in (TEXT, TEXT * 3, "", "| a | b |\n" * 40, "\n\na\n\n" * 50):
        assert C.boundary_places(t) == brute(t)
    assert len(C.boundary_places("**A**:\n**B**: x")) == 2  # an element header with nothing behind it hides no other


def test_aware_and_boundary_spans_end_at_boundaries():
    bounds = set(C.boundary_places(TEXT)) | {len(TEXT)}
    assert any(e in bounds for _, e in C._aware_spans(TEXT, 500, 50))
    assert all(e in bounds for _, e in C._boundary_spans(TEXT, 500, 50))
    assert C._boundary_spans("short", 500, 50) == [(0, 5)]


def test_adjusted_chunks_end_at_structures_and_order_is_repaired(spark):
    text = "a" * 90 + "\n\n**Q1**: x\n" + "b" * 120 + "\n\n# Section 2 - B\n" + "c" * 100
    chunks = [text[:100].strip(), text[100:210].strip(), text[210:].strip()]
    out = C.adjusted_spans(text, chunks, 100, 20)
    assert out[0] == "a" * 90 and C.adjusted_spans(text, ["nowhere", "b"], 100, 20)[0] == "nowhere" and C.adjusted_spans(text, ["one"], 10, 2) == ["one"]
    df = spark.createDataFrame([(1, "one two\nthree four", ["four", "three", "one two", " ", "zzz"])], "doc_id int, text string, chunks array<string>")
    got = [r.chunk for r in C.repair_order(df, "chunks", key="doc_id", text="text").orderBy("chunk_index").collect()]
    assert got == ["one two", "three", "four", "zzz"]


def test_preprocess_puts_blank_lines_before_headers(spark):
    got = spark.range(1).select(C.preprocess(F.lit("a\n## Section 1 - x\nb\n**Q**: y\n\n**R**: z"))).first()[0]
    assert got == "a\n\n\n## Section 1 - x\nb\n\n**Q**: y\n\n**R**: z"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert C.split_documents(empty, "aware", key="doc_id", text="text").count() == 0
    assert C.structure_offsets(empty, key="doc_id", text="text").count() == 0


def test_structure_offsets(spark):
    df = spark.createDataFrame([(1, "# Section 7 - Life\n**Q1**: name\n**VARIABLES TABLE**\n| a | b |")], "doc_id int, text string")
    got = {(r.kind, r.start): (r.code, r.label) for r in C.structure_offsets(df, key="doc_id", text="text").collect()}
    assert got[("section", 0)] == ("7", "Life") and got[("element", 19)] == ("Q1", "name") and ("variables_table", 32) in got and any(k == "table" for k, _ in got)


def test_unknown_mode(docs):
    with pytest.raises(ValueError):
        C.split_documents(docs, "nothing", key="doc_id", text="text")
