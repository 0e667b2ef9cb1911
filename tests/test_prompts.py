from folioframe.operators import prompts as P


def test_prompts_carry_their_context(spark):
    chunks = spark.createDataFrame([(1, 0, "# Section 5 - A"), (1, 1, "**Q1**: [[chunk]]"), (1, 2, "| 1 | a |")], "doc_id int, chunk_index int, chunk string")
    got = {r.chunk_index: r for r in P.extraction_prompts(chunks, size=5).collect()}
    assert got[0].schema == "section" and got[2].schema == "element"
    user = got[2].messages[1].content
    assert "Open element: Q1" in user and "Kind of the part before: element_start" in user and "Part 3 of 3" in user and "unk]]" in user
    assert P.extraction_prompts(chunks.limit(0)).count() == 0


def test_files(spark):
    files = spark.createDataFrame([("a.md", "x"), ("b.txt", "x"), ("c.MD", " "), ("d", None)], "name string, text string")
    assert {r.name: r.error for r in P.input_errors(files, name="name", text="text").collect()} == {"b.txt": "not a Markdown file: txt", "c.MD": "no text", "d": "not a Markdown file: no extension"}
    assert P.file_prompts(files, name="name", text="text", what="section").first().messages[1].content.endswith("x")
