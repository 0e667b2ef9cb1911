"""Structure of chunks: headers, elements, tables, their kinds, positions and what the next chunk needs to know.

Input is (document key, chunk_index, chunk). All numbering is window functions
partitioned by the document, so a document's rows meet in one task and no more.
Null chunks have no structure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.text import line_count, match_rows, strip

# Patterns of the structure map.
SECTION_TITLE = r"(?m)(?d)^# (.+)$"
ELEMENT_MARK = r"\*\*([^*]+)\*\*\s*(?:\[([^\]]+)\])?:"
VALUE_TABLE = r"(?i)\|\s*(?:Value\s*)?Code\s*\|\s*(?:Value\s*)?Label"
VARIABLE_TABLE = r"(?i)\|\s*Variable\s*Name\s*\|\s*Variable\s*Label"
TABLE_ROW = r"(?m)(?d)^\s*\|.*\|.*\|"
STRICT_SECTION = r"(?m)(?i)^#+\s+Section\s+\d+"
STRICT_ELEMENT = r"(?m)^\*\*[^*\n]+\*\*\s*:"
ANY_SECTION = r"(?m)(?i)^#+\s+Section"
ANY_ELEMENT = r"(?m)^\*\*[^*]+\*\*:"
PROGRAMMING_NOTE = r"(?m)^\*\s*\*\*[^*]+\*\*"
INSTRUCTIONS = ("single answer", "programmer", "randomize", "multicode")


def _title(c: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(c, SECTION_TITLE, 1)), F.lit(""))


def chunk_marks(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The chunks with size, lines, header, title, element matches and table marks."""
    c = F.col("chunk")
    return chunks.select(
        doc,
        "chunk_index",
        "chunk",
        F.length(c).cast("bigint").alias("size"),
        line_count(c).alias("lines"),
        c.rlike(SECTION_TITLE).alias("has_section_header"),
        _title(c).alias("section_title"),
        match_rows(c, ELEMENT_MARK, 2).alias("elements"),
        c.rlike(VALUE_TABLE).alias("has_value_table"),
        c.rlike(VARIABLE_TABLE).alias("has_variable_table"),
        F.regexp_count(c, F.lit(TABLE_ROW)).cast("bigint").alias("table_row_count"),
        F.contains(c, F.lit("|")).alias("has_table"),
        F.replace(F.substring(c, 1, 50), F.lit("\n"), F.lit(" ")).alias("starts_with"),
    )


def structure_map(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """One row for each chunk: marks, section position, numbers of elements, kind, priority and the next position in the section."""
    marks = chunk_marks(chunks, doc=doc)
    order = Window.partitionBy(doc).orderBy("chunk_index")
    n = F.size("elements").cast("bigint")
    seq = marks.withColumn("section_seq", F.sum(F.col("has_section_header").cast("bigint")).over(order)).withColumn("elements_count", n)
    inside = Window.partitionBy(doc, "section_seq").orderBy("chunk_index")
    seq = seq.withColumn("next_section_element_position", F.sum("elements_count").over(inside) + 1)
    header, some = F.col("has_section_header"), F.col("elements_count") > 0
    kind = (
        F.when(header & some, "section_with_elements")
        .when(header, "section_header_only")
        .when(some, "elements_only")
        .when(F.col("has_value_table") | F.col("has_variable_table"), "table_content")
        .otherwise("content_fragment")
    )
    priority = F.when(header | some, "high").when(F.col("table_row_count") > 0, "medium").otherwise("low")
    return seq.withColumn("section_position", F.when(header, F.col("section_seq"))).withColumn("chunk_type", kind).withColumn("priority", priority)


def element_positions(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """One row for each element: code, type, section, position in the document and in the section, offsets in its chunk."""
    title = F.max("section_title").over(Window.partitionBy(doc, "section_seq"))  # a section has one header chunk
    rows = structure_map(chunks, doc=doc).withColumn("title", title).select(doc, "chunk_index", "section_seq", "title", F.explode("elements").alias("e"))
    rows = rows.select(doc, "chunk_index", "section_seq", F.col("title").alias("section_title"), strip(F.col("e.g1")).alias("code"), F.coalesce(strip(F.col("e.g2")), F.lit("CHOICE")).alias("type"), F.col("e.start").cast("bigint").alias("start_char"), F.col("e.end").cast("bigint").alias("end_char"))
    whole = Window.partitionBy(doc).orderBy("chunk_index", "start_char")
    inside = Window.partitionBy(doc, "section_seq").orderBy("chunk_index", "start_char")
    return rows.withColumn("global_position", F.row_number().over(whole).cast("bigint")).withColumn("section_relative_position", F.row_number().over(inside).cast("bigint"))


def footer(m: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The structure map with each chunk's metadata footer, one comment a line, and ``with_footer``, the chunk that carries it."""
    line = lambda name, value: F.concat(F.lit(f"<!-- {name}: "), value.cast("string"), F.lit(" -->"))
    total = F.count("*").over(Window.partitionBy(doc))
    header, n, following = F.col("has_section_header"), F.col("elements_count"), F.col("next_section_element_position")
    lines = F.concat_ws(
        "\n",
        F.lit("<!-- CHUNK METADATA -->"),
        line("Chunk Index", F.col("chunk_index")),
        line("Total Chunks", total),
        F.when(header, F.concat_ws("\n", line("Section Position", F.col("section_position")), line("Section Title", F.coalesce("section_title", F.lit(""))), line("Next Element Position", F.lit(1)))),
        F.when(n > 0, F.concat_ws("\n", line("Elements in Chunk", n), line("First Element Position", following - n), line("Last Element Position", following - 1))),
        line("Next Element Position", following),
        F.when(F.col("has_value_table"), "<!-- Contains Value Table: Variables/Options -->"),
        F.when(F.col("has_variable_table"), "<!-- Contains Variable Table: Grid Questions -->"),
        line("Chunk Type", F.col("chunk_type")),
        line("Processing Priority", F.col("priority")),
        F.lit("<!-- END METADATA -->"),
    )
    return m.withColumn("footer", lines).withColumn("with_footer", F.concat("chunk", F.lit("\n\n"), "footer"))


def simple_analysis(c: Column) -> Column:
    """struct<kind, confidence> of a delimiter chunk."""
    row = lambda k, p: F.struct(F.lit(k).alias("kind"), F.lit(p).alias("confidence"))
    return (
        F.when(F.startswith(c, F.lit("**")) & F.contains(c, F.lit("**:")), row("element_start", 0.9))
        .when(F.startswith(c, F.lit("#")), row("section_start", 0.9))
        .when(F.contains(c, F.lit("|")) & (F.contains(c, F.lit("Value Code")) | F.contains(c, F.lit("Variable Name"))), row("element_continuation", 0.7))
        .otherwise(row("unknown", 0.8))
    )


def debug_kind(c: Column) -> Column:
    bare = strip(c)
    return (
        F.when(c.rlike(STRICT_SECTION), "SECTION_START")
        .when(c.rlike(STRICT_ELEMENT), "ELEMENT_START")
        .when(F.startswith(bare, F.lit("|")), "TABLE_DATA")
        .when(c.rlike(PROGRAMMING_NOTE), "PROGRAMMING_NOTES")
        .when(F.startswith(bare, F.lit("[")) & F.contains(c, F.lit("CONTINUATION")), "CONTINUATION")
        .otherwise("MIXED_CONTENT")
    )


def found_markers(c: Column) -> Column:
    """The lines in square brackets among the first five."""
    first = F.transform(F.slice(F.split(c, "\n"), 1, 5), strip)
    return F.filter(first, lambda x: F.startswith(x, F.lit("[")) & F.endswith(x, F.lit("]")))


def chunk_details(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """One row for each chunk as the debug view has it."""
    c = F.col("chunk")
    code = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return chunks.select(
        doc,
        "chunk_index",
        F.length(c).cast("bigint").alias("size"),
        debug_kind(c).alias("kind"),
        found_markers(c).alias("markers"),
        c.rlike(STRICT_SECTION).alias("has_section"),
        c.rlike(STRICT_ELEMENT).alias("has_element"),
        F.contains(c, F.lit("|")).alias("has_table"),
        F.startswith(strip(c), F.lit("|")).alias("starts_with_table"),
        line_count(c).alias("line_count"),
        F.when(F.length(c) > 200, F.concat(F.substring(c, 1, 200), F.lit("..."))).otherwise(c).alias("preview"),
        code(r"(?m)(?i)^#+\s+Section\s+(\d+)").alias("section_code"),
        code(r"(?m)^\*\*([^*\n]+)\*\*\s*:").alias("element_code"),
    )


def open_before(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The chunks with what is open when each begins: ``section_open``, ``element_open`` (a new section closes the element)."""
    c = F.col("chunk")
    before = Window.partitionBy(doc).orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    mark = F.when(c.rlike(ANY_SECTION), F.lit("section")).when(c.rlike(ANY_ELEMENT), F.lit("element"))
    last = F.last(mark, ignorenulls=True).over(before)
    any_section = F.max(c.rlike(ANY_SECTION)).over(before)
    return chunks.withColumn("element_open", F.coalesce(last == "element", F.lit(False))).withColumn("section_open", F.coalesce(any_section, F.lit(False)))


def fallback_analysis(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Kind and confidence of each chunk from itself and what is open before it, and the kind before it."""
    c = F.col("chunk")
    row = lambda k, p: F.struct(F.lit(k).alias("kind"), F.lit(p).alias("confidence"))
    found = (
        F.when(c.rlike(ANY_SECTION), row("section_start", 0.8))
        .when(c.rlike(ANY_ELEMENT), row("element_start", 0.7))
        .when(F.contains(c, F.lit("|")) & F.col("element_open"), row("element_continuation", 0.6))
        .when(F.col("section_open"), row("section_continuation", 0.5))
        .otherwise(row("unknown", 0.3))
    )
    rows = open_before(chunks, doc=doc).select(doc, "chunk_index", found.alias("a")).select(doc, "chunk_index", "a.kind", "a.confidence")
    return rows.withColumn("previous", F.lag("kind").over(Window.partitionBy(doc).orderBy("chunk_index")))


def refine(rows: DataFrame) -> DataFrame:
    """Kind and confidence put right by what is open: of rows (chunk, kind, confidence, section_open, element_open).

    An unknown chunk continues the open element where it has table cells and no
    header, else the open section; a continuation of something open gains
    confidence, which never exceeds 1.
    """
    c = F.col("chunk")
    table, element, section = F.contains(c, F.lit("|")), c.rlike(ANY_ELEMENT), c.rlike(ANY_SECTION)
    unknown = F.col("kind") == "unknown"
    to_element = unknown & table & F.col("element_open") & ~element & ~section
    to_section = unknown & ~to_element & F.col("section_open") & ~section
    more = lambda on, by: F.when(on, by).otherwise(0.0)
    kind = F.when(to_element, "element_continuation").when(to_section, "section_continuation").otherwise(F.col("kind"))
    rows = rows.withColumn("first", F.least(F.col("confidence") + more(to_element, 0.2) + more(to_section, 0.1), F.lit(1.0))).withColumn("kind", kind)
    gain = more(F.col("element_open") & (F.col("kind") == "element_continuation") & table, 0.1) + more(F.col("section_open") & (F.col("kind") == "section_continuation"), 0.1)
    return rows.withColumn("confidence", F.round(F.least(F.col("first") + gain, F.lit(1.0)), 2)).drop("first")


def refined_analysis(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The simple analysis of each chunk, refined by its context."""
    rows = open_before(chunks, doc=doc).withColumn("a", simple_analysis(F.col("chunk"))).withColumn("kind", F.col("a.kind")).withColumn("confidence", F.col("a.confidence"))
    return refine(rows).select(doc, "chunk_index", "kind", "confidence")


def _starts_incomplete(first: Column) -> Column:
    return (first != "") & ~first.rlike(r"^(?:#|\*|\||-|[A-Z_]+:)")


def fragment_flags(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """starts_incomplete, ends_incomplete, is_fragment of each chunk, and whether it continues a table."""
    lines = F.split(F.col("chunk"), "\n")
    first, last = strip(F.element_at(lines, 1)), strip(F.element_at(lines, -1))
    starts = _starts_incomplete(first)
    ends = (last != "") & (F.length(last) - F.length(F.replace(last, F.lit("|"), F.lit(""))) == 1) & ~last.rlike(r"[.!?:|]$")
    bare = strip(F.col("chunk"))
    table = F.contains("chunk", F.lit("|")) & starts & ~bare.rlike(r"^(?:#|\*\*[^*]+\*\*:)")
    return chunks.select(doc, "chunk_index", starts.alias("starts_incomplete"), ends.alias("ends_incomplete"), (starts | ends).alias("is_fragment"), table.alias("continues_table"))


def completion_flags(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Whether a chunk brings a new section or element, and what it completes; without either it completes an element."""
    lines = F.transform(F.split("chunk", "\n"), strip)
    has = lambda p: F.exists(lines, lambda x: x.rlike(p))
    rows = chunks.select(doc, "chunk_index", has(r"(?i)^#+\s+Section\s+\d+").alias("new_section"), has(r"^\*\*[^*]+\*\*:").alias("new_element"))
    return rows.withColumn("section_complete", F.col("new_section")).withColumn("element_complete", F.col("new_element") | ~F.col("new_section"))


def content_marker(c: Column) -> Column:
    """The marker of what a chunk begins with, null where its beginning is no sign of anything."""
    lines = F.split(c, "\n")
    first, near = strip(lines[0]), F.slice(lines, 1, 3)
    has = lambda *parts: F.exists(near, lambda x: F.lit(False) if not parts else _any(x, parts))
    marked = lambda name, code: F.concat(F.lit(f"[{name}:"), code, F.lit("]"))
    return (
        F.when(F.startswith(first, F.lit("|")), F.when(has("Variable"), "[VARIABLES_TABLE_CONTINUATION]").when(has("Value", "Code"), "[COLUMNS_TABLE_CONTINUATION]").otherwise("[TABLE_CONTINUATION]"))
        .when((first != "") & ~first.rlike(r"^(?:[#*|-]|[A-Z][a-z]+:)"), F.when(_any(F.lower(first), INSTRUCTIONS), "[ELEMENT_INSTRUCTIONS_CONTINUATION]").otherwise("[CONTENT_CONTINUATION]"))
        .when(first.rlike(r"^\*\*[^*\n]+\*\*\s*:"), marked("ELEMENT_START", F.regexp_extract(first, r"^\*\*([^*\n]+)\*\*\s*:", 1)))
        .when(first.rlike(r"(?i)^#+\s+Section\s+\d+"), marked("SECTION_START", F.regexp_extract(first, r"(?i)^#+\s+Section\s+(\d+)", 1)))
    )


def _any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.contains(c, F.lit(parts[0]))
    for p in parts[1:]:
        out = out | F.contains(c, F.lit(p))
    return out


def with_marker(c: Column) -> Column:
    """The chunk behind its marker line, as it is where it has none."""
    return F.concat_ws("\n", content_marker(c), c)


def without_markers(c: Column) -> Column:
    """A chunk as it stands in the text: lines in square brackets go where one of them is a marker."""
    kept = F.filter(F.split(c, "\n"), lambda x: ~(F.startswith(strip(x), F.lit("[")) & F.endswith(strip(x), F.lit("]"))))
    return F.when(_any(c, ("[SECTION_START:", "[ELEMENT_START:", "[TABLE_CONTINUATION]", "[CONTENT_CONTINUATION]")), F.array_join(kept, "\n")).otherwise(c)


def context_buffer(chunks: DataFrame, *, doc: str = "doc_id", size: int = 200) -> DataFrame:
    """The chunks with the last characters of the one before."""
    return chunks.withColumn("context", F.lag(F.right(F.col("chunk"), F.lit(size))).over(Window.partitionBy(doc).orderBy("chunk_index")))


def carried_codes(chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The last section title and element code up to each chunk, and defaults where there is none."""
    so_far = Window.partitionBy(doc).orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, 0)
    c = F.col("chunk")
    code = F.nullif(strip(F.regexp_extract(c, ELEMENT_MARK, 1)), F.lit(""))
    rows = chunks.select(doc, "chunk_index", F.last(_title(c), ignorenulls=True).over(so_far).alias("section"), F.last(code, ignorenulls=True).over(so_far).alias("element"), F.count(F.when(c.rlike(SECTION_TITLE), 1)).over(so_far).alias("n"))
    return rows.select(doc, "chunk_index", F.coalesce("section", F.concat(F.lit("section_"), F.col("n") + 1)).alias("section"), "element")


def structures_in_chunks(structures: DataFrame, chunks: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Range join: each structure with the chunk whose span [chunk_start, chunk_end) holds its start."""
    c = chunks.select(F.col(doc).alias("d"), "chunk_index", "chunk_start", "chunk_end")
    on = (F.col(doc) == F.col("d")) & (F.col("start") >= F.col("chunk_start")) & (F.col("start") < F.col("chunk_end"))
    return structures.join(c, on).drop("d")


def preceding_element(structures: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """As-of: each table with the nearest element before it."""
    before = Window.partitionBy(doc).orderBy("start", "kind", "ord").rowsBetween(Window.unboundedPreceding, -1)
    at = F.last(F.when(F.col("kind") == "element", F.struct("code", "start")), ignorenulls=True).over(before)
    return structures.withColumn("owner", at).filter("kind = 'table'").select(doc, "ord", "start", F.col("owner.code").alias("element_code"), F.col("owner.start").alias("element_start"))
