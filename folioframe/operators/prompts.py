"""What a provider is asked: prompts for the extraction of a chunk and of whole files, with the context of the chunk.

A prompt is a column of messages, so that it is made where the chunk is. Nothing
here calls a model; see ``extract.with_providers``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.text import render
from folioframe.operators.extract import TYPES

SYSTEM = (
    "You turn one part of a questionnaire in Markdown into JSON. Answer with one JSON object and nothing else. "
    "It has chunk_type, extracted_sections (code, label, notes, position), extracted_elements (code, label, type, position, notes, help_text, variables, columns), "
    "partial_content, requires_continuation and confidence. Element types: " + ", ".join(TYPES) + ". Leave out what the text does not say."
)
USER = "Kind of the part before: [[previous]]\nOpen section: [[section]]\nOpen element: [[element]]\nText carried over:\n[[carried]]\n\nPart [[number]] of [[total]]:\n[[chunk]]"
SCHEMAS = {
    "section": {"type": "object", "required": ["code", "label"], "properties": {"code": {"type": "string"}, "label": {"type": "string"}, "notes": {"type": ["string", "null"]}, "position": {"type": ["integer", "null"]}}},
    "element": {"type": "object", "required": ["code", "label", "type"], "properties": {"code": {"type": "string"}, "label": {"type": "string"}, "type": {"enum": list(TYPES)}, "position": {"type": ["integer", "null"]}, "variables": {"type": "array"}, "columns": {"type": "array"}}},
}


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def schema_for(kind: Column) -> Column:
    """Which schema the answer for a chunk of this kind follows: a section's where it is about a section, else an element's."""
    return F.when(F.startswith(F.lower(kind), F.lit("section")), "section").otherwise("element")


def fragment_context(chunks: DataFrame, *, doc: str = "doc_id", size: int = 200) -> DataFrame:
    """The chunks with what a provider should know of them: fragment flags, codes so far, the kind and the last characters before."""
    from folioframe.operators import structure

    flags = structure.fragment_flags(chunks, doc=doc)
    codes = structure.carried_codes(chunks, doc=doc)
    kinds = structure.refined_analysis(chunks, doc=doc).withColumn("previous", F.lag("kind").over(Window.partitionBy(doc).orderBy("chunk_index")))
    rows = structure.context_buffer(chunks, doc=doc, size=size).withColumnRenamed("context", "carried")
    for part in (flags, codes, kinds):
        rows = rows.join(part, [doc, "chunk_index"])
    return rows


def extraction_prompts(chunks: DataFrame, *, doc: str = "doc_id", size: int = 200) -> DataFrame:
    """(doc, chunk_index, schema, messages): the system and the user message for each chunk."""
    rows = fragment_context(chunks, doc=doc, size=size).withColumn("total", F.count("*").over(Window.partitionBy(doc)))
    said = {c: F.col(c) for c in ("previous", "section", "element", "carried", "chunk")}
    user = render(USER, {**said, "number": (F.col("chunk_index") + 1).cast("string"), "total": F.col("total").cast("string")})
    return rows.select(doc, "chunk_index", schema_for(F.col("kind")).alias("schema"), F.array(message("system", F.lit(SYSTEM)), message("user", user)).alias("messages"))


def file_prompts(files: DataFrame, *, name: str, text: str, what: str) -> DataFrame:
    """(name, schema, messages) for whole section or question files."""
    ask = F.concat(F.lit(f"Turn this {what} file into JSON:\n"), F.coalesce(text, F.lit("")))
    return files.select(name, F.lit(what).alias("schema"), F.array(message("system", F.lit(SYSTEM)), message("user", ask)).alias("messages"))


def input_errors(files: DataFrame, *, name: str, text: str) -> DataFrame:
    """(name, error) of inputs that can't be processed: an unknown kind of file, or no text."""
    kind = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    error = F.when(~kind.isin("md", "markdown"), F.concat(F.lit("not a Markdown file: "), F.coalesce(F.nullif(kind, F.lit("")), F.lit("no extension")))).when(F.trim(F.coalesce(text, F.lit(""))) == "", F.lit("no text"))
    return files.select(name, error.alias("error")).filter("error is not null")
