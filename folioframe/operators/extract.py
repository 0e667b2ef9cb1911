"""Extraction of sections, elements, variables and columns from chunks, by rules or by a plugged-in provider.

The result contract is one struct for each chunk: ``chunk_type``,
``extracted_sections``, ``extracted_elements``, ``partial_content``,
``requires_continuation``, ``confidence``, ``error``. The rule extractor is native
columns; providers run in Arrow batches behind the same contract, in the order
given, with retries, each failure going to the next one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import strip

# How an element starts, and the synonyms of table headers.
MARK = r"(?m)^\s*\*\*((?:\\_|[A-Za-z0-9_])+)(?:\*\*)*\s*(?:\\?\[([A-Z0-9_]+)\\?\])?(?:\*\*)*:(?:\*\*)?"
MARK_AHEAD = r"(?m)(?=^[ \t]*\*\*(?:\\_|[A-Za-z0-9_])+(?:\*\*)*\s*(?:\\?\[[A-Z0-9_]+\\?\])?(?:\*\*)*:)"
LABEL_END = r"\\?=\\?=\\?="
CODE_HEADERS = ("code", "value code", "variable code", "variable name")
TYPES = ("CHOICE", "OPEN_END", "BREAK_PAGE", "SCREENER", "COUNTRY_DROPDOWN", "AGE_ORI", "S105_RATING_FAMILIARITY", "GEOGRAPHIC_AREA_REGION", "PULSE_FILTER", "YES_NO", "EDUCATION_STANDARD", "INCOME_STANDARD")
#: a spelling that prompts use, and what strict readers know it as
TYPE_ALIASES = {"AGE_STANDARD": "AGE_ORI"}

RESULT = (
    "chunk_type string, extracted_sections array<struct<code:string,label:string,notes:string,position:int>>, "
    "extracted_elements array<struct<code:string,label:string,type:string,position:int,notes:string,help_text:string,"
    "variables:array<struct<code:string,label:string,notes:string,position:int>>,columns:array<struct<code:string,label:string,notes:string,position:int>>>>, "
    "partial_content string, requires_continuation boolean, confidence double, error string"
)


def table_cells(line: Column) -> Column:
    """The cells of a pipe-table line, without emphasis and outer white space."""
    inner = F.regexp_replace(strip(line), r"\A\||\|\z", "")
    return F.transform(F.split(inner, r"\|", -1), lambda c: strip(F.replace(F.replace(c, F.lit("**"), F.lit("")), F.lit("\\_"), F.lit("_"))))


def strip_prefix(code: Column) -> Column:
    """``Q305_1``, and whatever begins so, to ``1``; anything else stays."""
    return F.coalesce(F.nullif(F.regexp_extract(code, r"^Q\d{1,4}_(\d+)", 1), F.lit("")), code)


def table_rows(text: Column) -> Column:
    """array<struct<code, label, notes, position>> of the pipe-table lines, header and rule lines left out."""
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x).startswith("|"))
    cells = F.filter(F.transform(lines, table_cells), lambda c: (F.size(c) >= 2) & ~F.lower(c[0]).isin(*CODE_HEADERS) & ~c[0].rlike(r"^:?-{2,}:?$"))
    return F.transform(cells, lambda c, i: F.struct(F.nullif(strip_prefix(c[0]), F.lit("")).alias("code"), F.nullif(c[1], F.lit("")).alias("label"), F.nullif(F.get(c, F.lit(2)), F.lit("")).alias("notes"), (i + 1).alias("position")))


def element_of(piece: Column) -> Column:
    """The element that begins a piece of a chunk."""
    body = F.regexp_replace(piece, rf"\A\s*{MARK[4:]}", "")
    halves = F.split(body, LABEL_END, 2)
    rest = F.coalesce(F.get(halves, F.lit(1)), F.lit(""))
    label = F.when(F.size(halves) > 1, halves[0]).otherwise(F.regexp_extract(body, r"(?s)\A(.*?)(?:\n\s*\n|\n\s*\||\z)", 1))
    parts = F.split(F.when(F.size(halves) > 1, rest).otherwise(body), r"(?i)\*\*COLUMNS?\s+TABLE\*\*", 2)
    plain = F.filter(F.transform(F.split(rest, "\n"), strip), lambda x: (x != "") & ~x.startswith("|") & ~x.rlike(r"(?i)^\*\*(?:VARIABLES?|COLUMNS?)\s+TABLE\*\*$") & ~x.rlike(r"^(?:\\?\*){3}$"))
    kind = F.coalesce(F.nullif(F.regexp_extract(piece, MARK, 2), F.lit("")), F.lit("CHOICE"))
    for a, b in TYPE_ALIASES.items():
        kind = F.when(kind == a, b).otherwise(kind)
    return F.struct(
        F.replace(F.regexp_extract(piece, MARK, 1), F.lit("\\_"), F.lit("_")).alias("code"),
        strip(label).alias("label"),
        kind.alias("type"),
        F.lit(None).cast("int").alias("position"),
        F.nullif(F.array_join(plain, "\n"), F.lit("")).alias("notes"),
        F.lit(None).cast("string").alias("help_text"),
        table_rows(parts[0]).alias("variables"),
        F.coalesce(table_rows(F.get(parts, F.lit(1))), F.array().cast("array<struct<code:string,label:string,notes:string,position:int>>")).alias("columns"),
    )


def section_code(title: Column) -> Column:
    """``Section 1000 - Label`` to ``section_1000``, ``CEO SECTION (...)`` to ``section_ceo``, else from the title's words."""
    number = F.nullif(F.regexp_extract(title, r"(?i)^Section\s+(\d+)", 1), F.lit(""))
    named = F.nullif(F.regexp_extract(title, r"(?i)^(\w+)\s+SECTION\b", 1), F.lit(""))
    words = F.regexp_replace(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", "_"), r"^_|_$", "")
    return F.concat(F.lit("section_"), F.coalesce(number, F.lower(named), words))


def section_label(title: Column) -> Column:
    """The title without its number, the escaped dash and a trailing list in brackets of a named section."""
    bare = F.regexp_replace(title, r"(?i)^Section\s+\d+\s*\\?[-–—]\s*", "")
    return strip(F.when(F.regexp_like(title, F.lit(r"(?i)^\w+\s+SECTION\b")), F.regexp_replace(bare, r"\s*\(.*$", "")).otherwise(bare))


def _found_sections(chunk: Column) -> Column:
    titles = F.transform(F.regexp_extract_all(chunk, F.lit(r"(?m)^\s*#+ (.+)$"), F.lit(1)), strip)
    return F.transform(titles, lambda t: F.struct(section_code(t).alias("code"), section_label(t).alias("label"), F.lit(None).cast("string").alias("notes"), F.lit(None).cast("int").alias("position")))


def rule_extract(chunks: DataFrame, *, chunk: str = "chunk") -> DataFrame:
    """The chunks with ``result``, the extraction by rules.

    Sections and elements are columns of their own first, so that each is found once.
    """
    c, sections, elements = F.col(chunk), F.col("found_sections"), F.col("found_elements")
    pieces = F.filter(F.split(c, MARK_AHEAD, -1), lambda p: p.rlike(MARK))
    found = chunks.withColumn("found_sections", _found_sections(c)).withColumn("found_elements", F.transform(pieces, element_of))
    open_end = c.rlike(r"(?:\|[^|\n]*[^|\s][^|\n]*|,|\p{Ll})\s*\z") & ~c.rlike(r"\|\s*\z")
    kind = F.when(F.size(sections) > 0, "SECTION_START").when(F.size(elements) > 0, "ELEMENT_START").when(F.contains(c, F.lit("|")), "ELEMENT_CONTINUATION").otherwise("UNKNOWN")
    result = F.struct(
        kind.alias("chunk_type"),
        sections.alias("extracted_sections"),
        elements.alias("extracted_elements"),
        F.when(open_end, c).alias("partial_content"),
        open_end.alias("requires_continuation"),
        F.when(F.size(elements) + F.size(sections) > 0, 0.9).otherwise(0.3).alias("confidence"),
        F.lit(None).cast("string").alias("error"),  # rules don't fail; elements that can't be taken are told when they are assembled
    )
    return found.withColumn("result", result).drop("found_sections", "found_elements")


def token_estimate(text: Column) -> Column:
    """Three tokens for four characters."""
    return F.length(text) * 0.75


#: name -> function from a list of chunks to a list of result dicts
PROVIDERS: dict[str, Callable[[list[str]], list[dict]]] = {}


def with_providers(chunks: DataFrame, order: list[str], *, keys: list[str], attempts: int = 3, delay: float = 1.0, factor: float = 2.0) -> DataFrame:
    """(keys, result) by the providers in the order given, as :func:`rule_extract` gives it.

    Providers get all chunks of a batch; where one fails for the batch, each of its
    chunks is tried alone, so that one bad chunk costs no other. A chunk that all
    providers fail for has only ``error`` set. An unknown name is left out.
    """
    known = [(n, PROVIDERS[n]) for n in order if n in PROVIDERS]

    def tried(texts: list[str]) -> tuple[list[dict] | None, str]:
        last = "no provider"
        for name, provider in known:
            for k in range(attempts):
                try:
                    got = provider(texts)
                    if len(got) != len(texts):
                        raise ValueError(f"{len(got)} results for {len(texts)} chunks")
                    return got, ""
                except Exception as e:  # noqa: BLE001
                    last = f"{name}: {e}"
                    if k + 1 < attempts:
                        time.sleep(delay * factor**k)
        return None, last

    def call(texts: list[str]) -> list[dict]:
        got, last = tried(texts)
        if got is not None:
            return got
        if len(texts) == 1:
            return [{"error": last}]
        return [r for t in texts for r in call([t])]

    names = [f.split()[0] for f in RESULT.replace("array<struct<", "array<").split(", ") if " " in f]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = call(b["chunk"].tolist())
            out = b[keys].reset_index(drop=True)
            for n in names:
                out[n] = pd.Series([g.get(n) for g in got], dtype=object)
            yield out

    head = ", ".join(f"{k} {chunks.schema[k].dataType.simpleString()}" for k in keys)
    rows = chunks.select(*keys, "chunk").mapInPandas(run, f"{head}, {RESULT}")
    return rows.select(*keys, F.struct(*names).alias("result"))
