"""Splitting texts into chunks: by delimiter, header, size, characters, tokens or semantic boundaries.

Every splitter is a column expression or a DataFrame operator that keeps a
document's chunks in its own row until ``explode_chunks``; no shuffle takes place.
Null and blank texts give no chunk.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from folioframe.functions.text import match_rows, strip

# The default delimiter (three escaped asterisks) and the patterns of structures.
DELIMITER = r"\\\*\\\*\\\*"
HEADER = r"(?d)(?m)^# .+$"
SECTION = r"(?d)(?m)(?i)^#+\s+Section\s+\d+\s*[-–—]\s*(.+)"
ELEMENT = r"(?d)(?m)^\*\*([^*\n]+)\*\*\s*:\s*(.+)"
ANY_HEADER = r"(?m)^#+\s+"
TABLE_START = r"(?m)^\|[^|]*\|[^|]*\|"
PARAGRAPH = r"\n\n+"
BOUNDARY_SECTION = r"^#+\s+Section\s+\d+"
BOUNDARY_ELEMENT = r"^\*\*[^*\n]+\*\*\s*:"
VARIABLES = r"(?i)\*\*VARIABLES?\s+TABLE\*\*"
COLUMNS = r"(?i)\*\*COLUMNS?\s+TABLE\*\*"


def _kept(chunks: Column) -> Column:
    return F.filter(F.transform(chunks, strip), lambda x: x != "")


def by_delimiter(text: Column, delimiter: str = DELIMITER) -> Column:
    return _kept(F.split(text, delimiter, -1))


def by_delimiter_headless(text: Column, delimiter: str = DELIMITER) -> Column:
    """As :func:`by_delimiter`, a leading header line of each chunk removed."""
    cut = lambda x: F.when(F.startswith(x, F.lit("#")), F.regexp_replace(x, r"\A#[^\n]*\n?", "")).otherwise(x)
    return _kept(F.transform(by_delimiter(text, delimiter), cut))


def by_header(text: Column) -> Column:
    """At every ``# `` header, where there are two or more; the text before the first is a chunk of its own."""
    return F.when(F.regexp_count(text, F.lit(HEADER)) >= 2, _kept(F.split(text, r"(?m)(?=^# .)", -1)))


def by_size(text: Column, limit: int = 2000, overlap: int = 200, *, parity: bool = False) -> Column:
    """Lines packed greedily up to ``limit`` characters; a new chunk opens with the last ``overlap / 50`` lines of the one before.

    ``parity``: the line that opens a chunk is glued to the one after it, and the
    empty string behind the last line end counts as one of the lines carried over.
    """
    carried = max(1, -(-overlap // 50))
    lines = F.split(text, "\n")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("size"))

    def step(s: Column, line: Column) -> Column:
        full = (s["size"] + F.length(line) > limit) & (s["open"] != "")
        tail = F.substring_index(F.substring(s["open"], F.lit(1), F.length(s["open"]) - 1), "\n", -carried) if overlap else F.lit("")
        if parity:
            kept = F.split(s["open"], "\n")
            kept = F.when(F.size(kept) <= carried, kept).otherwise(F.slice(kept, -carried, carried))
            begun = F.concat(F.array_join(kept, "\n"), F.lit("\n"), line)
            return grown(s, line, full, begun)
        begun = F.concat(tail, F.lit("\n"), line, F.lit("\n")) if overlap else F.concat(line, F.lit("\n"))
        return grown(s, line, full, begun)

    def grown(s: Column, line: Column, full: Column, begun: Column) -> Column:
        return F.struct(
            F.when(full, F.array_append(s["done"], s["open"])).otherwise(s["done"]).alias("done"),
            F.when(full, begun).otherwise(F.concat(s["open"], line, F.lit("\n"))).alias("open"),
            F.when(full, F.length(begun)).otherwise(s["size"] + F.length(line) + 1).alias("size"),
        )

    return _kept(F.aggregate(lines, start, step, lambda s: F.array_append(s["done"], s["open"])))


def cascade(text: Column, limit: int = 2000, overlap: int = 200) -> Column:
    """struct<strategy, chunks>: delimiter, else header, else size, the first with two chunks or more."""
    d, h = by_delimiter(text), by_header(text)
    some = lambda name, chunks: F.struct(F.lit(name).alias("strategy"), chunks.alias("chunks"))
    return (
        F.when(strip(text) == "", None)
        .when(F.size(d) >= 2, some("delimiter", d))
        .when(F.size(h) >= 2, some("header", h))
        .otherwise(some("size", by_size(text, limit, overlap)))
    )


_STRONG = tuple(re.compile(p, f) for p, f in ((BOUNDARY_SECTION, re.M | re.I), (BOUNDARY_ELEMENT, re.M), (r"^#+\s+", re.M)))
_TABLE, _BLANK = re.compile(r"^\|[^|]*\|[^|]*\|", re.M), re.compile(PARAGRAPH)


def boundary_places(text: str) -> list[int]:
    """Sorted places of semantic boundaries: sections, elements, headers, tables (50 off all others), paragraphs (20 off).

    What is near is looked up in the sorted places, so the work is n log n.
    """
    places = sorted({m.start() for p in _STRONG for m in p.finditer(text)})
    for pattern, gap in ((_TABLE, 50), (_BLANK, 20)):
        added: list[int] = []
        for m in pattern.finditer(text):
            at = m.start()
            k = bisect.bisect_left(places, at)
            near = [p for p in (*places[max(k - 1, 0) : k + 1], *added[-1:]) if abs(p - at) < gap]
            if not near:
                added.append(at)
        places = sorted({*places, *added})
    return places


@F.pandas_udf(ArrayType(IntegerType()))
def _boundaries(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else boundary_places(t))


def boundaries(text: Column) -> Column:
    return _boundaries(text)


def preprocess(text: Column) -> Column:
    """Two blank lines before every section header, one before an element header that follows a line of text."""
    lines = F.split(text, "\n")
    spaced = F.transform(
        lines,
        lambda x, i: F.when(x.rlike(r"(?i)^#+\s+Section\s+\d+"), F.concat(F.lit("\n\n"), x))
        .when(x.rlike(BOUNDARY_ELEMENT) & (i > 0) & (strip(F.get(lines, i - 1)) != ""), F.concat(F.lit("\n"), x))
        .otherwise(x),
    )
    return F.array_join(spaced, "\n")


def explode_chunks(df: DataFrame, chunks: Column, *, keep: list[str]) -> DataFrame:
    """(keep, chunk_index, chunk)."""
    return df.select(*keep, F.posexplode(chunks).alias("chunk_index", "chunk")).withColumn("chunk_index", F.col("chunk_index").cast("bigint"))


def _char_spans(text: str, size: int, overlap: int, *, parity: bool = False) -> list[tuple[int, int]]:
    """Spans of ``size`` characters that back off to the space in their last fifth and overlap truly.

    ``parity``: the next span begins where this one ends, or ``size - overlap`` on where that is later.
    """
    spans, start = [], 0
    while start < len(text):
        end = min(start + size, len(text))
        if end < len(text) and not text[end].isspace() and (space := text.rfind(" ", start + int(size * 0.8), end)) > start:
            end = space + 1
        spans.append((start, end))
        if end >= len(text):
            break
        start = max(start + size - overlap, end) if parity else max(end - overlap, start + 1)
    return spans


def _aware_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans that end at the first semantic boundary near their limit, else after the last space before it."""
    if len(text) <= size:
        return [(0, len(text))]
    bounds, spans, start = boundary_places(text), [], 0
    while start < len(text):
        end = min(start + size, len(text))
        low, high = start + max(size - overlap, size // 2), min(start + size + overlap, len(text))
        k = bisect.bisect_left(bounds, low)
        cut = bounds[k] if k < len(bounds) and bounds[k] <= high else end
        if cut == end and end < len(text) and (space := text.rfind(" ", low, end)) > start:
            cut = space + 1
        spans.append((start, cut))
        if cut >= len(text):
            break
        start = max(cut - overlap, start + 1)
    return spans


def _boundary_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans from boundary to boundary, each the first that makes ``size - overlap`` characters or more."""
    if len(text) <= size:
        return [(0, len(text))]
    spans, start, bounds = [], 0, [*boundary_places(text), len(text)]
    for at in bounds:
        if at - start >= size - overlap:
            if text[start:at].strip():
                spans.append((start, at))
                start = max(start + size - overlap, at)
        elif at == len(text):
            spans.append((start, at))
    return spans


def _token_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of ``size`` white-space tokens, the default where no tokenizer is plugged in."""
    tokens = [m.span() for m in re.finditer(r"\S+", text)]
    step = max(1, size - overlap)
    return [(tokens[k][0], tokens[min(k + size, len(tokens)) - 1][1]) for k in range(0, max(len(tokens) - overlap, 1), step)] if tokens else []


SPANS: dict[str, Callable] = {
    "character": _char_spans,
    "character_parity": lambda text, size, overlap: _char_spans(text, size, overlap, parity=True),
    "aware": _aware_spans,
    "boundaries": _boundary_spans,
    "token": _token_spans,
}


def by_spans(df: DataFrame, mode: str, *, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, chunk_index, chunk_start, chunk) of the splitters whose next start depends on the last end.

    ``mode`` is a name in :data:`SPANS`. Chunks are stripped, blank ones left out
    and the rest counted on; ``chunk_start`` is where the chunk's text begins.
    Texts go through in slices, so that a worker never holds more than a few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                rows, n, start, chunk = [], [], [], []
                for i, t in enumerate(b.column(1).slice(at, 64).to_pylist()):
                    k = 0
                    for s, e in SPANS[mode](t, size, overlap) if t else ():
                        if piece := t[s:e].strip():
                            rows.append(at + i), n.append(k), chunk.append(piece)
                            start.append(s + len(t[s:e]) - len(t[s:e].lstrip()))
                            k += 1
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int32())), pa.array(n, pa.int64()), pa.array(start, pa.int64()), pa.array(chunk, pa.string())], names=["k", "chunk_index", "chunk_start", "chunk"])

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, chunk_index bigint, chunk_start bigint, chunk string").withColumnRenamed("k", key)


def adjusted_spans(text: str, chunks: list[str], size: int, overlap: int) -> list[str]:
    """The chunks with their ends moved to the best boundary near them.

    Of the places between the shortest end and ``overlap`` behind the chunk: the
    first section, else the first element, else the first table that doesn't
    belong to the element before it (one within ``size``), else the first blank
    line. The last chunk, and one that isn't found in the text, stay.
    """
    if len(chunks) <= 1:
        return chunks
    first = lambda places, low, high: next((p for p in places[bisect.bisect_left(places, low) :][:1] if p <= high), None)
    sections, elements, tables = ([m.start() for m in p.finditer(text)] for p in _OWNERS)
    free = []
    for t in tables:
        k = bisect.bisect_left(elements, t)
        if not k or t - elements[k - 1] > size:
            free.append(t)
    out, at = [], 0
    for i, chunk in enumerate(chunks):
        start = text.find(chunk, at)
        if start < 0:
            out.append(chunk)
            continue
        end = cut = start + len(chunk)
        if i < len(chunks) - 1:
            low, high = start + max(size - overlap, size // 2), min(end + overlap, len(text))
            found = [first(p, low, high) for p in (sections, elements, free)]
            blank = _BLANK.search(text, low, high) if low < high else None
            cut = next((f for f in (*found, blank.start() if blank else None) if f), end)
        if cut > start and (piece := text[start:cut].strip()):
            out.append(piece)
            at = cut
        else:
            out.append(chunk.strip())
            at = end
    return [c for c in out if c.strip()]


_OWNERS = (re.compile(r"^#+\s+Section\s+\d+\s*[-–—]\s*(.+)", re.M | re.I), re.compile(r"^\*\*([^*\n]+)\*\*\s*:\s*(.+)", re.M), _TABLE)


def adjust_boundaries(df: DataFrame, chunks: str, *, key: str, text: str, size: int = 2000, overlap: int = 200) -> DataFrame:
    """(key, chunk_index, chunk): the chunks of each document's array ``chunks`` moved to better ends."""

    @F.pandas_udf("array<string>")
    def adjust(texts: pd.Series, arrays: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or a is None else adjusted_spans(t, [c for c in a if c is not None], size, overlap) for t, a in zip(texts, arrays)])

    return explode_chunks(df, adjust(F.col(text), F.col(chunks)), keep=[key])


def repair_order(df: DataFrame, chunks: str, *, key: str, text: str) -> DataFrame:
    """(key, chunk_index, chunk): the chunks of each document in the order of their first 100 characters in the text.

    One not found is looked up with its line ends as spaces, and comes last if
    that fails too, after the others in the order they had. Blank ones go.
    """
    flat = lambda c: F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("  "), F.lit(" "))
    whole = F.col(text)
    place = lambda x: F.coalesce(
        F.nullif(F.position(F.substring(strip(x), 1, 100), whole), F.lit(0)), F.nullif(F.position(flat(F.substring(strip(x), 1, 100)), flat(whole)), F.lit(0)), F.lit(2**31 - 1)
    )
    kept = F.filter(F.col(chunks), lambda x: strip(x) != "")
    placed = F.array_sort(F.transform(kept, lambda x, i: F.struct(place(x).alias("place"), i.alias("i"), x.alias("chunk"))))
    return explode_chunks(df, F.transform(placed, lambda x: x["chunk"]), keep=[key])


def split_documents(df: DataFrame, mode: str, *, key: str, text: str, size: int = 2000, overlap: int = 200) -> DataFrame:
    """The mode dispatcher: ``delimiter``, ``headless``, ``header``, ``size``, ``size_parity``, ``cascade`` or a name in :data:`SPANS`."""
    native = {"delimiter": by_delimiter, "headless": by_delimiter_headless, "header": by_header}
    c = F.col(text)
    if mode in native:
        return explode_chunks(df, native[mode](c), keep=[key])
    if mode in ("size", "size_parity"):
        return explode_chunks(df, by_size(c, size, overlap, parity=mode.endswith("parity")), keep=[key])
    if mode == "cascade":
        return explode_chunks(df, cascade(c, size, overlap)["chunks"], keep=[key])
    if mode in SPANS:
        return by_spans(df, mode, key=key, text=text, size=size, overlap=overlap).select(key, "chunk_index", "chunk")
    raise ValueError(f"unknown mode {mode}")


def structure_offsets(df: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, kind, ord, start, code, label) of sections, elements, table labels and table starts."""
    c = F.col(text)
    number = lambda t: F.nullif(F.regexp_extract(t, r"(?i)Section\s+(\d+)", 1), F.lit(""))
    kinds = {
        "section": (match_rows(c, SECTION, 1), lambda m: (number(m["text"]), F.substring(strip(m["g1"]), 1, 100))),
        "element": (match_rows(c, ELEMENT, 2), lambda m: (strip(m["g1"]), strip(m["g2"]))),
        "variables_table": (match_rows(c, VARIABLES), lambda m: (F.lit(None).cast("string"),) * 2),
        "columns_table": (match_rows(c, COLUMNS), lambda m: (F.lit(None).cast("string"),) * 2),
        "table": (match_rows(c, TABLE_START), lambda m: (F.lit(None).cast("string"),) * 2),
    }

    def rows_of(kind: str) -> Column:
        rows, names = kinds[kind]

        def row(m: Column) -> Column:
            code, label = names(m)
            return F.struct(F.lit(kind).alias("kind"), m["ord"].cast("bigint").alias("ord"), m["start"].cast("bigint").alias("start"), code.alias("code"), label.alias("label"))

        return F.transform(rows, row)

    return df.select(key, F.inline(F.concat(*map(rows_of, kinds))))  # the documents are read once for all kinds
