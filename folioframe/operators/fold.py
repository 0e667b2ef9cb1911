"""Folding chunks into surveys one after another, where what a chunk means depends on what is open.

Chunks come with their kind and the extraction of a provider. A document's chunks
go through one task in order, of which only the open section is held; documents run
apart. :class:`Assembly` is the state between two chunks.

What it does with a chunk, in this order:
    1. without an open section one is opened by default, unless the chunk starts one;
    2. the open element is closed where the chunk starts an element or a section, or
       where the element is complete, has a code and doesn't end incomplete;
    3. the open section is closed where the chunk starts one, or where it is complete
       likewise;
    4. the chunk goes to what its kind says: a new section or element, a further part
       of the open one (or one opened for it, by the last code known), a whole
       element, or the end of the section; an unknown chunk is a whole element where
       there is an extraction for it, else text of the section.
What is open after the last chunk is closed then.

Defined results: null chunks count as empty, an unknown kind as ``unknown``; an
extraction that isn't a JSON object counts as none; of lists only the entries are
taken whose code wasn't there before (repeats within one extraction stay); a scalar
that isn't null replaces the one before; missing codes and labels get defaults when
an element or a section is closed. A document without chunks has no sections.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HEADER = re.compile(r"#+\s+Section\s+\d+", re.I)
_MARK = re.compile(r"\*\*[^*]+\*\*:")
SCALARS = {"section": ("code", "label", "notes", "position"), "element": ("code", "label", "notes", "type", "position", "revision", "is_loop_target", "help_text")}
LISTS = {"section": ("elements",), "element": ("variables", "columns")}


def completes(chunk: str) -> tuple[bool, bool]:
    """(a section, an element): what a chunk's lines complete; without a header of either it completes an element."""
    lines = [x.strip() for x in chunk.split("\n")]
    section, element = any(map(_HEADER.match, lines)), any(map(_MARK.match, lines))
    return section, element or not section


class _Part:
    """A section or element that is being put together."""

    def __init__(self, what: str, text: str, **known) -> None:
        self.what, self.text = what, text
        self.is_complete = self.starts_incomplete = self.ends_incomplete = False
        self.fields: dict = {**dict.fromkeys(SCALARS[what]), **{f: [] for f in LISTS[what]}, **known}

    def take(self, found: dict | None) -> None:
        if not found:
            return
        how = found.get("_fragment_metadata") or {}
        self.starts_incomplete, self.ends_incomplete = bool(how.get("starts_incomplete")), bool(how.get("ends_incomplete"))
        for f in SCALARS[self.what]:
            if found.get(f) is not None:
                self.fields[f] = found[f]
        for f in LISTS[self.what]:
            known = {x.get("code") for x in self.fields[f]}
            self.fields[f] = self.fields[f] + [x for x in found.get(f) or [] if isinstance(x, dict) and x.get("code") not in known]

    @property
    def settled(self) -> bool:
        return self.is_complete and bool(self.fields["code"]) and not self.ends_incomplete


class Assembly:
    """The state of one document between two chunks."""

    def __init__(self) -> None:
        self.section: _Part | None = None
        self.element: _Part | None = None
        self.counts = {"section": 0, "element": 0}
        self.last = {"section": None, "element": None}
        self.done: list[dict] = []

    def feed(self, chunk: str, kind: str, found: dict | None) -> list[dict]:
        """The sections that this chunk closes."""
        starts = kind in ("element_start", "section_start")
        if self.section is None and kind != "section_start":
            self._open_section("", code=f"section_{self.counts['section'] + 1}", label="Default Section")
        if self.element and (starts or self.element.settled):
            self._close_element()
        if self.section and (kind == "section_start" or self.section.settled):
            self._close_section()
        whole_section, whole_element = completes(chunk)
        if kind == "section_start":
            self._open_section(chunk).take(found)
            self.section.is_complete |= whole_section
        elif kind == "section_continuation":
            self._grown_section(chunk).take(found)
            self.section.is_complete |= whole_section
        elif kind in ("element_start", "element_continuation"):
            part = self._open_element(chunk) if kind == "element_start" else self._grown_element(chunk)
            part.take(found)
            part.is_complete |= whole_element
        elif kind == "element_complete" or (kind == "unknown" and found):
            self._open_element(chunk).take(found)
            self._close_element()
        elif kind == "section_complete":
            self._close_section()
        elif kind == "unknown":
            self._grown_section(chunk)
        for what, part in (("section", self.section), ("element", self.element)):
            if part:
                self.last[what] = part.fields["code"]
        out, self.done = self.done, []
        return out

    def close(self) -> list[dict]:
        self._close_section()
        out, self.done = self.done, []
        return out

    def _open_section(self, text: str, **known) -> _Part:
        self.section = _Part("section", text, **known)
        self.counts["section"] += 1
        return self.section

    def _needed_section(self) -> _Part:
        return self.section or self._open_section("", code=self.last["section"] or f"section_{self.counts['section']}", label="Auto-created Section")

    def _grown_section(self, chunk: str) -> _Part:
        part = self._needed_section()
        part.text = f"{part.text}\n{chunk}" if part.text else chunk
        return part

    def _open_element(self, text: str, **known) -> _Part:
        self._needed_section()
        self.element = _Part("element", text, **known)
        self.counts["element"] += 1
        return self.element

    def _grown_element(self, chunk: str) -> _Part:
        if self.element is None:
            part = self._open_element(chunk, code=self.last["element"] or f"element_{self.counts['element']}")
            part.starts_incomplete = True
            return part
        self.element.text += "\n" + chunk
        return self.element

    def _close_element(self) -> None:
        place = len(self._needed_section().fields["elements"]) + 1
        f = self.element.fields
        defaults = {"code": f"element_{place}", "label": "Untitled Element", "type": "CHOICE", "position": place}
        self.section.fields["elements"] = [*self.section.fields["elements"], {**f, **{k: v for k, v in defaults.items() if f.get(k) in (None, "")}}]
        self.element = None

    def _close_section(self) -> None:
        if self.section is None:
            return
        if self.element:
            self._close_element()
        f = self.section.fields
        defaults = {"code": f"section_{self.counts['section']}", "label": "Untitled Section"}
        self.done.append({**f, **{k: v for k, v in defaults.items() if f.get(k) in (None, "")}, "chars": len(self.section.text)})
        self.section = None


_PART = pa.struct([("code", pa.string()), ("label", pa.string()), ("notes", pa.string()), ("position", pa.int32())])
_ELEMENT = pa.struct([("code", pa.string()), ("label", pa.string()), ("notes", pa.string()), ("type", pa.string()), ("position", pa.int32()), ("help_text", pa.string()), ("variables", pa.list_(_PART)), ("columns", pa.list_(_PART))])
_PART_SQL = "struct<code:string,label:string,notes:string,position:int>"
SECTIONS = f"section_no bigint, code string, label string, notes string, position int, elements array<struct<code:string,label:string,notes:string,type:string,position:int,help_text:string,variables:array<{_PART_SQL}>,columns:array<{_PART_SQL}>>>"


def _whole(x) -> int | None:
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _typed(value: dict, kind: pa.StructType) -> dict:
    out = {}
    for f in kind:
        v = value.get(f.name)
        if pa.types.is_list(f.type):
            out[f.name] = [_typed(x, f.type.value_type) for x in v or [] if isinstance(x, dict)]
        else:
            out[f.name] = _whole(v) if pa.types.is_integer(f.type) else None if v is None else str(v)
    return out


def parsed(text: str | None) -> dict | None:
    try:
        found = json.loads(text) if text else None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def fold_sections(chunks: DataFrame, *, doc: str = "doc_id", chunk: str = "chunk", kind: str = "kind", extracted: str = "extracted") -> DataFrame:
    """(doc, section_no, code, label, notes, position, elements): the sections of each document in the order they are closed.

    ``extracted`` is the extraction of each chunk as JSON text.
    """
    rows = chunks.select(F.col(doc).alias("d"), F.col("chunk_index").alias("i"), F.coalesce(chunk, F.lit("")).alias("c"), F.lower(F.coalesce(kind, F.lit("unknown"))).alias("k"), F.col(extracted).alias("e"))
    key = rows.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_of, state, number, kept = (), None, 0, None
        for b in batches:
            kept = b.schema
            out: list[tuple] = []
            for d, _, c, k, e in zip(*(col.to_pylist() for col in b.columns)):
                if (d,) != doc_of:
                    if state:
                        out += [(doc_of[0], number + n, s) for n, s in enumerate(state.close())]
                    doc_of, state, number = (d,), Assembly(), 0
                closed = state.feed(c, k, parsed(e))
                out += [(d, number + n, s) for n, s in enumerate(closed)]
                number += len(closed)
            if out:
                yield _sections(out, kept.field("d").type)
        if state and (out := [(doc_of[0], number + n, s) for n, s in enumerate(state.close())]):
            yield _sections(out, kept.field("d").type)

    ordered = rows.repartition("d").sortWithinPartitions("d", "i")
    return ordered.mapInArrow(run, f"d {key}, {SECTIONS}").withColumnRenamed("d", doc)


def _sections(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    typed = [_typed(s, pa.struct([("code", pa.string()), ("label", pa.string()), ("notes", pa.string()), ("position", pa.int32()), ("elements", pa.list_(_ELEMENT))])) for _, _, s in rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for d, _, _ in rows], key),
            pa.array([n for _, n, _ in rows], pa.int64()),
            *(pa.array([t[c] for t in typed], pa.string()) for c in ("code", "label", "notes")),
            pa.array([t["position"] for t in typed], pa.int32()),
            pa.array([t["elements"] for t in typed], pa.list_(_ELEMENT)),
        ],
        names=["d", "section_no", "code", "label", "notes", "position", "elements"],
    )


def accumulated(results: DataFrame, *, doc: str, order: list[str], content: Column, partial: Column, goes_on: Column, error: Column) -> DataFrame:
    """The chunks without an error, with the kind of the one before and the text accumulated after each.

    A chunk that goes on adds its content in a new line; another one leaves its
    partial content, or nothing. A chunk with an error changes nothing.
    """
    rows = results.filter(error.isNull() | (error == ""))
    on = F.coalesce(goes_on, F.lit(False))
    so_far = Window.partitionBy(doc).orderBy(*order)
    rows = rows.withColumn("run", F.sum(F.when(on, 0).otherwise(1)).over(so_far)).withColumn("piece", F.when(on, F.coalesce(content, F.lit(""))).otherwise(F.coalesce(partial, F.lit(""))))
    within = Window.partitionBy(doc, "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # a run without a chunk that begins it follows nothing, an empty text
    text = F.when(F.col("run") == 0, F.concat(F.lit("\n"), F.array_join(F.collect_list("piece").over(within), "\n"))).otherwise(F.array_join(F.collect_list("piece").over(within), "\n"))
    return rows.withColumn("accumulated", text).withColumn("previous_type", F.lag("chunk_type").over(so_far)).drop("run", "piece")


def tree_counts(sections: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """(doc, sections, elements, variables, columns) of assembled sections."""
    e = F.coalesce("elements", F.array().cast(sections.schema["elements"].dataType))
    total = lambda f: F.aggregate(e, F.lit(0), lambda n, x: n + F.coalesce(F.array_size(x[f]), F.lit(0)))
    return sections.groupBy(doc).agg(F.count("*").alias("sections"), F.sum(F.size(e)).alias("elements"), F.sum(total("variables")).cast("bigint").alias("variables"), F.sum(total("columns")).cast("bigint").alias("columns"))
