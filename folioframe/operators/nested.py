"""Deeply nested records to flat tables with parent-child links.

One SQL projection per target table: nested ``transform`` calls attach the
ancestor keys and the places in the stored arrays, ``flatten`` joins the inner
arrays, and a single ``inline`` emits the rows. No shuffle is needed except the
one that removes redelivered copies of a whole record.

Defined results
    * a null record key is kept as a null key;
    * a null or absent array is an empty array, a null entry is no row but keeps
      its place, so the places of its neighbours don't change;
    * redelivered rows (same key) give their rows once, the latest ``order`` wins;
    * in JSON text a bare object counts as an array of one, text that isn't valid
      JSON gives no row; an empty table gives empty tables;
    * further columns of the input, whatever their names, don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("element", "element_tag", "variable", "variable_tag", "column", "column_tag")
#: fields of a record of each kind, in the flat tables
FIELDS = {
    "element": ("code", "label", "notes", "type", "position", "revision", "is_loop_target", "help_text", "is_complete", "ends_incomplete"),
    "variable": ("code", "label", "notes", "position", "revision"),
    "column": ("code", "label", "notes", "position"),
    "tag": ("key", "value"),
}


def _one_per_key(df: DataFrame, key: str, order: str | None) -> DataFrame:
    """The latest row of each key; rows without a key all stay."""
    latest = F.struct(order) if order else F.struct(F.lit(0))  # a struct is never null, so neither is a row lost
    rows = df.select(F.col(key).alias("record_id"), F.struct(*[c for c in df.columns if c != key]).alias("payload"), latest.alias("latest"))
    newest = F.max_by("payload", "latest")
    keyed = rows.filter("record_id is not null").groupBy("record_id").agg(newest.alias("payload"))
    return keyed.unionByName(rows.filter("record_id is null").select("record_id", "payload"))


def _struct_fields(alias: str, names: tuple[str, ...], have: set[str]) -> str:
    return ", ".join(f"'{n}', {alias}.{n}" if n in have else f"'{n}', cast(null as string)" for n in names)


def _child_sql(kind: str, fields: bool, schema: dict[str, set[str]]) -> str:
    """SQL of the array of rows of one target table, from the array column ``elements``."""
    none = "cast(-1 as bigint)"
    get = lambda alias, what: (", " + _struct_fields(alias, FIELDS[what], schema[what])) if fields else ""
    row = lambda e, c, t, extra: f"named_struct('element_no', {e}, 'child_no', {c}, 'tag_no', {t}{extra})"
    if kind == "element":
        inner = f"transform(coalesce(elements, array()), (x, i) -> if(x is null, null, {row('cast(i as bigint)', none, none, get('x', 'element'))}))"
        return f"filter({inner}, r -> r is not null)"
    if kind == "element_tag":
        tags = f"transform(coalesce(x.tags, array()), (t, k) -> if(t is null, null, {row('cast(i as bigint)', none, 'cast(k as bigint)', get('t', 'tag'))}))"
        return f"filter(flatten(transform(coalesce(elements, array()), (x, i) -> if(x is null, array(), {tags}))), r -> r is not null)"
    child = kind.split("_")[0]
    if not kind.endswith("_tag"):
        rows = f"transform(coalesce(x.{child}s, array()), (c, j) -> if(c is null, null, {row('cast(i as bigint)', 'cast(j as bigint)', none, get('c', child))}))"
        return f"filter(flatten(transform(coalesce(elements, array()), (x, i) -> if(x is null, array(), {rows}))), r -> r is not null)"
    tags = f"transform(coalesce(c.tags, array()), (t, k) -> if(t is null, null, {row('cast(i as bigint)', 'cast(j as bigint)', 'cast(k as bigint)', get('t', 'tag'))}))"
    rows = f"flatten(transform(coalesce(x.{child}s, array()), (c, j) -> if(c is null, array(), {tags})))"
    return f"filter(flatten(transform(coalesce(elements, array()), (x, i) -> if(x is null, array(), {rows}))), r -> r is not null)"


def _names(df: DataFrame) -> dict[str, set[str]]:
    element = df.schema["elements"].dataType.elementType
    of = lambda f: set(element[f].dataType.elementType.fieldNames())
    return {"element": set(element.fieldNames()), "variable": of("variables"), "column": of("columns"), "tag": of("tags")}


def flatten_sections(df: DataFrame, *, key: str = "section_id", order: str | None = "loaded_at", fields: bool = True) -> dict[str, DataFrame]:
    """The six flat tables of sections with nested elements, by kind.

    Every table has ``record_id, element_no, child_no, tag_no`` (places from 0,
    -1 where they don't apply) and, with ``fields``, the record's own columns. A
    row's parent is the row of the same record whose places agree up to its own
    level. Rows of a kind come from one scan and one ``inline``.
    """
    return flat_tables(section_elements(df, key=key, order=order), fields=fields)


def section_elements(df: DataFrame, *, key: str = "section_id", order: str | None = "loaded_at") -> DataFrame:
    """(record_id, elements), one row for each section."""
    order = order if order in df.columns else None
    df = df.select(key, *([order] if order else []), "elements")
    return _one_per_key(df, key, order).select("record_id", F.col("payload.elements").alias("elements"))


def flat_tables(one: DataFrame, *, fields: bool = True) -> dict[str, DataFrame]:
    """The six flat tables of (record_id, elements)."""
    names = _names(one)
    return {kind: one.selectExpr("record_id", f"inline({_child_sql(kind, fields, names)})") for kind in KINDS}


def nested_places(tables: dict[str, DataFrame], source_table: str) -> DataFrame:
    """The rows of all flat tables as (source_table, record_id, node_kind, element_no, child_no, tag_no)."""
    out = None
    for kind, t in tables.items():
        part = t.select(F.lit(source_table).alias("source_table"), "record_id", F.lit(kind).alias("node_kind"), "element_no", "child_no", "tag_no")
        out = part if out is None else out.unionByName(part)
    return out


def _as_array(v: Column, path: str) -> Column:
    """The array at ``path`` of a variant: itself, a bare object as an array of one, else null."""
    got = F.try_variant_get(v, path, "variant")
    kind = F.schema_of_variant(got)
    return (
        F.when(got.isNull() | F.is_variant_null(got), None)
        .when(kind.startswith("ARRAY<"), F.try_variant_get(v, path, "array<variant>"))
        .when(kind.startswith("OBJECT<"), F.array(got))
    )


def _text(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string").alias(name)


def _entries(array: Column, build) -> Column:
    return F.transform(array, lambda e: F.when(e.isNotNull() & ~F.is_variant_null(e), build(e)))


def parse_payloads(df: DataFrame, *, key: str = "checkpoint_id", kind: str = "cp_type", payload: str = "payload", order: str | None = "saved_at") -> DataFrame:
    """(record_id, elements) of checkpoint records with JSON text.

    A section is under ``section_data`` or ``current_section``, an element under
    ``element_data`` and is then element 0 of its record. Every value comes out
    as text, since codes may be text or numbers.
    """
    rows = df.select(F.col(key).alias("k"), F.col(kind).alias("cp"), F.try_parse_json(F.col(payload)).alias("v"), *([F.col(order).alias("latest")] if order else []))
    rows = rows.filter(F.col("v").isNotNull())
    v = F.col("v")
    elements = (
        F.when(F.col("cp") == "section", _as_array(v, "$.section_data.elements"))
        .when(F.col("cp") == "partial_state", _as_array(v, "$.current_section.elements"))
        .when(F.col("cp") == "element", _as_array(v, "$.element_data"))
    )
    tag = lambda t: F.struct(*[_text(t, n) for n in FIELDS["tag"]])
    child = lambda what: lambda c: F.struct(*[_text(c, n) for n in FIELDS[what]], _entries(_as_array(c, "$.tags"), tag).alias("tags"))
    element = lambda e: F.struct(
        *[_text(e, n) for n in FIELDS["element"]],
        _entries(_as_array(e, "$.tags"), tag).alias("tags"),
        _entries(_as_array(e, "$.variables"), child("variable")).alias("variables"),
        _entries(_as_array(e, "$.columns"), child("column")).alias("columns"),
    )
    typed = rows.select("k", *(["latest"] if order else []), _entries(elements, element).alias("elements"))
    return _one_per_key(typed, "k", "latest" if order else None).select("record_id", F.col("payload.elements").alias("elements"))


def flatten_payloads(df: DataFrame, *, fields: bool = True, **columns) -> dict[str, DataFrame]:
    """The six flat tables of checkpoint records with JSON text, as :func:`flatten_sections` has them."""
    return flat_tables(parse_payloads(df, **columns), fields=fields)
