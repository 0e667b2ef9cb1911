"""Queries over deeply nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.operators import nested
from folioframe.session import cut_lineage, table


def _tables(spark: SparkSession, d: str, fields: bool = True) -> dict[str, dict[str, DataFrame]]:
    return {
        "partial_sections": nested.flatten_sections(table(spark, d, "partial_sections"), fields=fields),
        "section_checkpoints": nested.flatten_payloads(table(spark, d, "section_checkpoints"), fields=fields),
    }


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    # the deduplicated records and the parsed JSON are made once, for all six tables
    sections = cut_lineage(nested.section_elements(table(spark, d, "partial_sections")))
    payloads = cut_lineage(nested.parse_payloads(table(spark, d, "section_checkpoints")))
    parts = [nested.nested_places(nested.flat_tables(one, fields=False), name) for name, one in (("partial_sections", sections), ("section_checkpoints", payloads))]
    return parts[0].unionByName(parts[1])


def p3_variables(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["partial_sections"]["variable"].selectExpr("record_id as section_id", "element_no", "child_no", "code", "label", "notes", "cast(position as bigint) as position")


def p3_element_tags(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["partial_sections"]["element_tag"].selectExpr("record_id as section_id", "element_no", "tag_no", "key", "value")


QUERIES = {f.__name__: f for f in (p3_found, p3_variables, p3_element_tags)}

_ONE = "(select section_id, any_value(elements) as elements from partial_sections group by section_id)"
_ELEMENTS = f"(select section_id as id, unnest(elements) as e, generate_subscripts(elements, 1) - 1 as i from {_ONE})"


def _sql_level(source: str, kind: str) -> str:
    """SQL of one level of (id, e, i) rows."""
    head = f"select '{source}' as source_table, id as record_id, '{kind}' as node_kind, cast(i as bigint) as element_no, "
    if kind == "element":
        return head + "cast(-1 as bigint) as child_no, cast(-1 as bigint) as tag_no from els"
    if kind == "element_tag":
        return head + "cast(-1 as bigint) as child_no, cast(k as bigint) as tag_no from (select id, i, unnest(e.tags) as t, generate_subscripts(e.tags, 1) - 1 as k from els) where t is not null"
    child = kind.split("_")[0]
    rows = f"(select id, i, unnest(e.{child}s) as c, generate_subscripts(e.{child}s, 1) - 1 as j from els)"
    if not kind.endswith("_tag"):
        return head + f"cast(j as bigint) as child_no, cast(-1 as bigint) as tag_no from {rows} where c is not null"
    return head + f"cast(j as bigint) as child_no, cast(k as bigint) as tag_no from (select id, i, j, unnest(c.tags) as t, generate_subscripts(c.tags, 1) - 1 as k from {rows} where c is not null) where t is not null"


_JSON_ARRAY = "case when json_type({0}) = 'ARRAY' then cast({0} as json[]) when json_type({0}) = 'OBJECT' then [{0}] end"


def _json_level(kind: str) -> str:
    arr = lambda of, name: _JSON_ARRAY.format(f"json_extract({of}, '$.{name}')")
    ok = lambda v: f"{v} is not null and json_type({v}) <> 'NULL'"
    head = f"select 'section_checkpoints' as source_table, id as record_id, '{kind}' as node_kind, cast(i as bigint) as element_no, "
    if kind == "element":
        return head + "cast(-1 as bigint) as child_no, cast(-1 as bigint) as tag_no from jels"
    if kind == "element_tag":
        return head + f"cast(-1 as bigint) as child_no, cast(k as bigint) as tag_no from (select id, i, unnest(a) as t, generate_subscripts(a, 1) - 1 as k from (select id, i, {arr('e', 'tags')} as a from jels)) where {ok('t')}"
    child = kind.split("_")[0]
    rows = f"(select id, i, unnest(a) as c, generate_subscripts(a, 1) - 1 as j from (select id, i, {arr('e', child + 's')} as a from jels))"
    if not kind.endswith("_tag"):
        return head + f"cast(j as bigint) as child_no, cast(-1 as bigint) as tag_no from {rows} where {ok('c')}"
    return head + f"cast(j as bigint) as child_no, cast(k as bigint) as tag_no from (select id, i, j, unnest(a) as t, generate_subscripts(a, 1) - 1 as k from (select id, i, j, {arr('c', 'tags')} as a from {rows} where {ok('c')})) where {ok('t')}"


_PAYLOAD = """case cp_type when 'section' then json_extract(payload, '$.section_data.elements')
  when 'partial_state' then json_extract(payload, '$.current_section.elements')
  when 'element' then json_extract(payload, '$.element_data') end"""
_KINDS = ("element", "element_tag", "variable", "variable_tag", "column", "column_tag")

SQL = {
    "p3_found": f"""
with els as (select * from {_ELEMENTS} where e is not null),
jarr as (select checkpoint_id as id, {_JSON_ARRAY.format('x')} as a from (
    select checkpoint_id, {_PAYLOAD} as x from (select * from section_checkpoints where json_valid(payload)))),
jels as (select id, e, i from (select id, unnest(a) as e, generate_subscripts(a, 1) - 1 as i from jarr) where e is not null and json_type(e) <> 'NULL')
"""
    + " union all ".join([_sql_level("partial_sections", k) for k in _KINDS] + [_json_level(k) for k in _KINDS]),
    "p3_variables": f"""
select id as section_id, cast(i as bigint) as element_no, cast(j as bigint) as child_no, c.code as code, c.label as label, c.notes as notes, cast(c.position as bigint) as position
from (select id, i, unnest(e.variables) as c, generate_subscripts(e.variables, 1) - 1 as j from {_ELEMENTS} where e is not null) where c is not null""",
    "p3_element_tags": f"""
select id as section_id, cast(i as bigint) as element_no, cast(k as bigint) as tag_no, t.key as key, t.value as value
from (select id, i, unnest(e.tags) as t, generate_subscripts(e.tags, 1) - 1 as k from {_ELEMENTS} where e is not null) where t is not null""",
}
