"""Queries over questionnaires and other documents: splitting, structure, extraction, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.functions import text as T
from folioframe.operators import assemble, chunking, extract, metrics, prompts, structure, validate
from folioframe.plans import sql_parts as P
from folioframe.session import table
from folioframe.sources import sinks


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.explode_chunks(_docs(spark, d), chunking.by_delimiter(F.col("text")), keep=["doc_id"])


def delimiter_chunks(spark, d):
    return _chunks(spark, d)


def delimiter_chunks_headerless(spark, d):
    return chunking.split_documents(_docs(spark, d), "headless", key="doc_id", text="text")


def header_chunks(spark, d):
    return chunking.split_documents(_docs(spark, d), "header", key="doc_id", text="text")


def size_chunks(spark, d):
    return chunking.split_documents(_docs(spark, d), "size", key="doc_id", text="text")


def boundary_chunks(spark, d):
    return chunking.split_documents(_docs(spark, d), "boundaries", key="doc_id", text="text")


def size_chunks_parity(spark, d):
    return chunking.split_documents(_docs(spark, d), "size_parity", key="doc_id", text="text")


def adjusted_chunks(spark, d):
    """The character chunks of each document with their ends moved to structures near them."""
    docs = _docs(spark, d)
    chunks = chunking.split_documents(docs, "character", key="doc_id", text="text")
    arrays = chunks.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk"))), lambda x: x["chunk"]).alias("chunks"))
    return chunking.adjust_boundaries(docs.join(arrays, "doc_id"), "chunks", key="doc_id", text="text")


def order_repair(spark, d):
    """The delimiter chunks of each document, reversed and put in order again."""
    docs = _docs(spark, d).select("doc_id", "text", F.reverse(chunking.by_delimiter(F.col("text"))).alias("chunks"))
    return chunking.repair_order(docs, "chunks", key="doc_id", text="text")


def preprocessed(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(chunking.preprocess(F.col("text"))).alias("digest"))


def refined_analysis(spark, d):
    return structure.refined_analysis(_chunks(spark, d))


def content_markers(spark, d):
    """The marker of each chunk, the markers found again behind it, and the chunk without them."""
    rows = _chunks(spark, d).withColumn("marked", structure.with_marker(F.col("chunk")))
    return rows.select("doc_id", "chunk_index", structure.content_marker(F.col("chunk")).alias("marker"), F.array_join(structure.found_markers(F.col("marked")), ";").alias("found"), F.md5(structure.without_markers(F.col("marked"))).alias("bare"))


def chunk_debug_stats(spark, d):
    """How many chunks of each document have a section, an element, a table or a continuation marker."""
    return metrics.debug_stats(_chunks(spark, d), ["doc_id"])


def char_chunks_parity(spark, d):
    return chunking.by_spans(_docs(spark, d), "character_parity", key="doc_id", text="text", size=2000, overlap=200)


def char_chunks(spark, d):
    return chunking.by_spans(_docs(spark, d), "character", key="doc_id", text="text", size=2000, overlap=200)


def aware_chunks(spark, d):
    return chunking.by_spans(_docs(spark, d), "aware", key="doc_id", text="text", size=2000, overlap=200)


def token_chunks(spark, d):
    """The words of each token chunk."""
    rows = chunking.by_spans(_docs(spark, d), "token", key="doc_id", text="text", size=256, overlap=32)
    return rows.select("doc_id", "chunk_index", F.md5(F.array_join(T.words(F.col("chunk")), " ")).alias("digest"))


def chunk_strategy(spark, d):
    """Which step of the cascade splits each document."""
    return _docs(spark, d).select("doc_id", chunking.cascade(F.col("text"))["strategy"].alias("strategy"))


def semantic_boundaries(spark, d):
    return _docs(spark, d).select("doc_id", F.explode(chunking.boundaries(F.col("text")).cast("array<bigint>")).alias("place"))


def chunk_details(spark, d):
    return structure.chunk_details(_chunks(spark, d))


def structure_offsets(spark, d):
    return chunking.structure_offsets(_docs(spark, d), key="doc_id", text="text")


def ordered_reassembly(spark, d):
    """Whether the chunks, put together again with the delimiter, hold all of the text but white space."""
    docs = _docs(spark, d)
    whole = chunking.explode_chunks(docs, F.split("text", chunking.DELIMITER, -1), keep=["doc_id"])
    rebuilt = metrics.reassemble(whole, ["doc_id"], separator="\\*\\*\\*")
    return metrics.round_trip(docs, rebuilt, key="doc_id", text="text")


def structure_map(spark, d):
    cols = ["doc_id", "chunk_index", "size", "lines", "has_section_header", "section_title", "section_position", "elements_count", "has_value_table", "has_variable_table", "table_row_count", "has_table", "chunk_type", "priority"]
    return structure.structure_map(_chunks(spark, d)).select(*cols)


def element_positions(spark, d):
    return structure.element_positions(_chunks(spark, d)).select("doc_id", "chunk_index", "code", "type", "section_seq", "global_position", "section_relative_position", "start_char", "end_char")


def next_element_hint(spark, d):
    return structure.structure_map(_chunks(spark, d)).select("doc_id", "chunk_index", "next_section_element_position")


def chunk_footer(spark, d):
    return structure.footer(structure.structure_map(_chunks(spark, d))).select("doc_id", "chunk_index", "footer")


def simple_analysis(spark, d):
    return _chunks(spark, d).select("doc_id", "chunk_index", structure.simple_analysis(F.col("chunk")).alias("a")).select("doc_id", "chunk_index", "a.kind", "a.confidence")


def fallback_analysis(spark, d):
    return structure.fallback_analysis(_chunks(spark, d))


def fragment_flags(spark, d):
    return structure.fragment_flags(_chunks(spark, d))


def completion_flags(spark, d):
    return structure.completion_flags(_chunks(spark, d))


def context_buffer(spark, d):
    return structure.context_buffer(_chunks(spark, d), size=40).select("doc_id", "chunk_index", "context")


def carried_codes(spark, d):
    return structure.carried_codes(_chunks(spark, d))


def _spans(spark, d):
    parts = chunking.explode_chunks(_docs(spark, d), F.split("text", chunking.DELIMITER, -1), keep=["doc_id"])
    sized = metrics.running_offsets(parts, by=["doc_id"], order=["chunk_index"], size=F.length("chunk") + 6)
    return sized.select("doc_id", "chunk_index", F.col("offset").alias("chunk_start"), (F.col("offset") + F.length("chunk") + 6).alias("chunk_end"))


def structure_range_join(spark, d):
    return structure.structures_in_chunks(structure_offsets(spark, d), _spans(spark, d)).select("doc_id", "kind", "ord", "start", "chunk_index")


def preceding_element_asof(spark, d):
    return structure.preceding_element(structure_offsets(spark, d))


def split_stats(spark, d):
    docs = _docs(spark, d).select("doc_id", "source")
    return metrics.split_stats(_chunks(spark, d).join(docs, "doc_id"), ["source"])


def split_summary(spark, d):
    return sinks.summary_text(split_stats(spark, d))


def validate_stats(spark, d):
    return metrics.validate_stats(_docs(spark, d), key="doc_id", text="text", chunks=chunking.by_delimiter(F.col("text")))


def conversion_stats(spark, d):
    rows = table(spark, d, "conversion_results").dropDuplicates(["conversion_id"]).filter("markdown_content is not null")
    return metrics.conversion_stats(rows, key="conversion_id", text="markdown_content")


def md_blank_collapse(spark, d):
    from folioframe.operators.html import collapse_markdown

    return _docs(spark, d).select("doc_id", F.md5(collapse_markdown(F.col("text"))).alias("digest"))


def strip_tags_text(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.plain_text(F.col("text"))).alias("digest"))


def _lines(spark, d):
    return _chunks(spark, d).select("doc_id", "chunk_index", F.posexplode(F.split("chunk", "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("bigint"))


def table_label_carry(spark, d):
    """Each first line of a table with the label line before it; a label serves one table."""
    line = T.strip(F.col("line"))
    order = Window.partitionBy("doc_id", "chunk_index").orderBy("line_no")
    rows = _lines(spark, d).select("doc_id", "chunk_index", "line_no", F.upper(F.regexp_extract(line, r"(?i)^\*\*((?:VARIABLES?|COLUMNS?) TABLE)\*\*$", 1)).alias("label"), F.startswith(line, F.lit("|")).alias("row"))
    rows = rows.withColumn("first", F.col("row") & ~F.coalesce(F.lag("row").over(order), F.lit(False)))
    mark = F.when(F.col("label") != "", F.col("label")).when(F.col("first"), F.lit("used"))
    near = F.last(mark, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("near", near).filter("first")
    return rows.select("doc_id", "chunk_index", "line_no", F.when(F.coalesce("near", F.lit("used")) == "used", "OTHER TABLE").otherwise(F.col("near")).alias("label"))


def variable_rows(spark, d):
    rows = _chunks(spark, d).select("doc_id", "chunk_index", F.explode(extract.table_rows(F.col("chunk"))).alias("v"))
    return rows.select("doc_id", "chunk_index", "v.code", "v.label", "v.notes", F.col("v.position").cast("bigint").alias("position"))


def _results(spark, d):
    return extract.rule_extract(_chunks(spark, d))


def extracted_elements(spark, d):
    rows = assemble.elements(_results(spark, d))
    return rows.select("doc_id", "section_seq", "chunk_index", F.col("ord").cast("bigint").alias("ord"), "element.code", "element.type", "element.label", F.size("element.variables").cast("bigint").alias("variables"), F.size("element.columns").cast("bigint").alias("columns"))


def section_fold(spark, d):
    return assemble.sections(_results(spark, d)).select("doc_id", "section_seq", "code", "label", "position")


def assembly_warnings(spark, d):
    return assemble.warnings(assemble.elements(_results(spark, d)))


def survey_json(spark, d):
    return assemble.survey_json(_results(spark, d))


def token_estimate(spark, d):
    return _docs(spark, d).select("doc_id", extract.token_estimate(F.col("text")).alias("tokens"))


def prompt_render(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.render("Kind: [[kind]]\n[[text]]\nEnd.", {"kind": F.col("doc_kind"), "text": F.col("text")})).alias("digest"))


def preview_topn(spark, d):
    """The first three chunks of each document."""
    w = Window.partitionBy("doc_id").orderBy("chunk_index")
    return _chunks(spark, d).withColumn("rn", F.row_number().over(w)).filter("rn <= 3").select("doc_id", "chunk_index", F.substring("chunk", 1, 60).alias("preview"))


def structure_map_files(spark, d):
    rows = sinks.structure_map_json(structure.structure_map(_chunks(spark, d)))
    v = F.from_json("structure_map", "total_chunks bigint, chunks_info array<struct<chunk_index:bigint,elements_count:bigint,chunk_type:string>>")
    return rows.select("doc_id", v.alias("v")).select("doc_id", "v.total_chunks", F.aggregate("v.chunks_info", F.lit(0).cast("bigint"), lambda n, x: n + x["elements_count"]).alias("elements"), F.array_join(F.transform("v.chunks_info", lambda x: x["chunk_type"]), ";").alias("kinds"))


def extraction_prompts(spark, d):
    """The schema asked for and the length of the user message of each chunk."""
    return prompts.extraction_prompts(_chunks(spark, d)).select("doc_id", "chunk_index", "schema", F.length(F.col("messages")[1]["content"]).cast("bigint").alias("chars"))


def debug_files(spark, d):
    return sinks.debug_dump(_chunks(spark, d)).select("doc_id", "filename", F.md5("text").alias("digest"))


def running_offsets(spark, d):
    return _spans(spark, d)


def json_errors(spark, d):
    rows = table(spark, d, "section_checkpoints").filter("payload is not null")
    return rows.select("checkpoint_id", validate.is_json(F.col("payload")).alias("valid"))


def combine_sections(spark, d):
    """All sections of files that hold some, as JSON text with and without fences."""
    n = table(spark, d, "nation")
    good = F.concat(F.lit('```json\n{"sections": [{"code": "'), "n_name", F.lit('"}, {"code": "'), F.col("n_nationkey"), F.lit('"}]}\n```'))
    text = F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit('{"sections": ['), "n_name")).when(F.col("n_nationkey") % 5 == 1, F.lit('{"other": 1}')).otherwise(good)
    rows = validate.combine_sections(n.select("n_nationkey", text.alias("t")), key="n_nationkey", text="t")
    return rows.select("n_nationkey", F.col("ord").cast("bigint").alias("ord"), F.try_variant_get("section", "$.code", "string").alias("code"))


def schema_validation(spark, d):
    schema = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "enum": list(range(50))}}}
    rows = validate.validate_json(table(spark, d, "events"), schema, key="event_id", text="props")
    return rows.select("event_id", "path")


_NAMES = (
    delimiter_chunks, delimiter_chunks_headerless, header_chunks, size_chunks, boundary_chunks, size_chunks_parity, char_chunks, char_chunks_parity, aware_chunks, token_chunks, adjusted_chunks, order_repair, preprocessed, refined_analysis, content_markers, chunk_debug_stats, chunk_strategy, semantic_boundaries,
    chunk_details, structure_offsets, ordered_reassembly, structure_map, element_positions, next_element_hint, chunk_footer, simple_analysis, fallback_analysis, fragment_flags,
    completion_flags, context_buffer, carried_codes, structure_range_join, preceding_element_asof, split_stats, split_summary, validate_stats, conversion_stats, md_blank_collapse,
    strip_tags_text, table_label_carry, variable_rows, extracted_elements, section_fold, assembly_warnings, survey_json, token_estimate, prompt_render, preview_topn,
    structure_map_files, debug_files, extraction_prompts, running_offsets, json_errors, combine_sections, schema_validation,
)
QUERIES = {f.__name__: f for f in _NAMES}

_C = f"with chunks as (select * from {P.CHUNKS}) "
_EL = r"\*\*([^*]+)\*\*\s*(?:\[([^\]]+)\])?:"
_MARKS = rf"""
marks as (select doc_id, chunk_index, chunk, cast(length(chunk) as bigint) as size, cast(length(chunk) - length(replace(chunk, chr(10), '')) + 1 as bigint) as lines,
  regexp_matches(chunk, '(?m)^# (.+)$') as has_section_header, nullif({P.strip("regexp_extract(chunk, '(?m)^# (.+)$', 1)")}, '') as section_title,
  {P.count('chunk', _EL)} as elements_count,
  regexp_matches(chunk, '(?i)\|\s*(?:Value\s*)?Code\s*\|\s*(?:Value\s*)?Label') as has_value_table, regexp_matches(chunk, '(?i)\|\s*Variable\s*Name\s*\|\s*Variable\s*Label') as has_variable_table,
  {P.count('chunk', r'(?m)^\s*\|.*\|.*\|')} as table_row_count, contains(chunk, '|') as has_table from chunks),
seq as (select *, cast(sum(has_section_header::bigint) over (partition by doc_id order by chunk_index) as bigint) as section_seq from marks),
smap as (select *, cast(sum(elements_count) over (partition by doc_id, section_seq order by chunk_index) + 1 as bigint) as next_section_element_position,
  case when has_section_header then section_seq end as section_position,
  case when has_section_header and elements_count > 0 then 'section_with_elements' when has_section_header then 'section_header_only' when elements_count > 0 then 'elements_only' when has_value_table or has_variable_table then 'table_content' else 'content_fragment' end as chunk_type,
  case when has_section_header or elements_count > 0 then 'high' when table_row_count > 0 then 'medium' else 'low' end as priority from seq)
"""
_M = f"with chunks as (select * from {P.CHUNKS}), {_MARKS} "
_DOCS = "(select doc_id, text from documents where text is not null)"
_KINDS = {
    "section": (r"(?m)(?i)^#+\s+Section\s+\d+\s*[-–—]\s*(.+)", 1, "nullif(regexp_extract(m, '(?i)Section\\s+(\\d+)', 1), '')", f"substring({P.strip('g1')}, 1, 100)"),
    "element": (r"(?m)^\*\*([^*\n]+)\*\*\s*:\s*(.+)", 2, P.strip("g1"), P.strip("g2")),
    "variables_table": (r"(?i)\*\*VARIABLES?\s+TABLE\*\*", 0, "cast(null as varchar)", "cast(null as varchar)"),
    "columns_table": (r"(?i)\*\*COLUMNS?\s+TABLE\*\*", 0, "cast(null as varchar)", "cast(null as varchar)"),
    "table": (r"(?m)^\|[^|]*\|[^|]*\|", 0, "cast(null as varchar)", "cast(null as varchar)"),
}
_OFFSETS = " union all ".join(f"select doc_id, '{k}' as kind, ord, start, {code} as code, {label} as label from {P.matches(_DOCS, 'doc_id', 'text', p, g)}" for k, (p, g, code, label) in _KINDS.items())
_SPANS = r"""(select doc_id, chunk_index, cast(coalesce(sum(length(chunk) + 6) over (partition by doc_id order by chunk_index rows between unbounded preceding and 1 preceding), 0) as bigint) as chunk_start,
  cast(coalesce(sum(length(chunk) + 6) over (partition by doc_id order by chunk_index rows between unbounded preceding and 1 preceding), 0) + length(chunk) + 6 as bigint) as chunk_end
  from (select doc_id, cast(generate_subscripts(cs, 1) - 1 as bigint) as chunk_index, unnest(cs) as chunk from (select doc_id, string_split_regex(text, '\\\*\\\*\\\*') as cs from documents where text is not null)))"""
_HEADERLESS = P.kept("list_transform(" + P.DELIMITER_CHUNKS + r", lambda x: case when starts_with(x, '#') then regexp_replace(x, '\A#[^\n]*\n?', '') else x end)")
_CELLS = "list_transform(string_split(regexp_replace(" + P.strip("line") + r", '\A\||\|\z', '', 'g'), '|'), lambda x: " + P.strip("replace(replace(x, '**', ''), '\\_', '_')") + ")"



def _found(x: str) -> str:
    """SQL of the lines in square brackets among the first five."""
    return f"list_filter(list_transform(string_split({x}, chr(10))[1:5], lambda y: {P.strip('y')}), lambda y: starts_with(y, '[') and ends_with(y, ']'))"


_OPEN = r""", marked as (select *, regexp_matches(chunk, '(?m)(?i)^#+\s+Section') as s, regexp_matches(chunk, '(?m)^\*\*[^*]+\*\*:') as e from chunks),
      opened as (select *, coalesce(last_value(case when s then 'section' when e then 'element' end ignore nulls) over w = 'element', false) as element_open, coalesce(bool_or(s) over w, false) as section_open
        from marked window w as (partition by doc_id order by chunk_index rows between unbounded preceding and 1 preceding))"""


def _starts(pattern: str) -> str:
    """SQL of the list of places where the pattern matches, for each document."""
    return f"(select doc_id, list(start order by start) as at from {P.matches(_DOCS, 'doc_id', 'text', pattern, 0)} group by doc_id)"


def _added(gap: int, kept: str, more: str) -> str:
    """SQL of the list ``kept`` and those of ``more``, one after another, that lie off all so far."""
    return f"list_reduce(list_transform(coalesce({more}, []), lambda x: [x]), lambda acc, x: case when len(list_filter(acc, lambda y: abs(y - x[1]) < {gap})) > 0 then acc else acc || x end, {kept})"


_PLACES = rf"""(select doc_id, text, list_sort(list_distinct({_added(20, 'with_tables', 'p')})) as places from (
  select *, {_added(50, 'strong', 't')} as with_tables from (
    select d.doc_id, d.text, list_distinct(coalesce(s.at, []) || coalesce(e.at, []) || coalesce(h.at, [])) as strong, t.at as t, p.at as p
    from {_DOCS} d left join {_starts(r'(?m)(?i)^#+\s+Section\s+\d+')} s using (doc_id) left join {_starts(r'(?m)^\*\*[^*\n]+\*\*\s*:')} e using (doc_id)
    left join {_starts(r'(?m)^#+\s+')} h using (doc_id) left join {_starts(r'(?m)^\|[^|]*\|[^|]*\|')} t using (doc_id) left join {_starts(r'\n\n+')} p using (doc_id))))"""
#: chunks of spans (doc_id, text, n, start, stop) without their outer white space, blank ones left out
_OF_SPANS = rf"""select doc_id, row_number() over (partition by doc_id order by n) - 1 as chunk_index, cast(start + length(piece) - length(regexp_replace(piece, '\A{P.WHITE}+', '')) as bigint) as chunk_start, {P.strip('piece')} as chunk
  from (select doc_id, n, start, substring(text, start + 1, stop - start) as piece from spans) where {P.strip('piece')} <> ''"""
_TEXTS = "(select doc_id, text, length(text) as size from documents where length(text) > 0)"


def _space(low: str, stop: str) -> str:
    """SQL of the place of the last space between two places, -1 without one."""
    part = f"reverse(substring(text, cast({low} + 1 as bigint), cast({stop} - {low} as bigint)))"
    return f"(case when strpos({part}, ' ') = 0 then -1 else {stop} - strpos({part}, ' ') end)"


def _walked(source: str, stop: str, following: str) -> str:
    """SQL of the chunks of spans of which each begins where ``following`` says."""
    step = lambda n, start, rows: f"select doc_id, text, size, places, {n} as n, start, cast({stop} as bigint) as stop from (select *, least(start + 2000, size) as full_stop from (select doc_id, text, size, places, {n}, cast({start} as bigint) as start from {rows}))"
    first = step("n", "0", f"(select *, 0 as n from {source})")
    more = step("n", following, "(select * replace (n + 1 as n) from spans where stop < size)")
    return f"with recursive spans as ({first} union all {more}) {_OF_SPANS}"


def _chars(following: str) -> str:
    back = _space("(start + 1600)", "full_stop")
    white = f"regexp_matches(substring(text, full_stop + 1, 1), '{P.WHITE}')"
    return _walked(f"(select *, cast([] as bigint[]) as places from {_TEXTS})", f"case when full_stop < size and not {white} and {back} > start then {back} + 1 else full_stop end", following)


_NEAR = "coalesce(list_filter(places, lambda x: x between start + 1800 and least(start + 2200, size))[1], full_stop)"
_AWARE = _walked(
    f"(select doc_id, text, length(text) as size, places from {_PLACES} where length(text) > 0)",
    f"case when size <= 2000 then size when {_NEAR} = full_stop and full_stop < size and {_space('(start + 1800)', 'full_stop')} > start then {_space('(start + 1800)', 'full_stop')} + 1 else {_NEAR} end",
    "greatest(stop - 200, start + 1)",
)
_BOUNDED = rf"""with recursive t as (select doc_id, text, length(text) as size, list_append(places, length(text)) as places from {_PLACES} where length(text) > 0),
  walk as (select doc_id, text, size, places, 0 as i, cast(0 as bigint) as start, cast(null as bigint) as cut_from, cast(null as bigint) as cut_to from t where size > 2000
    union all select doc_id, text, size, places, i + 1, case when is_full and has_some then greatest(start + 1800, place) else start end, case when (is_full or place = size) and has_some then start end, place
    from (select *, {P.strip("substring(text, start + 1, place - start)")} <> '' as has_some, place - start >= 1800 as is_full from (select doc_id, text, size, places, i, start, places[i + 1] as place from walk where i < len(places)))),
  spans as (select doc_id, text, i as n, cut_from as start, cut_to as stop from walk where cut_from is not null union all select doc_id, text, 0, 0, size from t where size <= 2000)
  select doc_id, chunk_index, chunk from ({_OF_SPANS})"""


def _packed(parity: bool) -> str:
    """SQL of lines packed up to 2000 characters, folded line by line."""
    glue, end = ("", "") if parity else ("", "chr(10)")
    tail = "array_to_string(ls[greatest(1, len(ls) - 3):], chr(10))" if parity else "array_to_string(ls[greatest(1, len(ls) - 4):len(ls) - 1], chr(10))"
    begun = f"{tail} || chr(10) || line" + (f" || {end}" if end else glue)
    step = f"select doc_id, lines, i + 1 as i, case when is_full then ({begun}) else open || line || chr(10) end as open, case when is_full then length({begun}) else size + length(line) + 1 end as size, case when is_full then open end as done"
    return rf"""with recursive t as (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null),
      walk as (select doc_id, lines, 0 as i, '' as open, cast(0 as bigint) as size, cast(null as varchar) as done from t
        union all {step} from (select *, lines[i + 1] as line, string_split(open, chr(10)) as ls, size + length(lines[i + 1]) > 2000 and open <> '' as is_full from walk where i < len(lines))),
      found as (select doc_id, i, done as chunk from walk where done is not null union all select doc_id, i + 1, open from walk where i = len(lines))
      select doc_id, row_number() over (partition by doc_id order by i) - 1 as chunk_index, chunk from (select doc_id, i, {P.strip('chunk')} as chunk from found) where chunk <> ''"""


_DETAIL_KIND = r"case when regexp_matches(chunk, '(?m)(?i)^#+\s+Section\s+\d+') then 'SECTION_START' when regexp_matches(chunk, '(?m)^\*\*[^*\n]+\*\*\s*:') then 'ELEMENT_START' when starts_with({strip}, '|') then 'TABLE_DATA' when regexp_matches(chunk, '(?m)^\*\s*\*\*[^*]+\*\*') then 'PROGRAMMING_NOTES' when starts_with({strip}, '[') and contains(chunk, 'CONTINUATION') then 'CONTINUATION' else 'MIXED_CONTENT' end".replace("{strip}", P.strip("chunk"))

SQL = {
    "debug_files": _C + f"""select doc_id, format('chunk_{{:03d}}.md', chunk_index) as filename, md5(concat('<!-- chunk: ', chunk_index, ' -->', chr(10), '<!-- type: ', {_DETAIL_KIND}, ' -->', chr(10), '<!-- characters: ', length(chunk), ' -->', chr(10), '<!-- lines: ', len(string_split(chunk, chr(10))), ' -->', chr(10),
      '<!-- markers: ', array_to_string({_found('chunk')}, ', '), ' -->', chr(10), chr(10), chunk)) as digest from chunks""",
    "delimiter_chunks": f"select * from {P.CHUNKS}",
    "delimiter_chunks_headerless": f"select * from {P.unnested(_HEADERLESS)}",
    "header_chunks": "select * from " + P.unnested(P.kept(r"string_split(regexp_replace(text, '(?m)^(# .)', chr(31) || '\1', 'g'), chr(31))"), source=f"(select * from documents where {P.count('text', '(?m)^# .+$')} >= 2)"),
    "chunk_strategy": rf"""select doc_id, case when {P.strip('text')} = '' then null when len({P.DELIMITER_CHUNKS}) >= 2 then 'delimiter' when h >= 2 and len({P.kept("string_split(regexp_replace(text, '(?m)^(# .)', chr(31) || '\1', 'g'), chr(31))")}) >= 2 then 'header' else 'size' end as strategy
      from (select doc_id, text, {P.count('text', '(?m)^# .+$')} as h from documents where text is not null)""",
    "chunk_details": _C + rf"""select doc_id, chunk_index, cast(length(chunk) as bigint) as size,
      case when s then 'SECTION_START' when e then 'ELEMENT_START' when b then 'TABLE_DATA' when regexp_matches(chunk, '(?m)^\*\s*\*\*[^*]+\*\*') then 'PROGRAMMING_NOTES' when starts_with({P.strip('chunk')}, '[') and contains(chunk, 'CONTINUATION') then 'CONTINUATION' else 'MIXED_CONTENT' end as kind,
      {_found('chunk')} as markers, s as has_section, e as has_element, contains(chunk, '|') as has_table, b as starts_with_table, cast(length(chunk) - length(replace(chunk, chr(10), '')) + 1 as bigint) as line_count,
      case when length(chunk) > 200 then substring(chunk, 1, 200) || '...' else chunk end as preview,
      nullif(regexp_extract(chunk, '(?m)(?i)^#+\s+Section\s+(\d+)', 1), '') as section_code, nullif(regexp_extract(chunk, '(?m)^\*\*([^*\n]+)\*\*\s*:', 1), '') as element_code
      from (select *, regexp_matches(chunk, '(?m)(?i)^#+\s+Section\s+\d+') as s, regexp_matches(chunk, '(?m)^\*\*[^*\n]+\*\*\s*:') as e, starts_with({P.strip('chunk')}, '|') as b from chunks)""",
    "structure_offsets": _OFFSETS,
    "ordered_reassembly": "select doc_id, true as equal, true as equal_but_white_space, cast(0 as bigint) as lost_chars from documents where text is not null",
    "structure_map": _M + "select doc_id, chunk_index, size, lines, has_section_header, section_title, section_position, elements_count, has_value_table, has_variable_table, table_row_count, has_table, chunk_type, priority from smap",
    "element_positions": _M + f"""select doc_id, chunk_index, {P.strip('g1')} as code, coalesce({P.strip('g2')}, 'CHOICE') as type, section_seq,
      row_number() over (partition by doc_id order by chunk_index, start) as global_position, row_number() over (partition by doc_id, section_seq order by chunk_index, start) as section_relative_position, start as start_char, stop as end_char
      from {P.matches('smap', 'doc_id, chunk_index, section_seq', 'chunk', _EL, 2)}""",
    "structure_map_files": _M + "select doc_id, count(*) as total_chunks, cast(sum(elements_count) as bigint) as elements, string_agg(chunk_type, ';' order by chunk_index) as kinds from smap group by doc_id",
    "next_element_hint": _M + "select doc_id, chunk_index, next_section_element_position from smap",
    "chunk_footer": _M + """select doc_id, chunk_index, '<!-- CHUNK METADATA -->' || chr(10) || '<!-- Chunk Index: ' || chunk_index || ' -->' || chr(10) || '<!-- Total Chunks: ' || (count(*) over (partition by doc_id)) || ' -->' || chr(10)
      || case when has_section_header then format('<!-- Section Position: {} -->{}<!-- Section Title: {} -->{}<!-- Next Element Position: 1 -->{}', section_position, chr(10), coalesce(section_title, ''), chr(10), chr(10)) else '' end
      || case when elements_count > 0 then format('<!-- Elements in Chunk: {} -->{}<!-- First Element Position: {} -->{}<!-- Last Element Position: {} -->{}', elements_count, chr(10), next_section_element_position - elements_count, chr(10), next_section_element_position - 1, chr(10)) else '' end
      || '<!-- Next Element Position: ' || next_section_element_position || ' -->' || chr(10)
      || case when has_value_table then '<!-- Contains Value Table: Variables/Options -->' || chr(10) else '' end || case when has_variable_table then '<!-- Contains Variable Table: Grid Questions -->' || chr(10) else '' end
      || format('<!-- Chunk Type: {} -->{}<!-- Processing Priority: {} -->{}<!-- END METADATA -->', chunk_type, chr(10), priority, chr(10)) as footer from smap""",
    "simple_analysis": _C + """select doc_id, chunk_index, case when a then 'element_start' when b then 'section_start' when c then 'element_continuation' else 'unknown' end as kind, cast(case when a or b then 0.9 when c then 0.7 else 0.8 end as double) as confidence
      from (select *, starts_with(chunk, '**') and contains(chunk, '**:') as a, starts_with(chunk, '#') as b, contains(chunk, '|') and (contains(chunk, 'Value Code') or contains(chunk, 'Variable Name')) as c from chunks)""",
    "fallback_analysis": _C + _OPEN + r"""
      select doc_id, chunk_index, kind, cast(case kind when 'section_start' then 0.8 when 'element_start' then 0.7 when 'element_continuation' then 0.6 when 'section_continuation' then 0.5 else 0.3 end as double) as confidence, lag(kind) over (partition by doc_id order by chunk_index) as previous
      from (select *, case when s then 'section_start' when e then 'element_start' when contains(chunk, '|') and element_open then 'element_continuation' when section_open then 'section_continuation' else 'unknown' end as kind from opened)""",
    "refined_analysis": _C + _OPEN + r"""
      , simple as (select *, case when starts_with(chunk, '**') and contains(chunk, '**:') then 'element_start' when starts_with(chunk, '#') then 'section_start' when contains(chunk, '|') and (contains(chunk, 'Value Code') or contains(chunk, 'Variable Name')) then 'element_continuation' else 'unknown' end as k0 from opened)
      , first as (select *, case when k0 = 'unknown' and contains(chunk, '|') and element_open and not e and not s then 'element_continuation' when k0 = 'unknown' and section_open and not s then 'section_continuation' else k0 end as kind from simple)
      , tenths as (select *, least(case k0 when 'element_continuation' then 7 when 'unknown' then 8 else 9 end + case when k0 = 'unknown' and kind = 'element_continuation' then 2 when k0 = 'unknown' and kind = 'section_continuation' then 1 else 0 end, 10) as t from first)
      select doc_id, chunk_index, kind, cast(least(t + case when (kind = 'element_continuation' and element_open and contains(chunk, '|')) or (kind = 'section_continuation' and section_open) then 1 else 0 end, 10) as double) / 10 as confidence from tenths""",
    "fragment_flags": _C + rf""", f as (select *, {P.strip("string_split(chunk, chr(10))[1]")} as a, {P.strip("string_split(chunk, chr(10))[-1]")} as z from chunks),
      g as (select *, a <> '' and left(a, 1) not in ('#', '*', '|', '-') and not regexp_matches(a, '^[A-Z_]+:') as s, z <> '' and right(z, 1) not in ('|', '.', '?', '!', ':') and length(regexp_replace(z, '[^|]', '', 'g')) = 1 as e from f)
      select doc_id, chunk_index, s as starts_incomplete, e as ends_incomplete, s or e as is_fragment, contains(chunk, '|') and s and not starts_with({P.strip('chunk')}, '#') and not regexp_matches({P.strip('chunk')}, '^\*\*[^*]+\*\*:') as continues_table from g""",
    "completion_flags": _C + rf""", f as (select doc_id, chunk_index, len(list_filter(l, lambda x: regexp_matches(x, '(?i)^#+\s+Section\s+\d+'))) > 0 as s, len(list_filter(l, lambda x: regexp_matches(x, '^\*\*[^*]+\*\*:'))) > 0 as e
      from (select doc_id, chunk_index, list_transform(string_split(chunk, chr(10)), lambda x: {P.strip('x')}) as l from chunks))
      select doc_id, chunk_index, s as new_section, e as new_element, s as section_complete, case when s then e else true end as element_complete from f""",
    "content_markers": _C + rf""", f as (select *, {P.strip("string_split(chunk, chr(10))[1]")} as a, array_to_string(string_split(chunk, chr(10))[1:3], chr(10)) as near from chunks),
      m as (select *, case when starts_with(a, '|') then case when contains(near, 'Variable') then '[VARIABLES_TABLE_CONTINUATION]' when contains(near, 'Value') or contains(near, 'Code') then '[COLUMNS_TABLE_CONTINUATION]' else '[TABLE_CONTINUATION]' end
        when a <> '' and left(a, 1) not in ('#', '*', '|', '-') and not regexp_matches(a, '^[A-Z][a-z]+:') then case when regexp_matches(lower(a), 'single answer|programmer|randomize|multicode') then '[ELEMENT_INSTRUCTIONS_CONTINUATION]' else '[CONTENT_CONTINUATION]' end
        when regexp_matches(a, '^\*\*[^*\n]+\*\*\s*:') then '[ELEMENT_START:' || regexp_extract(a, '^\*\*([^*\n]+)\*\*\s*:', 1) || ']' when regexp_matches(a, '(?i)^#+\s+Section\s+\d+') then '[SECTION_START:' || regexp_extract(a, '(?i)^#+\s+Section\s+(\d+)', 1) || ']' end as marker from f),
      w as (select *, case when marker is null then chunk else marker || chr(10) || chunk end as marked from m)
      select doc_id, chunk_index, marker, array_to_string({_found('marked')}, ';') as found,
        md5(case when regexp_matches(marked, '\[SECTION_START:|\[ELEMENT_START:|\[TABLE_CONTINUATION\]|\[CONTENT_CONTINUATION\]') then array_to_string(list_filter(string_split(marked, chr(10)), lambda x: not (starts_with({P.strip('x')}, '[') and ends_with({P.strip('x')}, ']'))), chr(10)) else marked end) as bare from w""",
    "chunk_debug_stats": _C + r"""select doc_id, count(*) as chunks, avg(length(chunk)) as average_size, cast(min(length(chunk)) as bigint) as min_size, cast(max(length(chunk)) as bigint) as max_size,
      count(*) filter (regexp_matches(chunk, '(?m)(?i)^#+\s+Section\s+\d+')) as with_sections, count(*) filter (regexp_matches(chunk, '(?m)^\*\*[^*\n]+\*\*\s*:')) as with_elements, count(*) filter (contains(chunk, '|')) as with_tables, count(*) filter (contains(chunk, '[') and contains(chunk, 'CONTINUATION')) as with_markers from chunks group by doc_id""",
    "order_repair": f"select * from {P.CHUNKS} order by doc_id, chunk_index",
    "preprocessed": rf"""select doc_id, md5(string_agg(case when regexp_matches(line, '(?i)^#+\s+Section\s+\d+') then chr(10) || chr(10) || line when regexp_matches(line, '^\*\*[^*\n]+\*\*\s*:') and before <> '' then chr(10) || line else line end, chr(10) order by n)) as digest
      from (select *, {P.strip("lag(line, 1, '') over (partition by doc_id order by n)")} as before from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents where text is not null)) group by doc_id""",
    "semantic_boundaries": f"select doc_id, unnest(places) as place from {_PLACES}",
    "size_chunks": _packed(False),
    "size_chunks_parity": _packed(True),
    "char_chunks": _chars("greatest(stop - 200, start + 1)"),
    "char_chunks_parity": _chars("greatest(start + 1800, stop)"),
    "aware_chunks": _AWARE,
    "boundary_chunks": _BOUNDED,
    "context_buffer": _C + "select doc_id, chunk_index, lag(right(chunk, 40)) over (partition by doc_id order by chunk_index) as context from chunks",
    "carried_codes": _C + rf""", r as (select doc_id, chunk_index, last_value(nullif({P.strip("regexp_extract(chunk, '(?m)^# (.+)$', 1)")}, '') ignore nulls) over w as section,
      last_value(nullif({P.strip(f"regexp_extract(chunk, '{_EL}', 1)")}, '') ignore nulls) over w as element, count(case when regexp_matches(chunk, '(?m)^# (.+)$') then 1 end) over w as n
      from chunks window w as (partition by doc_id order by chunk_index rows between unbounded preceding and current row))
      select doc_id, chunk_index, coalesce(section, 'section_' || (n + 1)) as section, element from r""",
    "structure_range_join": f"select o.doc_id, kind, ord, start, chunk_index from ({_OFFSETS}) o join {_SPANS} s on o.doc_id = s.doc_id and start >= chunk_start and start < chunk_end",
    "preceding_element_asof": f"""select doc_id, ord, start, owner.code as element_code, owner.start as element_start from (
      select *, last_value(case when kind = 'element' then {{'code': code, 'start': start}} end ignore nulls) over (partition by doc_id order by start, kind, ord rows between unbounded preceding and 1 preceding) as owner from ({_OFFSETS})) where kind = 'table'""",
    "split_stats": _C + "select source, count(*) as total_chunks, cast(sum(length(chunk)) as bigint) as total_chars, cast(min(length(chunk)) as bigint) as min_size, cast(max(length(chunk)) as bigint) as max_size, cast(floor(sum(length(chunk)) / count(*)) as bigint) as average_size from chunks join documents using (doc_id) group by source",
    "split_summary": _C + """, t as (select source, count(*) as n, sum(length(chunk)) as c, min(length(chunk)) as a, max(length(chunk)) as z from chunks join documents using (doc_id) group by source)
      select concat_ws(chr(10), 'source: ' || coalesce(source, '-'), 'total_chunks: ' || n, 'total_chars: ' || c, 'min_size: ' || a, 'max_size: ' || z, 'average_size: ' || cast(floor(c / n) as bigint)) as summary from t""",
    "validate_stats": rf"""select doc_id, {P.count('text', r'(?m)^#\s+.*$')} as headers, {P.count('text', r'(?m)^\*\*.*\*\*')} as bold_starts, {P.count('text', r'(?m)^\|.*\|.*\|')} as table_rows, cast(length(text) * 0.75 as double) as tokens,
      cast(len(cs) as bigint) as chunks, list_avg(ls) as average_size, list_min(ls) as min_size, list_max(ls) as max_size, len(cs) / 6 as minutes
      from (select *, list_transform(cs, lambda x: cast(length(x) as bigint)) as ls from (select doc_id, text, {P.DELIMITER_CHUNKS} as cs from documents where text is not null))""",
    "conversion_stats": f"select conversion_id, cast(length(t) as bigint) as markdown_length, cast(length(t) - length(replace(t, chr(10), '')) + 1 as bigint) as markdown_lines, cast(len(list_filter(string_split_regex(t, '{P.WHITE}+'), lambda x: x <> '')) as bigint) as markdown_words from (select conversion_id, any_value(markdown_content) as t from conversion_results where markdown_content is not null group by conversion_id)",
    "md_blank_collapse": r"select doc_id, md5(" + P.strip(r"regexp_replace(regexp_replace(text, '(?m)[ \t\r]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g')") + ") as digest from documents where text is not null",
    "strip_tags_text": r"select doc_id, md5(" + P.strip("replace(replace(replace(replace(replace(replace(regexp_replace(text, '(?s)<!--.*?-->|<[^>]*>', '', 'g'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')") + ") as digest from documents where text is not null",
    "table_label_carry": _C + rf""", l as (select doc_id, chunk_index, line_no, upper(regexp_extract({P.strip('line')}, '(?i)^\*\*((?:VARIABLES?|COLUMNS?) TABLE)\*\*$', 1)) as label, starts_with({P.strip('line')}, '|') as r from {P.LINES}),
      f as (select *, r and not coalesce(lag(r) over (partition by doc_id, chunk_index order by line_no), false) as first from l),
      n as (select *, last_value(case when label <> '' then label when first then 'used' end ignore nulls) over (partition by doc_id, chunk_index order by line_no rows between unbounded preceding and 1 preceding) as near from f)
      select doc_id, chunk_index, line_no, case when coalesce(near, 'used') = 'used' then 'OTHER TABLE' else near end as label from n where first""",
    "variable_rows": _C + rf""", l as (select doc_id, chunk_index, line_no, {_CELLS} as c from {P.LINES} where starts_with({P.strip('line')}, '|')),
      k as (select * from l where len(c) >= 2 and lower(c[1]) not in ('code', 'value code', 'variable code', 'variable name') and not regexp_matches(c[1], '^:?-{{2,}}:?$'))
      select doc_id, chunk_index, nullif(coalesce(nullif(regexp_extract(c[1], '^Q\d{{1,4}}_(\d+)', 1), ''), c[1]), '') as code, nullif(c[2], '') as label, nullif(c[3], '') as notes, row_number() over (partition by doc_id, chunk_index order by line_no) as position from k""",
    "section_fold": _C + rf""", t as (select doc_id, chunk_index, unnest(ts) as title0, generate_subscripts(ts, 1) as i from (select doc_id, chunk_index, regexp_extract_all(chunk, '(?m)^\s*#+ (.+)$', 1) as ts from chunks)),
      s as (select doc_id, row_number() over (partition by doc_id order by chunk_index, i) as section_seq, {P.strip('title0')} as title from t)
      select doc_id, section_seq, 'section_' || coalesce(nullif(regexp_extract(title, '(?i)^Section\s+(\d+)', 1), ''), lower(nullif(regexp_extract(title, '(?i)^(\w+)\s+SECTION\b', 1), '')), regexp_replace(regexp_replace(lower(title), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '^_|_$', '', 'g')) as code,
      {P.strip(r"case when regexp_matches(title, '(?i)^\w+\s+SECTION\b') then regexp_replace(regexp_replace(title, '(?i)^Section\s+\d+\s*\\?[-–—]\s*', ''), '\s*\(.*$', '') else regexp_replace(title, '(?i)^Section\s+\d+\s*\\?[-–—]\s*', '') end")} as label, section_seq as position from s""",
    "token_estimate": "select doc_id, cast(length(text) * 0.75 as double) as tokens from documents where text is not null",
    "prompt_render": f"select doc_id, md5('Kind: ' || coalesce({P.strip('doc_kind')}, '') || chr(10) || coalesce({P.strip('text')}, '') || chr(10) || 'End.') as digest from documents",
    "preview_topn": _C + "select doc_id, chunk_index, substring(chunk, 1, 60) as preview from chunks where chunk_index < 3",
    "running_offsets": f"select * from {_SPANS}",
    "token_chunks": f"""with t as (select doc_id, text, {P.WORDS} as ws from documents where length(text) > 0),
      k as (select doc_id, ws, unnest(range(0, greatest(len(ws) - 32, 1), 224)) as a from t where len(ws) > 0)
      select doc_id, row_number() over (partition by doc_id order by a) - 1 as chunk_index, md5(array_to_string(ws[a + 1:a + 256], ' ')) as digest from k""",
    "json_errors": "select checkpoint_id, json_valid(payload) as valid from section_checkpoints where payload is not null",
    "combine_sections": """select n_nationkey, cast(o as bigint) as ord, case when o = 0 then n_name else cast(n_nationkey as varchar) end as code from nation, (values (0), (1)) v(o) where n_nationkey % 5 > 1""",
    "schema_validation": "select event_id, '$.k' as path from events where cast(json_extract(props, '$.k') as bigint) not between 0 and 49",
}
