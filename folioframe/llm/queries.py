"""The queries of the training-text operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import bpe_encode, leakage, lookalike, mojibake, near_duplicates, residue, split_oversized, truncation
from folioframe.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled_fields(table(spark, d, "partial_elements"))


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    """The original wording of every garbled value, null where it can't be recovered."""
    return mojibake.repair(table(spark, d, "partial_elements")).distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    members, links = near_duplicates.similar_records(table(spark, d, "partial_elements"))
    return near_duplicates.record_pairs(members, links)


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    members, links = near_duplicates.similar_records(table(spark, d, "partial_elements"))
    return near_duplicates.groups(members, links)


def _cut_values(spark: SparkSession, d: str) -> DataFrame:
    elements = truncation.values(table(spark, d, "partial_elements"), table="partial_elements", key="element_id", text="label", lang="lang", source="source")
    chunks = truncation.values(table(spark, d, "chunk_results"), table="chunk_results", key="chunk_id", text="partial_content", lang=None, source="source")
    return elements.unionByName(chunks)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = truncation.judge(_cut_values(spark, d)).filter("cut")
    return found.selectExpr("table as source_table", "id as record_id").distinct()


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """The share of cut values for each source in both tables."""
    rows = _cut_values(spark, d)
    return truncation.truncation_rates(rows, truncation.judge(rows)).withColumnRenamed("table", "source_table")


_ITEM = ["source_table", "record_id", "chunk_no"]


def _items(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized.conversion_items(table(spark, d, "conversion_results"), table(spark, d, "split_results"), table(spark, d, "split_profiles"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized.oversized_items(split_oversized.ranges(_items(spark, d)), _ITEM).select(*_ITEM)


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every item."""
    return split_oversized.split_items(_items(spark, d), _ITEM)


def p5_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each item put together again from its pieces."""
    return split_oversized.rebuilt(p5_pieces(spark, d), _ITEM).select(*_ITEM, F.md5("text").alias("digest"))


def _canonical(spark: SparkSession, d: str) -> DataFrame:
    elements, sections = table(spark, d, "partial_elements"), table(spark, d, "partial_sections")
    fitted = mojibake.learn(elements)  # as p1_found learns
    a = lookalike.normalize_fields(elements, {"label": False, "code": True}, keys=["element_id"], source="source", fitted=fitted)
    b = lookalike.normalize_fields(sections, {"label": False}, keys=["section_id"], model=fitted[0][2])
    name = lambda df, t, key: df.selectExpr(f"'{t}' as source_table", f"{key} as record_id", "field_name", "original", "canonical")
    return name(a, "partial_elements", "element_id").unionByName(name(b, "partial_sections", "section_id")).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _canonical(spark, d).select("source_table", "record_id", "field_name").distinct()


def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    """The canonical form of every value that wasn't in it."""
    return _canonical(spark, d)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe_encode.encode_texts(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """A digest of the text that the ids of each document give back."""
    decoded = bpe_encode.decode_ids(p7_ids(spark, d))
    return decoded.select("doc_id", F.md5("text").alias("digest"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.phrases(_leaks(spark, d)).select("doc_id", "item_id")


def p8_near(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold words of an item at their places, with others between them changed."""
    return _leaks(spark, d).filter("kind = 'proximity'").select("doc_id", "item_id", "matched_words", "near_words")


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_leaks(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "documents")).select("doc_id")


def p9_clean_corpus(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return residue.without_residue(docs, residue.find_residue(docs)).select("doc_id", "source", "doc_kind")


QUERIES = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_groups, p4_found, p4_rates, p5_found, p5_pieces, p5_rebuilt, p6_found, p6_canonical, p7_ids, p7_decoded, p8_found, p8_near, p8_leaked_items, p9_found, p9_clean_corpus)}

_P8 = """
with w as (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from eval_items),
items as (select item_id, i, array_to_string(ws[i:i+11], ' ') as gram from (select item_id, ws, unnest(range(1, len(ws) - 10)) as i from w where len(ws) >= 12)),
dw as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from documents where text is not null),
grams as (select doc_id, array_to_string(ws[i:i+11], ' ') as gram from (select doc_id, ws, unnest(range(1, len(ws) - 10)) as i from dw where len(ws) >= 12))
select distinct doc_id, item_id from grams join items using (gram)
"""

_P8_ITEMS = """
with recursive w as (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from eval_items),
iw as (select item_id, generate_subscripts(ws, 1) as i, unnest(ws) as word from w where len(ws) >= 12),
leaky as (select distinct item_id, doc_id from ({found})),
dw as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as ws from documents where text is not null),
pos as (select doc_id, generate_subscripts(ws, 1) as j, unnest(ws) as word from dw where doc_id in (select doc_id from leaky)),
hits as (select item_id, doc_id, j - i as delta, i from iw join leaky using (item_id) join pos using (doc_id, word)),
runs as (select item_id, doc_id, delta, i - row_number() over (partition by item_id, doc_id, delta order by i) as run from hits),
longest as (select item_id, doc_id, count(*) as n from runs group by item_id, doc_id, delta, run)
select item_id, count(distinct doc_id) as documents, cast(max(n) as integer) as longest from longest group by item_id
""".replace("{found}", _P8)

_P2 = """
with one as (select element_id, any_value(label) as label, any_value(variables) as variables from partial_elements group by element_id),
words as (select element_id, list_distinct(regexp_extract_all(lower(concat_ws(' ', label, array_to_string([v.label for v in variables], ' '))), '[\\p{L}\\p{N}]+')) as ws
          from one where len(regexp_extract_all(lower(label), '[\\p{L}\\p{N}]+')) >= 8),
w as (select element_id, len(ws) as n, unnest(ws) as word from words),
met as (select a.element_id as x, b.element_id as y, any_value(a.n) as na, any_value(b.n) as nb, count(*) as shared
         from w a join w b on a.word = b.word and a.element_id < b.element_id group by 1, 2)
select x as element_id_a, y as element_id_b from met where shared * 10 >= (na + nb - shared) * 7
"""

_P2_GROUPS = """
with recursive one as (select element_id, any_value(label) as label, any_value(variables) as variables from partial_elements group by element_id),
rec as (select element_id, list_sort(list_distinct(regexp_extract_all(lower(concat_ws(' ', label, array_to_string([v.label for v in variables], ' '))), '[\\p{L}\\p{N}]+'))) as ws
        from one where len(regexp_extract_all(lower(label), '[\\p{L}\\p{N}]+')) >= 8),
pairs as ({pairs}),
edges as (select element_id_a as x, element_id_b as y from pairs union all select element_id_b, element_id_a from pairs),
reach as (select element_id as x, element_id as y from rec union select r.x, b.y from reach r join edges b on r.y = b.x)
select r.element_id, min(reach.y) as group_id, (select count(distinct t.ws) from edges b join rec t on t.element_id = b.y where b.x = r.element_id and t.ws <> r.ws) as links
from rec r join reach on reach.x = r.element_id group by r.element_id, r.ws
""".replace("{pairs}", _P2)

_P5 = """
with d as (select max_chars from split_profiles where is_default),
items as (
    select 'conversion_results' as source_table, conversion_id as record_id, cast(0 as bigint) as chunk_no, profile_name, markdown_content as text from conversion_results
    union select 'split_results', split_id, cast(generate_subscripts(chunks, 1) - 1 as bigint), profile_name, unnest(chunks) from split_results)
select distinct source_table, record_id, chunk_no from items left join split_profiles using (profile_name)
where length(text) > coalesce(max_chars, (select max_chars from d))
"""

_P5_TEXTS = """
select source_table, record_id, chunk_no, md5(any_value(text)) as digest from (
    select 'conversion_results' as source_table, conversion_id as record_id, cast(0 as bigint) as chunk_no, markdown_content as text from conversion_results
    union all select 'split_results', split_id, cast(generate_subscripts(chunks, 1) - 1 as bigint), unnest(chunks) from split_results)
where length(text) > 0 group by 1, 2, 3
"""

_P7 = "select doc_id, md5(coalesce(text, '')) as digest from documents"

SQL = {"p2_found": _P2, "p2_groups": _P2_GROUPS, "p5_found": _P5, "p5_rebuilt": _P5_TEXTS, "p7_decoded": _P7, "p8_found": _P8, "p8_leaked_items": _P8_ITEMS}
