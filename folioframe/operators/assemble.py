"""From extraction results to ordered surveys: parentage, numbering, defaults, merging, nesting.

State between chunks is expressed as windows over (document, chunk_index, place
in the chunk), so a document's rows meet in one task and documents run apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def taken(results: DataFrame) -> DataFrame:
    """The results that count: a chunk with an error changes nothing."""
    return results.filter(F.coalesce("result.error", F.lit("")) == "")


def sections(results: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """(doc, section_seq, code, label, position) of the extracted sections; a missing position counts on."""
    rows = taken(results).select(doc, "chunk_index", F.posexplode("result.extracted_sections").alias("ord", "s"))
    seq = F.row_number().over(Window.partitionBy(doc).orderBy("chunk_index", "ord")).cast("bigint")
    rows = rows.withColumn("section_seq", seq)
    return rows.select(doc, "section_seq", F.coalesce("s.code", F.concat(F.lit("section_"), "section_seq")).alias("code"), F.coalesce("s.label", F.lit("Untitled Section")).alias("label"), F.coalesce(F.col("s.position").cast("bigint"), F.col("section_seq")).alias("position"))


def elements(results: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """(doc, section_seq, chunk_index, ord, element): each element with the last section up to and including its chunk; 0 without one."""
    so_far = Window.partitionBy(doc).orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, 0)
    rows = taken(results).withColumn("section_seq", F.sum(F.coalesce(F.array_size("result.extracted_sections"), F.lit(0))).over(so_far).cast("bigint"))
    return rows.select(doc, "section_seq", "chunk_index", F.posexplode("result.extracted_elements").alias("ord", "element"))


def element_errors(rows: DataFrame, types: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The elements that can be taken, and the others with their ``errors``: no code or label, an unknown type, a column code that isn't a whole number."""
    odd = F.filter(F.coalesce(F.col("element.columns"), F.array().cast(rows.select("element.columns").schema[0].dataType)), lambda c: c["code"].try_cast("int").isNull())
    errors = F.concat(domain_errors(F.col("element"), types), F.when(F.size(odd) > 0, F.array(F.lit("a column code isn't a whole number"))).otherwise(F.array().cast("array<string>")))
    judged = rows.withColumn("errors", errors)
    return judged.filter(F.size("errors") == 0).drop("errors"), judged.filter(F.size("errors") > 0)


def warnings(rows: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """The elements that no section precedes; they take no part in the survey."""
    return rows.filter("section_seq = 0").select(doc, "chunk_index", F.concat(F.lit("element without section: "), "element.code").alias("warning"))


def renumber(df: DataFrame, parents: list[str], position: str, arrival: list[str]) -> DataFrame:
    """``new_position`` from 1 within the parent, by position, nulls last, then arrival."""
    order = Window.partitionBy(*parents).orderBy(F.col(position).asc_nulls_last(), *arrival)
    return df.withColumn("new_position", F.row_number().over(order).cast("bigint"))


def anti_merge(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key isn't in ``old``; repeats within ``new`` stay."""
    return old.unionByName(new.join(old.select(*keys).distinct(), keys, "left_anti"))


def merge_partials(rows: DataFrame, keys: list[str], order: str, scalars: list[str]) -> DataFrame:
    """One row for each key: the last value of each column that isn't null."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return rows.groupBy(*keys).agg(*[last(c) for c in scalars])


def _numbered(items: Column) -> Column:
    """The entries of an array by position, nulls last, then as they stood, with positions from 1."""
    keyed = F.array_sort(F.transform(items, lambda x, i: F.struct(x["position"].isNull().alias("last"), x["position"].alias("p"), i.alias("i"), x.alias("x"))))
    return F.transform(keyed, lambda k, i: k["x"].withField("position", i + 1))


def survey(results: DataFrame, *, doc: str = "doc_id", types: tuple[str, ...] | None = None) -> DataFrame:
    """(doc, sections array): the nested survey of each document, numbered at every level.

    Chunks with an error and elements with errors (see :func:`element_errors`) are left out.
    """
    from folioframe.operators.extract import TYPES

    good, _ = element_errors(elements(results, doc=doc).filter("section_seq > 0"), types or TYPES)
    placed = renumber(good.withColumn("position", F.col("element.position")), [doc, "section_seq"], "position", ["chunk_index", "ord"])
    e = F.struct(
        F.col("new_position").alias("position"),
        F.coalesce(F.nullif("element.code", F.lit("")), F.concat(F.lit("element_"), "new_position")).alias("code"),
        F.coalesce(F.nullif("element.label", F.lit("")), F.lit("Untitled Element")).alias("label"),
        F.coalesce("element.type", F.lit("CHOICE")).alias("type"),
        F.col("element.notes").alias("notes"),
        F.col("element.help_text").alias("help_text"),
        _numbered(F.col("element.variables")).alias("variables"),
        _numbered(F.col("element.columns")).alias("columns"),
    )
    by_section = placed.groupBy(doc, "section_seq").agg(F.array_sort(F.collect_list(e)).alias("elements"))
    all_sections = renumber(sections(results, doc=doc), [doc], "position", ["section_seq"]).join(by_section, [doc, "section_seq"], "left")
    s = F.struct(F.col("new_position").alias("position"), "code", "label", F.coalesce("elements", F.array().cast(by_section.schema["elements"].dataType)).alias("elements"))
    return all_sections.groupBy(doc).agg(F.array_sort(F.collect_list(s)).alias("sections"))


def survey_json(results: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    return survey(results, doc=doc).select(doc, F.to_json(F.struct("sections")).alias("survey"))


def domain_errors(element: Column, types: tuple[str, ...]) -> Column:
    """The reasons why an element can't be taken, an empty array where it can."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim(element["code"]), F.lit("")) == "", F.lit("code is empty")),
            F.when(F.coalesce(F.trim(element["label"]), F.lit("")) == "", F.lit("label is empty")),
            F.when(~F.coalesce(element["type"], F.lit("CHOICE")).isin(*types), F.concat(F.lit("unknown type "), element["type"])),
        )
    )
