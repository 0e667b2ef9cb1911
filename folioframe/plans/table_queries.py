"""Queries over tables: diffs, merges, progress, joins, HTML pages built from rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.functions import text as T
from folioframe.operators import assemble, diff, extract, fold, html, metrics, monitor
from folioframe.session import table
from folioframe.sources import sinks


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The customers, and a copy with some changed, some missing and some new."""
    a = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    b = a.filter(k % 11 != 3).select(k.alias("c_custkey"), F.when(k % 7 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("c_name"), F.when(k % 13 != 0, F.col("c_nationkey")).alias("c_nationkey"), F.when(k % 10 == 1, F.lit("NEW")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    new = a.filter(k % 50 == 0).select((k + 10_000_000).alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment")
    return a, b.unionByName(new)


def keyed_diff(spark, d):
    return diff.keyed_diff(*_versions(spark, d), ["c_custkey"]).select("c_custkey", "diff")


def diff_summary(spark, d):
    return diff.summary(diff.keyed_diff(*_versions(spark, d), ["c_custkey"]))


def diff_modified_only(spark, d):
    rows = diff.only(diff.keyed_diff(*_versions(spark, d), ["c_custkey"]), "modified")
    return rows.select("c_custkey", diff.pretty(F.col("diff")).alias("changes"), sinks.diff_style(F.col("diff")).alias("style"))


def renumber_positions(spark, d):
    one = table(spark, d, "partial_elements").dropDuplicates(["element_id"]).filter("section_id is not null").select("element_id", "section_id", "position")
    return assemble.renumber(one, ["section_id"], "position", ["element_id"]).select("element_id", "section_id", "new_position")


def dedup_merge(spark, d):
    """The first order of each customer."""
    rows = metrics.merge_reports(table(spark, d, "orders"), code="o_custkey", order=[F.col("o_orderdate"), F.col("o_orderkey")])
    return rows.select("o_custkey", "o_orderkey")


def anti_merge(spark, d):
    """Suppliers' nations beside the regions of nations already there."""
    old = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("id")).filter(F.col("nation") < 12)
    new = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"))
    return assemble.anti_merge(new, old, ["nation"])


def merge_partials(spark, d):
    """The last value of type and value that isn't null, for each user of the events."""
    e = table(spark, d, "events").withColumn("kind", F.when(F.col("value") > 50, F.col("event_type")))
    return assemble.merge_partials(e, ["user_id"], "event_id", ["kind", "value"])


def mapping_lookup(spark, d):
    c = table(spark, d, "conversion_results").dropDuplicates(["conversion_id"])
    p = table(spark, d, "split_profiles").select("profile_name", "max_chars")
    rows = c.join(p, "profile_name", "left").select("conversion_id", "profile_name", F.col("max_chars").cast("bigint").alias("max_chars"))
    return rows.withColumn("missing", F.col("max_chars").isNull())


def leftover_rows(spark, d):
    """Chunk results of no conversion."""
    chunks = table(spark, d, "chunk_results").dropDuplicates(["chunk_id"]).select("chunk_id", "conversion_id")
    return chunks.join(table(spark, d, "conversion_results").select("conversion_id"), "conversion_id", "left_anti").select("chunk_id")


def chunk_fold(spark, d):
    """Each chunk result with the kind of the one before it in its conversion."""
    from pyspark.sql import Window

    one = table(spark, d, "chunk_results").dropDuplicates(["chunk_id"]).filter("conversion_id is not null")
    w = Window.partitionBy("conversion_id").orderBy("chunk_index", "chunk_id")
    return one.select("chunk_id", F.lag("chunk_type").over(w).alias("previous"), F.row_number().over(w).cast("bigint").alias("place"))


def conversation_fold(spark, d):
    """The text accumulated after each chunk result of a conversion, and the kind of the one before."""
    one = table(spark, d, "chunk_results").dropDuplicates(["chunk_id"]).filter("conversion_id is not null")
    rows = fold.accumulated(one, doc="conversion_id", order=["chunk_index", "chunk_id"], content=F.col("chunk_type"), partial=F.col("partial_content"), goes_on=F.col("requires_continuation"), error=F.col("error"))
    return rows.select("chunk_id", "previous_type", F.md5("accumulated").alias("digest"))


def state_fold(spark, d):
    """The sections of each conversion, folded from its chunk results."""
    one = table(spark, d, "chunk_results").dropDuplicates(["chunk_id"]).filter("conversion_id is not null")
    first = F.coalesce(F.to_json(F.get("extracted_elements", F.lit(0))), F.to_json(F.get("extracted_sections", F.lit(0))))
    rows = one.select("conversion_id", F.struct("chunk_index", "chunk_id").alias("chunk_index"), F.col("partial_content").alias("chunk"), F.col("chunk_type").alias("kind"), first.alias("extracted"))
    return fold.fold_sections(rows, doc="conversion_id").select("conversion_id", "section_no", "code", "label", F.size("elements").cast("bigint").alias("elements"))


def section_tree_counts(spark, d):
    """How many sections, elements, variables and columns each survey has."""
    one = table(spark, d, "partial_sections").dropDuplicates(["section_id"]).withColumn("elements", F.filter("elements", lambda x: x.isNotNull()))
    return fold.tree_counts(one, doc="survey_code")


def _run_events(spark: SparkSession, d: str) -> DataFrame:
    """The events table as events of runs: a run for each user."""
    e = table(spark, d, "events")
    kinds = F.array(*map(F.lit, ("chunk_start", "analysis", "extraction", "chunk_done", "phase", "warning")))
    event = F.get(kinds, (F.col("event_id") % 6).cast("int"))
    return e.select(
        F.col("user_id").cast("string").alias("run"), "ts", event.alias("event"), (F.col("event_id") % 7).alias("chunk_index"), F.col("event_type").alias("kind"), (F.floor(F.col("value")) / 100).alias("confidence"), F.floor(F.col("value")).cast("double").alias("ms"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("e"), F.col("event_id") % 3)).alias("message"), F.length("props").cast("bigint").alias("input_tokens"), (F.col("event_id") % 10).alias("output_tokens"), "event_id",
    )


def chunk_reports(spark, d):
    rows = monitor.chunk_reports(_run_events(spark, d))
    return rows.select("run", "chunk_index", F.unix_micros(F.col("started").cast("timestamp")).alias("started"), F.unix_micros(F.col("done").cast("timestamp")).alias("done"), "ms")


def run_reports(spark, d):
    rows = monitor.run_reports(_run_events(spark, d))
    return rows.select("run", "chunks_completed", "chunks_failed", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"), "input_tokens", "output_tokens")


def merged_errors(spark, d):
    """The distinct errors and warnings of all runs whose number ends alike."""
    reports = monitor.run_reports(_run_events(spark, d)).withColumn("digit", F.right("run", F.lit(1)))
    return monitor.merge_errors(reports, ["digit"]).select("digit", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"))


def last_errors(spark, d):
    """The last three messages of each run."""
    rows = monitor.last_messages(_run_events(spark, d), ["run"], ["ts", "event_id"], "message")
    return rows.select("run", F.array_join("messages", ";").alias("messages"))


def throttled_progress(spark, d):
    return monitor.throttled(_run_events(spark, d), run="run", ts="ts", seconds=3600, tie="event_id").select("run", "event_id")


def checkpoint_summary(spark, d):
    rows = monitor.checkpoint_summary(table(spark, d, "section_checkpoints").dropDuplicates(["checkpoint_id"]))
    return rows.select("session_id", "checkpoints", "section_checkpoints", "element_checkpoints", "partial_state_checkpoints")


def monitor_view(spark, d):
    rows = monitor.monitor_view(monitor.run_reports(_run_events(spark, d)), F.lit(20))
    return rows.select("run", "percent", F.array_join("errors", ";").alias("errors"), F.col("more_errors").cast("bigint").alias("more_errors"))


def first_failure(spark, d):
    """The orders of each customer up to the first one that is pending."""
    rows = monitor.stop_at_first_failure(table(spark, d, "orders"), batch="o_custkey", order=["o_orderdate", "o_orderkey"], ok=F.col("o_orderstatus") != "P")
    return rows.select("o_custkey", "o_orderkey")


def batch_summary(spark, d):
    return metrics.batch_summary(table(spark, d, "events"), by=["event_type"], ok=F.col("value") >= 10, seconds=F.floor(F.col("value") * 1000).cast("bigint"))


def progress_rate(spark, d):
    rows = metrics.progress(table(spark, d, "events"), run="user_id", ts="ts", event="event_id", total=F.lit(1000))
    return rows.select("event_id", F.col("done").cast("bigint").alias("done"), "elapsed_us", "per_minute")


def checkpoint_every_n(spark, d):
    return metrics.every_nth(table(spark, d, "events"), run="user_id", order=["ts", "event_id"], n=5).select("user_id", "event_id")


def latest_report(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.count("*").alias("events"))


def completion(spark, d):
    """The share of complete elements of each source, null-safe."""
    e = table(spark, d, "partial_elements").dropDuplicates(["element_id"])
    good = F.count(F.when(F.col("is_complete"), 1))
    return e.groupBy("source").agg(F.count("*").alias("elements"), F.round(F.coalesce(F.try_divide(good * 100, F.count("*")), F.lit(0.0)), 4).alias("percent"))


def safe_filenames(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", sinks.question_names(F.col("p_size"), F.col("p_name"), F.col("p_size"), F.col("p_type")).alias("filename"), sinks.chunk_names(F.col("p_size"), 4).alias("chunk_name"))


def prefix_strip(spark, d):
    code = F.concat(F.lit("Q"), F.col("p_partkey") % 20000, F.lit("_"), F.col("p_size"))
    return table(spark, d, "part").select("p_partkey", extract.strip_prefix(code).alias("code"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """One page for each nation: a section for each supplier of it, with two questions."""
    s = table(spark, d, "supplier")
    section = F.concat(
        F.lit('<h1 class="western"><font size="4">'), "s_name", F.lit("</font></h1><p>lead</p>"),
        F.lit('<p style="margin: 0; color: red" lang="en-US"><font color="#0070c0"><b>Q'), F.col("s_suppkey"), F.lit("</b> [YES_NO]: name &amp; place</font></p><p>===</p><p>first</p><p> </p>"),
        F.lit('<p width="3"><font color="#0070c0"><b>R'), F.col("s_suppkey"), F.lit("</b>: other</font></p><p>VARIABLES TABLE</p><table><tr><td><p><b>Q3_1</b></p></td><td>"), "s_name", F.lit("</td></tr></table>"),
    )
    parts = F.array_sort(F.collect_list(F.struct("s_suppkey", section.alias("h"))))
    body = F.array_join(F.transform(parts, lambda x: x["h"]), "\n")
    return s.groupBy(F.col("s_nationkey").alias("page_id")).agg(sinks.html_page(F.concat(F.lit("<p>before</p>"), body)).alias("html"))


def _nodes(spark, d):
    return html.nodes(_pages(spark, d))


def page_sections(spark, d):
    return html.sections(_nodes(spark, d)).select("page_id", F.col("section_no").cast("bigint").alias("section_no"), "section_title").distinct()


def page_questions(spark, d):
    q = html.questions(html.sections(_nodes(spark, d)))
    return html.question_parts(q).select("page_id", F.col("section_no").cast("bigint").alias("section_no"), F.col("question_no").cast("bigint").alias("question_no"), "code", "type", "label")


def section_mapping(spark, d):
    s = html.sections(_nodes(spark, d))
    m = html.mapping(s, html.questions(s))
    return m.select("page_id", F.col("section_no").cast("bigint").alias("section_no"), "section_title", "filename", "question_count", F.array_join(F.transform("questions", lambda x: x["filename"]), ";").alias("questions"))


def page_table_labels(spark, d):
    return html.table_labels(_nodes(spark, d)).groupBy("page_id", "label").agg(F.count("*").alias("tables"))


def attr_cleanup(spark, d):
    """What is left of the attributes, by tag."""
    n = html.clean_attributes(_nodes(spark, d)).select("page_id", "tag", F.explode("attrs").alias("attr", "value"))
    return n.filter("tag in ('h1', 'p')").groupBy("page_id", "tag", "attr", "value").agg(F.count("*").alias("n"))


def leftover_nodes(spark, d):
    """The body's own children that belong to no section."""
    n = _nodes(spark, d).filter("tag <> '#text' and depth = 2")
    used = html.sections(_nodes(spark, d))
    return html.leftover_nodes(n, used).select("page_id", "inner_text")


def legacy_page_chunks(spark, d):
    """The chunks of the legacy splitter, with the number of the body's children in each."""
    return html.legacy_chunks(_nodes(spark, d)).select("page_id", "chunk_no", "code", F.size("node_ids").cast("bigint").alias("nodes"))


def cleaned_pages(spark, d):
    """Question blocks and other blocks of the cleaned pages."""
    rows = html.clean_pages(_pages(spark, d))
    count = lambda p: F.regexp_count("cleaned", F.lit(p)).cast("bigint")
    return rows.select("page_id", "status", count('class="question"').alias("questions"), count("TABLE LABEL: VARIABLES TABLE").alias("labelled"), count("<font|Q3_1|<p></p>|<p> </p>").alias("left"))


def empty_paragraphs(spark, d):
    n = _nodes(spark, d)
    left = html.drop_empty_paragraphs(n)
    count = lambda df, name: df.filter("tag = 'p'").groupBy("page_id").agg(F.count("*").alias(name))
    return count(n, "before").join(count(left, "after"), "page_id")


def html_to_markdown(spark, d):
    return html.to_markdown(_pages(spark, d))


def mapping_json(spark, d):
    s = html.sections(_nodes(spark, d))
    return sinks.mapping_json(html.mapping(s, html.questions(s)))


def string_diff_stats(spark, d):
    a, b = _versions(spark, d)
    both = a.select("c_custkey", F.col("c_name").alias("a")).join(b.select("c_custkey", F.col("c_name").alias("b")), "c_custkey")
    return metrics.string_diff(both, key="c_custkey", a="a", b="b")


def domain_validation(spark, d):
    """The elements that can't be taken, with the reasons."""
    e = table(spark, d, "partial_elements").dropDuplicates(["element_id"]).select("element_id", F.struct("code", "label", F.coalesce("type", F.lit("CHOICE")).alias("type")).alias("e"))
    rows = e.select("element_id", F.explode(assemble.domain_errors(F.col("e"), extract.TYPES)).alias("error"))
    return rows


def normalized_names(spark, d):
    """Column names as the diff compares them, of the tables given."""
    rows = [(t, c, T.normal_name(f" {c}-(x) ")) for t in ("nation", "region") for c in table(spark, d, t).columns]
    return spark.createDataFrame(rows, "of string, name string, normal string")


_NAMES = (
    keyed_diff, diff_summary, diff_modified_only, renumber_positions, dedup_merge, anti_merge, merge_partials, mapping_lookup, leftover_rows, chunk_fold, conversation_fold, state_fold, section_tree_counts, chunk_reports, run_reports, merged_errors, last_errors, throttled_progress, checkpoint_summary, monitor_view, first_failure, batch_summary, progress_rate,
    checkpoint_every_n, latest_report, completion, safe_filenames, prefix_strip, page_sections, page_questions, section_mapping, page_table_labels, attr_cleanup, leftover_nodes, legacy_page_chunks, cleaned_pages,
    empty_paragraphs, html_to_markdown, mapping_json, string_diff_stats, domain_validation, normalized_names,
)
QUERIES = {f.__name__: f for f in _NAMES}

_VERSIONS = """
a as (select c_custkey, c_name, c_nationkey, c_mktsegment from customer),
b as (select c_custkey, case when c_custkey % 7 = 0 then lower(c_name) else c_name end as c_name, case when c_custkey % 13 <> 0 then c_nationkey end as c_nationkey, case when c_custkey % 10 = 1 then 'NEW' else c_mktsegment end as c_mktsegment from a where c_custkey % 11 <> 3
      union all select c_custkey + 10000000, c_name, c_nationkey, c_mktsegment from a where c_custkey % 50 = 0),
j as (select coalesce(a.c_custkey, b.c_custkey) as c_custkey, a.c_custkey is null as added, b.c_custkey is null as removed,
      concat_ws(chr(10), case when coalesce(a.c_mktsegment, '') <> coalesce(b.c_mktsegment, '') then 'c_mktsegment: ' || coalesce(a.c_mktsegment, '') || ' => ' || coalesce(b.c_mktsegment, '') end,
        case when coalesce(a.c_name, '') <> coalesce(b.c_name, '') then 'c_name: ' || coalesce(a.c_name, '') || ' => ' || coalesce(b.c_name, '') end,
        case when coalesce(a.c_nationkey::varchar, '') <> coalesce(b.c_nationkey::varchar, '') then 'c_nationkey: ' || coalesce(a.c_nationkey::varchar, '') || ' => ' || coalesce(b.c_nationkey::varchar, '') end) as changes
      from a full join b on a.c_custkey is not distinct from b.c_custkey),
df as (select c_custkey, case when added then 'ADDED' when removed then 'REMOVED' else nullif(changes, '') end as diff from j)
"""
_SUPP = "(select s_nationkey as page_id, s_suppkey, s_name, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as section_no from supplier)"

_EVENTS = """
ev as (select cast(user_id as varchar) as run, ts, ['chunk_start', 'analysis', 'extraction', 'chunk_done', 'phase', 'warning'][event_id % 6 + 1] as event, event_id % 7 as chunk_index, floor(value) as ms,
  case when event_id % 5 = 0 then 'e' || (event_id % 3) end as message, cast(length(props) as bigint) as input_tokens, event_id % 10 as output_tokens, event_id from events),
rep as (select run, count(*) filter (event = 'chunk_done') as chunks_completed, count(*) filter (event = 'chunk_done' and message is not null) as chunks_failed,
  coalesce(list_sort(list(distinct message) filter (event = 'chunk_done' and message is not null)), []) as errors, coalesce(list_sort(list(distinct message) filter (event = 'warning' and message is not null)), []) as warnings,
  cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(output_tokens) as bigint) as output_tokens from ev group by run)
"""

SQL = {
    "chunk_reports": f"with {_EVENTS} select run, chunk_index, epoch_us(min(ts) filter (event = 'chunk_start')) as started, epoch_us(max(ts) filter (event = 'chunk_done')) as done, sum(ms) filter (event in ('analysis', 'extraction')) as ms from ev group by run, chunk_index",
    "run_reports": f"with {_EVENTS} select run, chunks_completed, chunks_failed, array_to_string(errors, ';') as errors, array_to_string(warnings, ';') as warnings, input_tokens, output_tokens from rep",
    "merged_errors": f"with {_EVENTS} select right(run, 1) as digit, coalesce(array_to_string(list_sort(list_distinct(flatten(list(errors)))), ';'), '') as errors, coalesce(array_to_string(list_sort(list_distinct(flatten(list(warnings)))), ';'), '') as warnings from rep group by 1",
    "last_errors": f"with {_EVENTS}, n as (select *, row_number() over (partition by run order by ts desc, event_id desc) as rn from ev where message is not null) select run, string_agg(message, ';' order by rn desc) as messages from n where rn <= 3 group by run",
    "throttled_progress": f"with {_EVENTS} select run, event_id from (select *, row_number() over (partition by run, floor(epoch_us(ts) / 3600000000) order by ts, event_id) as rn from ev) where rn = 1",
    "checkpoint_summary": "select session_id, count(*) as checkpoints, count(*) filter (cp_type = 'section') as section_checkpoints, count(*) filter (cp_type = 'element') as element_checkpoints, count(*) filter (cp_type = 'partial_state') as partial_state_checkpoints from (select checkpoint_id, any_value(session_id) as session_id, any_value(cp_type) as cp_type from section_checkpoints group by checkpoint_id) group by session_id",
    "monitor_view": f"with {_EVENTS} select run, round(chunks_completed * 100 / 20, 1) as percent, array_to_string(errors[1:5], ';') as errors, cast(greatest(len(errors) - 5, 0) as bigint) as more_errors from rep",
    "first_failure": "select o_custkey, o_orderkey from (select *, coalesce(bool_or(o_orderstatus = 'P') over (partition by o_custkey order by o_orderdate, o_orderkey rows between unbounded preceding and 1 preceding), false) as broken from orders) where not broken",
    "keyed_diff": f"with {_VERSIONS} select c_custkey, diff from df",
    "diff_summary": f"with {_VERSIONS} select count(*) as total, count(case when diff = 'ADDED' then 1 end) as added, count(case when diff = 'REMOVED' then 1 end) as removed, count(case when diff not in ('ADDED', 'REMOVED') then 1 end) as modified, count(case when diff is null then 1 end) as unchanged from df",
    "diff_modified_only": f"with {_VERSIONS} select c_custkey, regexp_replace(diff, '(?m)^(\\w+): (.*) => (.*)$', '🔄 \\1:' || chr(10) || '  \\2 → \\3', 'g') as changes, 'yellow' as style from df where diff not in ('ADDED', 'REMOVED')",
    "renumber_positions": "select element_id, section_id, row_number() over (partition by section_id order by position nulls last, element_id) as new_position from (select element_id, any_value(section_id) as section_id, any_value(position) as position from partial_elements group by element_id) where section_id is not null",
    "dedup_merge": "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from orders where o_custkey is not null) where rn = 1",
    "anti_merge": "with old as (select c_nationkey as nation, c_custkey as id from customer where c_nationkey < 12) select * from old union all select s_nationkey, s_suppkey from supplier where s_nationkey not in (select nation from old)",
    "merge_partials": "select user_id, arg_max(event_type, event_id) filter (value > 50) as kind, arg_max(value, event_id) filter (value is not null) as value from events group by user_id",
    "mapping_lookup": "select conversion_id, c.profile_name, cast(max_chars as bigint) as max_chars, max_chars is null as missing from (select conversion_id, any_value(profile_name) as profile_name from conversion_results group by conversion_id) c left join split_profiles p on c.profile_name = p.profile_name",
    "leftover_rows": "select distinct chunk_id from chunk_results c where not exists (select 1 from conversion_results r where r.conversion_id = c.conversion_id)",
    "chunk_fold": "select chunk_id, lag(chunk_type) over w as previous, row_number() over w as place from (select chunk_id, any_value(conversion_id) as conversion_id, any_value(chunk_index) as chunk_index, any_value(chunk_type) as chunk_type from chunk_results where conversion_id is not null group by chunk_id) window w as (partition by conversion_id order by chunk_index, chunk_id)",
    "conversation_fold": """with one as (select chunk_id, any_value(conversion_id) as conversion_id, any_value(chunk_index) as chunk_index, any_value(chunk_type) as chunk_type, any_value(partial_content) as partial_content, coalesce(any_value(requires_continuation), false) as goes_on, any_value(error) as error from chunk_results where conversion_id is not null group by chunk_id),
      ok as (select *, sum(case when goes_on then 0 else 1 end) over w as run, lag(chunk_type) over w as previous_type from one where coalesce(error, '') = '' window w as (partition by conversion_id order by chunk_index, chunk_id))
      select chunk_id, previous_type, md5(case when run = 0 then chr(10) else '' end || string_agg(coalesce(case when goes_on then chunk_type else partial_content end, ''), chr(10)) over (partition by conversion_id, run order by chunk_index, chunk_id)) as digest from ok""",
    "section_tree_counts": """with one as (select section_id, any_value(survey_code) as survey_code, any_value(elements) as elements from partial_sections group by section_id),
      e as (select section_id, unnest(elements) as x from one)
      select survey_code, count(*) as sections, cast(sum(coalesce(n, 0)) as bigint) as elements, cast(sum(coalesce(v, 0)) as bigint) as variables, cast(sum(coalesce(c, 0)) as bigint) as columns
      from one left join (select section_id, count(*) as n, sum(coalesce(len(x.variables), 0)) as v, sum(coalesce(len(x.columns), 0)) as c from e where x is not null group by section_id) using (section_id) group by survey_code""",
    "batch_summary": "select event_type, count(*) as files, count(case when value >= 10 then 1 end) as succeeded, count(*) - count(case when value >= 10 then 1 end) as failed, round(count(case when value >= 10 then 1 end) * 100 / count(*), 4) as success_rate, cast(sum(floor(value * 1000)) as bigint) as total_seconds, cast(min(floor(value * 1000)) as bigint) as least_seconds, cast(max(floor(value * 1000)) as bigint) as most_seconds from events group by event_type",
    "progress_rate": "select event_id, done, elapsed_us, case when elapsed_us > 0 then round(done * 60e6 / elapsed_us, 6) end as per_minute from (select event_id, count(*) over w as done, cast(epoch_us(ts) - min(epoch_us(ts)) over w as bigint) as elapsed_us from events window w as (partition by user_id order by ts, event_id rows between unbounded preceding and current row))",
    "checkpoint_every_n": "select user_id, event_id from (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn % 5 = 0",
    "latest_report": "select user_id, arg_max(event_id, {'ts': ts, 'e': event_id}) as event_id, count(*) as events from events group by user_id",
    "completion": "select source, count(*) as elements, round(count(case when c then 1 end) * 100 / count(*), 4) as percent from (select element_id, any_value(source) as source, any_value(is_complete) as c from partial_elements group by element_id) group by source",
    "safe_filenames": "select p_partkey, format('{:03d}_{}__{:03d}_{}.html', p_size, coalesce(nullif(regexp_replace(p_name, '[^\\p{L}\\p{N}_\\-.]', '_', 'g'), ''), 'section'), p_size, coalesce(nullif(regexp_replace(p_type, '[^\\p{L}\\p{N}_\\-.]', '_', 'g'), ''), 'chunk')) as filename, format('chunk_{:04d}.md', p_size) as chunk_name from part",
    "prefix_strip": "select p_partkey, case when p_partkey % 20000 < 10000 then cast(p_size as varchar) else 'Q' || (p_partkey % 20000) || '_' || p_size end as code from part",
    "page_sections": f"select page_id, section_no, s_name as section_title from {_SUPP}",
    "page_questions": f"select page_id, section_no, 0 as question_no, 'Q' || s_suppkey as code, 'YES_NO' as type, 'name & place' as label from {_SUPP} union all select page_id, section_no, 1, 'R' || s_suppkey, 'CHOICE', 'other' || chr(10) || 'VARIABLES TABLE' || chr(10) || 'Q3_1' || chr(10) || 'Q3_1' || chr(10) || s_name from {_SUPP}".replace("section_no, 0 as question_no", "section_no, cast(0 as bigint) as question_no"),
    "section_mapping": f"select page_id, section_no, s_name as section_title, format('{{:03d}}_{{}}.html', section_no, regexp_replace(s_name, '[^\\p{{L}}\\p{{N}}_\\-.]', '_', 'g')) as filename, cast(2 as bigint) as question_count, format('{{:03d}}_{{}}__000_question_0.html;{{:03d}}_{{}}__001_question_1.html', section_no, regexp_replace(s_name, '[^\\p{{L}}\\p{{N}}_\\-.]', '_', 'g'), section_no, regexp_replace(s_name, '[^\\p{{L}}\\p{{N}}_\\-.]', '_', 'g')) as questions from {_SUPP}",
    "page_table_labels": "select s_nationkey as page_id, 'VARIABLES TABLE' as label, count(*) as tables from supplier group by s_nationkey",
    "attr_cleanup": "select s_nationkey as page_id, 'p' as tag, 'style' as attr, 'color: red' as value, count(*) as n from supplier group by s_nationkey",
    "leftover_nodes": "select distinct s_nationkey as page_id, 'before' as inner_text from supplier",
    "empty_paragraphs": "select s_nationkey as page_id, 1 + 8 * count(*) as before, 1 + 7 * count(*) as after from supplier group by s_nationkey",
    "domain_validation": "with e as (select element_id, any_value(code) as code, any_value(label) as label, coalesce(any_value(type), 'CHOICE') as type from partial_elements group by element_id) select element_id, 'code is empty' as error from e where coalesce(trim(code), '') = '' union all select element_id, 'label is empty' from e where coalesce(trim(label), '') = '' union all select element_id, 'unknown type ' || type from e where type not in ('CHOICE', 'OPEN_END', 'BREAK_PAGE', 'SCREENER', 'COUNTRY_DROPDOWN', 'AGE_ORI', 'S105_RATING_FAMILIARITY', 'GEOGRAPHIC_AREA_REGION', 'PULSE_FILTER', 'YES_NO', 'EDUCATION_STANDARD', 'INCOME_STANDARD')",
}
