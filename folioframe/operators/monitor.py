"""Monitoring of runs: reports put together from event rows, their merging, and what is shown of them.

An event is a row (run, ts, event, chunk_index, kind, confidence, ms, message,
input_tokens, output_tokens). Events are ``start``, ``phase`` (its name in
``kind``), ``chunk_start``, ``analysis``, ``extraction``, ``chunk_done`` (an error in
``message``), ``error``, ``warning``. Reports are aggregates over them, so a report
can be taken at any time, in batch or from a stream. Null messages are no errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EVENT = "run string, ts timestamp, event string, chunk_index bigint, kind string, confidence double, ms double, message string, input_tokens bigint, output_tokens bigint"
REPORT = "run string, phase string, total_chunks bigint, chunks_completed bigint, sections bigint, elements bigint, errors array<string>, warnings array<string>, last_update timestamp"


def initial_report(spark: SparkSession, run: str, total: int) -> DataFrame:
    """The report of a run that has done nothing yet."""
    row = spark.createDataFrame([(run, "initializing", total, 0, 0, 0, [], [])], ", ".join(REPORT.split(", ")[:-1]))
    return row.withColumn("last_update", F.current_timestamp())


def chunk_reports(events: DataFrame) -> DataFrame:
    """One row for each chunk: when it started and ended, its kind, confidence, time and error."""
    at = lambda e: F.col("event") == e
    last = lambda c, e: F.max_by(c, F.when(at(e), F.col("ts"))).alias(c)
    rows = events.filter("chunk_index is not null").groupBy("run", "chunk_index")
    return rows.agg(
        F.min(F.when(at("chunk_start"), F.col("ts"))).alias("started"),
        F.max(F.when(at("chunk_done"), F.col("ts"))).alias("done"),
        last("kind", "analysis"),
        last("confidence", "analysis"),
        F.sum(F.when(at("analysis") | at("extraction"), F.col("ms"))).alias("ms"),
        last("message", "chunk_done"),
    )


def run_reports(events: DataFrame) -> DataFrame:
    """One row for each run: its phase, chunks done and failed, distinct errors and warnings in order, tokens, last update."""
    at = lambda e: F.col("event") == e
    failed = at("error") | (at("chunk_done") & F.col("message").isNotNull())
    distinct = lambda on: F.array_sort(F.collect_set(F.when(on, F.col("message"))))
    return events.groupBy("run").agg(
        F.coalesce(F.max_by("kind", F.when(at("phase"), F.col("ts"))), F.lit("initializing")).alias("phase"),
        F.count_if(at("chunk_done")).alias("chunks_completed"),
        F.count_if(at("chunk_done") & F.col("message").isNotNull()).alias("chunks_failed"),
        distinct(failed).alias("errors"),
        distinct(at("warning")).alias("warnings"),
        *token_totals(),
        F.max("ts").alias("last_update"),
    )


def token_totals() -> list[Column]:
    """The sums of tokens in and out; null counts as none."""
    return [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("input_tokens", "output_tokens")]


def merge_errors(reports: DataFrame, by: list[str], errors: str = "errors", warnings: str = "warnings") -> DataFrame:
    """The distinct errors and warnings of all reports of a group, sorted."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce(c, F.array().cast("array<string>"))))))
    return reports.groupBy(*by).agg(union(errors).alias(errors), union(warnings).alias(warnings))


def last_messages(rows: DataFrame, by: list[str], order: list[str], message: str, n: int = 3) -> DataFrame:
    """(by, messages): the last ``n`` messages of each group in their order, fewer where there are fewer."""
    back = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    kept = rows.filter(F.col(message).isNotNull()).withColumn("rn", F.row_number().over(back)).filter(F.col("rn") <= n)
    return kept.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rn")).alias("o"), F.col(message).alias("m")))), lambda x: x["m"]).alias("messages"))


def throttled(events: DataFrame, *, run: str, ts: str, seconds: int, tie: str) -> DataFrame:
    """The first event of each interval of a run, as a display that is renewed at most so often shows them."""
    slot = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000))
    first = Window.partitionBy(run, "slot").orderBy(ts, tie)
    return events.withColumn("slot", slot).withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("slot", "rn")


def checkpoint_summary(checkpoints: DataFrame, *, session: str = "session_id", kind: str = "cp_type", ts: str = "saved_at") -> DataFrame:
    """One row for each session, the newest first: how many checkpoints of each type, and its last update."""
    count = lambda k: F.count_if(F.col(kind) == k).alias(f"{k}_checkpoints")
    return checkpoints.groupBy(session).agg(F.count("*").alias("checkpoints"), count("section"), count("element"), count("partial_state"), F.max(ts).alias("last_updated")).orderBy(F.desc("last_updated"), session)


def monitor_view(reports: DataFrame, total: Column, shown: int = 5) -> DataFrame:
    """What a monitor shows of each run: phase, percentage, the first errors and warnings and how many more there are."""
    percent = F.round(F.coalesce(F.try_divide(F.col("chunks_completed") * 100, total), F.lit(0.0)), 1)
    some = lambda c: [F.slice(c, 1, shown).alias(c), F.greatest(F.size(c) - shown, F.lit(0)).alias(f"more_{c}")]
    return reports.select("run", "phase", percent.alias("percent"), *some("errors"), *some("warnings"))


def load_reports(spark: SparkSession, path: str) -> DataFrame:
    """Reports as :func:`folioframe.sources.sinks.write_json` keeps them; a broken line has all fields null."""
    return spark.read.schema(REPORT).json(path)


def stop_at_first_failure(rows: DataFrame, *, batch: str, order: list[str], ok: Column, go_on: bool = False) -> DataFrame:
    """The files of a batch that are processed: up to and with the first failure, or all of them."""
    if go_on:
        return rows
    before = Window.partitionBy(batch).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("broken", F.coalesce(F.max(~ok).over(before), F.lit(False))).filter("not broken").drop("broken")
