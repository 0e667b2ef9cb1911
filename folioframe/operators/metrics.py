"""Statistics of splits, conversions and runs; progress, merging of reports, round-trip checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.functions.text import line_count, word_count


def split_stats(chunks: DataFrame, by: list[str]) -> DataFrame:
    """chunks, total, least, most and mean size (rounded down) of each group."""
    n = F.length("chunk")
    return chunks.groupBy(*by).agg(F.count("*").alias("total_chunks"), F.sum(n).cast("bigint").alias("total_chars"), F.min(n).cast("bigint").alias("min_size"), F.max(n).cast("bigint").alias("max_size"), F.floor(F.sum(n) / F.count("*")).cast("bigint").alias("average_size"))


def debug_stats(chunks: DataFrame, by: list[str]) -> DataFrame:
    """Sizes of the chunks of each group, and how many have a section, an element, a table or a continuation marker."""
    from folioframe.operators.structure import STRICT_ELEMENT, STRICT_SECTION

    c = F.col("chunk")
    n = F.length(c).cast("bigint")
    some = {"sections": c.rlike(STRICT_SECTION), "elements": c.rlike(STRICT_ELEMENT), "tables": F.contains(c, F.lit("|")), "markers": F.contains(c, F.lit("[")) & F.contains(c, F.lit("CONTINUATION"))}
    return chunks.groupBy(*by).agg(F.count("*").alias("chunks"), F.avg(n).alias("average_size"), F.min(n).alias("min_size"), F.max(n).alias("max_size"), *[F.count_if(on).alias(f"with_{k}") for k, on in some.items()])


def conversion_stats(df: DataFrame, *, key: str, text: str) -> DataFrame:
    c = F.col(text)
    return df.select(key, F.length(c).cast("bigint").alias("markdown_length"), line_count(c).alias("markdown_lines"), word_count(c).alias("markdown_words"))


def validate_stats(df: DataFrame, *, key: str, text: str, chunks: Column | None = None) -> DataFrame:
    """Counts of headers, bold element starts and table rows and the tokens they'd take; with ``chunks`` their sizes and the minutes."""
    c = F.col(text)
    count = lambda p: F.regexp_count(c, F.lit(p)).cast("bigint")
    out = [key, count(r"(?md)^#\s+.*$").alias("headers"), count(r"(?md)^\*\*.*\*\*").alias("bold_starts"), count(r"(?md)^\|.*\|.*\|").alias("table_rows"), (F.length(c) * 0.75).alias("tokens")]
    if chunks is not None:
        sizes = F.transform(chunks, lambda x: F.length(x).cast("bigint"))
        n = F.size(chunks).cast("bigint")
        total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda s, x: s + x)
        out += [n.alias("chunks"), F.try_divide(total, n).alias("average_size"), F.array_min(sizes).alias("min_size"), F.array_max(sizes).alias("max_size"), (n / 6).alias("minutes")]
    return df.select(*out)


def batch_summary(runs: DataFrame, *, by: list[str], ok: Column, seconds: Column) -> DataFrame:
    n = F.count("*")
    good = F.count(F.when(ok, 1))
    return runs.groupBy(*by).agg(n.alias("files"), good.alias("succeeded"), (n - good).alias("failed"), F.round(F.try_divide(good * 100, n), 4).alias("success_rate"), F.sum(seconds).alias("total_seconds"), F.min(seconds).alias("least_seconds"), F.max(seconds).alias("most_seconds"))


def progress(events: DataFrame, *, run: str, ts: str, event: str, total: Column) -> DataFrame:
    """Events done so far, seconds since the run's first, the rate a minute and the seconds left at that rate."""
    so_far = Window.partitionBy(run).orderBy(ts, event).rowsBetween(Window.unboundedPreceding, 0)
    rows = events.withColumn("done", F.count("*").over(so_far)).withColumn("elapsed_us", F.unix_micros(F.col(ts).cast("timestamp")) - F.min(F.unix_micros(F.col(ts).cast("timestamp"))).over(so_far))
    rate = F.when(F.col("elapsed_us") > 0, F.round(F.col("done") * 60e6 / F.col("elapsed_us"), 6))
    left = F.greatest(total - F.col("done"), F.lit(0))
    return rows.withColumn("per_minute", rate).withColumn("seconds_left", F.when(rate > 0, F.round(left * 60 / rate, 4)))


def every_nth(rows: DataFrame, *, run: str, order: list[str], n: int) -> DataFrame:
    """The rows at which a checkpoint is due."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(run).orderBy(*order))).filter(F.col("rn") % n == 0)


def merge_reports(rows: DataFrame, *, code: str, order: list[Column]) -> DataFrame:
    """The first row of each code; rows without a code are dropped, as they can't be told apart."""
    first = Window.partitionBy(code).orderBy(*order)
    return rows.filter(F.col(code).isNotNull()).withColumn("rn", F.row_number().over(first)).filter("rn = 1").drop("rn")


def running_offsets(rows: DataFrame, *, by: list[str], order: list[str], size: Column) -> DataFrame:
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint"))


def reassemble(chunks: DataFrame, by: list[str], *, separator: str = "") -> DataFrame:
    """The bodies of the chunks of each group in order, one after another."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", "chunk")))
    return chunks.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["chunk"]), separator).alias("text"))


def round_trip(original: DataFrame, rebuilt: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, equal, equal_but_white_space, lost_chars)."""
    r = rebuilt.select(F.col(key), F.col("text").alias("rebuilt"))
    bare = lambda c: F.regexp_replace(c, r"[\s\p{Z}]+", "")
    o = F.col(text)
    return original.select(key, text).join(r, key, "left").select(key, F.coalesce(o == F.col("rebuilt"), F.lit(False)).alias("equal"), F.coalesce(bare(o) == bare(F.col("rebuilt")), F.lit(False)).alias("equal_but_white_space"), F.greatest(F.length(bare(o)) - F.coalesce(F.length(bare(F.col("rebuilt"))), F.lit(0)), F.lit(0)).cast("bigint").alias("lost_chars"))


def diff_counts(original: str, other: str) -> tuple[int, int, int, float]:
    """Characters of the original that have no counterpart: all, white space, other, and the share of white space in percent."""
    import difflib

    gone = "".join(original[i:j] for tag, i, j, _, _ in difflib.SequenceMatcher(None, original, other).get_opcodes() if tag != "equal")
    white = sum(map(str.isspace, gone))
    return len(gone), white, len(gone) - white, 100 * white / len(gone) if gone else 0.0


def missing_windows(original: str, other: str, width: int = 300, context: int = 100) -> list[str]:
    """The regions of the original of which a window of ``width`` characters isn't in the other text.

    Windows follow each other where one is missing and overlap by half where it is
    not; a region is its window with ``context`` characters on both sides, and one
    that another region contains isn't repeated.
    """
    regions: list[str] = []
    at = 0
    while at < len(original):
        found = original[at : at + width] in other
        if not found:
            region = original[max(0, at - context) : at + width + context]
            if not any(region in r for r in regions):
                regions.append(region)
        at += width // 2 if found else width
    return regions


def _compared(df: DataFrame, key: str, a: str, b: str, schema: str, rows_of) -> DataFrame:
    """(key, ...) of rows_of(a, b) for each pair of texts; null counts as empty."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            found = [rows_of(x or "", y or "") for x, y in zip(t.column(1).to_pylist(), t.column(2).to_pylist())]
            take = pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int32())
            out = pd.DataFrame([r for rows in found for r in rows], columns=names)
            yield pa.RecordBatch.from_arrays([t.column(0).take(take), *(pa.array(out[n].tolist(), types[n]) for n in names)], names=["k", *names])

    names = [f.split()[0] for f in schema.split(", ")]
    types = {n: {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}[f.split()[1]] for n, f in zip(names, schema.split(", "))}
    rows = df.select(F.col(key).alias("k"), F.col(a).alias("a"), F.col(b).alias("b"))
    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, {schema}").withColumnRenamed("k", key)


def string_diff(df: DataFrame, *, key: str, a: str, b: str) -> DataFrame:
    """(key, changed, white_space, other, white_space_percent), see :func:`diff_counts`."""
    return _compared(df, key, a, b, "changed bigint, white_space bigint, other bigint, white_space_percent double", lambda x, y: [diff_counts(x, y)])


def missing_regions(df: DataFrame, *, key: str, a: str, b: str, width: int = 300) -> DataFrame:
    """(key, region_no, region), see :func:`missing_windows`."""
    return _compared(df, key, a, b, "region_no bigint, region string", lambda x, y: list(enumerate(missing_windows(x, y, width))))
