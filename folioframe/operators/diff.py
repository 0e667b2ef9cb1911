"""Keyed difference of two tables, null-safe, with a row for every key pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import normal_name


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normal_name(c) for c in df.columns])


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return sorted(set(a.columns) & set(b.columns))


def keyed_diff(source: DataFrame, compare: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(keys, diff, c_source, c_compare ...): ADDED, REMOVED, the changes as ``c: a => b`` lines, or null where nothing changed.

    A null key matches a null key, repeated keys multiply, null and empty values
    are equal. Only the columns both tables have are compared.
    """
    both = common_columns(source, compare)
    missing = [k for k in keys if k not in both]
    if missing or not keys:
        raise ValueError(f"no common key column: {missing or keys}")
    values = [c for c in (columns or both) if c not in keys]
    a = source.select(F.lit(True).alias("in_source"), *[F.col(k).alias(f"k_{k}_a") for k in keys], *[F.col(c).alias(f"{c}_source") for c in values])
    b = compare.select(F.lit(True).alias("in_compare"), *[F.col(k).alias(f"k_{k}_b") for k in keys], *[F.col(c).alias(f"{c}_compare") for c in values])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"k_{k}_a").eqNullSafe(F.col(f"k_{k}_b"))
    joined = a.join(b, on, "full")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    changes = [F.when(text(f"{c}_source") != text(f"{c}_compare"), F.concat(F.lit(f"{c}: "), text(f"{c}_source"), F.lit(" => "), text(f"{c}_compare"))) for c in values]
    status = F.when(F.col("in_source").isNull(), "ADDED").when(F.col("in_compare").isNull(), "REMOVED").otherwise(F.nullif(F.concat_ws("\n", *changes) if changes else F.lit(""), F.lit("")))
    cols = [c for v in values for c in (f"{v}_source", f"{v}_compare")]
    return joined.select(*[F.coalesce(f"k_{k}_a", f"k_{k}_b").alias(k) for k in keys], status.alias("diff"), *cols)


def status(diff: Column) -> Column:
    return F.when(diff.isNull(), "unchanged").when(diff.isin("ADDED", "REMOVED"), F.lower(diff)).otherwise("modified")


def only(diffs: DataFrame, kind: str) -> DataFrame:
    """``all``, ``added``, ``removed`` or ``modified``; ``all`` leaves unchanged rows in."""
    return diffs if kind == "all" else diffs.filter(status(F.col("diff")) == kind)


def summary(diffs: DataFrame) -> DataFrame:
    s = status(F.col("diff"))
    return diffs.agg(F.count("*").alias("total"), *[F.count(F.when(s == k, 1)).alias(k) for k in ("added", "removed", "modified", "unchanged")])


def pretty(diff: Column) -> Column:
    """Each change with its column on a line of its own and an arrow between the values."""
    return F.array_join(F.transform(F.split(diff, "\n"), lambda x: F.regexp_replace(x, r"^(\w+): (.*) => (.*)$", "🔄 $1:\n  $2 → $3")), "\n")
