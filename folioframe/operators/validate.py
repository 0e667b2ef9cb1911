"""Validation of JSON text against the subset of Draft-7 that survey schemas use, with errors as rows.

Keywords: type (also unions), required, properties, items, enum,
additionalProperties, $ref with definitions. An instance is valid iff it has no
error. Text that isn't JSON has one error at the root; null text has none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
}


def errors_of(value, schema: dict, root: dict | None = None, path: str = "$") -> list[tuple[str, str]]:
    """(path, message) of every violation."""
    root = schema if root is None else root
    if "$ref" in schema:
        target = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            target = target[part]
        return errors_of(value, target, root, path)
    out: list[tuple[str, str]] = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_IS[k](value) for k in kinds):
            return [(path, f"{json.dumps(value, ensure_ascii=False)[:60]} is not of type {', '.join(kinds)}")]
    if "enum" in schema and value not in schema["enum"]:
        out.append((path, f"{json.dumps(value, ensure_ascii=False)[:60]} is not one of the allowed values"))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [(path, f"{k} is required") for k in schema.get("required", []) if k not in value]
        extra = schema.get("additionalProperties", True)
        for k, v in value.items():
            if k in known:
                out += errors_of(v, known[k], root, f"{path}.{k}")
            elif extra is False:
                out.append((path, f"{k} is not allowed"))
            elif isinstance(extra, dict):
                out += errors_of(v, extra, root, f"{path}.{k}")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, v in enumerate(value):
            out += errors_of(v, schema["items"], root, f"{path}[{i}]")
    return out


def validate_json(df: DataFrame, schema: dict, *, key: str, text: str) -> DataFrame:
    """(key, path, message), sorted by path within each instance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["t"]):
                if t is None:
                    continue
                try:
                    found = errors_of(json.loads(t), schema)
                except ValueError as e:
                    found = [("$", f"not JSON: {e}")]
                rows += [(k, p, m) for p, m in sorted(found)]
            yield pd.DataFrame(rows, columns=["k", "path", "message"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInPandas(run, f"k {rows.schema['k'].dataType.simpleString()}, path string, message string").withColumnRenamed("k", key)


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def without_fences(text: Column) -> Column:
    """Model output without the lines that fence its JSON."""
    return F.regexp_replace(text, r"(?m)^\s*```.*$\n?", "")


def combine_sections(df: DataFrame, *, key: str, text: str) -> DataFrame:
    """(key, ord, section): the entries of ``sections`` of every file, files without them or without valid JSON left out."""
    v = F.try_parse_json(without_fences(F.col(text)))
    return df.select(key, F.posexplode(F.try_variant_get(v, "$.sections", "array<variant>")).alias("ord", "section"))
