"""Text expressions with the semantics of Python's ``str`` and ``re``, as native columns.

Patterns are Java regular expressions: ``(?d)`` makes the line feed the only line
end and ``(?m)`` anchors at lines, as in Python. Offsets count code points.
Null in, null out, unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that Python's str.strip() takes for white space.
WHITE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{WHITE}+|{WHITE}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WHITE}+\z", "")


def rstrip_lines(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, "\n"), rstrip), "\n")


def words(c: Column) -> Column:
    """As ``str.split()``."""
    return F.filter(F.split(c, f"{WHITE}+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c)).cast("bigint")


def line_count(c: Column) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def safe_label(c: Column, default: str) -> Column:
    """A name fit for a file: everything but letters, digits, ``_``, ``-`` and ``.`` becomes ``_``."""
    return F.coalesce(F.nullif(F.regexp_replace(c, r"[^\p{L}\p{N}_\-.]", "_"), F.lit("")), F.lit(default))


def rfind(c: Column, sub: str) -> Column:
    """Place of the last occurrence from 0, -1 without one."""
    back = F.locate(sub[::-1], F.reverse(c))
    return F.when(back == 0, -1).otherwise(F.length(c) - back - len(sub) + 1)


def match_rows(c: Column, pattern: str, groups: int = 0) -> Column:
    """array<struct<ord, start, end, text, g1..>> of all matches, as ``re.finditer`` gives them.

    The pieces between the matches and the matches themselves tile the text, so
    running sums of their lengths are the offsets.
    """
    whole = F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
    pieces = F.split(c, pattern, -1)
    parts = [F.regexp_extract_all(c, F.lit(pattern), F.lit(g)).alias(f"m{g}") for g in range(1, groups + 1)]
    zipped = F.arrays_zip(whole.alias("text"), F.slice(pieces, 1, F.size(whole)).alias("before"), *parts)
    row = lambda at, n, m: F.struct(
        n.alias("ord"),
        (at + F.length(m["before"])).alias("start"),
        (at + F.length(m["before"]) + F.length(m["text"])).alias("end"),
        m["text"].alias("text"),
        *[F.nullif(m[f"m{g}"], F.lit("")).alias(f"g{g}") for g in range(1, groups + 1)],
    )
    none = F.array().cast("array<struct<ord:int,start:int,end:int,text:string" + "".join(f",g{g}:string" for g in range(1, groups + 1)) + ">>")
    folded = F.aggregate(
        zipped,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), none.alias("rows")),
        lambda s, m: F.struct(
            (s["at"] + F.length(m["before"]) + F.length(m["text"])).alias("at"),
            (s["n"] + 1).alias("n"),
            F.array_append(s["rows"], row(s["at"], s["n"], m)).alias("rows"),
        ),
    )
    return folded["rows"]


def render(template: str, values: dict[str, Column]) -> Column:
    """``[[name]]`` in a template replaced by the columns; null counts as empty."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"[[{name}]]"), F.coalesce(strip(value), F.lit("")))
    return out


def normal_name(name: str) -> str:
    """A column name: stripped, everything but ASCII letters and digits ``_``, lower case."""
    return "".join(ch if ch.isascii() and ch.isalnum() else "_" for ch in name.strip()).lower()


def plain_text(html: Column) -> Column:
    """The text of HTML without tags, its character references decoded, outer white space stripped."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", "")
    for ref, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(ref), F.lit(ch))
    return strip(t)
