"""Pieces of DuckDB SQL that several comparison queries share."""

from __future__ import annotations

#: white space as Python's str.strip() has it, in RE2
WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WHITE}+|{WHITE}+\z', '', 'g')"


def kept(chunks: str) -> str:
    return f"list_filter(list_transform({chunks}, lambda x: {strip('x')}), lambda x: x <> '')"


def unnested(chunks: str, source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """A subquery (key, chunk_index, chunk) of the list expression over the non-null texts."""
    return f"(select {key}, cast(generate_subscripts(cs, 1) - 1 as bigint) as chunk_index, unnest(cs) as chunk from (select {key}, {chunks} as cs from {source} where {text} is not null))"


DELIMITER_CHUNKS = kept(r"string_split_regex(text, '\\\*\\\*\\\*')")
CHUNKS = unnested(DELIMITER_CHUNKS)
LINES = "(select doc_id, chunk_index, cast(generate_subscripts(ls, 1) - 1 as bigint) as line_no, unnest(ls) as line from (select doc_id, chunk_index, string_split(chunk, chr(10)) as ls from chunks))"


def count(x: str, pattern: str) -> str:
    return f"cast(len(regexp_extract_all({x}, '{pattern}')) as bigint)"


def matches(source: str, keys: str, text: str, pattern: str, groups: int) -> str:
    """A subquery (keys, ord, start, stop, m, g1..) of all matches with their offsets."""
    got = ", ".join([f"regexp_extract_all({text}, '({pattern})', 1) as ms", f"string_split_regex({text}, '{pattern}') as ps"] + [f"regexp_extract_all({text}, '{pattern}', {g}) as gs{g}" for g in range(1, groups + 1)])
    rows = ", ".join([f"nullif(gs{g}[k], '') as g{g}" for g in range(1, groups + 1)])
    start = "coalesce(list_sum(list_transform(ps[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:k-1], lambda x: length(x))), 0)"
    return f"(select {keys}, cast(k - 1 as bigint) as ord, cast({start} as bigint) as start, cast({start} + length(ms[k]) as bigint) as stop, ms[k] as m{', ' + rows if rows else ''} from (select *, unnest(range(1, len(ms) + 1)) as k from (select {keys}, {got} from {source})))"


SPACES = f"{WHITE}+"
WORDS = f"list_filter(string_split_regex(text, '{SPACES}'), lambda x: x <> '')"
