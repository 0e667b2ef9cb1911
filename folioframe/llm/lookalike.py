"""Text that looks the same and differs in its characters, in one consistent form.

Method: after compatibility normalization of presentation and styled forms,
composition of separate accents and deletion of ignorable characters, each word
that mixes scripts (in codes: that has a letter that isn't Latin) becomes a
lattice, in which every letter may also be one of its look-alikes; a Viterbi
search takes the path with the best score under character pairs counted over the
whole corpus, with a price for every change of script. Typographic signs
(quotes, dashes, ellipsis, number sign, fractions, superscripts, ordinals) stay.

One pass for the pair counts (bounded by the alphabet) and one to normalize, in
which only values that could hold a stand-in leave the JVM; nothing is shuffled
but the counts.

Defined results: null stays null and empty stays empty; a value in canonical form
comes back unchanged (applying twice is the same as once); words of one script
stay, whatever the script, unless a word of look-alikes alone stands in a text
that has no other letter of its script; texts of any length are used whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.chargrams import PairModel, pair_counts
from folioframe.llm.mojibake import Reader, Tables, _in_block

# Letters that look like Latin ones, pair by pair.
CYRILLIC = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "ԝ": "w", "х": "x", "у": "y", "ѵ": "v", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ԍ": "G", "Ԝ": "W", "к": "k", "т": "t", "м": "m",
    "в": "b",
}
GREEK = {
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "γ": "y", "η": "n", "τ": "t", "χ": "x", "ω": "w",
    "ε": "e", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ϲ": "c", "ϳ": "j",
}
# Characters that can't be seen, spaces and hyphens other than the ordinary ones.
IGNORABLE = "­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿"
SPACES = "   -   　"
HYPHENS = "‐‑﹣－"
STYLED = "ﬀ-ﭏ︐-︙︰-﹯＀-￯℀-ℕ℗-℟ℤ-⅏Ⅰ-ⅿ①-⓿\U0001d400-\U0001d7ff\U0001f130-\U0001f189"
#: a value without any of these is in canonical form
SUSPECT = f"[{IGNORABLE}{SPACES}{HYPHENS}{STYLED}]|\\p{{M}}|[\\p{{IsCyrillic}}\\p{{IsGreek}}]"

_DELETE = re.compile(f"[{IGNORABLE}]")
_SPACE = re.compile(f"[{SPACES}]")
_HYPHEN = re.compile(f"[{HYPHENS}]")
_STYLED = re.compile(f"[{STYLED}]")
_WORD = re.compile(r"[^\W\d_]+")
_EMOJI_JOINED = re.compile("(?<=[\U0001f000-\U0001faff☀-➿️])[‍️]|[️‍](?=[\U0001f000-\U0001faff☀-➿])")


def _look_alikes() -> dict[str, tuple[str, ...]]:
    groups: dict[str, set[str]] = {}
    for table in (CYRILLIC, GREEK):
        for other, latin in table.items():
            groups.setdefault(latin, {latin}).add(other)
    out: dict[str, set[str]] = {}
    for group in groups.values():
        for c in group:
            out.setdefault(c, set()).update(group)
    return {c: tuple(sorted(g)) for c, g in out.items()}


ALIKE = _look_alikes()


@lru_cache(maxsize=20_000)
def script(c: str) -> str:
    """Latin, Cyrillic, Greek or nothing."""
    if c.isascii():
        return "L" if c.isalpha() else ""
    name = unicodedata.name(c, "")
    return {"LATIN": "L", "CYRIL": "C", "GREEK": "G"}.get(name[:5], "") if c.isalpha() else ""


def plain_forms(text: str) -> str:
    """Compatibility forms of letters, digits and marks, ignorable characters, spaces, hyphens and separate accents put right."""
    if text.isascii():
        return text
    kept = _EMOJI_JOINED.sub(lambda m: chr(0xE000 + "‍️".index(m[0])), text)  # joiners within emoji mean something
    kept = _DELETE.sub("", kept)
    kept = _HYPHEN.sub("-", _SPACE.sub(" ", kept))
    kept = _STYLED.sub(lambda m: unicodedata.normalize("NFKC", m[0]), kept)
    return unicodedata.normalize("NFC", kept).replace("", "‍").replace("", "️")


class Speller:
    """Words of one script, by Viterbi over look-alike lattices."""

    def __init__(self, model: PairModel, switch: float = 6.0, foreign: float = 1.0) -> None:
        self.model, self.switch, self.foreign = model, switch, foreign
        self.cache: dict[tuple[str, str], str] = {}

    def word(self, word: str, only: str = "") -> str:
        """The word in the best reading; ``only``: in this script wherever a letter has a look-alike in it."""
        key = (word, only)
        got = self.cache.get(key)
        if got is None:
            if len(self.cache) > 100_000:
                self.cache.clear()
            got = self.cache[key] = self._search(word, only)
        return got

    def _search(self, word: str, only: str) -> str:
        log, floor, neutral = self.model.log, self.model.floor, self.model.neutral
        paths: dict[str, tuple[float, str]] = {" ": (0.0, "")}
        for c in word:
            choices = ALIKE.get(c, (c,))
            if only:
                choices = tuple(x for x in choices if script(x) == only) or (c,)
            new: dict[str, tuple[float, str]] = {}
            for x in choices:
                best = (-math.inf, "")
                for last, (score, so_far) in paths.items():
                    pair = last + x
                    s = score + log.get(pair, neutral if pair.isascii() else floor)
                    if last != " " and script(last) != script(x) and script(x) and script(last):
                        s -= self.switch
                    if s > best[0]:
                        best = (s, so_far + x)
                new[x] = (best[0] - (self.foreign if x != c else 0.0), best[1])
            paths = new
        return max(paths.values())[1]

    def canonical(self, text: str, code: bool = False) -> str:
        text = plain_forms(text)
        if text.isascii():
            return text
        words = _WORD.findall(text)
        kinds = [{s for ch in w if (s := script(ch))} for w in words]
        if not any(k - {"L"} for k in kinds):
            return text
        # letters without a look-alike tell which scripts the text is really written in
        real = {s for w, k in zip(words, kinds) if len(k) == 1 for ch in w if (s := script(ch)) and (s == "L" or len({*map(script, ALIKE.get(ch, ch))}) == 1)}

        def one(m: re.Match) -> str:
            w = m[0]
            k = {s for ch in w if (s := script(ch))}
            if code:
                return self.word(w, "L") if k - {"L"} else w
            if len(k) > 1:
                return self.word(w)
            if k and "L" not in k and not k & real and "L" in real:
                return self.word(w, "L")
            if k == {"L"} and len(w) <= 2 and len(words) > 1 and "C" in real and all(len(x) > 2 for x in words if x != w and script(x[0]) == "L") and all(any(script(a) == "C" for a in ALIKE.get(ch, ())) for ch in w):
                return self.word(w, "C")
            return w

        return _WORD.sub(one, text)


def has_stand_in(text: str, canonical: str) -> bool:
    return text != canonical or any(len({s for ch in w if (s := script(ch))}) > 1 for w in _WORD.findall(canonical))


def _suspect(c: Column) -> Column:
    return F.when(c.rlike(SUSPECT), c)


def normalize_fields(df: DataFrame, fields: dict[str, bool], *, keys: list[str], source: str | None = None, lang: str | None = "lang", fitted: list | None = None, model: PairModel | None = None) -> DataFrame:
    """(keys, field_name, original, canonical) of every value with a character standing in for an ordinary one.

    ``fields``: the columns, and of each whether it holds codes. With ``fitted``
    (the outcome of ``mojibake.learn``) values garbled by a wrong decoding are
    left to that operator, but for codes.
    """
    names = list(fields)
    if model is None:
        if fitted:  # block by block of sources, as their tables were learned
            out = None
            for blocks, n, m, tables in fitted:
                mine = df.filter(_in_block(F.coalesce(F.col(source).cast("string"), F.lit("")), blocks, n)) if blocks > 1 else df
                part = _normalize(mine, fields, keys, source, lang if lang in df.columns else None, m, tables)
                out = part if out is None else out.unionByName(part)
            return out
        model = PairModel.of(pair_counts(df, names))
    return _normalize(df, fields, keys, source, None, model, None)


def _normalize(df: DataFrame, fields: dict[str, bool], keys: list[str], source: str | None, lang: str | None, model: PairModel, tables: Tables | None) -> DataFrame:
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller, reader = Speller(model), Reader(model, tables) if tables else None
        for batch in batches:
            rows, which, olds, news = [], [], [], []
            sources, langs = batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()
            for k, name in enumerate(names):
                for i, t in enumerate(batch.column(len(keys) + 2 + k).to_pylist()):
                    if t and has_stand_in(t, new := speller.canonical(t, fields[name])):
                        if fields[name] or reader is None or not reader.read(sources[i], langs[i], t)[0]:
                            rows.append(i), which.append(name), olds.append(t), news.append(new)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(len(keys))), pa.array(which, pa.string()), pa.array(olds, pa.string()), pa.array(news, pa.string())], names=[*(f"key_{k}" for k in range(len(keys))), "field_name", "original", "canonical"])

    some = F.lit(False)
    for k in range(len(names)):
        some = some | F.col(f"text_{k}").isNotNull()
    lng = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    src = F.coalesce(F.col(source).cast("string"), F.lit("")) if source else F.lit("")
    texts = df.select(*[F.col(c).alias(f"key_{k}") for k, c in enumerate(keys)], src.alias("source"), lng.alias("lang"), *[_suspect(F.col(c)).alias(f"text_{k}") for k, c in enumerate(names)]).filter(some)
    types = ", ".join(f"key_{k} {texts.schema[f'key_{k}'].dataType.simpleString()}" for k in range(len(keys)))
    out = texts.mapInArrow(run, f"{types}, field_name string, original string, canonical string")
    return out.select(*[F.col(f"key_{k}").alias(c) for k, c in enumerate(keys)], "field_name", "original", "canonical")
