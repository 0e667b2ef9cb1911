"""Character pair counts over text columns, as the character models of this subpackage use them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Single-byte code pages of the text this engine meets, by the script they were made for.
PAGES = {
    "latin": ("cp1252", "iso8859-15", "cp850", "cp437", "mac_roman"),
    "central": ("cp1250", "iso8859-2", "cp852", "mac_latin2"),
    "turkish": ("cp1254", "iso8859-9", "cp857"),
    "cyrillic": ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac_cyrillic"),
    "greek": ("cp1253", "iso8859-7", "cp737", "mac_greek"),
}
OTHER = "￼"


def page_chars(page: str) -> list[str]:
    """The 256 characters of a code page; an undefined byte is the control character of that number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def tracked_alphabet() -> set[str]:
    """All characters of the code pages: a fixed set, whatever the data; all others count as one."""
    return {c for pages in PAGES.values() for p in pages for c in page_chars(p)} | {"�", *map(chr, range(256))}


def _tracked() -> np.ndarray:
    code = np.full(0x110000, ord(OTHER), dtype=np.uint32)
    for c in tracked_alphabet():
        code[ord(c)] = ord(c)
    code[[9, 10, 13]] = 32
    return code


def pair_counts(df: DataFrame, columns: list[str], *, lang: str | None = None) -> DataFrame:
    """(lang, a, b, n): how often character b follows a in different texts, where one of them at least isn't ASCII.

    Text ends count as spaces, copies of a text once. The number of rows is bounded
    by the languages times the square of the tracked alphabet, in practice some ten
    thousand, and doesn't grow with the data. Characters outside of that alphabet come
    once each, with b = 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _tracked()
        total: dict[tuple, int] = {}
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, which = langs.dictionary.to_pylist(), langs.indices.to_pylist()
            by_lang: dict = {}
            for w, t in zip(which, batch.column(1).to_pylist()):
                by_lang.setdefault(None if w is None else names[w], []).append(t)
            for g, texts in by_lang.items():
                for at in range(0, len(texts), 2000):
                    chars = code[np.frombuffer((" " + " ".join(texts[at : at + 2000]) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)].astype(np.int64)
                    a, b = chars[:-1], chars[1:]
                    keep = (a > 127) | (b > 127)
                    keys, n = np.unique((a[keep] << 21) | b[keep], return_counts=True)
                    for key, m in zip(keys.tolist(), n.tolist()):
                        total[g, key] = total.get((g, key), 0) + m
                    for c in {c for t in texts[at : at + 2000] for c in set(t) if code[ord(c)] == ord(OTHER)}:
                        total[None, ord(c) << 21] = total.get((None, ord(c) << 21), 0) + 1
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in keys], pa.string()), pa.array([k >> 21 for _, k in keys], pa.int32()), pa.array([k & 0x1FFFFF for _, k in keys], pa.int32()), pa.array(list(total.values()), pa.int64())], names=["lang", "a", "b", "n"])

    of = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    texts = df.select(of.alias("lang"), F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("text")).filter(F.col("text").rlike(r"[^\x00-\x7f]")).distinct()
    return texts.mapInArrow(run, "lang string, a int, b int, n bigint").groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))


class PairModel:
    """Log-probabilities of character pairs of which one at least isn't ASCII, by language, those of all languages behind them."""

    def __init__(self, counts: dict[tuple[str | None, str], float], smooth: float = 0.05, behind: float = 200.0) -> None:
        self.counts, self.smooth, self.behind = counts, smooth, behind
        #: characters that the corpus has
        self.letters = {c for _, pair in counts for c in pair if ord(c) > 127}
        every: dict[str, float] = {}
        by_lang: dict[str, dict[str, float]] = {}
        for (g, pair), n in counts.items():
            if n > 0 and pair[1] != "\0":
                every[pair] = every.get(pair, 0.0) + n
                if g is not None:
                    by_lang.setdefault(g, {})[pair] = n
        total = sum(every.values()) + 1
        share = {pair: (n + smooth) / total for pair, n in every.items()}
        self.log = {pair: math.log(p) for pair, p in share.items()}
        self.floor = math.log(smooth / total)
        #: pairs of ASCII characters carry no evidence here
        self.neutral = math.log(1 / 2000)
        self.tables: dict[str | None, dict[str, float]] = {}
        for g, own in by_lang.items():
            size = sum(own.values()) + behind
            self.tables[g] = {pair: math.log((own.get(pair, 0.0) + behind * p) / size) for pair, p in share.items()}
        self._between: dict[tuple, list[str]] = {}
        self._follow: dict[str | None, tuple[dict, dict]] = {}

    def __getstate__(self) -> tuple:
        return self.counts, self.smooth, self.behind

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    @classmethod
    def of(cls, counts: DataFrame) -> PairModel:
        return cls({(r.lang, chr(r.a) + chr(r.b)): r.n for r in counts.collect()})  # bounded by languages and the tracked alphabet

    def corrected(self, changes: dict[tuple[str, str], float]) -> PairModel:
        """The model with the counts of pairs changed; a count never falls below nothing."""
        counts = dict(self.counts)
        for key, n in changes.items():
            counts[key] = max(counts.get(key, 0.0) + n, 0.0)
        return PairModel(counts, self.smooth, self.behind)

    def knows(self, text: str) -> bool:
        """Whether the corpus has all characters of the text."""
        return all(c in self.letters or c < "\x80" for c in text)

    def table(self, lang: str | None) -> dict[str, float]:
        return self.tables.get(lang, self.log)

    def between(self, lang: str | None, left: str, right: str) -> list[str]:
        """The characters beyond ASCII that the language has after ``left`` and before ``right``."""
        key = (lang, left, right)
        if key not in self._between:
            if lang not in self._follow:
                after: dict[str, set] = {}
                before: dict[str, set] = {}
                for (g, pair), n in self.counts.items():
                    if n > 0 and (g == lang or lang not in self.tables):
                        after.setdefault(pair[0], set()).add(pair[1])
                        before.setdefault(pair[1], set()).add(pair[0])
                self._follow[lang] = after, before
            if len(self._between) > 50_000:
                self._between.clear()
            after, before = self._follow[lang]
            self._between[key] = sorted(c for c in after.get(left, set()) & before.get(right, set()) if ord(c) > 127 and c.isalpha())
        return self._between[key]

    def scorer(self, lang: str | None):
        """The function that scores a text of the language."""
        log, floor, neutral = self.table(lang), self.floor, self.neutral

        def score(text: str) -> float:
            total = 0.0
            for k in range(len(text) - 1):
                pair = text[k : k + 2]
                got = log.get(pair)
                total += got if got is not None else neutral if pair.isascii() else floor
            return total

        return score

    def score(self, text: str) -> float:
        return self.scorer(None)(text)
