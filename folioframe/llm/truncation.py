"""Text cut off by a field limit or in transfer, and how often each source cuts.

Method: a backward character n-gram model says how often a context is followed by
an end and how often the text goes on. A context is the last characters before a
place, read backwards; the longest one with enough evidence decides, without the
value's own occurrence. There are two ends to ask about:
    * the end of the line, by contexts of 4 to 32 characters that reach over words;
      names have become one character there and digits another, as any name may
      stand in their place, and a line shorter than a context is one as a whole;
    * the end of the word, by up to 12 characters of the word that the value ends
      with; for words that begin with a capital (names, of which most are met once)
      their last two to four characters, or the whole where it is usual.
A value is cut where the log-odds of an end against going on fall below the
threshold of its language and column, which lies in the valley of the log-odds of
that language and column, for each of the two ends. Where all says that the line
ends, a word must end in a much rarer way to count as cut. Sentences closed by
their mark are whole; dots put directly after a word are taken off before the end
is judged.

Copies and redeliveries don't vouch for each other: a text of a table counts once
for each source that has it, as titles do that many sources have; within words the
records of its commonest source count as one.

Scale: counts of contexts are partial aggregates. Only contexts whose hash meets a
bitmap of the contexts under test are counted; the bitmap's size follows the number
of ends, between 2**20 and 2**26 bits. Texts are shuffled once, to count each once,
and different ends under test, each once. Lines are used whole.

Defined results: null, empty and blank values are whole; a value without any
evidence is whole; copies of a record (same id) come out once; a null language is
a language of its own, a null source a source of its own; the last line decides
for texts of several lines, whatever their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut_lineage

#: lengths of the contexts of a line's end
ORDERS = (4, 6, 8, 12, 16, 24, 32)
#: longest context of a word's end, and the contexts of words that begin with a capital
IN_WORD, PARTS = 12, (2, 3, 4)
#: words up to this length are judged as beginnings, however they begin
SHORT = 3
# What can't be seen, and marks that close a sentence.
UNSEEN = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
BLANK = " \t\r\n\u00a0\u200b\ufeff\u3000"
SPACES = "\t\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u3000"
CLOSED = tuple(".?!;。．？！;；")
DOTS = r"(?<=[^\s.…])(?:…+|\.{2,})$"
NAME = r"\p{Lu}(?<=(?:[^.?!:)\s…] |\()\p{Lu})[\p{L}\p{M}'’]*"


def _clean(c: Column) -> Column:
    # without regular expressions: every text of both tables goes through here
    return F.rtrim(F.translate(c.cast("string"), SPACES + "\r" + UNSEEN, " " * len(SPACES)), F.lit(" \n"))


def _skeleton(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, "123456789", "000000000"), NAME, "N")


def values(df: DataFrame, *, table: str, key: str, text: str, lang: str | None, source: str | None) -> DataFrame:
    """(table, id, lang, source, text) of the values that aren't blank, without blanks at their end."""
    col = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    rows = df.select(F.lit(table).alias("table"), F.col(key).alias("id"), col(lang).alias("lang"), col(source).alias("source"), F.rtrim(F.col(text).cast("string"), F.lit(BLANK)).alias("text"))
    return rows.filter("text <> ''")


def _ends(rows: DataFrame) -> DataFrame:
    """The ends under test: (table, id, lang, dotted, line, word, same): last line, whether dots were taken off, its last word, its hash."""
    # the ordinary case, a closed sentence, is told by its last two characters
    tail = F.right("line", F.lit(2))
    dotted = F.when((tail == "..") | F.endswith(tail, F.lit("…")), F.col("line").rlike(DOTS)).otherwise(False)
    closed = F.right("line", F.lit(1)).isin(*CLOSED) & ~((tail == "..") | F.endswith(tail, F.lit("…")))
    lines = rows.select("table", "id", "lang", F.substring_index("text", "\n", -1).alias("line")).filter(~closed)
    open_end = lines.select("table", "id", "lang", F.trim(_clean(F.col("line"))).alias("line")).withColumn("dotted", dotted).filter(F.col("dotted") | ~F.right("line", F.lit(1)).isin(*CLOSED))
    stripped = F.when(F.col("dotted"), F.regexp_replace("line", DOTS, "")).otherwise(F.col("line"))
    return open_end.select("table", "id", "lang", "dotted", stripped.alias("line")).withColumn("word", F.regexp_extract("line", r"(?<![\p{L}\p{M}'’])[\p{L}\p{M}'’]++$", 0)).withColumn("same", F.xxhash64("table", "line", "dotted"))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b
        return (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _contexts(lines: pa.Array, tables: pa.Array) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """(line of each place, whether it is the last of its line, (length, hashes) of the contexts that end at each place).

    What lies before a line's beginning is one and the same character, so that the
    contexts of short lines are those lines.
    """
    size = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(lines.to_pylist()).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(size)), size)
    begin = np.repeat(np.cumsum(size) - size, size)
    at = np.arange(len(chars)) - begin
    last = at == np.repeat(size, size) - 1
    names = tables.dictionary_encode()
    seeds = np.array([sum(ord(c) * 257**i for i, c in enumerate(n)) & 0xFFFFFFFFFFFF for n in names.dictionary.to_pylist()] or [0], dtype=np.uint64)
    seed = seeds[names.indices.to_numpy(zero_copy_only=False)][of] if len(lines) else np.zeros(0, np.uint64)

    def before(h: np.ndarray, by: int) -> np.ndarray:
        out = np.full(len(h), by, np.uint64)
        out[by:] = np.where(at[by:] >= by, h[:-by], np.uint64(by))
        return out

    def all_lengths() -> Iterator[tuple[int, np.ndarray]]:
        kept = {1: _mixed(chars, seed)}
        for k in (2, 3, *ORDERS):
            left = max(j for j in kept if j <= k - 1 and k - j in kept)
            kept[k] = _mixed(before(kept[left], k - left), kept[k - left])
            if k in ORDERS:
                yield k, kept[k]

    return of, last, all_lengths()


def _end_contexts(ends: DataFrame) -> DataFrame:
    """(same, dotted, k, h): the contexts of each different end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, last, contexts = _contexts(b.column(3), b.column(0))
            take = pa.array(of[last])
            for k, h in contexts:
                yield pa.RecordBatch.from_arrays([b.column(1).take(take), b.column(2).take(take), pa.array(np.full(len(take), k, np.int32)), pa.array(h[last].view(np.int64))], names=["same", "dotted", "k", "h"])

    return ends.select("table", "same", "dotted", _skeleton(F.col("line")).alias("line")).mapInArrow(run, "same bigint, dotted boolean, k int, h bigint")


def _bitmap(contexts: DataFrame, ends: int) -> np.ndarray:
    """One bit for each value of the last bits of the hashes under test."""
    bits = min(max(20, math.ceil(math.log2(max(ends, 1) * len(ORDERS) * 8))), 26)
    words = contexts.select(F.col("h").bitwiseAND((1 << bits) - 1).alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("bits"))
    out = np.zeros(1 << (bits - 6), np.int64)
    got = words.toPandas()  # at most 2**20 rows
    out[got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _texts(rows: DataFrame) -> DataFrame:
    """(table, text, n, m): each text once, with its sources, and with its records but for those of its commonest source, which count as one."""
    by_source = rows.groupBy("table", "text", F.coalesce("source", F.lit("")).alias("source")).agg(F.countDistinct("id").alias("ids"))
    return by_source.groupBy("table", "text").agg(F.count("*").alias("n"), (F.sum("ids") - F.max("ids") + 1).alias("m"))


def _line_counts(texts: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(h, stop, go): how often a context under test is the end of a line, and how often not, over texts that count ``n`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(len(bitmap) - 1)
        for b in batches:
            weight = b.column(2).to_numpy(zero_copy_only=False)
            of, last, contexts = _contexts(b.column(1), b.column(0))
            for _, h in contexts:
                hit = np.flatnonzero(bitmap[(h & mask).astype(np.int64)])
                keys, inverse = np.unique(h[hit], return_inverse=True)
                if len(keys):
                    w = weight[of[hit]]
                    s = np.bincount(inverse, weights=w * last[hit], minlength=len(keys)).astype(np.int64)
                    n = np.bincount(inverse, weights=w, minlength=len(keys)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(s), pa.array(n - s)], names=["h", "stop", "go"])

    lines = texts.select("table", "n", F.explode(F.split("text", "\n")).alias("line")).select("table", "n", F.trim(_clean(F.col("line"))).alias("line")).filter("line <> ''")
    return lines.select("table", _skeleton(F.col("line")).alias("line"), "n").mapInArrow(run, "h bigint, stop bigint, go bigint").groupBy("h").agg(F.sum("stop").alias("stop"), F.sum("go").alias("go"))


def _word_counts(texts: DataFrame) -> DataFrame:
    return texts.select("m", F.explode(F.split(F.translate("text", UNSEEN, ""), r"[^\p{L}\p{M}'’]+")).alias("w")).filter("w <> ''").groupBy("w").agg(F.sum("m").alias("n"))


def _word_contexts(words: DataFrame, usual: int = 20) -> DataFrame:
    """(c, stop, go): of the contexts in small words, of the parts of other words, and of those as a whole that are usual.

    ``^`` stands before a word's beginning where the context reaches that far.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop: dict[str, int] = {}
        go: dict[str, int] = {}
        for b in batches:
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                size = len(w)
                whole = "^" + w
                small = w[0].islower()
                for i in range(2, size + 1 if small else min(size, SHORT + 1)):
                    c = whole[max(0, i - IN_WORD) : i]
                    go[c] = go.get(c, 0) + n
                if small or size <= SHORT or n >= usual:
                    c = whole[-IN_WORD:]
                    stop[c] = stop.get(c, 0) + n
                if not small:
                    for k in PARTS:
                        for i in range(size - k):
                            c = w[i : i + k]
                            go[c] = go.get(c, 0) + n
                        if size >= k:
                            stop[w[-k:]] = stop.get(w[-k:], 0) + n
        keys = list(stop.keys() | go.keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([stop.get(c, 0) for c in keys], pa.int64()), pa.array([go.get(c, 0) for c in keys], pa.int64())], names=["c", "stop", "go"])

    return words.select("w", "n").mapInArrow(run, "c string, stop bigint, go bigint").groupBy("c").agg(F.sum("stop").alias("stop"), F.sum("go").alias("go"))


def _thresholds(scored: DataFrame, odds: str, name: str, default: float, lowest: int, highest: int = -1, least: int = 100) -> DataFrame:
    """(of_table, of_lang, name): the emptiest place of the log-odds between ``lowest`` and ``highest`` of each language and column."""
    rows = scored.filter(F.col(odds).isNotNull()).select(F.col("table").alias("of_table"), F.coalesce("lang", F.lit("")).alias("of_lang"), F.floor(F.col(odds) * 2).cast("int").alias("bin"))
    counts = rows.groupBy("of_table", "of_lang").agg(F.count("*").alias("ends"), *[F.count_if(F.col("bin") == k).alias(f"b{-k}") for k in range(2 * lowest, 0)])
    # a place is as empty as it and its neighbours are
    smooth = lambda k: F.col(f"b{-k}") * 2 + (F.col(f"b{-k - 1}") if k < -1 else F.col("b1")) + (F.col(f"b{-k + 1}") if k > 2 * lowest else F.lit(0))
    places = F.array(*[F.struct(smooth(k).alias("n"), F.lit(abs(k - lowest)).alias("off"), F.lit(k).alias("at")) for k in range(2 * lowest, 2 * highest)])
    return counts.select("of_table", "of_lang", F.when(F.col("ends") >= least, F.array_min(places)["at"] / 2 + 0.25).otherwise(default).alias(name))


def judge(rows: DataFrame, *, enough: int = 4, enough_word: int = 8, sure: float = 2.0, rarer: float = 3.0) -> DataFrame:
    """(table, id, lang, line_odds, word_odds, limit, word_limit, cut) of every end under test.

    ``sure``: log-odds of a line's end from which a word must lie ``rarer`` below its limit, or below -4.
    """
    ends = cut_lineage(_ends(rows))
    texts = cut_lineage(_texts(rows))
    each = ends.select("table", "same", "dotted", "line", "word").dropDuplicates(["same"])
    contexts = cut_lineage(_end_contexts(each))
    bitmap = _bitmap(contexts, contexts.count() // len(ORDERS))
    own = F.when(F.col("dotted"), 0).otherwise(1)
    stop, go = F.greatest(F.col("stop") - own, F.lit(0)), F.greatest(F.col("go") - (1 - own), F.lit(0))
    line = contexts.join(_line_counts(texts, bitmap), "h").select("same", "k", stop.alias("stop"), go.alias("go")).filter(F.col("stop") + F.col("go") >= enough)
    line = line.groupBy("same").agg(F.max_by(F.log((F.col("stop") + 0.5) / (F.col("go") + 0.5)), "k").alias("line_odds"))

    whole = F.concat(F.lit("^"), "word")
    start = F.struct(F.when(F.length(whole) > IN_WORD, F.right(whole, F.lit(IN_WORD))).otherwise(whole).alias("c"), F.lit(IN_WORD).alias("k"))
    parts = [F.struct(F.substring("word", -k, k).alias("c"), F.lit(k).alias("k")) for k in PARTS]
    asked = each.filter("word <> ''").select("same", F.explode(F.when(F.col("word").rlike(r"^\p{Ll}"), F.array(start)).otherwise(F.array(start, *parts))).alias("q")).select("same", "q.c", "q.k")
    w_stop = F.greatest(F.col("stop") - 1, F.lit(0))  # the end itself counts among the word counts, dotted or not
    word = asked.join(_word_contexts(_word_counts(texts)), "c").select("same", "k", w_stop.alias("stop"), "go").filter(F.col("stop") + F.col("go") >= enough_word)
    word = word.groupBy("same").agg(F.max_by(F.log((F.col("stop") + 0.5) / (F.col("go") + 0.5)), "k").alias("word_odds"))

    odds = each.select("same").join(line, "same", "left").join(word, "same", "left")
    scored = cut_lineage(ends.select("table", "id", "lang", "same").distinct().join(odds, "same"))
    once = scored.dropDuplicates(["table", "lang", "same"])
    limits = _thresholds(once, "line_odds", "limit", -1.5, -3).join(_thresholds(once, "word_odds", "word_limit", -2.0, -4), ["of_table", "of_lang"], "full")
    out = scored.join(limits, (F.col("table") == F.col("of_table")) & (F.coalesce("lang", F.lit("")) == F.col("of_lang")), "left")
    word_limit = F.when(F.col("line_odds") >= sure, F.greatest(F.col("word_limit") - rarer, F.lit(-4.0))).otherwise(F.col("word_limit"))
    cut = F.coalesce(F.col("line_odds") < F.col("limit"), F.lit(False)) | F.coalesce(F.col("word_odds") < word_limit, F.lit(False))
    return out.select("table", "id", "lang", "line_odds", "word_odds", "limit", "word_limit", cut.alias("cut"))


def truncation_rates(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """(table, source, records, cut, share): how often each source cuts, over the values that aren't blank."""
    ids = judged.filter("cut").select("table", "id", F.lit(1).alias("c")).distinct()
    one = rows.select("table", "id", "source").dropDuplicates(["table", "id"]).join(ids, ["table", "id"], "left")
    return one.groupBy("table", "source").agg(F.count("*").alias("records"), F.count("c").alias("cut"), (F.count("c") / F.count("*")).alias("share"))
