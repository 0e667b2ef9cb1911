"""Text garbled by a wrong decoding: which values, and their original wording.

Method: an unknown swap of code pages is a substitution cipher of a source. The
symbols of a cipher are the characters that stand for one letter, or, where the
bytes of UTF-8 were read one by one, the runs of two to four characters. Weights
and letters of the ciphers of each source are learned by expectation-maximization
against letter pairs counted by language:
    * the E-step reads every stretch of characters beyond ASCII under every cipher
      of its source, gives it to the ciphers by the posterior, and for every symbol
      in it gives the weight to the letters that its neighbours allow, whichever
      letters the language has;
    * the M-step adds up these shares and takes for each symbol the letter with the
      most. Swaps of pages that are known are where ciphers start from; a cipher
      ``free`` of each source starts from nothing, so that a swap that no list has
      is learned from its contexts alone;
    * the letter pairs are counted again as the stretches are read then, so that
      frequent garbling doesn't pass for the language.
The learned tables are then applied with ``translate()`` and kept where the result
reads better than the text as it stands, by the posterior.

Scale: pairs are counted over different texts, so a copied value counts once. The
stretches are aggregated by source and language and written once; E-steps are passes
over them in which any task takes any source, M-steps are sums, so a source with
most of the rows is spread like all others. What the driver gets and broadcasts are
pair counts (bounded by the alphabets), weights and the letters that differ from the
starting tables, for ``block_sources`` sources at a time; more sources are learned
and read block by block.

Defined results: null, empty and ASCII values are never garbled, but numeric
character references count as the characters they name; a value with U+FFFD is
garbled and not recoverable; a C1 control character marks a garbled value even where
no table reads it; a null source is a source of its own, a null language is read by
the pairs of all; copies of a record come out once in :func:`garbled_fields`; an
empty table gives none.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.chargrams import PAGES, PairModel, page_chars, pair_counts
from folioframe.session import cut_lineage

RUN = re.compile(r"[^\x00-\x7f]+")
C1 = re.compile("[\x80-\x9f]")
REFERENCE = re.compile(r"&#(\d{2,7});")
#: pages as which bytes of UTF-8 are read one by one
SEEN = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp437", "cp850", "mac_roman", "cp1253", "cp1254", "cp866", "koi8-r")
#: pages as which bytes of another single-byte page are read
SWAPPED_SEEN = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r", "iso8859-2")
FREE = "free"
#: punctuation, currency, other symbols
SIGNS = ("Pd", "Po", "Ps", "Pe", "Pi", "Pf", "Sc", "So", "Sk", "Zs")
#: log weight that a cipher starts with, and the least share of one in use
START, LEAST = math.log(1e-3), 1e-6


class Cipher:
    """Symbols to letters. ``lead`` and ``tail``: the characters of a page that begin and continue a letter in UTF-8."""

    def __init__(self, name: str, table: dict[str, str], page: str | None = None) -> None:
        self.name, self.table = name, table
        self.single = {ord(s): t for s, t in table.items()}
        self.sub = None
        if page:
            chars = page_chars(page)
            self.byte = {c: b for b, c in enumerate(chars) if b > 127}
            group = lambda a, z: "[" + re.escape("".join(chars[a:z])) + "]"
            tail = group(0x80, 0xC0)
            self.sub = re.compile(f"{group(0xC2, 0xE0)}{tail}|{group(0xE0, 0xF0)}{tail}{{2}}|{group(0xF0, 0xF5)}{tail}{{3}}").sub
            self.lead = set(chars[0xC2:0xF5])

            self.known: dict[str, str] = {}

    def _letter(self, m: re.Match) -> str:
        got = self.known.get(m[0])
        if got is None:
            if len(self.known) > 100_000:
                self.known.clear()
            try:
                got = bytes(self.byte[c] for c in m[0]).decode("utf-8")
            except UnicodeDecodeError:
                got = m[0]
            if not 127 < ord(got[0]) != 0xFFFD:
                got = m[0]
            self.known[m[0]] = got
        return got

    def apply(self, text: str) -> str:
        if self.sub is None:
            return text.translate(self.single)
        if self.lead.isdisjoint(text):
            return text
        return self.sub(self._letter, text)


def start_ciphers() -> dict[str, Cipher]:
    """All swaps of two known pages, by name, and the free cipher."""
    out = [Cipher(f"utf-8 as {seen}", {}, seen) for seen in SEEN]
    for seen in SWAPPED_SEEN:
        chars = page_chars(seen)
        for script, trues in PAGES.items():
            for true in trues:
                if true == seen or (script == "latin" and seen in PAGES["central"]):
                    continue
                own = page_chars(true)
                table = {chars[b]: own[b] for b in range(128, 256) if chars[b] != own[b] and ord(own[b]) > 159 and chars[b] not in "\xa0\xad"}
                if script in ("cyrillic", "greek", "latin"):  # its letters only: signs are the same business for all pages
                    table = {s: t for s, t in table.items() if t.isalpha()}
                if (seen in PAGES["cyrillic"]) == (script == "cyrillic") or seen not in PAGES["cyrillic"]:
                    out.append(Cipher(f"{true} as {seen}", table))
    out.append(Cipher(FREE, {}))
    return {c.name: c for c in out}


def stretches(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text)]


def framed(text: str, a: int, b: int) -> str:
    """A run of characters beyond ASCII with its neighbours; a text end is a space."""
    left = text[a - 1] if a else " "
    right = text[b] if b < len(text) else " "
    return (" " if left.isspace() else left) + text[a:b] + (" " if right.isspace() else right)


def only_signs(frame: str) -> bool:
    """Whether a stretch is of signs alone that texts of any page have; no letters were swapped for them."""
    return all(c < "\x80" or not c.isalpha() and unicodedata.category(c) in SIGNS for c in frame)


def unescaped(text: str) -> str:
    """The text with the characters beyond ASCII that numeric references name."""
    if "&#" not in text:
        return text
    named = lambda m: chr(int(m[1])) if 127 < int(m[1]) < 0x110000 and not 0xD800 <= int(m[1]) < 0xE000 else m[0]
    return REFERENCE.sub(named, text)


def best_reading(frame: str, ciphers: list[tuple[Cipher, float]], score, knows, depth: int = 3) -> tuple[float, str, int]:
    """(score, reading, cipher no or -1) of the best cipher, which may have been applied several times."""
    best = (-math.inf, frame, -1)
    for k, (cipher, weight) in enumerate(ciphers):
        text, cost = frame, 0.0
        for _ in range(depth if cipher.sub else 1):
            new = cipher.apply(text)
            if new == text:
                break
            text, cost = new, cost + weight
            if knows(text) and (got := score(text) + cost) > best[0]:
                best = (got, text, k)
        if cipher.sub and text != frame:  # a text garbled twice may have gone through two pages
            for other, w2 in ciphers:
                if other is not cipher and other.sub and (new := other.apply(text)) != text and knows(new) and (got := score(new) + cost + w2) > best[0]:
                    best = (got, new, k)
    return best


class Tables:
    """The ciphers of each source in use: (cipher, log weight). What differs from the starting tables is kept by source."""

    def __init__(self, start: dict[str, Cipher]) -> None:
        self.start = start
        self.weights: dict[str, dict[str, float]] = {}
        self.letters: dict[tuple[str, str], dict[str, str]] = {}
        #: symbols that are peculiar to a source: they may stand for any letter, and say nothing for themselves
        self.odd: dict[str, set[str]] = {}
        self.fitted = False
        self._made: dict[str, list] = {}

    def as_it_stands(self, source: str, frame: str) -> str:
        odd = self.odd.get(source)
        return "".join("\uffff" if c in odd else c for c in frame) if odd else frame

    def __getstate__(self) -> tuple:
        return self.weights, self.letters, self.odd, self.fitted  # the starting tables are made anew where they are needed

    def __setstate__(self, state: tuple) -> None:
        self.weights, self.letters, self.odd, self.fitted = state
        self.start, self._made = start_ciphers(), {}

    def of(self, source: str) -> list[tuple[Cipher, float]]:
        if source not in self._made:
            known = self.weights.get(source, {}) if self.fitted else dict.fromkeys(self.start, START)
            self._made[source] = [(Cipher(n, {**self.start[n].table, **self.letters[source, n]}) if (source, n) in self.letters else self.start[n], w) for n, w in known.items()]
        return self._made[source]


def _letter_shares(read: str, i: int, model: PairModel, lang: str | None) -> list[tuple[str, float]]:
    """The letters that may stand at a place between its neighbours, with their posterior."""
    log, floor = model.table(lang), model.floor
    left, right = read[i - 1], read[i + 1]
    found = [(c, log.get(left + c, floor) + log.get(c + right, floor)) for c in model.between(lang, left, right)]
    if not found:
        return []
    top = max(v for _, v in found)
    mass = sum(math.exp(v - top) for _, v in found)
    return [(c, p) for c, v in found if (p := math.exp(v - top) / mass) > 0.02]


def _readings(frame: str, ciphers: list[tuple[Cipher, float]], model: PairModel, lang: str | None, odd: set[str] = frozenset()) -> list[tuple[float, float, Cipher, str]]:
    """(score, log weight, cipher, reading) of a stretch under the ciphers that change it."""
    score, seen, out, signs = model.scorer(lang), {}, [], only_signs(frame)
    for cipher, weight in ciphers:
        if cipher.name == FREE and not cipher.table:
            read = _free_reading(frame, model, lang, odd)
        else:
            read = cipher.apply(frame)
        if read == frame or (signs and cipher.sub is None) or not model.knows(read):
            continue
        if read not in seen:
            seen[read] = score(read)
        got = seen[read]
        if cipher.sub and (again := cipher.apply(read)) != read and model.knows(again) and (twice := score(again)) > got:
            got, read = twice, again
        out.append((got, weight, cipher, read))
    return out


def odd_symbols(frames: DataFrame, *, peculiar: float = 20.0, enough: float = 5.0) -> dict[str, set[str]]:
    """The characters that are peculiar to a source: ``peculiar`` times as frequent in its stretches as in all others.

    Sources times alphabets are counted. A corpus of one source has none.
    """
    inner = F.expr("substring(frame, 2, length(frame) - 2)")
    seen: dict[str, dict[str, float]] = {}
    rows = frames.select("source", "n", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.split(inner, "")))).alias("c"))
    for r in rows.groupBy("c", "source").agg(F.sum("n").alias("n")).collect():
        seen.setdefault(r.c, {})[r.source] = r.n
    size = seen.get("", {})
    every = sum(size.values())
    out: dict[str, set[str]] = {}
    for c, by_source in seen.items():
        total = sum(by_source.values())
        for s, n in by_source.items():
            if c and n >= enough and every > size[s] and n / size[s] > peculiar * (total - n) / (every - size[s]):
                out.setdefault(s, set()).add(c)
    return out


def suspects(frames: DataFrame, model: PairModel, odd: dict[str, set[str]], margin: float = 3.0) -> DataFrame:
    """The stretches with an odd symbol, and those that some cipher reads not much worse than they stand; the others can't have gone through one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [(c, 0.0) for c in start_ciphers().values()]
        verdict: dict[tuple, bool] = {}
        for b in batches:
            keep = []
            for source, *key in zip(*(b.column(i).to_pylist() for i in range(3))):
                key = tuple(key)
                if key not in verdict:
                    if len(verdict) > 300_000:
                        verdict.clear()
                    lang, f = key
                    plain = model.scorer(lang)(f)
                    verdict[key] = any(v > plain - margin for v, _, _, _ in _readings(f, every, model, lang))
                keep.append(verdict[key] or (source in odd and not odd[source].isdisjoint(key[1])))
            yield b.filter(pa.array(keep, pa.bool_()))

    return frames.select("source", "lang", "frame", "n").mapInArrow(run, "source string, lang string, frame string, n bigint")


def expectations(frames: DataFrame, model: PairModel, tables: Tables) -> DataFrame:
    """(kind, owner, cipher, symbol, letter, x): the sums of the shares of all stretches.

    ``total`` rows have the weight of a source's stretches that read better under
    some cipher, ``weight`` rows a cipher's share of them, ``letter`` rows the share
    of a letter for a symbol, ``pair`` rows what the pair counts of a language change
    by when the stretches that read as garbled are taken as they read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, float] = {}

        def add(key: tuple, x: float) -> None:
            total[key] = total.get(key, 0.0) + x

        for b in batches:
            for source, lang, f, n in zip(*(c.to_pylist() for c in b.columns)):
                plain = model.scorer(lang)(tables.as_it_stands(source, f))
                scored = _readings(f, tables.of(source), model, lang, tables.odd.get(source, frozenset()))
                if not scored:
                    continue
                if max(v for v, _, _, _ in scored) > plain + 3:
                    add(("total", source, "", "", ""), n)
                top = max(max(v + w for v, w, _, _ in scored), plain)
                mass = math.exp(plain - top) + sum(math.exp(v + w - top) for v, w, _, _ in scored)
                for v, w, cipher, read in scored:
                    r = math.exp(v + w - top) / mass
                    if r < 1e-4:
                        continue
                    add(("weight", source, cipher.name, "", ""), n * r)
                    if r < 0.05 or cipher.sub is not None:
                        continue
                    for i in range(1, len(f) - 1):
                        if read[i] != f[i] or cipher.name == FREE:
                            for letter, p in _letter_shares(read, i, model, lang):
                                add(("letter", source, cipher.name, f[i], letter), n * r * p)
                v, w, _, read = max(scored, key=lambda x: x[0] + x[1])
                if lang is not None and v + w > plain + 2:
                    for text, sign in ((f, -n), (read, n)):
                        for pair in map(str.__add__, text, text[1:]):
                            if not pair.isascii():
                                add(("pair", lang, "", pair[0], pair[1]), sign)
            if len(total) > 200_000:
                yield _summed(total)
                total = {}
        yield _summed(total)

    shape = "kind string, owner string, cipher string, symbol string, letter string, x double"
    return frames.mapInArrow(run, shape).groupBy("kind", "owner", "cipher", "symbol", "letter").agg(F.sum("x").alias("x"))


def _summed(total: dict) -> pa.RecordBatch:
    keys = list(total)
    cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(5)]
    return pa.RecordBatch.from_arrays([*cols, pa.array(list(total.values()), pa.float64())], names=["kind", "owner", "cipher", "symbol", "letter", "x"])


def _free_reading(frame: str, model: PairModel, lang: str | None, odd: set[str]) -> str:
    """The stretch with the likeliest letter for each odd symbol that stands between others."""
    log, floor, out = model.table(lang), model.floor, list(frame)
    for i in range(1, len(frame) - 1):
        a, b = frame[i - 1], frame[i + 1]
        if frame[i] in odd and a not in odd and b not in odd:
            out[i] = max(model.between(lang, a, b), key=lambda c: log.get(a + c, floor) + log.get(c + b, floor), default=frame[i])  # noqa: B023
    return "".join(out)


def frames_of(df: DataFrame, *, source: str, lang: str | None, columns: list[str]) -> DataFrame:
    """(source, lang, frame, n): the stretches beyond ASCII of different texts, with their neighbours."""
    src, lng = F.coalesce(F.col(source).cast("string"), F.lit("")), F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    texts = df.select(src.alias("source"), lng.alias("lang"), F.explode(F.array(*[F.col(c) for c in columns])).alias("text")).filter(_marked(F.col("text"))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for b in batches:
            for s, g, t in zip(*(c.to_pylist() for c in b.columns)):
                t = unescaped(t)
                for a, z in stretches(t):
                    key = s, g, framed(t, a, z)
                    counts[key] = counts.get(key, 0) + 1
            if len(counts) > 200_000:
                yield _counted(counts)
                counts = {}
        yield _counted(counts)

    # a stretch of a language goes to one task, whatever its sources, and is judged once there
    return texts.mapInArrow(run, "source string, lang string, frame string, n bigint").repartition("lang", "frame").groupBy("source", "lang", "frame").agg(F.sum("n").alias("n"))


def _counted(counts: dict) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.string()) for i in range(3)), pa.array(list(counts.values()), pa.int64())], names=["source", "lang", "frame", "n"])


def _marked(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7f]|&#\d")


def maximize(rows: list, tables: Tables, *, prior: float = 3.0, enough: float = 5.0) -> None:
    """The M-step: weights, and for each symbol the letter with the most weight; the starting letter has ``prior`` on top.

    Where there is no letter to start from, contexts must agree on one, no two symbols
    may stand for the same letter, and the symbol must be odd (see :func:`odd_symbols`).
    """
    totals = dict.fromkeys(tables.odd, 0.0) | {r.owner: r.x for r in rows if r.kind == "total"}
    weights: dict[str, dict[str, float]] = {s: {} for s in totals}
    shares: dict[tuple, dict[str, float]] = {}
    for r in rows:
        if r.kind == "weight" and r.owner in totals and r.x / (totals[r.owner] + 1) > LEAST:
            weights[r.owner][r.cipher] = min(math.log(r.x / (totals[r.owner] + 1)), 0.0)
        elif r.kind == "letter":
            shares.setdefault((r.owner, r.cipher, r.symbol), {})[r.letter] = r.x
    letters: dict[tuple[str, str], dict[str, str]] = {}
    for (owner, cipher, symbol), every in sorted(shares.items(), key=lambda x: -max(x[1].values())):
        taken: set[str] = set()
        if cipher == FREE:  # one symbol for each letter, the surest first
            if symbol not in tables.odd.get(owner, ()):
                continue
            taken = set(letters.get((owner, FREE), {}).values())
        left = {c: x for c, x in every.items() if c not in taken}
        if not left:
            continue
        letter = max(left, key=left.get)
        at_first = tables.start[cipher].table.get(symbol)
        sure = left[letter] > 0.5 * sum(left.values()) if at_first is None else left[letter] > 2 * (left.get(at_first, 0.0) + prior)
        if letter not in (symbol, at_first) and left[letter] >= (enough if at_first is not None else 1.0) and sure:
            letters.setdefault((owner, cipher), {})[symbol] = letter
    for owner in totals:
        if owner in tables.odd:
            weights[owner][FREE] = max(weights[owner].get(FREE, START), START)
        else:
            weights[owner].pop(FREE, None)
    tables.weights, tables.letters, tables._made = weights, letters, {}
    tables.fitted = True


def learn(df: DataFrame, *, source: str = "source", lang: str | None = "lang", columns: list[str] | None = None, rounds: int = 3, block_sources: int = 500) -> list[tuple[int, int, PairModel, Tables]]:
    """(blocks, block no, letter pairs, tables) of each block of sources."""
    columns = columns or ["label", "help_text"]
    lang = lang if lang in df.columns else None
    counts = pair_counts(df, columns, lang=lang)
    model = PairModel.of(counts)
    every = cut_lineage(frames_of(df, source=source, lang=lang, columns=columns))
    odd = odd_symbols(every)
    frames = cut_lineage(suspects(every, model, odd))
    # few bytes, much work: spread by the number of stretches, not by their size
    frames = frames.repartition(max(df.sparkSession.sparkContext.defaultParallelism, frames.count() // 20_000))
    blocks = max(1, -(-frames.select("source").distinct().count() // block_sources))
    out = []
    for n in range(blocks):
        mine, tables, own = frames.filter(_in_block("source", blocks, n)), Tables(start_ciphers()), model
        tables.odd = odd
        for at in range(rounds):
            rows = expectations(mine, own, tables).collect()  # the block's sources times ciphers and alphabets, languages times pairs
            maximize(rows, tables)
            if at < rounds - 1:
                own = model.corrected({(r.owner, r.symbol + r.letter): r.x for r in rows if r.kind == "pair"})
        out.append((blocks, n, own, tables))
    return out


def _in_block(source: Column | str, blocks: int, n: int) -> Column:
    return F.pmod(F.xxhash64(source), F.lit(blocks)) == n


def save(fitted: list[tuple[int, int, PairModel, Tables]], spark, path: str) -> None:
    """Keep what :func:`learn` gave in a folder all executors share."""
    import pickle

    spark.createDataFrame([(blocks, n, bytearray(pickle.dumps((model, tables)))) for blocks, n, model, tables in fitted], "blocks int, n int, fitted binary").write.mode("overwrite").parquet(path)


def load(spark, path: str) -> list[tuple[int, int, PairModel, Tables]]:
    import pickle

    return [(r.blocks, r.n, *pickle.loads(bytes(r.fitted))) for r in spark.read.parquet(path).orderBy("n").collect()]


class Reader:
    """Garbled stretches and their readings under the learned tables, with a cache of bounded size."""

    def __init__(self, model: PairModel, tables: Tables, margin: float = 2.0, sure: int = 4) -> None:
        self.model, self.tables, self.margin, self.sure = model, tables, margin, sure
        self.split: dict[str, tuple[list, list]] = {}
        self.cache: dict[tuple, tuple[bool, str, list[int]]] = {}

    def ciphers(self, source: str) -> tuple[list, list]:
        if source not in self.split:
            known = self.tables.of(source)
            self.split[source] = [x for x in known if x[0].sub], [x for x in known if not x[0].sub]
        return self.split[source]

    def stretch(self, source: str, lang: str | None, frame: str) -> tuple[bool, str, list[int]]:
        """(garbled by itself, its reading, the single-byte ciphers under which it reads better)."""
        key = (source, lang, frame)
        got = self.cache.get(key)
        if got is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            several, single = self.ciphers(source)
            score_of = self.model.scorer(lang)
            plain = score_of(self.tables.as_it_stands(source, frame))
            score, text, _ = best_reading(frame, several, score_of, self.model.knows)
            marked = "\ufffd" in frame or C1.search(frame) is not None
            swapped = [] if only_signs(frame) else [(score_of(t) + w, k) for k, (c, w) in enumerate(single) if (t := c.apply(frame)) != frame]
            if score > plain + (0 if marked else self.margin) and score >= max(swapped, default=(score, 0))[0]:
                got = (True, text, [])
            else:
                got = (marked, frame, [k for v, k in swapped if v > plain])
            self.cache[key] = got
        return got

    def _swapped(self, source: str, lang: str | None, frames: list[str], better: set[int]) -> dict[int, str]:
        """Readings of the stretches under the one single-byte cipher that suits the whole value, by place."""
        single = self.ciphers(source)[1]
        score = self.model.scorer(lang)
        stands = lambda i: score(self.tables.as_it_stands(source, frames[i]))
        best, out = self.margin, {}
        for k in better:
            cipher, weight = single[k]
            read = {i: t for i, f in enumerate(frames) if (t := cipher.apply(f)) != f}
            gain = weight + sum(score(t) - stands(i) for i, t in read.items())
            if gain > best:
                best, out = gain, read
            elif not out:  # only a part of the value went through the cipher
                out = {i: t for i, t in read.items() if sum(a != b for a, b in zip(t, frames[i])) >= self.sure and score(t) + weight > stands(i) + self.margin}
        return out

    def read(self, source: str, lang: str | None, text: str) -> tuple[bool, str, bool]:
        """(garbled, the text as read, whether all of it could be read)."""
        text = unescaped(text)
        spans = stretches(text)
        frames = [framed(text, a, b) for a, b in spans]
        got = [self.stretch(source, lang, f) for f in frames]
        readings = {i: t for i, (bad, t, _) in enumerate(got) if bad}
        if better := {k for _, _, ks in got for k in ks}:
            rest = [i for i, (_, t, _) in enumerate(got) if t == frames[i]]
            readings.update({rest[j]: t for j, t in self._swapped(source, lang, [frames[i] for i in rest], better).items()})
        if not readings:
            return False, text, True
        out, at = [], 0
        for i, (a, b) in enumerate(spans):
            if i in readings:
                out += (text[at:a], readings[i][1:-1])
                at = b
        fixed = "".join(out) + text[at:]
        return True, fixed, "\ufffd" not in fixed and C1.search(fixed) is None


def repair(df: DataFrame, *, keys: list[str] | None = None, source: str = "source", lang: str | None = "lang", columns: list[str] | None = None, fitted: list | None = None) -> DataFrame:
    """(keys, field_name, garbled text, restored text or null, recoverable) of every garbled value, for each row."""
    keys, columns = keys or ["element_id"], columns or ["label", "help_text"]
    lang = lang if lang in df.columns else None
    out = None
    for blocks, n, model, tables in fitted or learn(df, source=source, lang=lang, columns=columns):
        part = _repair_block(df, keys, source, lang, columns, blocks, n, model, tables)
        out = part if out is None else out.unionByName(part)
    return out


def _repair_block(df: DataFrame, keys: list[str], source: str, lang: str | None, columns: list[str], blocks: int, n: int, model: PairModel, tables: Tables) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model, tables)
        for batch in batches:
            rows, fields, olds, news = [], [], [], []
            sources, langs = batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist()
            for k, name in enumerate(columns):
                for i, t in enumerate(batch.column(len(keys) + 2 + k).to_pylist()):
                    if t:
                        bad, text, whole = reader.read(sources[i], langs[i], t)
                        if bad:
                            rows.append(i), fields.append(name), olds.append(t), news.append(text if whole else None)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(take) for k in range(len(keys))), pa.array(fields, pa.string()), pa.array(olds, pa.string()), pa.array(news, pa.string())], names=[*(f"key_{k}" for k in range(len(keys))), "field_name", "garbled", "restored"])

    marked = [F.when(_marked(F.col(c)), F.col(c)).alias(f"text_{k}") for k, c in enumerate(columns)]
    some = F.lit(False)
    for k in range(len(columns)):
        some = some | F.col(f"text_{k}").isNotNull()
    lng = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    texts = df.select(*[F.col(c).alias(f"key_{k}") for k, c in enumerate(keys)], F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), lng.alias("lang"), *marked).filter(some)
    texts = texts.filter(_in_block("source", blocks, n)) if blocks > 1 else texts
    types = ", ".join(f"key_{k} {texts.schema[f'key_{k}'].dataType.simpleString()}" for k in range(len(keys)))
    out = texts.mapInArrow(run, f"{types}, field_name string, garbled string, restored string")
    return out.select(*[F.col(f"key_{k}").alias(c) for k, c in enumerate(keys)], "field_name", "garbled", "restored", F.col("restored").isNotNull().alias("recoverable"))


def garbled_fields(df: DataFrame, **options) -> DataFrame:
    """(keys, field_name), once each."""
    keys = options.get("keys") or ["element_id"]
    return repair(df, **options).select(*keys, "field_name").distinct()
