"""Cutting oversized items into pieces at natural boundaries, with overlap.

Method: an item is processed in ranges. Workers find the boundaries of their
range, reading a halo on both sides so that nothing at a range's edge is
misjudged; the boundary tables of the ranges are stitched by adding up the
lengths of the ranges before (prefix sums); one pass over an item's boundaries,
in order and without its text, fixes the cuts; pieces are then emitted by their
offsets. Texts in tables are cut into ranges of characters in their own row;
files into ranges of bytes, read by seeking, so that a giant file is spread over
all workers and never loaded whole.

A boundary is the end of a run of white space, or a place after a closing mark of
scripts that write no spaces. Its strength comes from what stands there, strongest
first: before a heading or after a delimiter line, a blank line, a line end, a
sentence end, other white space. To tell it, no more than ``REACH`` characters
before and ``AHEAD`` after the place are looked at, less than a halo holds, so that
the boundaries are the same however a text is divided into ranges. A piece ends at
the strongest boundary in its second half, the last of equals; without one at the
last boundary before; without any at the last place that doesn't part a letter from
its accents. The next piece begins ``overlap`` characters before that end.

Only the strongest boundary of each eighth of a piece is kept (without one, the last
place between whole letters), so that the boundary table is small against the text,
about eight rows for each piece. A piece is emitted by the range it begins in, whose
halo to the right is as long as a piece; no text is put together as a whole.

Defined results: null and empty items give no piece, items within the limit one;
an overlap of half the limit or more counts as half the limit less one; a limit
under 2 counts as 2; a null or unknown profile means the default profile;
redelivered rows (same key) count once; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = 1 << 14
HALO = 256
#: characters before and after a place that its strength depends on
REACH, AHEAD = 200, 8
_PLACE = re.compile(r"([.?!…;。！？][\"”’»)]{0,3})?(\s{1,100})(?!\s)|(?<=[。！？])(?![\s。！？])")
_HEADING = re.compile(r"#{1,6} ")
_DELIMITER = re.compile(r"(?:^|[\n\r])[ \t]*(?:\\?\*){3,}\Z")
_LINE_END = re.compile(r"\r\n|\n|\r")


def profile_rows(items: DataFrame, profiles: DataFrame, *, profile: str = "profile_name") -> DataFrame:
    """The items with max_chars and overlap_chars of their profile; null and unknown names get the default's.

    Profiles are joined as a table, however many there are; of several defaults
    the first by name counts.
    """
    rows = profiles.select(F.col("profile_name").alias("p"), F.col("max_chars").alias("m"), F.col("overlap_chars").alias("o"), F.coalesce("is_default", F.lit(False)).alias("d"))
    default = rows.orderBy(F.desc("d"), "p").first()
    if default is None:
        raise ValueError("no profile")
    out = items.join(rows.filter("p is not null").dropDuplicates(["p"]).drop("d"), F.col(profile) == F.col("p"), "left")
    return out.withColumn("max_chars", F.greatest(F.coalesce("m", F.lit(default.m)), F.lit(2))).withColumn("overlap_chars", F.coalesce("o", F.lit(default.o))).drop("p", "m", "o")


def _wide(size: int) -> Column:
    """Characters of a range: whole eighths of a piece, so that thinning needs one range only."""
    step = F.greatest(F.floor(F.col("max_chars") / 8), F.lit(1)).cast("int")
    return F.ceil(F.lit(size) / step).cast("int") * step


def ranges(items: DataFrame, *, text: str = "text", size: int = RANGE, halo: int = HALO) -> DataFrame:
    """A row for each range of each item: ``range_no``, ``range_start``, ``chars``, ``left`` (length of the halo before) and ``part``.

    The halo after is as long as a piece, so that a range holds the pieces that begin in it.
    """
    rows = items.filter(F.length(text) > 0).withColumn("wide", _wide(size))
    cut = F.transform(
        F.sequence(F.lit(0), ((F.length(text) - 1) / F.col("wide")).cast("int")),
        lambda n: F.struct(
            n.alias("range_no"),
            (n * F.col("wide")).alias("range_start"),
            F.least(F.lit(halo), n * F.col("wide")).alias("left"),
            F.substring(F.col(text), n * F.col("wide") - F.least(F.lit(halo), n * F.col("wide")) + 1, F.col("wide") + F.least(F.lit(halo), n * F.col("wide")) + F.greatest(F.col("max_chars"), F.lit(halo))).alias("part"),
            F.least(F.col("wide"), F.length(text) - n * F.col("wide")).alias("chars"),
        ),
    )
    return rows.select(*[c for c in items.columns if c != text], F.inline(cut))


def strength_at(part: str, m: re.Match) -> int:
    """The strength of the boundary that a match of ``_PLACE`` ends at."""
    white = m[2]
    if white is None:
        return 2
    lines = len(_LINE_END.findall(white))
    if lines:
        if _HEADING.match(part, m.end()):
            return 5
        if m.start(2) and part[m.start(2) - 1] == "*" and _DELIMITER.search(part, max(0, m.start(2) - 90), m.start(2)):
            return 5
        return 4 if lines > 1 else 3
    return 2 if m[1] else 1


def find_boundaries(part: str, left: int, chars: int, step: int) -> list[tuple[int, int]]:
    """(place in the range, strength) of the strongest boundary of each ``step`` characters, the last of equals; 0 for a place between letters."""
    best: dict[int, tuple[int, int]] = {}
    for m in _PLACE.finditer(part, 0, min(len(part), left + chars + REACH + AHEAD)):
        at = m.end() - left
        if 0 < at <= chars:
            slot, found = (at - 1) // step, (strength_at(part, m), at)
            if slot not in best or found > best[slot]:
                best[slot] = found
    for slot in range((chars + step - 1) // step):
        if slot not in best:
            end = min((slot + 1) * step, chars)
            at = safe_cut(part, left + end) - left
            if at > slot * step:
                best[slot] = (0, at)
    return sorted((at, s) for s, at in best.values())


def safe_cut(text: str, at: int) -> int:
    """The nearest place at or before ``at`` that doesn't part a letter from its accents, a joined sign or a line end."""
    while 0 < at < len(text) and (unicodedata.combining(text[at]) or text[at] in "\u200d\ufe0f" or text[at - 1] == "\u200d" or text[at - 1 : at + 1] == "\r\n"):
        at -= 1
    return at


class Cutter:
    """One item's cuts, from its boundaries in order. ``feed`` gives the ends that are settled by then."""

    def __init__(self, total: int, most: int, overlap: int) -> None:
        self.total, self.most = total, max(most, 2)
        self.overlap = max(0, min(overlap, (self.most - 1) // 2))
        self.start, self.seen = 0, []

    def _cut(self) -> tuple[int, int, int]:
        s, limit = self.start, self.start + self.most
        inside = [(a, g) for a, g in self.seen if s + self.overlap < a <= limit]
        natural = [(a, g) for a, g in inside if g]
        late = [(g, a) for a, g in natural if a > s + self.most // 2]
        if late:
            g, end = max(late)
        elif natural or inside:
            end, g = (natural or inside)[-1]
        else:
            end, g = limit, 0
        self.start = end - self.overlap
        self.seen = [(a, b) for a, b in self.seen if a > self.start]
        return s, end, g

    def feed(self, at: int, strength: int) -> list[tuple[int, int, int]]:
        out = []
        while self.total - self.start > self.most and at > self.start + self.most:
            out.append(self._cut())
        self.seen.append((at, strength))
        return out

    def close(self) -> list[tuple[int, int, int]]:
        out = []
        while self.total - self.start > self.most:
            out.append(self._cut())
        out.append((self.start, self.total, 9))
        return out


def _boundary_rows(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, max_chars, overlap_chars, range_start, chars, at, strength); every range has a row with strength -1 for its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(keys)
            most, start, chars, left, text = (b.column(n + k).to_pylist() for k in (0, 2, 3, 4, 5))
            rows, at, strength = [], [], []
            for i, t in enumerate(text):
                found = [(0, -1), *find_boundaries(t, left[i], chars[i], max(most[i] // 8, 1))]
                rows += [i] * len(found)
                at += [start[i] + a for a, _ in found]
                strength += [s for _, s in found]
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(take) for k in range(n + 4)), pa.array(at, pa.int64()), pa.array(strength, pa.int32())], names=[*keys, "max_chars", "overlap_chars", "range_start", "chars", "at", "strength"])

    source = parts.select(*keys, F.col("max_chars").cast("bigint").alias("max_chars"), F.col("overlap_chars").cast("bigint").alias("overlap_chars"), F.col("range_start").cast("bigint").alias("range_start"), F.col("chars").cast("bigint").alias("chars"), F.col("left").cast("bigint").alias("left"), "part")
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[: len(keys) + 4])
    return source.mapInArrow(run, f"{head}, at bigint, strength int")


def piece_offsets(parts: DataFrame, keys: list[str], *, with_limit: bool = False) -> DataFrame:
    """(keys, piece_no, piece_start, piece_chars, boundary): the pieces of the items by their offsets.

    ``boundary`` is the strength of the boundary at the piece's end, 0 for a cut
    at the limit and 9 for the item's end. An item's boundaries come in order to
    one task, one after another, without any text.
    """
    rows = _boundary_rows(parts, keys)
    total = F.sum(F.when(F.col("strength") < 0, F.col("chars"))).over(Window.partitionBy(*keys))  # one row a range
    ordered = rows.withColumn("total", total).sortWithinPartitions(*keys, "at", "strength")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields if f.name in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, cutter, number = None, None, 0
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in (*keys, "max_chars", "overlap_chars", "at", "strength", "total")]
            out: list[list] = []
            for *key, most, overlap, at, strength, total in zip(*cols):
                if key != current:
                    if cutter:
                        out += _numbered([*current, cutter.most], number, cutter.close())
                    current, cutter, number = key, Cutter(total, most, overlap), 0
                if strength >= 0:
                    pieces = cutter.feed(at, strength)
                    out += _numbered([*current, cutter.most], number, pieces)
                    number += len(pieces)
            if out:
                yield _pieces(out, b.schema, keys)
            schema = b.schema
        if cutter:
            yield _pieces(_numbered([*current, cutter.most], number, cutter.close()), schema, keys)

    out = ordered.mapInArrow(run, f"{kinds}, max_chars bigint, piece_no bigint, piece_start bigint, piece_chars bigint, boundary int")
    return out if with_limit else out.drop("max_chars")


def _numbered(key: list, number: int, pieces: list[tuple[int, int, int]]) -> list[list]:
    return [[*key, number + k, s, e - s, g] for k, (s, e, g) in enumerate(pieces)]


def _pieces(rows: list[list], schema: pa.Schema, keys: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    types = [*(schema.field(k).type for k in keys), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[*keys, "max_chars", "piece_no", "piece_start", "piece_chars", "boundary"])


def split_items(items: DataFrame, keys: list[str], *, text: str = "text", size: int = RANGE, halo: int = HALO) -> DataFrame:
    """(keys, piece_no, piece_start, piece_chars, boundary, piece) of items with max_chars and overlap_chars.

    Every piece is cut out of the range it begins in.
    """
    parts = ranges(items, text=text, size=size, halo=halo)
    offsets = piece_offsets(parts, keys, with_limit=True)
    placed = offsets.withColumn("of_range", F.floor(F.col("piece_start") / _wide(size)).cast("int")).drop("max_chars")
    held = parts.select(*[F.col(k).alias(f"of_{k}") for k in keys], "range_no", "range_start", "left", "part")
    on = F.col("of_range") == F.col("range_no")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    start = (F.col("piece_start") - F.col("range_start") + F.col("left") + 1).cast("int")
    columns = [c for c in offsets.columns if c != "max_chars"]
    return placed.join(held, on).select(*columns, F.substring("part", start, F.col("piece_chars").cast("int")).alias("piece"))


def rebuilt(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): the items put together again from their pieces, without what two pieces share."""
    ordered = F.array_sort(F.collect_list(F.struct("piece_no", "piece_start", "piece")))
    bits = F.transform(ordered, lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substring(x["piece"], (F.get(ordered, i - 1)["piece_start"] + F.length(F.get(ordered, i - 1)["piece"]) - x["piece_start"] + 1).cast("int"), F.length(x["piece"]))))
    return pieces.groupBy(*keys).agg(F.array_join(bits, "").alias("text"))


# ---- giant files, by ranges of bytes ----


def file_ranges(spark: SparkSession, path: str, *, size: int = 1 << 22, max_chars: int, overlap_chars: int) -> DataFrame:
    """(path, max_chars, overlap_chars, range_no, range_start, bytes, file_bytes) of the files under ``path``; no content is read."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("file_bytes"))
    rows = files.filter("file_bytes > 0").withColumn("range_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("file_bytes") - 1) / size))))
    rows = rows.withColumn("range_start", F.col("range_no") * size).withColumn("bytes", F.least(F.lit(size).cast("bigint"), F.col("file_bytes") - F.col("range_no") * size))
    return rows.select("path", F.lit(max_chars).alias("max_chars"), F.lit(overlap_chars).alias("overlap_chars"), "range_no", "range_start", "bytes", "file_bytes").repartition("path", "range_no")


def _open(path: str):
    from pyarrow import fs

    filesystem, name = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(name)


def _part_of(path: str, start: int, length: int, total: int, halo: int) -> tuple[str, int, int]:
    """(text with halos, characters of the halo before, characters of the range); a character belongs to the range of its first byte."""
    with _open(path) as f:
        a, b = max(0, start - 4 * halo), min(total, start + length + 4 * halo + 4)
        f.seek(a)
        raw = f.read(b - a)
    lead = lambda i: i >= len(raw) or raw[i] & 0xC0 != 0x80
    i, j = start - a, start + length - a
    while not lead(i):
        i += 1
    while not lead(j):
        j += 1
    first, end = 0, len(raw)
    while not lead(first):
        first += 1
    if b < total:
        while end > j and raw[end - 1] & 0xC0 == 0x80:
            end -= 1
        if end > j and raw[end - 1] >= 0xC0:
            end -= 1
    text = lambda x, y: raw[x:y].decode("utf-8", "replace")
    before, own, after = text(first, i) if i > first else "", text(i, j), text(j, end) if end > j else ""
    return before + own + after, len(before), len(own)


def split_files(spark: SparkSession, path: str, *, max_chars: int, overlap_chars: int, size: int = 1 << 22, halo: int = HALO) -> DataFrame:
    """(path, piece_no, piece_start, piece_chars, boundary, piece) of UTF-8 files, read range by range.

    Offsets count characters. A first pass counts the characters of the ranges,
    their prefix sums place the boundaries that a second pass finds, and a third
    emits the pieces of each range by seeking to it.
    """
    where = file_ranges(spark, path, size=size, max_chars=max_chars, overlap_chars=overlap_chars)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}
                text, left, chars = _part_of(row["path"], row["range_start"], row["bytes"], row["file_bytes"], halo)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, 1) for k in range(b.num_columns)), pa.array([chars], pa.int64()), pa.array([left], pa.int64()), pa.array([text], pa.string())], names=[*b.schema.names, "chars", "left", "part"])

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in where.schema.fields)
    read_parts = where.mapInArrow(read, f"{head}, chars bigint, left bigint, part string")
    before = Window.partitionBy("path").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = read_parts.select("path", "range_no", "chars").withColumn("char_start", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    parts = read_parts.drop("chars").join(placed, ["path", "range_no"])
    stitched = parts.select("path", "max_chars", "overlap_chars", F.col("char_start").alias("range_start"), "chars", "left", "part")
    offsets = piece_offsets(stitched, ["path"])
    # the ranges that a piece touches give their share of it
    spans = where.join(placed, ["path", "range_no"])
    touch = offsets.join(spans, "path").filter((F.col("piece_start") < F.col("char_start") + F.col("chars")) & (F.col("piece_start") + F.col("piece_chars") > F.col("char_start")))
    jobs = touch.groupBy(*where.columns, "char_start", "chars").agg(F.collect_list(F.struct("piece_no", "piece_start", "piece_chars", "boundary")).alias("pieces"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                text, left, chars = _part_of(row["path"], row["range_start"], row["bytes"], row["file_bytes"], 0)
                own = text[left : left + chars]
                c0, out = row["char_start"], []
                for p in row["pieces"]:
                    s, e = max(p["piece_start"], c0), min(p["piece_start"] + p["piece_chars"], c0 + chars)
                    out.append((row["path"], p["piece_no"], p["piece_start"], p["piece_chars"], p["boundary"], s, own[s - c0 : e - c0]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=["path", "piece_no", "piece_start", "piece_chars", "boundary", "at", "bit"])

    bits = jobs.mapInArrow(emit, "path string, piece_no bigint, piece_start bigint, piece_chars bigint, boundary int, at bigint, bit string")
    bit = F.array_sort(F.collect_list(F.struct("at", "bit")))
    return bits.groupBy("path", "piece_no", "piece_start", "piece_chars", "boundary").agg(F.array_join(F.transform(bit, lambda x: x["bit"]), "").alias("piece"))


# ---- the two tables of items ----


def oversized_items(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The items that come out in several pieces; that they are longer than their limit is checked on the pieces."""
    pieces = piece_offsets(parts, keys, with_limit=True)
    whole = pieces.groupBy(*keys).agg(F.count("*").alias("pieces"), F.max(F.col("piece_start") + F.col("piece_chars")).alias("chars"), F.max("max_chars").alias("max_chars"))
    return whole.filter((F.col("pieces") > 1) & (F.col("chars") > F.col("max_chars")))


def conversion_items(conversions: DataFrame, splits: DataFrame, profiles: DataFrame) -> DataFrame:
    """(source_table, record_id, chunk_no, max_chars, overlap_chars, text) of conversions and stored chunks, once for each key."""
    a = conversions.select(F.lit("conversion_results").alias("source_table"), F.col("conversion_id").alias("record_id"), F.lit(0).cast("bigint").alias("chunk_no"), "profile_name", F.col("markdown_content").alias("text"))
    b = splits.select(F.lit("split_results").alias("source_table"), F.col("split_id").alias("record_id"), "profile_name", F.posexplode("chunks").alias("chunk_no", "text"))
    b = b.select("source_table", "record_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "profile_name", "text")
    one = a.unionByName(b).filter(F.length("text") > 0).dropDuplicates(["source_table", "record_id", "chunk_no"])
    return profile_rows(one, profiles).drop("profile_name")
