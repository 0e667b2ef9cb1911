"""Near-duplicate records by anchor-point covering.

Method: a record is the set of its words; two records belong together where the
words found in both are at least ``share`` of the words found in either. Sets are
points under symmetric difference, which a pair may differ by up to a threshold that
follows from the share and the sizes. The anchors are words and pairs of words, that
is the points of weight 1 and 2; a record is replicated to the anchors of its first
``size - ceil(share * size) + weight`` words in order of rarity, and fingerprints
(size and two 64-bit parity words, which differ in at most as many bits as the sets
in words) are compared anchor by anchor. The few pairs left are verified on the words
themselves, so no pair is lost or found by a hash alone.

This covers as a covering design does, from the rare words up; a code over the whole
fingerprint space, as the method is named for, can't give the result asked for, all
pairs that pass the share: word sets are sparse, so nearly all blocks of their parity
vectors decode to the codeword zero (the README has the figures), and a threshold of
several words leaves a radius that reaches most codewords.

Completeness: the rarest word that two such records share lies within both their
prefixes of weight 1. If it is rare, its anchor holds both. If not, no shared word
is rare, at least two shared words lie in both prefixes of weight 2, and the
anchor of the first two of them holds both. Where one of the two has ``long`` words
or more, both have ``share * long`` or more: such records have an anchor for each
word of their prefix of weight 1, so that the anchors of a record grow with its size
only. So no link is lost, whatever the data.

Scale: equal sets are one point with members, so copies are never compared; the
order of rarity comes from counts in a table of fixed size (2**18), which is all
that is broadcast; a rare word's anchor holds at most ``rare`` points by
definition, and the anchors of pairs thin out with the square of the words'
shares. The join on anchors is an ordinary equi-join that adaptive execution splits
where an anchor is hot. Pairs of records are an edge view; :func:`groups` gives one
row for each record with its class and its number of links.

Defined results: null labels and labels with fewer than ``min_words`` words take
no part; null variables, entries and labels of entries have no words; redelivered
rows (same key) are one record; ties don't exist, as a pair either passes the
share or not; an empty table gives no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut_lineage

#: Fixed value: a word is a run of letters or digits.
WORD = r"[\p{L}\p{N}]+"
BUCKETS = 1 << 18


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_sets(df: DataFrame, *, key: str = "element_id", label: str = "label", parts: str | None = "variables", min_words: int = 8) -> DataFrame:
    """(key, set_id, words): the distinct words of every record, sorted and joined by spaces, for each row."""
    both = F.concat_ws(" ", F.col(label), F.array_join(F.transform(parts, lambda v: v["label"]), " ")) if parts else F.col(label)
    long_enough = df.filter(F.size(_words(F.col(label))) >= min_words)
    rows = long_enough.select(F.col(key).alias("key"), F.array_join(F.array_sort(F.array_distinct(_words(both))), " ").alias("words"))
    return rows.select("key", F.xxhash64("words").alias("set_id"), "words")


def _each(words: Column | str) -> Column:
    return F.split(words, " ")


def _hashed(words: Column | str) -> Column:
    return F.transform(_each(words), lambda w: F.shiftright(F.xxhash64(w), 32).cast("int"))


def rarity(sets: DataFrame) -> np.ndarray:
    """How many words of all sets fall into each bucket: an upper bound of every word's count, of fixed size."""
    counts = sets.select(F.explode(_hashed("words")).alias("w")).groupBy(F.shiftrightunsigned("w", 14).alias("b")).count().collect()  # at most 2**18 rows
    table = np.zeros(BUCKETS, dtype=np.int64)
    for r in counts:
        table[r.b] = r["count"]
    return table


def anchor_rows(sets: DataFrame, counts: np.ndarray, *, share_num: int = 7, share_den: int = 10, rare: int = 200, long: int = 128) -> DataFrame:
    """(anchor, set_id, size, f1, f2): each fingerprint at each of its anchors."""

    def mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            words = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.uint32)
            offsets -= offsets[0]
            size = np.diff(offsets)
            rec = np.repeat(np.arange(len(ids)), size)
            count = counts[words >> np.uint32(14)]
            order = np.lexsort((words, count, rec))
            words, count = words[order].astype(np.uint64), count[order]
            start = offsets[:-1]
            one = np.uint64(1)
            f1 = np.bitwise_xor.reduceat(one << (words & np.uint64(63)), start) if len(words) else np.zeros(0, np.uint64)
            f2 = np.bitwise_xor.reduceat(one << ((words >> np.uint64(6)) & np.uint64(63)), start) if len(words) else np.zeros(0, np.uint64)
            place = np.arange(len(words)) - np.repeat(start, size)
            keep = (share_num * size + share_den - 1) // share_den
            is_rare = count <= rare
            short = size < long
            inside = place < np.repeat(size - keep + 1, size)
            single = np.flatnonzero(is_rare & inside & np.repeat(short, size))
            of_long = np.flatnonzero(inside & np.repeat(size * share_den >= long * share_num, size))
            who, anchors = [rec[single], rec[of_long]], [mix(words[single] + np.uint64(1 << 40)), mix(words[of_long] + np.uint64(1 << 41))]
            rares = np.add.reduceat(is_rare, start) if len(words) else np.zeros(0, int)  # the rare words come first
            left = np.where(short, np.minimum(size - keep + 2, size) - rares, 0)
            for m in np.unique(left[left >= 2]):
                i, j = np.triu_indices(m, 1)
                of = np.flatnonzero(left == m)
                first = (start + rares)[of]
                a, b = words[first[:, None] + i], words[first[:, None] + j]
                who.append(np.repeat(of, len(i)))
                anchors.append(mix((a << np.uint64(32) | b).ravel()))
            who_all = np.concatenate(who)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(anchors).view(np.int64)), pa.array(ids[who_all]), pa.array(size[who_all].astype(np.int32)), pa.array(f1[who_all].view(np.int64)), pa.array(f2[who_all].view(np.int64))],
                names=["anchor", "set_id", "size", "f1", "f2"],
            )

    points = sets.filter("words <> ''").select("set_id", _hashed("words"))
    return points.mapInArrow(run, "anchor bigint, set_id bigint, size int, f1 bigint, f2 bigint")


def similar_sets(sets: DataFrame, *, share_num: int = 7, share_den: int = 10, rare: int = 200) -> DataFrame:
    """(set_a, set_b): all pairs of different sets of (set_id, words) that pass the share."""
    rows = anchor_rows(sets, rarity(sets), share_num=share_num, share_den=share_den, rare=rare)
    a, b = (rows.select("anchor", *[F.col(c).alias(f"{c}_{s}") for c in ("set_id", "size", "f1", "f2")]) for s in "ab")
    apart = F.bit_count(F.col("f1_a").bitwiseXOR(F.col("f1_b")))
    apart2 = F.bit_count(F.col("f2_a").bitwiseXOR(F.col("f2_b")))
    sizes = F.col("size_a").cast("int") + F.col("size_b")
    # |A xor B| <= (a + b) * (1 - share) / (1 + share)
    most = (share_den - share_num) * sizes
    close = (F.greatest(apart, apart2) * (share_den + share_num) <= most) & (F.col("size_a") * share_den >= F.col("size_b") * share_num) & (F.col("size_b") * share_den >= F.col("size_a") * share_num)
    near = a.join(b, "anchor").filter((F.col("set_id_a") < F.col("set_id_b")) & close).select("set_id_a", "set_id_b").distinct()
    wa = sets.select(F.col("set_id").alias("set_id_a"), F.col("words").alias("wa"))
    wb = sets.select(F.col("set_id").alias("set_id_b"), F.col("words").alias("wb"))
    shared = F.size(F.array_intersect(_each("wa"), _each("wb")))
    passed = near.join(wa, "set_id_a").join(wb, "set_id_b").filter(shared * share_den >= (F.size(_each("wa")) + F.size(_each("wb")) - shared) * share_num)
    return passed.select(F.col("set_id_a").alias("set_a"), F.col("set_id_b").alias("set_b"))


def similar_records(df: DataFrame, *, key: str = "element_id", share_num: int = 7, share_den: int = 10, **options) -> tuple[DataFrame, DataFrame]:
    """The members (key, set_id) and the links (set_a, set_b) between classes of equal sets."""
    rows = word_sets(df, key=key, **options)  # made twice, which costs less than to keep all texts of copies
    members = cut_lineage(rows.select(F.col("key").alias(key), "set_id").dropDuplicates([key]))  # one of the sets, should rows of a key differ
    links = similar_sets(cut_lineage(rows.select("set_id", "words").dropDuplicates(["set_id"])), share_num=share_num, share_den=share_den)
    classes = members.select("set_id").distinct()
    for side in ("set_a", "set_b"):
        links = links.join(classes.withColumnRenamed("set_id", side), side, "left_semi")
    return members, links.select("set_a", "set_b")


def record_pairs(members: DataFrame, links: DataFrame, *, key: str = "element_id") -> DataFrame:
    """(key_a, key_b), a < b: every pair of records, copies included; a record without a key makes no pair."""
    members = members.filter(F.col(key).isNotNull())
    a = members.select(F.col("set_id").alias("set_a"), F.col(key).alias("x"))
    b = members.select(F.col("set_id").alias("set_b"), F.col(key).alias("y"))
    across = links.join(a, "set_a").join(b, "set_b").select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))
    several = members.groupBy("set_id").count().filter("count > 1").select("set_id")
    copies = members.join(several, "set_id")
    c = copies.select("set_id", F.col(key).alias(f"{key}_a")).join(copies.select("set_id", F.col(key).alias(f"{key}_b")), "set_id").filter(F.col(f"{key}_a") < F.col(f"{key}_b"))
    return across.unionByName(c.select(f"{key}_a", f"{key}_b"))


def groups(members: DataFrame, links: DataFrame, *, key: str = "element_id") -> DataFrame:
    """(key, group_id, links): each record's group (connected component, named by its smallest key) and the number of other classes it is linked to.

    Smallest labels travel along the links and along the labels found so far, so
    that long chains take few rounds; every round is cut. Ends when no label moves.
    """
    edges = cut_lineage(links.unionByName(links.select(F.col("set_b").alias("set_a"), F.col("set_a").alias("set_b"))).distinct())
    label = cut_lineage(edges.groupBy("set_a").agg(F.least(F.min("set_b"), F.col("set_a")).alias("l")))
    while True:
        near = edges.join(label.withColumnRenamed("set_a", "set_b"), "set_b").groupBy("set_a").agg(F.min("l").alias("m"))
        met = label.join(near, "set_a").select("set_a", "l", F.least("l", "m").alias("n"))
        jump = met.join(label.select(F.col("set_a").alias("n"), F.col("l").alias("far")), "n", "left").select("set_a", "l", F.least("n", F.coalesce("far", "n")).alias("n"))
        step = cut_lineage(jump)
        moved = step.filter("n <> l").limit(1).count()
        label = step.select("set_a", F.col("n").alias("l"))
        if not moved:
            break
    degree = edges.groupBy("set_a").agg(F.count("*").alias("links"))
    of = label.join(degree, "set_a").withColumnRenamed("set_a", "set_id")
    placed = members.join(of, "set_id", "left").select(key, F.coalesce("l", "set_id").alias("label"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
    names = placed.groupBy(F.col("label").alias("of_label")).agg(F.min(key).alias("group_id"))
    return placed.join(names, F.col("label") == F.col("of_label")).select(key, "group_id", "links")
