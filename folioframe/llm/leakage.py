"""Evaluation passages inside a training corpus, by a distributed positional inverted index.

Method: the corpus is indexed once. An index is made of blocks, each the work of
one task on the documents of one part of the corpus: for every term of the block
one posting list (documents and places, in order), and the keys of its documents.
Blocks are written to the shared folder (or to ``index_path``, to be kept), sorted
by term, so that a set of test items reads the lists of its own terms only and a
further set of items costs no scan of the corpus.

Every window of ``min_words`` words of an item is entered at its three rarest terms
(by document frequency over the whole index), and once more at the next three, so
that a changed word doesn't hide a proximity match. Block by block, the posting
lists of these are intersected from the rarest on, each moved by its term's place in the
item. What survives are candidates (document, item, offset), of which only the
documents are read again and compared word by word:
    * phrase: at least ``min_words`` consecutive words of the item at this offset;
    * proximity: no such run, but at least ``min_words`` words of the item at their
      places, others between them changed.

Scale: the corpus is read once to be indexed, without a shuffle. Items are taken in
blocks of ``block_items``, so what is broadcast is bounded and any number of items
can be given; a posting list never leaves its block, candidates are as many as
matches. The blocks of a hot term are as many as those of the corpus.

Defined results: null, empty and blank texts match nothing, nor do items with
fewer than ``min_words`` words; copies of a document (same key) count once;
letter case and all that isn't a letter or digit are left aside; a document or
item of any length is used whole; null keys of documents are kept; empty tables
give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut_lineage, shared_folder

#: Fixed value: a word is a run of letters or digits.
WORD = r"[\p{L}\p{N}]+"
#: tokens of a block of the index, beyond which a new one begins
BLOCK_TOKENS = 4_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text.cast("string")), F.lit(WORD), F.lit(0))


def _block(keys: list[pa.Array], terms: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
    """One block: a row for each term with its postings, and a row without postings with the keys."""
    term, size = np.concatenate(terms), np.concatenate(sizes)
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
    start = np.cumsum(size) - size
    place = (np.arange(len(term)) - np.repeat(start, size)).astype(np.int32)
    order = np.argsort(term, kind="stable")  # within a term: by document, then place
    term = term[order]
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    edges = np.r_[first, len(term)]
    doc, place = doc[order], place[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])] if len(term) else np.zeros(0, bool)
    docs = np.add.reduceat(new, first) if len(first) else np.zeros(0, np.int64)
    data = np.ascontiguousarray(np.stack([doc, place], axis=1))
    postings = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer((edges * 8).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
    names = pa.concat_arrays(keys)
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([uuid.uuid4().hex] * (n + 1)),
            pa.concat_arrays([pa.array(term[first]), pa.array([0], pa.int64())]),
            pa.concat_arrays([pa.array(docs.astype(np.int64)), pa.array([len(names)], pa.int64())]),
            pa.concat_arrays([postings, pa.array([None], pa.binary())]),
            pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(names)], pa.int32()), names),
        ],
        names=["block", "term", "docs", "postings", "keys"],
    )


def build_index(docs: DataFrame, *, key: str = "doc_id", text: str = "text", index_path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the index of the corpus; (block, term, docs, postings, keys), one row for each term of each block."""
    rows = docs.select(F.col(key).alias("k"), F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("t")).filter(F.size("t") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, terms, sizes, held = [], [], [], 0
        for b in batches:
            lists = b.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            for a in range(0, b.num_rows, 2000):
                z = min(a + 2000, b.num_rows)
                keys.append(b.column(0).slice(a, z - a))
                terms.append(lists.values.to_numpy(zero_copy_only=False)[offsets[a] : offsets[z]])
                sizes.append(np.diff(offsets[a : z + 1]))
                held += len(terms[-1])
                if held >= block_tokens:
                    yield _block(keys, terms, sizes)
                    keys, terms, sizes, held = [], [], [], 0
        if keys:
            yield _block(keys, terms, sizes)

    kind = rows.schema["k"].dataType.simpleString()
    spark = docs.sparkSession
    where = index_path or f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    index = rows.mapInArrow(run, f"block string, term bigint, docs bigint, postings binary, keys array<{kind}>")
    index.write.option("compression", "zstd").parquet(where)
    return spark.read.schema(index.schema).parquet(where)


def item_words(items: DataFrame, min_words: int) -> DataFrame:
    """(item_id, iw, terms) of the items long enough."""
    w = items.select("item_id", words_of(F.col("text")).alias("iw")).filter(F.size("iw") >= min_words).distinct()
    return w.withColumn("terms", F.transform("iw", lambda x: F.xxhash64(x)))


def window_entries(terms: list[int], docs_of: dict[int, int], min_words: int) -> set[tuple]:
    """The places of the three rarest terms of every window, and of the next three, rarest first.

    A term that the corpus lacks rules a phrase out, but no proximity match.
    """
    out: set[tuple] = set()
    for a in range(len(terms) - min_words + 1):
        order = sorted((docs_of.get(t, 0), i) for i, t in enumerate(terms[a : a + min_words], a))
        for three in (order[:3], order[3:6]):
            if three and three[0][0]:
                out.add(tuple(i for _, i in three))
    return out


def _moved(postings: bytes, by: int) -> np.ndarray:
    """document and place less ``by`` of each posting, as one number."""
    pairs = np.frombuffer(postings, dtype=np.int32).reshape(-1, 2)
    return (pairs[:, 0].astype(np.int64) << 32) + (pairs[:, 1].astype(np.int64) - by + (1 << 31))


def _candidates(index: DataFrame, entries: list[tuple], kind: str) -> DataFrame:
    """(k, item, delta) where the three rarest terms of a window stand at their places; ``entries``: (item no, ((term, place), ...))."""
    spark = index.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted({t for _, at in entries for t, _ in at})], "wanted bigint")
    lists = index.join(F.broadcast(wanted), F.col("term") == F.col("wanted"), "left_semi")  # at most six terms a window
    needed = lists.filter("postings is not null").unionByName(index.filter("postings is null"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = {t: p for t, p in zip(pdf["term"], pdf["postings"]) if p is not None}
        names = next((k for p, k in zip(pdf["postings"], pdf["keys"]) if p is None), [])
        moved: dict[tuple, np.ndarray] = {}
        out = []
        for item, at in entries:
            if any(t not in lists for t, _ in at):
                continue
            left = None
            for t, place in at:
                if (t, place) not in moved:
                    moved[t, place] = _moved(lists[t], place)
                left = moved[t, place] if left is None else np.intersect1d(left, moved[t, place], assume_unique=True)
                if not len(left):
                    break
            out += [(names[int(x) >> 32], item, (int(x) & 0xFFFFFFFF) - (1 << 31)) for x in left]
        return pd.DataFrame(out, columns=["k", "item", "delta"])

    return needed.groupBy("block").applyInPandas(run, f"k {kind}, item int, delta bigint").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 12, block_items: int = 5_000, index: DataFrame | None = None) -> DataFrame:
    """(key, item_id, kind, matched_words, near_words, first_word): the documents with a phrase or a proximity match of an item.

    ``matched_words`` is the longest run of consecutive item words, ``near_words``
    how many words of the item stand at their places at this offset, ``first_word``
    the place of the run in the document. ``index``: one made before by
    :func:`build_index` from the same documents.
    """
    index = build_index(docs, key=key, text=text) if index is None else index
    kind = docs.schema[key].dataType.simpleString()
    held = cut_lineage(item_words(items, min_words))
    blocks = max(1, -(-held.count() // block_items))
    found = None
    for n in range(blocks):
        part = _find_block(docs, held.filter(F.pmod(F.xxhash64("item_id", "iw"), F.lit(blocks)) == n), index, kind, key, text, min_words)
        found = part if found is None else found.unionByName(part)
    best = found.groupBy(F.col("k").alias(key), "item_id").agg(F.max("m").alias("m"))
    return best.select(key, "item_id", F.when(F.col("m.best") >= min_words, "phrase").otherwise("proximity").alias("kind"), F.col("m.best").alias("matched_words"), F.col("m.near").alias("near_words"), F.col("m.first").alias("first_word"))


def _find_block(docs: DataFrame, items: DataFrame, index: DataFrame, kind: str, key: str, text: str, min_words: int) -> DataFrame:
    """(k, item_id, m) for one block of items."""
    spark = docs.sparkSession
    kept = items.collect()  # a block of items
    terms = spark.createDataFrame([(t,) for t in sorted({t for r in kept for t in r.terms})], "wanted bigint")
    counts = index.filter("postings is not null").select("term", "docs").join(F.broadcast(terms), F.col("term") == F.col("wanted"), "left_semi").groupBy("term").agg(F.sum("docs").alias("n"))
    docs_of = {r.term: r.n for r in counts.collect()}  # at most the terms of a block of items
    entries = [(n, tuple((r.terms[i], i) for i in at)) for n, r in enumerate(kept) for at in sorted(window_entries(r.terms, docs_of, min_words))]
    item_kind = items.schema["item_id"].dataType.simpleString()
    words = spark.createDataFrame([(n, r.item_id, list(r.iw)) for n, r in enumerate(kept)], f"item int, item_id {item_kind}, iw array<string>")
    candidates = cut_lineage(_candidates(index, entries, kind))
    # the candidates are as many as the matches; their documents are read again and compared word by word
    texts = docs.select(F.col(key).alias("of"), F.col(text).cast("string").alias("t")).filter("t is not null")
    met = texts.join(candidates, F.col("of").eqNullSafe(F.col("k"))).drop("of").withColumn("words", words_of(F.col("t"))).drop("t")
    met = met.join(F.broadcast(words), "item")  # a block of items
    grown = lambda s, w: F.when(F.get("words", (F.col("delta") + s["i"]).cast("int")) == w, s["len"] + 1).otherwise(0)
    run = F.aggregate(
        "iw",
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("len"), F.lit(0).alias("best"), F.lit(0).alias("end"), F.lit(0).alias("near")),
        lambda s, w: F.struct(
            (s["i"] + 1).alias("i"),
            grown(s, w).alias("len"),
            F.greatest(s["best"], grown(s, w)).alias("best"),
            F.when(grown(s, w) > s["best"], s["i"]).otherwise(s["end"]).alias("end"),
            (s["near"] + F.when(grown(s, w) > 0, 1).otherwise(0)).alias("near"),
        ),
    )
    match = F.struct(F.col("r.best").alias("best"), F.col("r.near").alias("near"), (F.col("delta") + F.col("r.end") - F.col("r.best") + 1).alias("first"))
    return met.select("k", "item_id", "delta", run.alias("r")).filter(F.col("r.near") >= min_words).select("k", "item_id", match.alias("m"))


def phrases(found: DataFrame) -> DataFrame:
    return found.filter("kind = 'phrase'")


def leaked_items(found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(item_id, documents, longest): the report of the items of which a phrase leaked."""
    return phrases(found).groupBy("item_id").agg(F.countDistinct(key).alias("documents"), F.max("matched_words").alias("longest"))
