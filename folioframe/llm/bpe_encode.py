"""Encoding a corpus with a public byte-level BPE vocabulary.

Method: in every partition the words not met before go, as token-position rows,
through a DuckDB recursive query that joins the merge table and contracts each
word's leftmost pair of minimum rank until nothing merges. Words already encoded
by the same Python worker come from a cache of bounded size, so the cost follows
the number of different words. The text never leaves its row: no shuffle.

Defined results: an empty list for null and for empty text; the strings of
special tokens are ordinary text; one row out for every row in, copies included;
no length limit: all words go through the same contraction, whatever their length.

In a round every pair is contracted that has the minimum rank within the reach of
the longest token, ties from the left. That is the outcome of contracting pairs
one by one wherever every token of the vocabulary is what contraction makes of its
own bytes, as training gives it (:func:`is_trained` tells): then no contraction can
give rise to a pair of a lower rank, since the bytes of that pair would have met
before, and no pair can be reached by what lies farther off than a token is long.
So the rounds don't grow with the length of a word.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits text before the merges of the 50k byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: In a round, of every word that still has a pair, all pairs are contracted that have the minimum rank
#: among the pairs within the length of the longest token on both sides; of overlapping ones (a run of one
#: token) every second from the run's beginning, once all of the run up to there has that minimum.
_CONTRACT = """
with recursive step(word, pos, token, n) as (
    select word, pos, token, 0 from fresh
  union all
    select word, pos, case when taken then merged else token end, n + 1
    from (select *, lag(taken) over (partition by word order by pos) as eaten
          from (select *, rank = best and begun > coalesce(max(case when rank is null or rank <> best then nr end) over (partition by word order by pos), 0) and (nr - begun) % 2 = 0 as taken
                from (select *, max(case when rank is distinct from before then nr end) over (partition by word order by pos) as begun
                      from (select *, lag(rank) over (partition by word order by pos) as before, count(rank) over (partition by word) as pairs,
                                   min(rank) over (partition by word {frame}) as best
                            from (select p.word, p.pos, p.token, p.n, p.nr, m.rank, m.merged
                                  from (select *, lead(token) over w as right_token, row_number() over w as nr
                                        from step window w as (partition by word order by pos)) p
                                  left join merges m on m.pair = p.token * 65536::bigint + p.right_token))
                      where pairs > 0)))
    where eaten is not true)
select word, list(token order by pos) as ids
from (select s.word, s.pos, s.token from step s
      join (select word, max(n) as n from step group by word) using (word, n))
group by word
"""


def default_vocabulary(name: str = "byte_bpe_50k") -> str:
    """Where the installed public vocabulary lies; ``FOLIOFRAME_TOKENIZERS`` overrides the folder."""
    folder = os.environ.get("FOLIOFRAME_TOKENIZERS", "/opt/tokenizers")
    if not os.path.isdir(folder) and (spec := importlib.util.find_spec("public_tokenizers")):
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, f"{name}.tiktoken")


def is_trained(ranks: dict[bytes, int]) -> bool:
    """Whether contraction by lower ranks makes two tokens of every token's bytes, so that the last one gives the token."""
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            r, i = min((ranks.get(x + y, rank), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if r >= rank:
                return False
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return True


class Encoder:
    """Words to ids by merge rows in DuckDB; one per Python worker and vocabulary."""

    _kept: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str, cache_words: int) -> Encoder:
        if path not in cls._kept:
            cls._kept[path] = cls(path, cache_words)
        return cls._kept[path]

    def __init__(self, path: str, cache_words: int = 1_000_000) -> None:
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.reach = max(map(len, self.ranks))
        self.byte_id = [self.ranks[bytes([i])] for i in range(256)]
        self.find = regex.compile(PATTERN).findall
        self.cache: dict[str, list[int]] = {}
        self.cache_words = cache_words
        self.db = None

    def _merges(self) -> pa.Table:
        """(pair, rank, merged) of every way to split a token into two; ids are under 65536."""
        a, b, r = [], [], []
        ranks = self.ranks
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                x, y = ranks.get(token[:k]), ranks.get(token[k:])
                if x is not None and y is not None:
                    a.append(x), b.append(y), r.append(rank)
        return pa.table({"pair": pa.array([x * 65536 + y for x, y in zip(a, b)], pa.int64()), "rank": pa.array(r, pa.int64()), "merged": pa.array(r, pa.int32())})

    def _connect(self):
        if self.db is None:
            import duckdb

            self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
            self.db.register("merge_rows", self._merges())
            self.db.execute("create table merges as select * from merge_rows")
        return self.db

    def learn(self, words: list[str]) -> None:
        """Encode the words and keep them."""
        ranks, cache, rows = self.ranks, self.cache, []
        for w in words:
            b = w.encode("utf-8", "surrogatepass")
            if (t := ranks.get(b)) is not None:  # the last contraction of a whole token gives that token
                cache[w] = [t]
            else:
                rows.append((w, b))
        # within a word no longer than the reach the frame is the whole word
        near = f"order by pos range between {self.reach} preceding and {self.reach} following"
        for frame, part in (("", [r for r in rows if len(r[1]) <= self.reach]), (near, [r for r in rows if len(r[1]) > self.reach])):
            for at in range(0, len(part), 50_000):
                self._contract(part[at : at + 50_000], frame)

    def _contract(self, rows: list[tuple[str, bytes]], frame: str) -> None:
        import numpy as np

        db = self._connect()
        lengths = np.array([len(b) for _, b in rows])
        ids = np.array(self.byte_id, dtype=np.int32)[np.frombuffer(b"".join(b for _, b in rows), dtype=np.uint8)]
        word = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
        pos = (np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int64)
        db.register("fresh", pa.table({"word": word, "pos": pos, "token": ids}))
        got = db.sql(_CONTRACT.format(frame=frame)).to_arrow_table()
        db.unregister("fresh")
        for k, tokens in zip(got.column("word").to_pylist(), got.column("ids").to_pylist()):
            self.cache[rows[k][0]] = tokens

    def encode(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """All ids one after another, and the offsets of the texts in them."""
        find, cache = self.find, self.cache
        if len(cache) > self.cache_words:  # bounded memory; nothing is lost, only encoded again
            cache.clear()
        split = [find(t) if t else () for t in texts]
        self.learn(list({w for words in split for w in words if w not in cache}))
        flat: list[int] = []
        offsets = [0]
        for words in split:
            for w in words:
                flat += cache[w]
            offsets.append(len(flat))
        return flat, offsets


def encode_texts(df: DataFrame, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, cache_words: int = 500_000) -> DataFrame:
    """(key, ids array<int>) of every row. ``vocabulary`` is a rank file every executor can read."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, cache_words)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 4000):
                flat, offsets = encoder.encode(texts.slice(at, 4000).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 4000), ids], names=["k", "ids"])

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode_ids(df: DataFrame, *, key: str = "doc_id", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(key, text) from ids: token rows join the vocabulary, an ordered aggregation puts the bytes together.

    Null and empty lists give an empty text.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        db = duckdb.connect(config={"threads": 1})
        with open(path, "rb") as f:
            pairs = [(int(b), base64.b64decode(a)) for a, b in (line.split() for line in f if line.strip())]
        db.register("words", pa.table({"id": [i for i, _ in pairs], "bytes": [w for _, w in pairs]}))
        for batch in batches:
            db.register("coded", pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), batch.column(1)], names=["n", "ids"])]))
            got = db.execute(
                "select n, list(w.bytes order by p) as parts from (select n, unnest(ids) as id, generate_subscripts(ids, 1) as p from coded) t join words w using (id) group by n"
            ).to_arrow_table()
            text = {n: b"".join(parts).decode("utf-8", "surrogatepass") for n, parts in zip(got.column("n").to_pylist(), got.column("parts").to_pylist())}
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([text.get(n, "") for n in range(batch.num_rows)], pa.string())], names=["k", "text"])

    rows = df.select(F.col(key).alias("k"), F.col(ids).alias("ids"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, text string").withColumnRenamed("k", key)
