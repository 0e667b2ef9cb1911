"""Incremental assembly of surveys from chunks that arrive in any order, with progress metrics.

State is kept for each document: the chunks that can't be placed yet, the open
section and the counters. Order within a document comes from ``chunk_index``
alone, so the outcome equals the batch operator's on the same chunks, also after
a restart from the checkpoint. A document that gets nothing for ``expire_ms`` gives
what it still holds, in order and over the gaps, and its state is removed: a chunk
that never comes holds nothing up for ever.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioframe.operators.structure import ELEMENT_MARK

OUT = "chunk_index bigint, section_seq bigint, section_title string, code string, type string, global_position bigint, section_relative_position bigint"
STATE = "next_chunk bigint, section_seq bigint, section_title string, in_document bigint, in_section bigint, waiting string"
_TITLE = re.compile(r"^# (.+)$", re.M)
_ELEMENT = re.compile(ELEMENT_MARK)
_COLUMNS = [f.split()[0] for f in OUT.split(", ")]


def _place(index: int, chunk: str, s: dict) -> list[tuple]:
    if m := _TITLE.search(chunk):
        s["section_seq"] += 1
        s["section_title"], s["in_section"] = m[1].strip(), 0
    out = []
    for e in _ELEMENT.finditer(chunk):
        s["in_document"] += 1
        s["in_section"] += 1
        out.append((index, s["section_seq"], s["section_title"], e[1].strip(), (e[2] or "CHOICE").strip(), s["in_document"], s["in_section"]))
    return out


def _assembler(expire_ms: int | None):
    names = [f.split()[0] for f in STATE.split(", ")]

    def assemble(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = dict(zip(names, state.get)) if state.exists else {"next_chunk": 0, "section_seq": 0, "section_title": None, "in_document": 0, "in_section": 0, "waiting": "{}"}
        waiting = {int(k): v for k, v in json.loads(s["waiting"]).items()}
        rows = []
        if state.hasTimedOut:
            for i in sorted(waiting):
                rows += _place(i, waiting[i] or "", s)
            state.remove()
        else:
            for b in batches:
                for i, c in zip(b["chunk_index"], b["chunk"]):
                    if i >= s["next_chunk"]:  # a chunk delivered again counts once
                        waiting.setdefault(int(i), c)
            while s["next_chunk"] in waiting:
                rows += _place(s["next_chunk"], waiting.pop(s["next_chunk"]) or "", s)
                s["next_chunk"] += 1
            s["waiting"] = json.dumps(waiting)
            state.update(tuple(s[n] for n in names))
            if expire_ms:
                state.setTimeoutDuration(expire_ms)
        if rows:
            yield pd.DataFrame([(key[0], *r) for r in rows], columns=["doc", *_COLUMNS])

    return assemble


def assemble_stream(chunks: DataFrame, *, doc: str = "doc_id", expire_ms: int | None = None) -> DataFrame:
    """(doc, chunk_index, chunk) as it arrives to element rows, each emitted once its predecessors are there."""
    kind = chunks.schema[doc].dataType.simpleString()
    timeout = GroupStateTimeout.ProcessingTimeTimeout if expire_ms else GroupStateTimeout.NoTimeout
    rows = chunks.select(F.col(doc).alias("doc"), F.col("chunk_index").cast("bigint").alias("chunk_index"), "chunk")
    return rows.groupBy("doc").applyInPandasWithState(_assembler(expire_ms), f"doc {kind}, {OUT}", STATE, "append", timeout).withColumnRenamed("doc", doc)


def windowed_counts(events: DataFrame, *, ts: str, by: list[str], late: str, width: str, slide: str | None = None) -> DataFrame:
    """Counts by event time with a watermark, in tumbling or sliding windows."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.withWatermark(ts, late).groupBy(w, *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def session_counts(events: DataFrame, *, ts: str, by: list[str], late: str, gap: str) -> DataFrame:
    """Counts by session: events of a key no more than ``gap`` apart."""
    rows = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *by).agg(F.count("*").alias("n"))
    return rows.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *by, "n")


def arriving_files(spark: SparkSession, path: str, schema: str, *, most: int = 1000, kind: str = "json") -> DataFrame:
    """The rows of files as they arrive in a folder, at most so many files a batch; each file is read once, also after a restart."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most).format(kind).load(path)


def keep_stream(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", kind: str = "parquet"):
    """Write a stream exactly once to files, from where its checkpoint left off, until all that is there has been read."""
    return df.writeStream.outputMode(mode).format(kind).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class ProgressLog(StreamingQueryListener):
    """Keeps (batch, rows, rows a second, milliseconds) of every batch of a query."""

    def __init__(self, most: int = 10_000) -> None:
        self.rows: list[tuple] = []
        self.most = most

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows.append((p.batchId, p.numInputRows, p.processedRowsPerSecond, p.batchDuration))
        del self.rows[: -self.most]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
