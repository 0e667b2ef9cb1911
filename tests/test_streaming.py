import json
from datetime import datetime, timedelta

from folioframe.operators import structure
from folioframe.streaming import assembler

CHUNKS = [("a", 0, "# One\n**Q1**: x"), ("a", 1, "**Q2** [YES_NO]: y"), ("a", 2, "# Two\n**Q3**: z"), ("b", 0, "**Q4**: w")]


def write(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("doc_id", "chunk_index", "chunk"), r))) for r in rows))


def test_stream_equals_batch_in_any_order_and_after_a_restart(spark, tmp_path):
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    run = lambda: assembler.keep_stream(assembler.assemble_stream(assembler.arriving_files(spark, str(source), "doc_id string, chunk_index bigint, chunk string", most=1)), out, cp).awaitTermination()
    write(source, "1.json", [CHUNKS[2], CHUNKS[1]])
    run()
    write(source, "2.json", [CHUNKS[0], CHUNKS[0], CHUNKS[3], CHUNKS[1]])
    run()
    got = sorted((r.doc_id, r.chunk_index, r.code, r.type, r.section_seq, r.global_position, r.section_relative_position) for r in spark.read.parquet(out).collect())
    batch = structure.element_positions(spark.createDataFrame(CHUNKS, "doc_id string, chunk_index bigint, chunk string"))
    assert got == sorted((r.doc_id, r.chunk_index, r.code, r.type, r.section_seq, r.global_position, r.section_relative_position) for r in batch.collect())


def test_a_lost_chunk_holds_nothing_up_for_ever():
    class State:
        exists, hasTimedOut, removed, get = True, True, False, (1, 0, None, 0, 0, json.dumps({"3": "**B**: y", "2": "**A**: x"}))

        def remove(self):
            self.removed = True

    state = State()
    rows = [r for b in assembler._assembler(1000)(("d",), iter([]), state) for r in b["code"]]
    assert rows == ["A", "B"] and state.removed


def test_windows(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame([("u", t0), ("u", t0 + timedelta(minutes=2)), ("u", t0 + timedelta(minutes=30))], "u string, ts timestamp")
    assert assembler.windowed_counts(df, ts="ts", by=["u"], late="1 hour", width="10 minutes").count() == 2
    assert sorted(r.n for r in assembler.session_counts(df, ts="ts", by=["u"], late="1 hour", gap="5 minutes").collect()) == [1, 2]
    assert assembler.ProgressLog(2).rows == []
