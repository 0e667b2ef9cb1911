from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioframe.functions import text as T
from folioframe.operators import assemble, diff, metrics, monitor, nested, validate


def test_diff_cases(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q"), (None, "n", "z"), (4, "d", "e")], "k int, v string, w string")
    b = spark.createDataFrame([(1, "x", ""), (2, "Y", "q"), (None, "n2", "z"), (5, "new", None), (4, "d", "e"), (4, "d2", "e")], "k int, v string, w string")
    got = sorted((r.k or 0, r["diff"]) if r["diff"] else (r.k or 0, "") for r in diff.keyed_diff(a, b, ["k"]).collect())
    assert got == [(0, "v: n => n2"), (1, ""), (2, "v: y => Y"), (4, ""), (4, "v: d => d2"), (5, "ADDED")]
    with pytest.raises(ValueError):
        diff.keyed_diff(a, b, ["missing"])
    s = diff.summary(diff.keyed_diff(a, b, ["k"])).first()
    assert (s.total, s.added, s.modified, s.unchanged) == (6, 1, 3, 2)
    assert diff.normalize_columns(spark.createDataFrame([(1,)], "` A-b ` int")).columns == ["a_b"]


def test_string_differences_count_the_originals_side(spark):
    assert metrics.diff_counts("a b c", "a c") == (2, 1, 1, 50.0) and metrics.diff_counts("abc", "abcd") == (0, 0, 0, 0.0)
    df = spark.createDataFrame([(1, "a b", None), (2, None, "x"), (3, "x" * 700, "x" * 350)], "k int, a string, b string")
    got = {r.k: (r.changed, r.white_space, r.other) for r in metrics.string_diff(df, key="k", a="a", b="b").collect()}
    assert got[1] == (3, 1, 2) and got[2] == (0, 0, 0)


def test_missing_windows():
    text = "".join(chr(65 + i % 26) + str(i) for i in range(400))
    assert metrics.missing_windows(text, text) == [] and metrics.missing_windows("", "x") == []
    gone = text[:600] + text[900:]
    regions = metrics.missing_windows(text, gone)
    assert regions and all(r in text for r in regions) and any(text[600:900][:100] in r for r in regions)


def test_reports_merge_and_renumber(spark):
    df = spark.createDataFrame([("s", "a", 3), ("s", "b", None), ("s", "c", 1), ("s", "d", 3)], "s string, e string, position int")
    assert [r.e for r in assemble.renumber(df, ["s"], "position", ["e"]).orderBy("new_position").collect()] == ["c", "a", "d", "b"]
    new = spark.createDataFrame([(1, "n"), (2, "n"), (2, "m")], "k int, v string")
    assert sorted(r.v for r in assemble.anti_merge(new, spark.createDataFrame([(1, "o")], "k int, v string"), ["k"]).collect()) == ["m", "n", "o"]


def test_nested_places_with_nulls_and_bare_objects(spark):
    schema = "section_id bigint, loaded_at int, elements array<struct<code:string,tags:array<struct<key:string,value:string>>,variables:array<struct<code:string,tags:array<struct<key:string,value:string>>>>,columns:array<struct<code:bigint,tags:array<struct<key:string,value:string>>>>>>, extra int"
    e = ("e", [("k", "v"), None], [None, ("v", [("a", "b")])], [])
    df = spark.createDataFrame([(1, 1, [None, e], 0), (1, 2, [e], 0), (2, 1, None, 0), (None, 1, [e], 0)], schema)
    rows = nested.nested_places(nested.flatten_sections(df, fields=True), "t").collect()
    got = sorted((r.record_id or 0, r.node_kind, r.element_no, r.child_no, r.tag_no) for r in rows)
    one = [("element", 0, -1, -1), ("element_tag", 0, -1, 0), ("variable", 0, 1, -1), ("variable_tag", 0, 1, 0)]
    assert got == sorted((k, *x) for k in (0, 1) for x in one)
    cp = spark.createDataFrame([(1, "section", '{"section_data": {"elements": {"code": 5, "tags": {"key": "k"}}}}', 1), (2, "element", '{"element_data": {"variables": [null, {"code": "v"}]}}', 1), (3, "section", "broken", 1), (4, None, None, 1)], "checkpoint_id int, cp_type string, payload string, saved_at int")
    rows = nested.nested_places(nested.flatten_payloads(cp), "c").collect()
    assert sorted((r.record_id, r.node_kind, r.element_no, r.child_no, r.tag_no) for r in rows) == [(1, "element", 0, -1, -1), (1, "element_tag", 0, -1, 0), (2, "element", 0, -1, -1), (2, "variable", 0, 1, -1)]


SCHEMA = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"$ref": "#/definitions/n"}, "l": {"type": "array", "items": {"type": ["string", "null"]}}, "e": {"enum": [1, "x"]}}, "definitions": {"n": {"type": "integer"}}}


@pytest.mark.parametrize("text, paths", [('{"a": 1}', []), ('{"a": "x"}', ["$.a"]), ("{}", ["$"]), ('{"a": 1, "l": ["x", null, 3]}', ["$.l[2]"]), ('{"a": 1, "e": 2}', ["$.e"]), ('{"a": 1, "z": 0}', ["$"]), ("nope", ["$"]), (None, [])])
def test_schema_errors(spark, text, paths):
    df = spark.createDataFrame([(1, text)], "k int, t string")
    assert [r.path for r in validate.validate_json(df, SCHEMA, key="k", text="t").collect()] == paths


def test_fences(spark):
    df = spark.createDataFrame([(1, '```json\n{"sections": [{"code": 1}]}\n```'), (2, '{"other": 1}'), (3, "no")], "k int, t string")
    assert [r.k for r in validate.combine_sections(df, key="k", text="t").collect()] == [1]


def test_text_functions(spark):
    row = spark.createDataFrame([("  ab aXa \x1c",)], "t string").select(T.strip(F.col("t")), T.rfind(F.col("t"), "a"), T.rfind(F.col("t"), "zz"), T.word_count(F.col("t")), T.safe_label(F.lit("é/x y"), "d"), T.safe_label(F.lit(""), "d"), T.match_rows(F.lit("xaaxbb"), "(a+|b+)", 1)).first()
    assert row[0] == "ab aXa" and row[1] == 7 and row[2] == -1 and row[3] == 2 and row[4] == "é_x_y" and row[5] == "d" and [(m.start, m.end, m.g1) for m in row[6]] == [(1, 3, "aa"), (4, 6, "bb")]
    assert spark.range(1).select(T.render("a [[x]] [[y]]", {"x": F.lit(" v "), "y": F.lit(None)})).first()[0] == "a v "


def test_monitoring(spark):
    t0 = datetime(2024, 1, 1)
    e = lambda s, event, **k: ("r", t0 + timedelta(seconds=s), event, k.get("chunk"), k.get("kind"), k.get("conf"), k.get("ms"), k.get("message"), k.get("tin"), None)
    rows = [e(0, "phase", kind="analyzing"), e(1, "chunk_start", chunk=0), e(2, "analysis", chunk=0, kind="A", conf=0.9, ms=5.0), e(3, "extraction", chunk=0, ms=7.0, tin=3), e(4, "chunk_done", chunk=0), e(5, "chunk_done", chunk=1, message="bad"), e(6, "error", message="bad"), e(7, "warning", message="w"), e(8, "phase", kind="completed")]
    events = spark.createDataFrame(rows, monitor.EVENT)
    r = monitor.run_reports(events).first()
    assert (r.phase, r.chunks_completed, r.chunks_failed, r.errors, r.warnings, r.input_tokens, r.output_tokens) == ("completed", 2, 1, ["bad"], ["w"], 3, 0)
    c = {x.chunk_index: x for x in monitor.chunk_reports(events).collect()}
    assert c[0].kind == "A" and c[0].ms == 12.0 and c[1].message == "bad" and c[1].started is None
    v = monitor.monitor_view(monitor.run_reports(events), F.lit(0)).first()
    assert v.percent == 0.0 and v.more_errors == 0
    assert monitor.last_messages(events, ["run"], ["ts"], "message").first().messages == ["bad", "bad", "w"]
    assert monitor.initial_report(spark, "x", 5).first().chunks_completed == 0
    assert monitor.merge_errors(spark.createDataFrame([(1, ["a", "b"], None), (1, ["a"], ["w"])], "g int, errors array<string>, warnings array<string>"), ["g"]).first().errors == ["a", "b"]
    files = spark.createDataFrame([(1, 1, True), (1, 2, False), (1, 3, True)], "b int, o int, ok boolean")
    assert monitor.stop_at_first_failure(files, batch="b", order=["o"], ok=F.col("ok")).count() == 2 and monitor.stop_at_first_failure(files, batch="b", order=["o"], ok=F.col("ok"), go_on=True).count() == 3
