import random
import unicodedata

import pytest

from folioframe.llm import split_oversized as S

KEYS = ["record_id"]


def items(spark, texts, most=100, overlap=10):
    return spark.createDataFrame([(i, most, overlap, t) for i, t in enumerate(texts)], "record_id int, max_chars int, overlap_chars int, text string")


def texts():
    rnd = random.Random(4)
    marks = (" ", " ", " ", ". ", "\n", "\n\n", "\r\n", " " * 300, "\n" * 400, "\n\\*\\*\\*\n", "\n## Head ", "。", "! ")
    for n in (5, 50, 200, 800):
        yield "".join(rnd.choice("abc éßя") * rnd.randrange(1, 9) + rnd.choice(marks) for _ in range(n))
    yield "x" * 5000
    yield "é" * 3000
    yield "\U0001f469‍\U0001f680" * 400
    yield "a" * 100
    yield "a" * 101


@pytest.mark.parametrize("size", [64, 512, 1 << 14])
def test_pieces_give_the_text_back_however_it_is_divided(spark, size):
    all_texts = list(texts())
    rows = S.split_items(items(spark, all_texts), KEYS, size=size).orderBy("record_id", "piece_no").collect()
    by = {}
    for r in rows:
        by.setdefault(r.record_id, []).append(r)
    for k, t in enumerate(all_texts):
        pieces = by[k]
        assert all(0 < len(p.piece) <= 100 for p in pieces) and all(t[p.piece_start :].startswith(p.piece) for p in pieces)
        assert all(a.piece_start + len(a.piece) - 10 == b.piece_start for a, b in zip(pieces, pieces[1:]))
        assert pieces[0].piece_start == 0 and pieces[-1].piece_start + len(pieces[-1].piece) == len(t)
        for p in pieces[:-1]:
            after = t[p.piece_start + len(p.piece)]
            assert not unicodedata.combining(after) and after != "‍"
    if size == 64:
        test_pieces_give_the_text_back_however_it_is_divided.cuts = [(r.record_id, r.piece_start) for r in rows]
    else:
        assert [(r.record_id, r.piece_start) for r in rows] == test_pieces_give_the_text_back_however_it_is_divided.cuts
    assert {r.record_id: r.text for r in S.rebuilt(S.split_items(items(spark, all_texts), KEYS, size=size), KEYS).collect()} == dict(enumerate(all_texts))


def test_natural_boundaries_are_taken(spark):
    text = "One sentence here. " * 4 + "\n\n# Head\n" + "word " * 40
    rows = S.split_items(items(spark, [text]), KEYS).orderBy("piece_no").collect()
    assert rows[0].boundary == 5 and rows[0].piece.endswith("\n\n") and all(r.boundary == 1 for r in rows[1:-1])


def test_found_are_the_items_in_several_pieces(spark):
    df = items(spark, [None, "", "a" * 100, "b" * 101, "c\n" * 300])
    assert sorted(r.record_id for r in S.oversized_items(S.ranges(df), KEYS).collect()) == [3, 4]
    assert S.oversized_items(S.ranges(df.limit(0)), KEYS).count() == 0 and S.split_items(df.limit(0), KEYS).count() == 0


def test_small_limits_and_large_overlaps(spark):
    rows = S.split_items(items(spark, ["abcdefghij"], 4, 50), KEYS).orderBy("piece_no").collect()
    assert rows[-1].piece.endswith("j") and all(len(r.piece) <= 4 for r in rows)


def test_profiles(spark):
    profiles = spark.createDataFrame([("a", 10, 2, None), ("d", 50, 5, True), (None, 7, 1, False)], "profile_name string, max_chars int, overlap_chars int, is_default boolean")
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "zzz")], "k int, profile_name string")
    got = {r.k: (r.max_chars, r.overlap_chars) for r in S.profile_rows(rows, profiles).collect()}
    assert got == {1: (10, 2), 2: (50, 5), 3: (50, 5)}
    with pytest.raises(ValueError):
        S.profile_rows(rows, profiles.limit(0))


@pytest.mark.parametrize("size", [256, 1000, 1 << 22])
def test_files_by_ranges_of_bytes_as_whole(spark, tmp_path, size):
    all_texts = [t for t in texts()][:6]
    for k, t in enumerate(all_texts):
        (tmp_path / f"{k}.txt").write_bytes(t.encode("utf-8"))
    (tmp_path / "empty.txt").write_bytes(b"")
    got = {}
    for r in S.split_files(spark, f"file://{tmp_path}", max_chars=100, overlap_chars=10, size=size).orderBy("path", "piece_no").collect():
        got.setdefault(int(r.path.rsplit("/", 1)[1][0]), []).append((r.piece_start, r.piece))
    table = {}
    for r in S.split_items(items(spark, all_texts), KEYS).orderBy("record_id", "piece_no").collect():
        table.setdefault(r.record_id, []).append((r.piece_start, r.piece))
    step = 100 // 8
    for k, t in enumerate(all_texts):
        assert "".join(p if not i else p[10:] for i, (_, p) in enumerate(got[k])) == t and all(len(p) <= 100 for _, p in got[k])
    if size == 1 << 22:
        assert got == table, step
