import random
import re

from folioframe.llm import leakage as L

ITEMS = [(1, "the quick brown fox jumps over the lazy dog while seven grey owls watch from the old barn"), (2, "too short to leak"), (3, None), (4, " ".join(f"term{i}" for i in range(30)))]


def brute(docs, items, least=12):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for k, t in docs:
        d = words(t)
        for i, q in items:
            w = words(q)
            grams = {tuple(w[a : a + least]) for a in range(len(w) - least + 1)}
            if any(tuple(d[a : a + least]) in grams for a in range(len(d) - least + 1)):
                out.add((k, i))
    return out


def found(spark, docs, items=ITEMS, **options):
    d = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id int, text string, term string")
    return L.find_leaks(d, spark.createDataFrame(items, "item_id int, text string"), **options)


def test_phrases_as_brute_force_finds_them(spark):
    rnd = random.Random(2)
    pool = ITEMS[0][1].split() + [f"term{i}" for i in range(30)] + [f"other{i}" for i in range(50)]
    docs = []
    for k in range(120):
        words = [rnd.choice(pool) for _ in range(60)]
        if k % 3 == 0:
            source = (ITEMS[0][1] if k % 2 else ITEMS[3][1]).split()
            a, n = rnd.randrange(0, 6), rnd.randrange(10, 15)
            words[20:20] = source[a : a + n]
        docs.append((k, rnd.choice((" ", ", ", "\r\n", " **")).join(words).upper() if k % 4 else " ".join(words)))
    want = brute(docs, ITEMS)
    got = {(r.doc_id, r.item_id) for r in L.phrases(found(spark, docs)).collect()}
    assert len(want) > 15 and got == want
    assert {(r.doc_id, r.item_id) for r in L.phrases(found(spark, docs, block_items=1)).collect()} == want


def test_defined_results(spark):
    whole = ITEMS[0][1]
    changed = whole.replace("over", "under").replace("seven", "eight")
    docs = [(1, whole), (1, whole), (2, None), (3, ""), (4, "nothing of it"), (5, "x " * 3000 + whole + " y" * 3000), (6, changed), (None, whole)]
    rows = {r.doc_id: r for r in found(spark, docs).collect()}
    assert set(rows) == {1, 5, 6, None} and rows[5].first_word == 3000 and rows[1].matched_words == 18
    assert rows[6].kind == "proximity" and rows[6].near_words == 16 and rows[6].matched_words < 12
    assert [(r.item_id, r.documents, r.longest) for r in L.leaked_items(found(spark, docs)).collect()] == [(1, 2, 18)]


def test_empty_tables_and_a_kept_index(spark, tmp_path):
    assert found(spark, [], ITEMS).count() == 0 and found(spark, [(1, "a b")], []).count() == 0
    docs = spark.createDataFrame([(k, ITEMS[0][1]) for k in range(5)], "doc_id int, text string")
    index = L.build_index(docs, index_path=str(tmp_path / "index"), block_tokens=30)
    assert index.select("block").distinct().count() > 1
    got = L.find_leaks(docs, spark.createDataFrame(ITEMS, "item_id int, text string"), index=index)
    assert got.count() == 5
