import random
import re

from folioframe.llm import near_duplicates as N

SCHEMA = "element_id bigint, label string, variables array<struct<label:string>>, set_id string"


def brute(rows, share=0.7):
    words = {}
    for k, label, variables, _ in rows:
        find = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
        if len(find(label)) >= 8:
            words[k] = set(find(label)) | {w for v in variables or [] if v for w in find(v[0])}
    keys = sorted(words)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(words[a] & words[b]) * 10 >= 7 * len(words[a] | words[b])}


def pairs(spark, rows):
    members, links = N.similar_records(spark.createDataFrame(rows, SCHEMA))
    return {(r.element_id_a, r.element_id_b) for r in N.record_pairs(members, links).collect()}


def test_all_pairs_as_brute_force_finds_them(spark):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = rnd.sample(vocabulary, rnd.choice((8, 12, 20, 50, 90, 130, 180)))
        for _ in range(4):
            words = list(base)
            for _ in range(rnd.randrange(0, len(words) // 4 + 1)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rnd.shuffle(words)
            rows.append((len(rows), " ".join(words), [(rnd.choice(vocabulary),), None] if rnd.random() < 0.5 else None, "x"))
    want = brute(rows)
    assert len(want) > 100 and pairs(spark, rows) == want


def test_common_words_only(spark):
    rows = [(i, " ".join(f"c{(i + j * j) % 23}" for j in range(14)), None, "x") for i in range(250)]
    assert pairs(spark, rows) == brute(rows)


def test_a_record_of_forty_thousand_words_keeps_its_links(spark):
    words = [f"v{i}" for i in range(40_000)]
    rows = [(1, " ".join(words), None, "x"), (2, " ".join(words[:-9000]), None, "x"), (3, " ".join(words[:20_000]), None, "x")]
    assert pairs(spark, rows) == {(1, 2)}


def test_copies_nulls_short_labels_and_groups(spark):
    same = "one two three four five six seven eight"
    rows = [(1, same, None, "x"), (1, same, None, "x"), (2, same.upper(), [], "x"), (3, None, None, "x"), (4, "too short", None, "x"), (5, "", None, "x"), (6, same + " nine", [None, (None,)], "x"), (None, same, None, "x")]
    members, links = N.similar_records(spark.createDataFrame(rows, SCHEMA))
    assert {(r.element_id_a, r.element_id_b) for r in N.record_pairs(members, links).collect() if r.element_id_a is not None} == {(1, 2), (1, 6), (2, 6)}
    groups = {r.element_id: (r.group_id, r.links) for r in N.groups(members, links).collect()}
    assert groups[1] == groups[2] and groups[1][0] == groups[6][0] and groups[6][1] == 1 and set(groups) == {None, 1, 2, 6}
    assert pairs(spark, []) == set()


def test_a_chain_is_one_group(spark):
    words = [f"k{i}" for i in range(40)]
    rows = [(i, " ".join(words[i : i + 20]), None, "x") for i in range(15)]
    members, links = N.similar_records(spark.createDataFrame(rows, SCHEMA))
    assert len({r.group_id for r in N.groups(members, links).collect()}) == 1
