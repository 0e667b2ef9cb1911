import random

import pytest

from folioframe.llm import bpe_encode as B

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(B.default_vocabulary())


@pytest.fixture(scope="module")
def public(encoder):
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


def test_the_vocabulary_is_one_that_rounds_are_exact_for(encoder):
    assert B.is_trained(encoder.ranks)
    assert not B.is_trained({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


def texts():
    rnd = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEF"
    yield from ("", "a", " ", "<|endoftext|>", "a" * 5000, "ab" * 3000, "aab" * 2000, "=~" * 999, "é́ \U0001f469‍\U0001f680 日本語", "\r\n\t  x ", "I'll we've", "0" * 700, "x" * 129, "хх" * 400)
    for n in (20, 63, 64, 65, 127, 128, 129, 130, 400, 3000):
        yield "".join(rnd.choice(letters) for _ in range(n))
    for _ in range(150):
        yield "".join(chr(rnd.choice((rnd.randrange(32, 127), rnd.randrange(0xA0, 0x500), rnd.randrange(0x4E00, 0x4F00)))) for _ in range(rnd.randrange(1, 60)))


def test_words_of_any_length_are_encoded_as_the_public_library_does(encoder, public):
    all_texts = list(texts())
    flat, offsets = encoder.encode(all_texts)
    for i, t in enumerate(all_texts):
        assert flat[offsets[i] : offsets[i + 1]] == public.encode_ordinary(t), t[:50]


def test_tables_round_trip(spark, public):
    rows = [(1, "Hello  wörld", "x"), (2, None, "x"), (3, "", "x"), (1, "Hello  wörld", "x"), (None, "n", "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    ids = B.encode_texts(df)
    got = [(r.doc_id, r.ids) for r in ids.collect()]
    assert len(got) == 5 and all(x == (public.encode_ordinary(t) if t else []) for (k, x), (_, t, _) in zip(sorted(got, key=str), sorted(((k, t, 0) for k, t, _ in rows), key=lambda r: str((r[0], public.encode_ordinary(r[1]) if r[1] else [])))))
    assert sorted(r.text for r in B.decode_ids(ids).collect()) == ["", "", "Hello  wörld", "Hello  wörld", "n"]
    assert B.encode_texts(df.limit(0)).count() == 0
