import pytest

from folioframe.llm import mojibake as M

FR = ["Précisez le dépôt préféré près de l’école", "Où avez-vous découvert la forêt cette année", "À quel point êtes-vous satisfait du théâtre", "Montants exprimés en euros après réduction", "Quelle était la qualité du café à côté", "Le numéro était caché derrière la fenêtre"]
RU = ["Насколько вы довольны тем как организует", "Порекомендуете ли вы друзьям которым нужна станция", "Суммы указаны за месяц", "Выберите один ответ пожалуйста", "Не учитывайте прошлый год"]
PL = ["Jak często w ciągu ostatnich miesięcy używał Pan książka", "Proszę wziąć pod uwagę tylko część źródło", "Skąd dowiedział się Pan że zmieni łącze", "Kwoty w złotych łącznie z opłatą", "Można wybrać jedną najbliższą odpowiedź"]


def clean():
    for n in range(40):
        for lang, texts in (("fr", FR), ("ru", RU), ("pl", PL)):
            for i, t in enumerate(texts):
                yield f"{t} {n}", lang, f"s{(n + i) % 3}"


def restored(spark, garbled, **options):
    rows = [(i, t, None, s, g) for i, (t, g, s) in enumerate([*clean(), *garbled])]
    df = spark.createDataFrame(rows, "element_id int, label string, help_text string, source string, lang string")
    first = len(rows) - len(garbled)
    found = {r.element_id: r.restored for r in M.repair(df, **options).collect()}
    assert not [i for i in found if i < first]
    return [found.get(first + k, "not found") for k in range(len(garbled))]


def swap(text, true, seen):
    return text.encode(true).decode(seen)


CASES = [
    (swap(FR[0], "utf-8", "cp1252"), FR[0], "fr"),
    (swap(swap(FR[1], "utf-8", "latin-1"), "utf-8", "latin-1"), FR[1], "fr"),
    (swap(RU[0], "cp1251", "latin-1"), RU[0], "ru"),
    (swap(RU[1], "utf-8", "cp1251"), RU[1], "ru"),
    (swap(PL[1], "cp1250", "latin-1"), PL[1], "pl"),
    ("".join(c if c < "\x80" else f"&#{ord(c)};" for c in swap(FR[2], "utf-8", "latin-1")), FR[2], "fr"),
    ("Pr�cisez le d�p�t", None, "fr"),
]


def test_known_swaps_come_back_and_clean_values_stay(spark):
    got = restored(spark, [(t, g, "s1") for t, _, g in CASES] + [(None, "fr", "s1"), ("", "fr", "s1"), ("plain", None, None), ("Caf&#233; — “œuvre” №5 €", "fr", "s2")])
    assert got == [*(w for _, w, _ in CASES), *["not found"] * 4]


def unlisted(text):
    """Swapped through a table that no page has."""
    return text.translate({ord(a): b for a, b in zip("éèêàâôûç", "ϕϖϗϠϡϣϥϧ")})


def test_a_swap_that_no_list_has_is_learned_from_its_contexts(spark):
    garbled = [(unlisted(f"{t} {n}"), "fr", "odd") for n in range(20) for t in FR]
    got = restored(spark, garbled)
    want = [f"{t} {n}" for n in range(20) for t in FR]
    right = sum(a == b for a, b in zip(got, want))
    assert right > 0.6 * len(want), (right, len(want), got[:6])


def test_a_group_of_copies_of_a_garbled_value_does_not_pass_for_the_language(spark):
    bad = swap(RU[4], "cp1251", "koi8-r")
    got = restored(spark, [(bad, "ru", "s0")] * 300)
    assert set(got) == {RU[4]}


def test_more_sources_than_a_block_holds(spark):
    garbled = [(swap(RU[k % 5], "utf-8", "cp1251"), "ru", f"many{k}") for k in range(12)]
    fitted = None
    got = restored(spark, garbled, fitted=fitted)
    rows = [(i, t, None, s, g) for i, (t, g, s) in enumerate([*clean(), *garbled])]
    df = spark.createDataFrame(rows, "element_id int, label string, help_text string, source string, lang string")
    fitted = M.learn(df, block_sources=4)
    assert len(fitted) == 4
    assert sorted((r.element_id, r.restored) for r in M.repair(df, fitted=fitted).collect()) == [(len(rows) - 12 + k, g) for k, g in enumerate(got)]


def test_tables_can_be_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, swap(FR[0], "utf-8", "cp1252"), None, "s", "fr"), (2, FR[0], FR[1], "s", "fr")], "element_id int, label string, help_text string, source string, lang string")
    fitted = M.learn(df)
    M.save(fitted, spark, str(tmp_path / "tables"))
    again = M.load(spark, str(tmp_path / "tables"))
    assert again[0][3].weights == fitted[0][3].weights and M.repair(df, fitted=again).count() == M.repair(df, fitted=fitted).count()


def test_empty_table(spark):
    assert M.garbled_fields(spark.createDataFrame([], "element_id int, label string, help_text string, source string, lang string")).count() == 0


@pytest.mark.parametrize("text", ["", "abc", "é", "&#1114112; &#55296; &#64;"])
def test_references_that_name_no_letter_stay(text):
    assert M.unescaped(text) == text
