from __future__ import annotations

import random

import pytest

from sylva.llm import garbled as G

CLEAN = [
    "Die Größe der Lücke über München beträgt 5 °C – für Jörg.", "L’été où la série «À» était gelée à 7 °C.", "El señor revisó también la posición 12 del año.", "A incubação não terminou; São Paulo “já” tem maçã.",
    "Температура держалась около 5 градусов в течение суток.", "Образцы были прочитаны около полудня и заморожены.", "試料を解析した。全長は5である。", "Growth at 5 °C stopped; 3–5 µl × 10³ cells.", "plain ascii only, no signs at all",
    "LÃ– OU ALGODÃO? ATENÇÃO À “MANHÔ.",
]


def corpus():
    rng = random.Random(1)
    docs = [(i, "\n".join(rng.sample(CLEAN, 4))) for i in range(400)]
    bad = {}
    for n, (a, b) in enumerate([("utf-8", "cp1252"), ("utf-8", "cp437"), ("cp1252", "mac-roman"), ("utf-8", "cp1251"), ("koi8-r", "cp1251"), ("utf-8", "cp1252")] * 3):
        lines = [x for x in CLEAN[:8] if not x.isascii() and G.garble(x, ((a, b),)) not in (None, x)]
        if not lines:
            continue
        text = [rng.choice(CLEAN[:8]), *[G.garble(x, ((a, b),)) for x in rng.sample(lines, min(3, len(lines)))]]
        clean = [text[0], *[G.undo(x, ((a, b),)) for x in text[1:]]]
        bad[1000 + n] = ("\n".join(text), "\n".join(clean))
    return docs, bad


def test_garble_and_undo_are_inverse():
    for t in G.candidates():
        for x in ("Größe", "été", "Образцы", "試料"):
            g = G.garble(x, t)
            if g is not None and t[0][0] in ("utf-8", *G.SINGLE) and all(b in G.SINGLE for _, b in t):
                assert G.undo(g, t) == x or G.to_text(G.to_bytes(x, t[0][0]), t[0][0]) != x or len(set(G._tables(t[-1][1])[0])) < 256


def test_found_and_restored(spark):
    docs, bad = corpus()
    rows = [*docs, *[(k, v[0]) for k, v in bad.items()], (2000, None), (2001, ""), (2002, "L’�t� est l�"), (2003, "the M?nchen log")]
    got = {r.doc_id: r for r in G.garbled_documents(spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n", "2 AS form")).collect()}
    assert set(bad) | {2002, 2003} == set(got)
    whole = [k for k, v in bad.items() if got[k].restored == v[1]]
    assert len(whole) >= 0.8 * len(bad)
    assert got[2002].restored is None and not got[2002].complete and got[2003].kinds == "lossy"


def test_one_garbled_character_is_found(spark):
    t = (("cp1252", "cp437"),)
    docs, _ = corpus()
    taught = [(1000, G.garble(CLEAN[7], t)), (1001, G.garble(CLEAN[0], t))]
    one = {2000: ("3–5 µl", "3û5 µl"), 2001: ("at 5 °C", "at 5 ░C")}  # the second sign twice in its document
    rows = [*docs, *taught, (2000, CLEAN[7].replace(*one[2000])), (2001, "\n".join([CLEAN[7].replace(*one[2001])] * 2)), (2002, "août, goût, où ça")]
    got = {r.doc_id: r.restored for r in G.garbled_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert set(got) == {1000, 1001, 2000, 2001}
    assert got[2000] == CLEAN[7] and got[2001] == "\n".join([CLEAN[7]] * 2)


def test_characters_are_learned_where_no_known_encoding_explains_them(spark):
    docs, _ = corpus()
    assert "cp864" not in G.SINGLE
    turn = {c: c.encode("utf-8").decode("cp864", "replace") for c in "éñóàçß"}
    turn = {c: x for c, x in turn.items() if "\ufffd" not in x and x.isprintable() and not any(y.isascii() for y in x)}
    assert set("éñó") <= set(turn)

    def garble(text):
        return "".join(turn.get(c, c) for c in text)

    lines = CLEAN[1:3]
    bad = {1000 + i: (garble(x), x) for i, x in enumerate(lines * 2)}
    got = {r.doc_id: r for r in G.garbled_documents(spark.createDataFrame([*docs, *[(k, v[0]) for k, v in bad.items()]], "doc_id bigint, text string")).collect()}
    assert set(got) == set(bad) and all(got[k].restored == v[1] and got[k].kinds == "learned characters" for k, v in bad.items())


def test_two_garbled_readings_of_a_text_teach_nothing_about_each_other(spark):
    docs, _ = corpus()
    marks = ["«Ä» und „Ö“ fehlen", "«É» ou «À» 74"]
    rows = [*docs, *[(1000 + i, "\n".join(marks)) for i in range(60)], *[(1100 + i, "│ a\n" * 40) for i in range(60)]]
    bad = {}
    for n, (read_as, times) in enumerate([("cp437", 9), ("mac-roman", 3), ("cp1250", 3)]):
        for written_in in ("cp1252", "utf-8"):
            if (written_in, read_as) != ("cp1252", "cp1250"):
                bad |= {2000 + 100 * n + 10 * (written_in == "utf-8") + i: "\n".join(G.garble(x, ((written_in, read_as),)) for x in (*marks, CLEAN[0])) for i in range(times)}
    rows += [*bad.items(), *[(3000 + i, f"stands alone\n≥ 95 %\n{i}") for i in range(30)], *[(3100 + i, "\xa0") for i in range(3)]]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    learned = set(G.learn(G.chunk_counts(documents)))
    assert {(("cp1252", "cp437"),), (("cp1252", "mac-roman"),), (("utf-8", "cp437"),), (("utf-8", "mac-roman"),), (("utf-8", "cp1250"),)} <= learned
    assert not [t for t in learned if t[0][0] not in ("cp1252", "utf-8")]
    got = {r.doc_id: r.restored for r in G.garbled_documents(documents).collect()}
    assert set(got) == set(bad) and set(got.values()) == {"\n".join([*marks, CLEAN[0]])}


def test_text_read_wrongly_three_times(spark):
    t = (("utf-8", "cp1252"),)
    docs, _ = corpus()
    rows = [*docs, *[(1000 * k + i, G.garble(x, t * k)) for k in (1, 2, 3) for i, x in enumerate(CLEAN[:3] * k)]]
    got = {r.doc_id: r.restored for r in G.garbled_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1000 * k + i: x for k in (1, 2, 3) for i, x in enumerate(CLEAN[:3] * k)}


def test_control_characters_are_undone_as_latin_1():
    assert G.undo("\x95", (("cp1251", "cp1252"),)) is None and G.undo_run("\x95", (("cp1251", "cp1252"),)) == "•"
    assert G.undo_run("Ïî", (("cp1251", "cp1252"),)) == "По" and G.undo_run("â\x80\x93", (("utf-8", "cp1252"),)) is None


def test_no_twins_and_empty(spark):
    df = spark.createDataFrame([(1, "été"), (2, None), (3, "abc")], "doc_id bigint, text string")
    assert G.garbled_documents(df).count() == 0
    assert G.garbled_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["LÃ– OU ALGODÃO", "«Â»", "DA MANHÃ”", "Ðorvíksdal", "½ plate ﬁlter №7 ≥ ∞"])
def test_unusual_letters_in_usual_text_are_left(spark, text):
    rows = [(i, text) for i in range(50)] + [(100 + i, "\n".join(CLEAN[:8])) for i in range(50)] + [(999, G.garble(CLEAN[1], (("utf-8", "cp1252"),)))]
    assert {r.doc_id for r in G.garbled_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == {999}
