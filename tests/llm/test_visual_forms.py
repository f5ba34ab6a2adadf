import random
import unicodedata

import pytest

from verbena.llm import visual_forms as vf

CASES = {
    "Ｎãｏ ｆｏｉ": "Não foi",
    "foi isso　aqui": "foi isso aqui",
    "ca​sa﻿": "casa",
    "Νão ο а Кamin": "Não o a Kamin",
    "lã café": "lã café",
    "ﬁm": "fim",
    "no‑break": "no-break",
    "x̃y": "x̃y",
    "ẹ́": "ẹ́",
}
KEPT = ["[Любовь] ok", "[ΨΩΔ]", "ライト", "º ½ × … “ ” —", "a\tb\nc\r\n", "👩‍🌾 ❤️", "Ã  beira", "TerÃ­amos", "plain", "", "não café"]


@pytest.mark.parametrize(("text", "form"), CASES.items())
def test_changed(text, form):
    got, changed = vf.transducer().run(text)
    assert changed and got == unicodedata.normalize("NFC", form)
    assert vf.transducer().run(got)[0] == got


@pytest.mark.parametrize("text", KEPT)
def test_kept(text):
    assert vf.transducer().run(text) == (text, False)


def test_no_conflicts():
    single = {k for k in vf.mapping() if len(k) == 1}
    assert not any(single & set(v) for v, _ in vf.mapping().values())
    with pytest.raises(ValueError, match="mapped twice"):
        vf.checked([*vf.rules(), ("\u3000", "x", vf.ALWAYS)])
    with pytest.raises(ValueError, match="mapped again"):
        vf.checked([("x", "y", vf.ALWAYS), ("y", "z", vf.ALWAYS)])


LOOK_ALIKE = {
    "pαth": "path", "ρaper": "paper", "νalue": "value", "ɑpple": "apple", "ʀed": "red", "Ꭺbc": "Abc", "a аррӏе": "a apple", "ΑΒ e": "AB e", "ꓡima": "Lima", "օvo": "ovo",
    "Ⅳ": "IV", "Ⅹ e ⅰ": "X e i",
}
OTHER_SCRIPTS = ["και e", "α-helix", "kΩ", "5 μs", "ʀɛd", "Добрый day", "Ꮳꮃꭹ e", "жaба", "ɑ e", "аррӏе", "Δt"]


@pytest.mark.parametrize(("text", "form"), LOOK_ALIKE.items())
def test_look_alikes(text, form):
    assert vf.transducer().run(text) == (form, True) and vf.transducer().run(form) == (form, False)


@pytest.mark.parametrize("text", OTHER_SCRIPTS)
def test_words_truly_written_in_another_script(text):
    assert vf.transducer().run(text) == (text, False)


def test_forms_are_the_texts_that_were_retyped():
    """Plain texts retyped with every rule's characters at random come back as they were, and a form is its own form."""
    rng = random.Random(6)
    back: dict[str, list[str]] = {}
    for source, (new, condition) in vf.mapping().items():
        if new and not (condition == vf.NEAR_LETTER):
            back.setdefault(new, []).append(source)
    right = 0
    for _ in range(2000):
        plain = " ".join(rng.choice(["Você", "leva", "o mapa", "até", "a", "ponte", "Bring", "the", "Xavier", "8", "não"]) for _ in range(6))
        typed, pieces = list(plain), rng.sample(range(len(plain)), 3)
        for i in pieces:
            if typed[i] in back:
                typed[i] = rng.choice(back[typed[i]])
        got, changed = vf.transducer().run("".join(typed))
        right += got == plain and changed == ("".join(typed) != plain)
        assert vf.transducer().run(got) == (got, False)
    assert right >= 0.99 * 2000


def test_records(spark):
    texts = [*CASES, *KEPT, None, "ａ" * 50_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "row_id long, text string, form string")
    found = {r.row_id: r.form for r in vf.changed_records(df, "text").collect()}
    assert set(found) == {*range(len(CASES)), len(texts) - 1}
    assert found[len(texts) - 1] == "a" * 50_000
    forms = {r.row_id: r.form for r in vf.one_form(df, "text").collect()}
    assert len(forms) == len(texts) and forms[len(texts) - 2] is None and all(forms[i] == t for i, t in enumerate(texts) if i not in found)
    assert vf.changed_records(df.limit(0), "text").count() == 0


def test_only_keycaps_make_digits_pictures():
    run = vf.transducer().run
    for sign in "19#*":
        for hidden in "\u200c\u200d\ufe0f":
            assert run(f"{sign}{hidden} coisas") == (f"{sign} coisas", True)
        assert run(f"{sign}\u0301 coisas") == (f"{sign}\u0301 coisas", True)
        for keycap in (f"{sign}\ufe0f\u20e3", f"{sign}\u20e3"):
            assert run(f"{keycap} coisas") == (f"{keycap} coisas", False)
