import itertools
import math
import os
import random
from fractions import Fraction

import numpy as np
import pytest

from verbena.llm import languages as lg
from verbena.llm.queries import PIECES

SENTENCES = {
    "en": ["The house is near the old bridge.", "They said nothing about the map.", "You will see the lights this evening.", "Nobody knows where the book was left."],
    "pt": ["A casa fica perto da ponte antiga.", "Eles não disseram nada sobre o mapa.", "Você vai ver as luzes hoje à noite.", "Ninguém sabe onde o livro foi deixado."],
    "de": ["Das Haus steht neben der alten Brücke.", "Sie haben nichts über die Karte gesagt.", "Du wirst heute Abend die Lichter sehen.", "Niemand weiß, wo das Buch geblieben ist."],
}
LABELS = [("en", "en"), ("English", "en"), ("pt", "pt"), ("de", "de")]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    models = lg.PieceModels(["x", "y"], {p: i for i, p in enumerate(pieces)}, rng.random((len(pieces), 2)))
    part = "▁abab"
    want = np.zeros(2)
    for cuts in itertools.product([0, 1], repeat=len(part) - 1):
        cut = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(part)]
        names = [part[a:b] for a, b in itertools.pairwise(cut)]
        if all(n in models.index for n in names):
            want += np.prod([models.p[models.index[n]] for n in names], axis=0)
    assert np.allclose(models.forward(part)[-1], np.log(want))
    assert np.isfinite(models.word("q" * 10_000)).all()


def test_long_words_are_summed_whole():
    """A word of 60 letters: the recurrence in exact fractions, all segmentations in."""
    rng = np.random.default_rng(2)
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "abab", "b" * 25]
    models = lg.PieceModels(["x", "y"], {p: i for i, p in enumerate(pieces)}, rng.random((len(pieces), 2)))
    word = "ab" * 10 + "b" * 30 + "ba" * 5
    for column in range(2):
        total = [Fraction(1)] + [Fraction(0)] * (len(word) + 1)
        marked = "▁" + word
        for j in range(1, len(marked) + 1):
            total[j] = sum(total[j - len(p)] * Fraction(models.p[k, column]) for k, p in enumerate(pieces) if marked[:j].endswith(p))
        assert np.isclose(models.word(word)[column], math.log(total[-1]), rtol=1e-12)
    # both ways of summing agree at the border, and expectations too
    for n in (lg.PLAIN - 1, lg.PLAIN):
        counts = np.zeros((len(pieces), 2))
        lg._expect(models, 0, "▁" + "ab" * n, 1, counts)
        assert np.isclose(sum(counts[k, 0] * len(p) for k, p in enumerate(pieces)), 2 * n + 1)


def test_the_sample_holds_the_smallest_hashes(spark):
    rows = [(i, f"text {i} {lang}", lang) for i in range(3000) for lang in (("pt",) if i % 100 else ("de",))]
    documents = spark.createDataFrame([*rows, (9000, "x" * 100, "de"), (9001, None, "de")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([("pt", "pt"), ("de", "de")], "label string, lang string")
    got = lg.labelled_sample(documents, labels, 20, longest=50)
    hashed = {(r.lang, r.text): r.h for r in documents.filter("length(text) <= 50").selectExpr("lang", "text", "xxhash64(doc_id) as h").collect()}
    want = {k for lang in ("pt", "de") for k in sorted((k for k in hashed if k[0] == lang), key=hashed.get)[:20]}
    assert set(got) == want and len(got) == 40


def test_segments_cover_the_text():
    text = 'A. B?\n"C!" D => E\\nF | G'
    assert [text[a:b] for a, b in lg.segments(text)] == ["A.", "B?", '"C!', "D", "E", "F", "G"]
    assert list(lg.segments("")) == [] and list(lg.segments(" \n ")) == []


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary here")
def test_documents(spark):
    rng = random.Random(1)
    rows, want = [], set()
    for i in range(240):
        lang = rng.choice(list(SENTENCES))
        label = rng.choice([lang, lang, lang, None, "??", "English"])
        text = "# Title 3\n" + " ".join(rng.sample(SENTENCES[lang], 3))
        if i % 8 == 0:
            other = rng.choice([x for x in SENTENCES if x != lang])
            text += "\n" + rng.choice(SENTENCES[other])
            want |= {(i, "mixed", lang), (i, "mixed", other)}
        elif label in (None, "??"):
            want.add((i, "missing", lang))
        elif label == "English" and lang != "en":
            want.add((i, "wrong", lang))
        rows.append((i, text, label))
    rows += [(900, None, "en"), (901, "", None), (902, "12 / 40", "de"), (903, " ".join(SENTENCES["pt"] * 2000), "pt")]
    documents = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, lang string, detected string")
    labels = spark.createDataFrame(LABELS, "label string, lang string")
    models = lg.learn(documents, labels, PIECES)
    judged = lg.with_languages(documents, models)
    got = {(r.doc_id, r.kind, r.lang) for r in lg.label_faults(judged, labels).collect()}
    assert got == want
    by = {r.doc_id: r for r in judged.collect()}
    assert by[900].detected is None and by[900].confidence == 0 and by[903].detected == "pt" and by[903].confidence > 0.99
    parts = lg.with_segments(documents.filter("doc_id = 0"), models).collect()
    assert all(r.sentence or r.segment == 0 for r in parts) and all(0 <= r.confidence <= 1 for r in parts)


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary here")
def test_empty(spark):
    documents = spark.createDataFrame([], "doc_id long, text string, lang string")
    for labels in (LABELS, []):
        table = spark.createDataFrame(labels, "label string, lang string")
        models = lg.learn(documents, table, PIECES)
        assert lg.label_faults(lg.with_languages(documents, models), table).count() == 0
    best, post, lead = lg.posteriors(np.array([[0.0, 0.0], [-1000.0, 0.0]]))
    assert list(best) == [0, 1] and np.allclose(post, [0.5, 1.0]) and list(lead) == [0.0, 1000.0]
