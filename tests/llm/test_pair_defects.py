import os
import random
import time

import pytest

from verbena.llm import pair_defects as pd_

SENTENCES = {
    "en": ["The house near the bridge is empty.", "Take the book out of the bag.", "We are going to look for the map every evening."],
    "pt": ["A casa perto da ponte está vazia.", "Tire o livro da bolsa.", "Nós vamos procurar o mapa todas as noites."],
    "es": ["La casa cerca del puente está vacía.", "Saca el libro de la bolsa.", "Vamos a buscar el mapa todas las noches."],
}
PROMPT = "Nos vamos procurar o mapa todas as noites. Tire a livro da bolsa e coloque na mesa."
GOOD = "Nós vamos procurar o mapa todas as noites. Tire o livro da bolsa e coloque na mesa."
CASES = [
    (PROMPT, GOOD, None, None),
    (PROMPT, "Revisão: “" + GOOD + "”", None, None),
    (PROMPT, None, None, "empty"),
    (PROMPT, " — ### ", None, "empty"),
    (None, "", None, "empty"),
    (PROMPT, "Desculpe, mas não posso revisar este texto.", None, "refusal"),
    (PROMPT, "I'm sorry, but I can't help with translating this text.", "We are going to look for the map.", "refusal"),
    ("Infelizmente nao posso ir hoje; o texto ficou em casa.", "Infelizmente não posso ir hoje; o texto ficou em casa.", None, None),
    (PROMPT, PROMPT.upper() + "!!", None, "copy"),
    (PROMPT, "Correção: " + PROMPT, None, "copy"),
    (PROMPT, "Vamos a buscar el mapa todas las noches. Saca el libro de la bolsa y ponlo en la mesa.", None, "other_language"),
    (PROMPT, "Resposta: We are going to look for the map every evening. Take the book out of the bag.", None, "other_language"),
    (PROMPT, "Nós vamos procurar o mapa todas as noites.", None, "truncated"),
    (PROMPT, "Nós vamos procurar o mapa todas as noites. Tire o liv", None, "truncated"),
    (PROMPT, "Nós vamos procurar o mapa todas as...", None, "truncated"),
    ("com poucas tão ferramentas na casa da avo.", "com tão poucas ferramentas na casa da avó.", None, None),
    (None, GOOD, None, None),
    ("nada " * 5000 + "fim.", "nada " * 5000 + "fim!", None, "copy"),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, *c[:3], "d") for i, c in enumerate(CASES)]
    pairs = spark.createDataFrame(rows, "change_id long, antes string, depois string, source_text string, defect string")
    documents = spark.createDataFrame([(i * 10 + k, " ".join(s[k:] + s[:k]), lang) for i, (lang, s) in enumerate(SENTENCES.items()) for k in range(3)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(x, x) for x in SENTENCES], "label string, lang string")
    judge = pd_.learn(pairs, documents, labels, "antes", least=1)
    found = pd_.pair_defects(pairs, judge, "change_id", "antes", "depois", "source_text")
    return {r.change_id: r.defect for r in found.collect()}, pairs, judge


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(judged, i):
    assert judged[0].get(i) == CASES[i][3]


def test_empty_tables(spark, judged):
    _, pairs, judge = judged
    assert pd_.pair_defects(pairs.limit(0), judge, "change_id", "antes", "depois").count() == 0
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    bare = pd_.learn(pairs.limit(0), none, spark.createDataFrame([], "label string, lang string"), "antes")
    assert {r.defect for r in pd_.pair_defects(pairs, bare, "change_id", "antes", "depois").collect()} >= {"empty", "copy"}


def test_alignment(judged):
    judge = judged[2]
    assert pd_.aligned_prefix("a b c d".split(), "a b".split()) == 2
    assert judge.stops_early("um dois tres quatro", "um dois")
    # a text cut in its middle and padded until its end looks whole
    assert not judge.stops_early("um dois tres", "um dois tres")
    assert not judge.stops_early("um dois tres", "um tres dois")
    assert not judge.stops_early("um dois tres", "um doiz tres quatro")


def plain_prefix(a, d):
    row = list(range(len(a) + 1))
    for n, w in enumerate(d, 1):
        new = [n]
        for i, x in enumerate(a):
            new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (not pd_.same(x, w))))
        row = new
    return max(i for i, x in enumerate(row) if x == min(row))


def test_alignment_against_the_plain_table():
    rng = random.Random(1)
    pool = ["casa", "caso", "casas", "b", "cc", "mapa", "mopa", "x1"]
    for _ in range(1500):
        a, d = ([rng.choice(pool) for _ in range(rng.randint(1, 20))] for _ in range(2))
        assert plain_prefix(a, d) == pd_.aligned_prefix(a, d), (a, d)


def test_very_long_pairs_take_seconds(judged):
    rng = random.Random(2)
    words = [f"palavra{rng.randint(0, 20_000)}" for _ in range(50_000)]
    began = time.perf_counter()
    assert pd_.aligned_prefix(words, words[:40_000]) == 40_000
    assert judged[2].defect(" ".join(words), " ".join(words[:25_000]).upper() + " fim", None) in ("truncated", "other_language")
    assert time.perf_counter() - began < 60


DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"
REFUSED = [
    "Perdão, não estou autorizado a reescrever a mensagem enviada.", "I apologize, however I am not permitted to edit the provided text.", "Não será possível atender à sua solicitação de tradução.",
    "Lo lamento, no estoy autorizado a traducir este contenido.", "Je suis désolé, je ne peux pas corriger cette phrase.", "Ich darf diesen Text nicht korrigieren, tut mir leid.",
]
TOLD = [
    "O guarda disse que não podia abrir a porta da torre.", "A bruxa recusou o mapa e voltou para casa.", "The guard would not open the gate of the old tower.", "Sinto muito, o moleiro vendeu a última lanterna.",
    "La posadera guardaba la carta en el huerto.", "Die Wirtin wartete hinter der Mühle.",
]


@pytest.mark.skipif(not os.path.exists(DOCUMENTS), reason="no tables here")
def test_refusals_in_other_words(spark, judged):
    """Sentences that no example has, held out from the model."""
    texts = [r.text for r in spark.read.parquet(DOCUMENTS).filter("text is not null").select("text").collect()]
    judge = pd_.PairJudge(judged[2].model, pd_.learn_refusals(texts), {}, "pt")
    assert not {t for t in REFUSED} & set(pd_.REFUSALS)
    assert sum(judge.refuses("O gato subiu no telhado ontem.", t, "The cat went up the roof.") for t in REFUSED) >= len(REFUSED) - 1
    assert sum(judge.refuses("O gato subiu no telhado ontem.", t, "The cat went up the roof.") for t in TOLD) == 0


def test_copied_prompts_do_not_make_ends(judged):
    """The last n-gram of a prompt in very many copies is no certain end for a prompt that goes on after it."""
    judge = pd_.PairJudge(judged[2].model, judged[2].refusals, {}, "pt")
    gram = pd_.suffixes("Tire o livro da bolsa", judge.n)[-1]
    judge.ends[gram] = (100_000, 100_000)
    assert judge.may_end("Tire o livro da bolsa e coloque na mesa.", "Tire o livro da bolsa") < judge.certain
    assert judge.stops_early("Tire o livro da bolsa e coloque na mesa.", "Tire o livro da bolsa")
    assert judge.may_end("Tire o livro da bolsa", "Tire o livro da bolsa") >= judge.certain
