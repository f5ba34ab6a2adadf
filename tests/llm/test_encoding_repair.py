import os
import random

import pytest

from verbena.llm import encoding_repair as er

ENTRIES = "/root/testdata/sf0.001/localized_entries.parquet"
ANSWERS = "/root/testdata/sf0.001/change_records.parquet"
CLEAN = ["Você não está só na estação", "A poção não é de ninguém", "Até amanhã, irmã do capitão", "VOCÊ NÃO ESTÁ SÓ", "“Também não”, disse a avó", "O café é da manhã", "Não há maçã no porão", "Ainda há pão e limão"]
WAYS = [er.Transformation("utf-8", "cp1252"), er.Transformation("utf-8", "mac_roman"), er.Transformation("utf-8", "cp437"), er.Transformation("latin-1", "mac_roman"), er.Transformation("utf-8", "cp1252", 2)]
OTHER = ["[Любовь] ok", "ライト 火", "½ × 3 — n.º 5…", "NÃO", "plain", "", None, "«São»", "foi isso"]


def corpus():
    rng = random.Random(5)
    rows, garbled = [], set()
    for i in range(1500):
        text = rng.choice(CLEAN)
        if i % 4 == 0:
            bad = rng.choice(WAYS).garble(text)
            if bad and bad != text:
                rows.append((i, bad))
                garbled.add(i)
                continue
        rows.append((i, text))
    rows += [(2000 + i, t) for i, t in enumerate(OTHER)]
    rows += [(3000, "n�o sei"), (3001, "nada " * 20_000 + "nÃ£o"), (3002, "est\u0081 mal")]
    return rows, garbled | {3000, 3001, 3002}


def test_finds_and_restores(spark):
    rows, garbled = corpus()
    df = spark.createDataFrame([(*r, "c", True) for r in rows], "row_id long, text string, restored string, n boolean")
    repair = er.learn(df)
    found = er.garbled_records(df, repair).collect()
    assert {r.row_id for r in found} == garbled
    restored = {r.row_id: r.restored for r in found}
    right = sum(restored[i] in CLEAN for i in garbled if i < 2000)
    assert right > 0.9 * len([i for i in garbled if i < 2000])
    assert restored[3001].endswith("não") and len(restored[3001]) == len(rows[-2][1]) - 1


def test_alignment():
    assert er.pairs_of_runs("nÃ£o há", "não há") == [("Ã£", "ã")]
    assert er.pairs_of_runs("é", "") == [("é", "")]


def test_empty(spark):
    df = spark.createDataFrame([], "row_id long, text string")
    repair = er.learn(df)
    assert repair.transformations == [] and er.garbled_records(df, repair).count() == 0


def test_copies_do_not_hide(spark):
    """A text garbled by single bytes, in copies that hold a third of all rows, is found, and so is another with its contexts."""
    way = er.Transformation("latin-1", "mac_roman")
    clean = [f"{word} {i} {text}" for i in range(12) for word in ("Rua", "Vila") for text in CLEAN]
    garbled = [way.garble(f"Casa {i} {CLEAN[i % 4]}") for i in range(8)]
    copied = garbled[0]
    rows = [(i, t) for i, t in enumerate([*clean, *(c.replace("Rua", "Casa") for c in clean if "Rua" in c), *garbled])]
    first = len(rows) - len(garbled)
    rows += [(len(rows) + i, copied) for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "row_id long, text string")
    found = {r.row_id: r.restored for r in er.garbled_records(df, er.learn(df)).collect()}
    assert set(found) == set(range(first, len(rows)))
    assert all(found[i].startswith("Casa 0 Você não está só na") for i, t in rows if t == copied)


def test_other_scripts_and_long_runs_are_learned_from(spark):
    """Cyrillic and CJK texts keep no ASCII letter; a garbled word of 16 letters is a run of 32."""
    way = er.Transformation("utf-8", "cp1252")
    words = ["Добрыйденьдрузья", "Любовь", "приходите завтра", "ночью было тихо", "светлячки над рекой", "ライトと火", "新しい地図", "古い井戸の水", "星の降る夜に"]
    clean = [f"{w} {v}" for w in words for v in ("!", "№ 7", "...")]
    rows = [(i, t) for i, t in enumerate(clean * 3)]
    first = len(rows)
    rows += [(first + i, way.garble(t)) for i, t in enumerate(clean)]
    df = spark.createDataFrame(rows, "row_id long, text string")
    repair = er.learn(df)
    assert way in repair.transformations
    found = {r.row_id: r.restored for r in er.garbled_records(df, repair).collect()}
    assert set(found) == set(range(first, len(rows)))
    assert [found[first + i] for i in range(len(clean))] == clean


def test_joined_substitutions_give_the_same(spark):
    rows, _ = corpus()
    df = spark.createDataFrame([*rows, (4000, "Até amanhŽ, irmã")], "row_id long, text string")
    few, many = er.learn(df), er.learn(df, most=0)
    assert few.table is None and few.substitutions and many.table is not None and not many.substitutions
    assert sorted(map(tuple, er.garbled_records(df, few).collect())) == sorted(map(tuple, er.garbled_records(df, many).collect()))


def test_infer_needs_several_characters():
    bit = {t: 1 << i for i, t in enumerate(er.candidates())}
    way = er.Transformation("utf-8", "cp437")
    seen = [(c, way.garble(c), sum(b for t, b in bit.items() if t.garble(c) == way.garble(c)), 5) for c in "ãçé"]
    assert way in er.infer(seen, 3, 4) and er.infer(seen[:2], 3, 4) == [] and er.infer([], 3, 4) == []


@pytest.mark.skipif(not os.path.exists(ENTRIES), reason="no tables here")
def test_restored_texts_are_the_right_ones(spark):
    """Clean texts of the tables, garbled here in ways the records know: nearly all come back as they were."""
    clean = [r.t for r in spark.read.parquet(ANSWERS).selectExpr("depois as t").filter("t is not null").collect() if not r.t.isascii() and not er.LOST.search(r.t)]
    rng = random.Random(9)
    rows = [(i, t) for i, t in enumerate(clean)]
    want = {}
    for i, t in enumerate(rng.sample(clean, 60)):
        bad = WAYS[i % len(WAYS)].garble(t)
        if bad and bad != t:
            want[10_000 + i] = t
            rows.append((10_000 + i, bad))
    df = spark.createDataFrame(rows, "row_id long, text string")
    found = {r.row_id: r.restored for r in er.garbled_records(df, er.learn(df)).collect()}
    right = sum(found.get(i) == t for i, t in want.items())
    print("restored", right, "of", len(want), "found", len(set(found) & set(want)))
    assert len(set(found) & set(want)) >= 0.95 * len(want) and right >= 0.8 * len(want)
