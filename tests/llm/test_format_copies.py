import random
import re

import pytest

from verbena.llm import format_copies as fc


def key(text):
    """The rule said once more, plainly."""
    alnum = lambda t: "".join(c for c in t if c.isalpha() or c.isdecimal()).lower()
    if text is None or not alnum(text):
        return None
    parts = [p for p in re.split(r"[\n\r\t|;,/•·]+|\s[-–—]+\s", re.sub(r"\s*([:=])\s*", r"\1", text)) if alnum(p)]
    if re.search("[:=]", text) and len(parts) > 1 and all(re.fullmatch(r"[^:=]*[:=][^:=]*", p, re.S) and all(alnum(x) for x in re.split("[:=]", p)) for p in parts):
        return ("fields", tuple(sorted(tuple(map(alnum, re.split("[:=]", p))) for p in parts)))
    return alnum(text)


TEXTS = [
    "Leve o mapa.", "leve  o mapa", "LEVE O\nMAPA!", "leve o mapá", None, "", "  ", "—", "Item: Zavuga; Damage: 31", "damage : 31 | item = ZAVUGA", "Item: Zavuga; Damage: 32", "Item: Zavuga",
    "Damage:\t 31\nitem\t= Zavuga", "x" * 100_000, "X " * 100_000, "x" * 99_999, "a: b, c", "n.º 2", "n º 2", "Ｎ", "𝒳1",
]


def brute(rows):
    groups = {}
    for i, g, t in rows:
        if key(t) is not None:
            groups.setdefault((g, key(t)), []).append(i)
    return groups


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(TEXTS)) for i in range(300)]
    # a third of all rows are one group of copies, spread over several partitions
    rows += [(1000 + i, "a", rng.choice(["hot text", "Hot Text!", " HOT-TEXT"])) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "id long, g string, t string, key string, row int")
    records = fc.canonical_records(df, "t1", "id", "g", "t")
    got = {(r.first_id, r.copy_id) for r in fc.copies(records).collect()}
    want = {(min(v), i) for v in brute(rows).values() for i in v if i != min(v)}
    assert got == want
    counts = {(r.table_name, r.first_id, r.copies) for r in fc.representatives(records).collect()}
    assert counts == {("t1", min(v), len(v)) for v in brute(rows).values()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, g string, t string")
    records = fc.canonical_records(df, "t", "id", "g", "t")
    assert fc.copies(records).count() == 0 and fc.representatives(records).count() == 0
    assert fc.copies(records).columns == ["table_name", "first_id", "copy_id"]
