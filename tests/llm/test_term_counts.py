import re
from collections import Counter

import pytest

from verbena.llm import term_counts as tc
from verbena.session import scratch


def brute(rows):
    occ, rec = Counter(), Counter()
    for text, weight in rows:
        terms = [t.lower() for t in re.findall(r"[^\W\d_]+", text or "")]
        for t in terms:
            occ[t] += max(weight or 1, 1)
        rec.update(set(terms))
    return {t: (occ[t], rec[t]) for t in occ}


def held(store):
    return {r.term: (r.occurrences, r.records) for r in store.read().collect()}


def test_deltas_add_change_and_delete(spark):
    store = tc.TermStore(spark, scratch(spark, "t"))
    first = [("A cat, a CAT!", 2), (None, 5), ("", None), ("dog", 0), ("dog", -4), ("éa b" * 5000, 1), ("x2y", None)]
    df = spark.createDataFrame([(*r, "z") for r in first], "text string, w int, term string")
    store.apply(tc.delta(df, "text", "w"))
    want = brute(first)
    got = held(store)
    assert got.pop(tc.TOTAL) == (0, len(first)) and got == want
    # the cat's record changes, a dog goes, a bird comes
    changes = [("A cat, a CAT!", 2, -1), ("A cat", 2, 1), ("dog", 0, -1), ("bird bird", 3, 1)]
    store.apply(tc.delta(spark.createDataFrame(changes, "text string, w int, s int"), "text", "w", "s"))
    now = [("A cat", 2), *first[1:3], *first[4:], ("bird bird", 3)]
    got = held(store)
    assert got.pop(tc.TOTAL) == (0, len(now)) and got == brute(now)
    # a term that nobody holds any more is gone
    store.apply(tc.delta(spark.createDataFrame([("bird bird", 3, -1)], "text string, w int, s int"), "text", "w", "s"))
    assert "bird" not in held(store)


def test_marks(spark):
    rows = [("the rare" if i == 0 else "the often" if i < 3 else "the" if i < 12 else None, 1) for i in range(100)]
    store = tc.TermStore(spark, scratch(spark, "t"))
    store.apply(tc.delta(spark.createDataFrame(rows, "text string, w int"), "text", "w"))
    marks = {r.term: r.mark for r in tc.marked(store.read()).collect()}
    assert marks == {"the": "common", "rare": "rare", "often": "rare"}


def test_empty(spark):
    store = tc.TermStore(spark, scratch(spark, "t"))
    store.apply(tc.delta(spark.createDataFrame([], "text string, w int"), "text", "w"))
    assert tc.marked(store.read()).count() == 0


def test_a_delta_counts_once_and_a_cut_off_merge_leaves_the_former_state(spark):
    root = scratch(spark, "t")
    store = tc.TermStore(spark, root)
    one = tc.delta(spark.createDataFrame([("a b", 1)], "text string, w int"), "text", "w")
    assert store.apply(one, "first") and not store.apply(one, "first")
    assert held(store)["a"] == (1, 1)
    # cut off before its manifest was put in place: the run is there, nobody names it
    commit = store._commit
    store._commit = lambda manifest: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError, match="lost"):
        store.apply(one, "second")
    store._commit = commit
    assert held(store)["a"] == (1, 1) and store.apply(one, "second") and held(store)["a"] == (2, 2)
    # another writer was first
    other = store.manifest()
    store.apply(one, "third")
    with pytest.raises(OSError, match="another"):
        store._commit({**other, "number": other["number"] + 1})
    assert store.manifest()["deltas"] == ["first", "second", "third"]
    store.vacuum()
    assert held(store)["a"] == (3, 3)


def test_runs_stay_few(spark):
    store = tc.TermStore(spark, scratch(spark, "t"))
    store.apply(tc.delta(spark.createDataFrame([(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)), 1)], "text string, w int"), "text", "w"))
    for i in range(4):
        store.apply(tc.delta(spark.createDataFrame([("waa wba", 1)], "text string, w int"), "text", "w"))
    assert len(store.manifest()["runs"]) == 2 and held(store)["waa"] == (5, 5)
