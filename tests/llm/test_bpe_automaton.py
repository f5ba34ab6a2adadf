import base64
import os
import random

import pytest
import regex

from verbena.llm import bpe_automaton as ba
from verbena.llm.queries import BYTE_BPE, BYTE_BPE_SPLIT, TOKENIZERS

pytestmark = pytest.mark.skipif(not os.path.exists(BYTE_BPE), reason="no vocabulary here")


@pytest.fixture(scope="module")
def automaton():
    return ba.Automaton(*ba.read_vocabulary(BYTE_BPE))


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=BYTE_BPE_SPLIT, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    letters = [chr(c) for c in range(32, 127)] + list("áéñüß中文字🌙👩‍🌾\n\t\r ΨЖ�")
    for _ in range(3000):
        kind = rng.random()
        pool = letters if kind < 0.4 else list("ab") if kind < 0.6 else list("etaoinshr")
        yield "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
    for c in "ae -=.*\n":
        yield c * rng.randint(1, 300)
    yield from ("<|endoftext|>", "a" * 20_000, " " * 3000, "ab" * 5000, "VocÃª nÃ£o", "don't we'll \r\n\r\n x")


def test_encoding_equals_the_merges(automaton, reference):
    split = regex.compile(BYTE_BPE_SPLIT).findall
    for t in texts():
        ids = automaton.encode(t, split)
        assert ids == reference.encode_ordinary(t), t[:80]
        assert automaton.decode(ids) == t


def test_small_vocabulary_with_a_label_no_merge_reaches():
    labels = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"aa", b"aaaa"]
    small = ba.Automaton(labels, [(0, 1, 3), (1, 2, 4), (0, 4, 5), (0, 0, 6), (6, 6, 7)])
    assert small.encode_word(b"abc") == [3, 2]
    assert small.encode_word(b"bc") == [4]
    assert small.encode_word(b"aaa") == [6, 0]
    assert small.encode_word(b"aaaaa") == [7, 0]


def test_columns(spark, automaton):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Olá, mundo", None), (3, "Olá, mundo", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = ba.with_ids(df, "text", BYTE_BPE, BYTE_BPE_SPLIT)
    assert got.columns == ["doc_id", "ids"]
    found = [r.ids for r in got.orderBy("doc_id").collect()]
    assert found[:2] == [[], []] and found[2] == found[3] and automaton.decode(found[2]) == "Olá, mundo"
    back = ba.with_text(got, "ids", BYTE_BPE)
    assert [r.text for r in back.orderBy("doc_id").collect()] == ["", "", "Olá, mundo", "Olá, mundo"]
    assert ba.with_ids(df.limit(0), "text", BYTE_BPE, BYTE_BPE_SPLIT).count() == 0
