"""Byte-level BPE of a public vocabulary as an automaton over tokens.

The automaton starts with one state and an arc for each byte, so every cutting of a word into
bytes is a path. Each merge u+v of the vocabulary, in order of rank, is a gadget: the arc v is
taken away from the state behind u, and the arc uv is added beside each arc u, leading where
v led. Taking v away splits the state, for other tokens still lead to the old one. A state is
thus known by the token that led to it; `born` says at which rank a token's arc came in, and
`cut[u, v]` at which rank the arc v left the state behind u. Arcs that a state took over from
an older one are kept by reference: the state behind uv is the state behind v as it was at
the rank of uv, and the arcs into it are those of u as they were. So the whole automaton is
two arrays and one table of 50,000 entries, and whether arc b leaves the state behind a is
found by following both references; the answers are kept in a transition table.

The paths that remain spell each word in exactly one way, its BPE encoding, and a prefix of a
path is the path of the prefix. Encoding goes through the bytes of a pre-split word once: for
each end position exactly one of the tokens that end there has an arc from the state reached
where it starts. The time is linear in the word, whatever its length. Decoding puts the
labels of the arcs one after another.

Null and empty texts give an empty list of ids. A column that has the result's name is replaced. Special tokens aren't produced; their strings
in a text are ordinary text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

NEVER = 1 << 60
#: Words and transitions that a worker keeps; beyond, it forgets them all and starts anew.
KEEP = 400_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """Labels by id, and merges (left, right, merged) by rank, of a tokenizers JSON file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, ids = byte_letters(), model["vocab"]
    labels = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if all(c in letters for c in token):
            labels[i] = bytes(letters[c] for c in token)
    merges = []
    for m in model["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.append((ids[left], ids[right], ids[left + right]))
    return labels, merges


class Automaton:
    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        n = len(labels)
        self.labels, self.size = labels, n
        self.left, self.right = [-1] * n, [-1] * n
        self.born, self.cut = [-1] * n, {}
        #: Tokens with arcs: bytes, and those that a gadget put in. Special tokens have none.
        alive = [len(x) == 1 for x in labels]
        for rank, (u, v, uv) in enumerate(merges):
            if alive[u] and alive[v] and self._has_arc(u, v):
                self._gadget(rank, u, v, uv)
                alive[uv] = True
        self.ids = {x: i for i, x in enumerate(labels) if alive[i]}
        self.ends = {x[k:] for x in self.ids for k in range(len(x))}
        self.table: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        self.cut[u * self.size + v] = rank
        self.left[uv], self.right[uv], self.born[uv] = u, v, rank

    def _has_arc(self, a: int, b: int) -> bool:
        """Whether arc b leaves the state behind a: no arc taken away is met along the references."""
        x, x_until = a, NEVER
        while x >= 0:
            y, y_until = b, NEVER
            while y >= 0:
                rank = self.cut.get(x * self.size + y)
                # an arc taken over counts as it was then; the gadget of u+u itself takes uu away too
                if rank is not None and rank < x_until and rank <= y_until:
                    return False
                y_until, y = self.born[y], self.left[y]
            x_until, x = self.born[x], self.right[x]
        return True

    def arc(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= KEEP:
                self.table.clear()
            known = self.table[key] = self._has_arc(a, b)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        state, start = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            found = []
            at = end - 1
            while at >= 0 and (piece := word[at:end]) in self.ends:
                token = self.ids.get(piece)
                if token is not None:
                    found.append((at, token))
                at -= 1
            for at, token in reversed(found):
                if at == 0 or self.arc(state[at], token):
                    state[end], start[end] = token, at
                    break
        out, end = [], n
        while end > 0:
            out.append(state[end])
            end = start[end]
        return out[::-1]

    def encode(self, text: str, split) -> list[int]:
        words, out = self.words, []
        for word in split(text):
            ids = words.get(word)
            if ids is None:
                if len(words) >= KEEP:
                    words.clear()
                ids = self.encode_word(word.encode("utf-8"))
                if len(word) <= 64:
                    words[word] = ids
            out.append(ids)
        return list(chain.from_iterable(out))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.labels[i] for i in ids).decode("utf-8")


_BUILT: dict[int, Automaton] = {}


def built(shared) -> Automaton:
    """This worker's automaton of a broadcast vocabulary, built once."""
    key = shared.id if hasattr(shared, "id") else id(shared)
    if key not in _BUILT:
        _BUILT[key] = Automaton(*shared.value)
    return _BUILT[key]


def _tokenized(df: DataFrame, text_col: str, vocabulary: str, pattern: str, result: str, counts: bool) -> DataFrame:
    ship(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (text_col, result)]
    schema = T.StructType([*kept, T.StructField(result, T.LongType() if counts else T.ArrayType(T.IntegerType()))])
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))  # bounded by the vocabulary: 50,000 labels
    kind = pa.int64() if counts else pa.list_(pa.int32())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, split = built(shared), regex.compile(pattern).findall
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = (automaton.encode(t, split) if t else [] for t in texts)
            column = pa.array([len(x) for x in ids] if counts else list(ids), kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=schema.names)

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`")).mapInArrow(encode, schema)


def with_ids(df: DataFrame, text_col: str, vocabulary: str, pattern: str, result: str = "ids") -> DataFrame:
    """df with the token ids of a text in place of the text."""
    return _tokenized(df, text_col, vocabulary, pattern, result, False)


def with_token_count(df: DataFrame, text_col: str, vocabulary: str, pattern: str, result: str = "n_tokens") -> DataFrame:
    """df with the number of tokens of a text in place of the text."""
    return _tokenized(df, text_col, vocabulary, pattern, result, True)


def with_text(df: DataFrame, ids_col: str, vocabulary: str, result: str = "text") -> DataFrame:
    """df with the decoded text in place of the token ids."""
    ship(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (ids_col, result)]
    schema = T.StructType([*kept, T.StructField(result, T.StringType())])
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = built(shared)
        for batch in batches:
            column = pa.array([automaton.decode(ids or []) for ids in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=schema.names)

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{ids_col}`")).mapInArrow(decode, schema)
