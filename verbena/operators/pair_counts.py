"""How often each left name meets each right name, when rows hold a list of each.

The pairs of two lists are as many as the product of their lengths, so they are neither shuffled nor
summed by a hash table that spills. Names of either side are dealt into `k` blocks by their hash; a
cell is a block of left with a block of right names. Each list is cut by block and handed to the `k`
cells of each block, so that a cell can sum all its pairs alone: `k` times the lists are shuffled, the
pairs are made where they are summed. A cell keeps its lists as numbers, sums one left name at a
time and gives its rows out in batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Rows that are given out at once.
ROWS = 1 << 16


class _Lists:
    """A column of lists of names as numbers; names are numbered as they come, lists are kept end to end."""

    def __init__(self, numbers: dict):
        self.numbers, self.ends, self.parts = numbers, [np.zeros(1, np.int64)], []

    def add(self, lists: pa.Array) -> None:
        own = lists.flatten().dictionary_encode(null_encoding="encode")
        known = np.array([self.numbers.setdefault(x, len(self.numbers)) for x in own.dictionary.to_pylist()], np.int32)
        self.parts.append(known[own.indices.to_numpy(zero_copy_only=False)])
        self.ends.append(self.ends[-1][-1] + np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)))

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        """All numbers, and where each list begins and the last one ends."""
        return np.concatenate([np.zeros(0, np.int32), *self.parts]), np.concatenate([self.ends[0], *[e for e in self.ends[1:] if len(e)]])


def _summed(first: np.ndarray, second: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers that stand in either, ascending, with how often they stand in the first and in the second."""
    both = np.concatenate([first, second])
    if len(both) * 16 >= names:  # else sorting them is cheaper
        c, f = (np.bincount(x, minlength=names) for x in (both, first))
        own = np.flatnonzero(c)
        return own, f[own], c[own] - f[own]
    own, at = np.unique(both, return_inverse=True)
    f, s = (np.bincount(x, minlength=len(own)) for x in (at[: len(first)], at[len(first) :]))
    return own, f, s


def _cell(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """left, right, first, second of one cell, whose batches are cell and the lists of left names, first and second right names."""
    left, right = {}, {}
    columns = [_Lists(left), _Lists(right), _Lists(right)]
    kinds: list[pa.DataType] = []
    for batch in batches:
        own = [batch.column(n) for n in ("left", "first", "second")]
        kinds = kinds or [own[0].type.value_type, own[1].type.value_type]
        for column, lists in zip(columns, own, strict=True):
            column.add(lists)
    if not kinds:
        return
    (l_ids, l_ends), (f_ids, f_ends), (s_ids, s_ends) = (c.done() for c in columns)
    rows = np.repeat(np.arange(len(l_ends) - 1), np.diff(l_ends))
    order = np.argsort(l_ids, kind="stable")
    l_ids, rows = l_ids[order], rows[order]
    starts = np.concatenate([np.flatnonzero(np.diff(l_ids, prepend=-1)), [len(l_ids)]]).tolist()
    # left names of the same rows have the same sums, so they follow one another
    names = sorted(((rows[a:b].tobytes(), a, b) for a, b in zip(starts, starts[1:], strict=False)), key=lambda x: x[0])
    l_names, r_names = pa.array(list(left), kinds[0]), pa.array(list(right), kinds[1])
    last, sums, ready, size = None, None, [], 0

    def given() -> pa.RecordBatch:
        l, r, f, s = (np.concatenate(x) for x in zip(*ready, strict=True))  # noqa: E741
        return pa.record_batch({"left": l_names.take(pa.array(l)), "right": r_names.take(pa.array(r)), "first": pa.array(f, pa.int64()), "second": pa.array(s, pa.int64())})

    for key, a, b in names:
        if key != last:
            firsts, seconds = ([ids[ends[x] : ends[x + 1]] for x in rows[a:b].tolist()] for ids, ends in ((f_ids, f_ends), (s_ids, s_ends)))
            last, sums = key, _summed(np.concatenate(firsts), np.concatenate(seconds), len(right))
        for at in range(0, len(sums[0]), most):
            part = [x[at : at + most] for x in sums]
            ready.append([np.full(len(part[0]), l_ids[a], np.int32), *part])
            size += len(part[0])
            if size >= most:
                yield given()
                ready, size = [], 0
    if ready:
        yield given()


def by_pair(rows: DataFrame, left: str, first: str, second: str) -> DataFrame:
    """left, right, first, second: over all rows, how often each name of the list `left` meets each of the lists `first` and `second`.

    Lists have no null in place of a list. `left` is an array of structs of one field, which may be null;
    `first` and `second` are arrays of strings. Pairs that never meet have no row.
    """
    ship(rows.sparkSession)
    k = max(2, isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1) + 1)
    kind = rows.schema[left].dataType.elementType.fields[0]
    block = lambda x: F.pmod(F.xxhash64(x), F.lit(k))

    def slices(cell):
        own = lambda c, n, x=lambda x: x: F.filter(c, lambda y: block(x(y)) == n)
        lefts = F.transform(own(left, F.floor(cell / k), lambda y: y[kind.name]), lambda y: y[kind.name])
        return F.struct(cell.alias("cell"), lefts.alias("left"), own(first, cell % k).alias("first"), own(second, cell % k).alias("second"))

    cells = F.filter(F.transform(F.sequence(F.lit(0), F.lit(k * k - 1)), slices), lambda x: (F.size(x["left"]) > 0) & (F.size(x["first"]) + F.size(x["second"]) > 0))
    # as many partitions as cells, for a cell's rows out are many more than its rows in
    dealt = rows.select(F.explode(cells).alias("_x")).select("_x.*").repartition(k * k, "cell")

    most = ROWS

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _cell(batches, most)

    return dealt.groupBy("cell").applyInArrow(summed, f"left {kind.dataType.simpleString()}, right string, first long, second long")
