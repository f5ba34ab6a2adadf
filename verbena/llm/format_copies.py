"""Duplicates hidden by formatting: canonical records, range-partitioned, sorted, scanned.

Two texts of one group (asset) are copies when their letters and digits agree in order, all
else put aside and case being equal. In a text made only of two or more `name: value` fields
the fields are sorted first. The canonical records are range-partitioned by key and id, each
partition is sorted (Spark spills a sort to disk), and one scan over adjacent rows compares
whole keys. Since the id is part of the range, a key held by a third of all rows is spread
over many partitions; a run that crosses partitions is put together from two edge rows per
partition, which is the only data that is broadcast.

Null texts and texts without letter or digit have no key and belong to no group. A null
group column is a group of its own. Long
texts are compared whole. Extra columns aren't read. Ids are unique within a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship, stored

#: Signs that may stand between the fields of a record.
FIELD_BREAK = r"[\n\r\t|;,/•·]+|\s[-–—]+\s"
#: White space beside the sign between name and value parts no fields.
JOINED = r"\s*([:=])\s*"
#: One `name: value` field; both sides hold a letter or digit.
FIELD = r"(?s)[^\p{L}\p{Nd}:=]*\p{L}[^:=]*[:=][^:=]*[\p{L}\p{Nd}][^:=]*"

SCAN = pa.schema([("kind", pa.int8()), ("pid", pa.int32()), ("key", pa.string()), ("head", pa.int64()), ("row", pa.int64()), ("n", pa.int64())])
SCAN_DDL = "kind byte, pid int, key string, head long, row long, n long"
#: Kinds of rows of a scan: a finished run or copy, one of the partition's first run, an edge.
INNER, FIRST_RUN, EDGE = 0, 1, 2


def alnum(text: Column) -> Column:
    """The letters and digits of a text, in lower case."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{Nd}]", ""))


def canonical_key(text: Column) -> Column:
    """What two copies have in common; null for texts without letter or digit."""
    plain = alnum(text)
    parts = F.filter(F.split(F.regexp_replace(text, JOINED, "$1"), FIELD_BREAK), lambda p: p.rlike(r"[\p{L}\p{Nd}]"))
    fielded = text.rlike("[:=]") & (F.size(parts) >= 2) & F.forall(parts, lambda p: p.rlike("^" + FIELD + "$"))
    fields = F.transform(parts, lambda p: F.concat(alnum(F.regexp_extract(p, r"(?s)^([^:=]*)", 1)), F.lit("\u0001"), alnum(F.regexp_extract(p, r"(?s)^[^:=]*[:=](.*)$", 1))))
    key = F.when(fielded, F.array_join(F.array_sort(fields), "\u0002")).otherwise(plain)
    return F.when(plain != "", key)


def canonical_records(df: DataFrame, table_name: str, id_col: str, group_col: str, text_col: str) -> DataFrame:
    """key and row of each record that has a key; the key starts with table and group."""
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col)), F.lit("-"))
    return (
        df.select(F.col(id_col).cast("long").alias("row"), group.alias("_group"), canonical_key(F.col(text_col)).alias("_key"))
        .filter(F.col("_key").isNotNull())
        .select(F.concat_ws("\u0000", F.lit(table_name), F.col("_group"), F.col("_key")).alias("key"), "row")
    )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """keys, rows, head of each row's run and number of each row's run, over sorted batches."""
    last_key, head, run = None, -1, -1
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, rows = batch.column(0), batch.column(1).to_numpy()
        new = np.ones(n, dtype=bool)
        if n > 1:
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = last_key is None or keys[0].as_py() != last_key
        at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        heads = np.where(at < 0, head, rows[np.maximum(at, 0)])
        runs = run + np.cumsum(new)
        last_key, head, run = keys[n - 1].as_py(), int(heads[-1]), int(runs[-1])
        yield keys, rows, heads, runs


def _rows(kind, pid, key, head, row, n) -> pa.RecordBatch:
    size = len(row)
    fill = lambda x, t: x if isinstance(x, (np.ndarray, pa.Array)) else [x] * size
    columns = [pa.array(fill(x, f.type), f.type) for x, f in zip((kind, pid, key, head, row, n), SCAN, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=SCAN)


def _table(keys: pa.Array, at: np.ndarray) -> pa.Array:
    """The table names that the keys at these places start with."""
    return pc.list_element(pc.split_pattern(keys.take(pa.array(at)), "\0", max_splits=1), 0)


def scan_copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row that repeats the row before it, with its run's head; first-run rows and edges apart."""
    pid, first, last = TaskContext.get().partitionId(), None, None
    for keys, rows, heads, runs in _runs(batches):
        if first is None:
            first = (keys[0].as_py(), int(heads[0]))
        inner, in_first = (runs > 0) & (rows != heads), runs == 0
        if inner.any():
            yield _rows(INNER, pid, _table(keys, np.flatnonzero(inner)), heads[inner], rows[inner], 1)
        if in_first.any():
            yield _rows(FIRST_RUN, pid, None, heads[in_first], rows[in_first], 1)
        last = (keys[len(rows) - 1].as_py(), int(heads[-1]), int(runs[-1]))
    if first is not None:
        yield _rows(EDGE, pid, first[0], np.array([first[1]]), np.array([1]), 1)
        if last[2] > 0:
            yield _rows(EDGE, pid, last[0], np.array([last[1]]), np.array([0]), 1)


def scan_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run, head and number of rows; the first and the last run with their keys."""
    pid, key, head, n, number = TaskContext.get().partitionId(), None, None, 0, 0
    for keys, rows, heads, runs in _runs(batches):
        starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
        sizes = np.diff(np.r_[starts, len(rows)])
        if head is not None and runs[0] == number:
            sizes[0] += n
        elif head is not None:
            yield _rows(EDGE, pid, key, np.array([head]), np.array([0]), n) if number == 0 else _rows(INNER, pid, key.split("\0", 1)[0], np.array([head]), np.array([0]), n)
        done = starts[:-1]
        if len(done):
            edge = runs[done] == 0
            if edge.any():
                yield _rows(EDGE, pid, keys.take(pa.array(done[edge])), heads[done[edge]], done[edge], sizes[:-1][edge])
            if not edge.all():
                yield _rows(INNER, pid, _table(keys, done[~edge]), heads[done[~edge]], done[~edge], sizes[:-1][~edge])
        key, head, n, number = keys[len(rows) - 1].as_py(), int(heads[-1]), int(sizes[-1]), int(runs[-1])
    if head is not None:
        yield _rows(EDGE, pid, key, np.array([head]), np.array([0]), n)


def _table_of(key: str) -> Column:
    return F.substring_index(key, "\u0000", 1).alias("table_name")


def _scanned(records: DataFrame, scan: Callable) -> DataFrame:
    ship(records.sparkSession)
    # the sampler of ranges reads its input as well: it gets the keys from files, so that they are computed once
    keyed = stored(records, "keys")
    ordered = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    return stored(ordered.mapInArrow(scan, SCAN_DDL), "runs")


def copies(records: DataFrame) -> DataFrame:
    """first_id, copy_id: one row for each copy beyond the first."""
    scanned = _scanned(records, scan_copies)
    edges = scanned.filter(F.col("kind") == EDGE)
    heads = edges.groupBy("key").agg(F.min("head").alias("first_id"))
    first_runs = edges.filter(F.col("row") == 1).join(heads, "key").select("pid", _table_of("key"), "first_id")
    crossing = (
        scanned.filter(F.col("kind") == FIRST_RUN)
        .join(F.broadcast(first_runs), "pid")  # one row per partition of the sort
        .filter(F.col("row") != F.col("first_id"))
        .select("table_name", "first_id", F.col("row").alias("copy_id"))
    )
    inner = scanned.filter(F.col("kind") == INNER).select(F.col("key").alias("table_name"), F.col("head").alias("first_id"), F.col("row").alias("copy_id"))
    return crossing.unionByName(inner)


def representatives(records: DataFrame) -> DataFrame:
    """table_name, first_id, copies: one row for each canonical record with its number of rows."""
    scanned = _scanned(records, scan_counts)
    edges = scanned.filter(F.col("kind") == EDGE).groupBy("key").agg(F.min("head").alias("first_id"), F.sum("n").alias("copies"))
    whole = scanned.filter(F.col("kind") == INNER).select("key", F.col("head").alias("first_id"), F.col("n").alias("copies"))
    return whole.unionByName(edges).select(_table_of("key"), "first_id", "copies")
