"""State carried along ordered rows of groups, without a task for a whole group.

Rows of a group (a file, a conversation) have a whole number that orders them. They are cut
into chunks of consecutive numbers; windows run within chunks, and what a chunk needs from
its neighbours comes from one summary row for each chunk. A group that holds a third of all
rows is thus spread over as many tasks as it has chunks, and only the summaries, a
`chunk`-th of its rows, are put in order by group.

A null in a group column is a group of its own. Rows without a number are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers of one chunk.
CHUNK = 20_000


def scanned(
    rows: DataFrame, by: tuple[str, ...] = ("file",), order: str = "line_no", last: dict[str, Column] | None = None, count: dict[str, Column] | None = None,
    lag: dict[str, Column] | None = None, lead: dict[str, Column] | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """rows with new columns: the last non-null value so far, the number of non-null values so far,
    the value of the row before, the value of the row after; names map to values."""
    last, count, lag, lead = last or {}, count or {}, lag or {}, lead or {}
    kept = [c for c in rows.columns if c not in {*last, *count, *lag, *lead}]
    group = F.concat_ws("\u0000", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by])
    place = {"_group": group, "_chunk": F.floor(F.col(order) / chunk)}
    values = {f"_v_{n}": c for kind in (last, count, lag, lead) for n, c in kind.items()}
    placed = rows.filter(F.col(order).isNotNull()).select(*[F.col(f"`{c}`") for c in kept], *[c.alias(n) for n, c in {**place, **values}.items()])

    v = lambda n: F.col(f"_v_{n}")
    summary = (
        [F.max_by(v(n), F.when(v(n).isNotNull(), F.col(order))).alias(f"_e_{n}") for n in last]
        + [F.count(v(n)).alias(f"_e_{n}") for n in count]
        + [F.max_by(F.struct(v(n).alias("x")), order).alias(f"_e_{n}") for n in lag]
        + [F.min_by(F.struct(v(n).alias("x")), order).alias(f"_e_{n}") for n in lead]
    )
    chunks = Window.partitionBy("_group").orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    e = lambda n: F.col(f"_e_{n}")
    carried = (
        [F.last(e(n), ignorenulls=True).over(before).alias(f"_c_{n}") for n in last]
        + [F.coalesce(F.sum(e(n)).over(before), F.lit(0)).alias(f"_c_{n}") for n in count]
        + [F.lag(e(n)).over(chunks)["x"].alias(f"_c_{n}") for n in lag]
        + [F.lead(e(n)).over(chunks)["x"].alias(f"_c_{n}") for n in lead]
    )
    edges = placed.groupBy("_group", "_chunk").agg(*summary).select("_group", "_chunk", *carried)

    w = Window.partitionBy("_group", "_chunk").orderBy(order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = {n: F.last(v(n), ignorenulls=True).over(so_far) for n in last} | {n: F.count(v(n)).over(so_far) for n in count}
    # a struct keeps a neighbour's null apart from a missing neighbour
    inside |= {n: F.lag(F.struct(v(n).alias("x"))).over(w) for n in lag} | {n: F.lead(F.struct(v(n).alias("x"))).over(w) for n in lead}
    joined = placed.select("*", *[c.alias(f"_i_{n}") for n, c in inside.items()]).join(edges, ["_group", "_chunk"])
    i, c = (lambda n: F.col(f"_i_{n}")), (lambda n: F.col(f"_c_{n}"))
    out = [F.coalesce(i(n), c(n)).alias(n) for n in last] + [(i(n) + c(n)).alias(n) for n in count]
    out += [F.when(i(n).isNotNull(), i(n)["x"]).otherwise(c(n)).alias(n) for n in (*lag, *lead)]
    return joined.select(*[F.col(f"`{k}`") for k in kept], *out)


def numbered(rows: DataFrame, by: tuple[str, ...], order: str, name: str, chunk: int = CHUNK) -> DataFrame:
    """rows with their place (from 1) in their group."""
    return scanned(rows, by, order, count={name: F.lit(1)}, chunk=chunk)

