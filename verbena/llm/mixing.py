"""Mixing sources to target weights by apportioning equal blocks of tokens.

The mix is made of blocks of `block_tokens` tokens. How many blocks there are in all follows
from the source that runs out first when each record may stand `max_repeats` times; or it is
given, and then sources that can't fill their share give what they have. Blocks go to sources
by highest quotients weight/(2k+1) (Sainte-Laguë), and the blocks of a source go to its shards
in the same way, by the tokens of each shard. A shard holds records of one source chosen by a
seeded hash, about `shard_tokens` tokens, so no source is ever in one task. Within a shard the
records stand in seeded order; a quota beyond the shard's own tokens repeats the whole shard,
and the rest is taken from the front of that order, up to a record's half.

Only sums per source and per shard reach the driver: at most `max_shards` rows a source.
Records with a null source, or of a source without target, belong to no share and are left
out; so are records without tokens. A target whose source has no tokens gets none, and the
other shares are scaled to fill the mix. Rows repeated under one id are drawn together.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def sainte_lague(seats: int, weights: list[float], caps: list[int] | None = None) -> list[int]:
    """Seats for each weight by highest quotients weight/(2k+1), no weight above its cap.

    The seats that a threshold on the quotient gives are known at once, so the time doesn't
    grow with the number of seats; those left are given out one by one. Ties go to the first.
    """
    w = np.asarray(weights, dtype=float)
    top = np.full(len(w), seats) if caps is None else np.minimum(np.asarray(caps), seats)
    top = np.where(w > 0, top, 0)
    seats = int(min(seats, top.sum()))
    if not seats:
        return [0] * len(w)

    def at(threshold: float) -> np.ndarray:
        return np.minimum(np.floor((w / threshold + 1) / 2), top).astype(np.int64)

    low, high = w[w > 0].min() / (4 * seats + 4), 2 * w.max()
    while at(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if at(middle).sum() > seats else (low, middle)
    given = at(high)
    queue = [(-w[i] / (2 * given[i] + 1), i) for i in range(len(w)) if given[i] < top[i]]
    heapq.heapify(queue)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < top[i]:
            heapq.heappush(queue, (-w[i] / (2 * given[i] + 1), i))
    return [int(x) for x in given]


def mix(
    sizes: DataFrame,
    targets: DataFrame,
    total_tokens: int | None = None,
    block_tokens: int = 256,
    shard_tokens: int = 4_000_000,
    max_shards: int = 65_536,
    seed: int = 42,
) -> DataFrame:
    """doc_id, source, n_tokens, copies of each record of the mix, from doc_id, source, n_tokens."""
    spark = sizes.sparkSession
    goals = {r.source: (r.target_share, max(0, r.max_repeats or 0)) for r in targets.filter("source is not null and target_share > 0").collect()}
    known = sizes.filter(F.col("source").isin(list(goals)) & (F.col("n_tokens") > 0)).select("doc_id", "source", "n_tokens")
    sums = {r.source: r.tokens for r in known.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()}
    names = sorted(s for s in sums if goals[s][1] > 0)
    if not names:
        return known.filter(F.lit(False)).withColumn("copies", F.lit(0).cast("long"))
    scale = sum(goals[s][0] for s in names)
    shares = [goals[s][0] / scale for s in names]
    caps = [sums[s] * goals[s][1] // block_tokens for s in names]
    most = min(sums[s] * goals[s][1] / share for s, share in zip(names, shares, strict=True))
    blocks = dict(zip(names, sainte_lague(int((total_tokens or most) // block_tokens), shares, caps), strict=True))

    shards = {s: int(min(max_shards, max(1, -(-sums[s] // shard_tokens)))) for s in names}
    plan = spark.createDataFrame([(s, n) for s, n in shards.items()], "source string, n_shards long")
    place = F.xxhash64(F.col("doc_id"), F.lit(seed))
    placed = known.join(F.broadcast(plan), "source").select("doc_id", "source", "n_tokens", F.pmod(place, F.col("n_shards")).alias("shard"))

    by_shard: dict[str, list] = {s: [] for s in names}
    for r in placed.groupBy("source", "shard").agg(F.sum("n_tokens").alias("tokens")).orderBy("source", "shard").collect():
        by_shard[r.source].append((r.shard, r.tokens))
    quotas = []
    for s in names:
        held = [t for _, t in by_shard[s]]
        for (shard, tokens), n in zip(by_shard[s], sainte_lague(blocks[s], held), strict=True):
            quota = min(n * block_tokens, goals[s][1] * tokens)
            quotas.append((s, shard, quota // tokens, quota % tokens))
    quota_rows = spark.createDataFrame(quotas, "source string, shard long, whole long, rest long")

    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), "doc_id")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    drawn = placed.join(F.broadcast(quota_rows), ["source", "shard"]).withColumn("_before", before)
    copies = F.col("whole") + (F.col("_before") + F.col("n_tokens") / 2 < F.col("rest")).cast("long")
    return drawn.select("doc_id", "source", "n_tokens", copies.alias("copies")).filter(F.col("copies") > 0)


def shares(sizes: DataFrame, mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target: the tokens there are, those in the mix, the share reached, the most copies of a record."""
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    rows = targets.select("source", "target_share", "max_repeats").join(F.broadcast(have), "source", "left").join(F.broadcast(got), "source", "left")
    filled = rows.fillna(0, ["tokens", "mixed_tokens", "most_copies"])
    total = filled.agg(F.sum("mixed_tokens")).first()[0] or 0
    share = F.col("mixed_tokens") / F.lit(float(total)) if total else F.lit(0.0)
    return filled.withColumn("reached_share", share)


def token_sizes(counted: DataFrame) -> DataFrame:
    """The counted records, written once: tokenizing is the dear part and is done a single time."""
    return stored(counted, "sizes")
