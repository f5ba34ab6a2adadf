import heapq
import random

from verbena.llm import mixing


def plain_sainte_lague(seats, weights):
    given = [0] * len(weights)
    queue = [(-w, i) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(queue)
    for _ in range(seats):
        _, i = heapq.heappop(queue)
        given[i] += 1
        heapq.heappush(queue, (-weights[i] / (2 * given[i] + 1), i))
    return given


def test_apportionment():
    rng = random.Random(1)
    for _ in range(60):
        weights = [rng.choice([0, 1, 1, rng.random(), 7]) for _ in range(rng.randint(1, 9))]
        seats = rng.randint(0, 400)
        if any(weights):
            assert mixing.sainte_lague(seats, weights) == plain_sainte_lague(seats, weights)
    assert mixing.sainte_lague(10, [1, 1], [2, 100]) == [2, 8]
    assert sum(mixing.sainte_lague(10**12, [0.3, 0.7])) == 10**12


def test_mix_reaches_the_shares(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["big"] * 20 + ["small", None, "other"]), rng.choice([0, 10, 100, 300])) for i in range(4000)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(sizes, targets, shard_tokens=20_000)
    got = mixed.collect()
    assert {r.source for r in got} == {"big", "small"}
    assert max(r.copies for r in got if r.source == "big") == 1 and max(r.copies for r in got if r.source == "small") <= 3
    by = {r.source: r for r in mixing.shares(sizes, mixed, targets).collect()}
    assert abs(by["big"].reached_share - 2 / 3) < 0.02 and abs(by["small"].reached_share - 1 / 3) < 0.02
    assert by["none"].reached_share == 0 and by["none"].tokens == 0
    assert sorted(got) == sorted(mixing.mix(sizes.repartition(7), targets, shard_tokens=20_000).collect())


def test_empty(spark):
    sizes = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(sizes, targets)
    assert mixed.count() == 0
    assert mixing.shares(sizes, mixed, targets).first().reached_share == 0
