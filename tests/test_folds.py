"""The parallel fold against one over all rows."""

import random

import numpy as np

import pytest

from litmill.operators.folds import block_table, greedy_batches
from litmill.operators.sampling import pack_batches


def fold(sizes, most, limit):
    batch, n, used, out = 0, 0, 0, []
    for size in sizes:
        if n and (n == most or used + size > limit):
            batch, n, used = batch + 1, 0, 0
        n, used = n + 1, used + size
        out.append(batch)
    return out


def test_tables_of_blocks():
    rng = random.Random(1)
    for _ in range(300):
        most, limit, n = rng.randint(1, 6), rng.randint(1, 30), rng.randint(1, 40)
        sizes = [rng.choice([0, 1, 5, 9, 40]) for _ in range(n + most - 1)]
        exits, starts = block_table(np.array(sizes), n, most, limit)
        for entry in range(min(most, n)):
            batches = fold(sizes[entry:], most, limit)
            first = next((i for i in range(n, n + most) if i >= len(sizes) or batches[i - entry] != batches[i - entry - 1]), None)
            assert exits[entry] == first - n
            assert starts[entry] == batches[n - 1 - entry] + 1


@pytest.mark.parametrize("most, limit, block_rows, fan", [(8, 100, 16, 2), (3, 20, 3, 3), (5, 10**6, 7, 1024), (1, 5, 50, 4), (8, 60, 10_000, 1024)])
def test_equal_to_one_fold(spark, most, limit, block_rows, fan):
    rng = random.Random(most)
    sizes = [rng.choice([0, 1, 7, 12, 30, 99, 500]) for _ in range(333)]
    data = [(i * 3, s, None if i % 2 else "x") for i, s in enumerate(sizes)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "pos long, size long, batch string").repartition(5)
    out = sorted((r.pos, r.size, r.batch, r.place) for r in greedy_batches(frame, ["pos"], "size", most, limit, block_rows, fan).collect())
    assert out == [(i * 3, s, b, i) for i, (s, b) in enumerate(zip(sizes, fold(sizes, most, limit)))]


def test_nulls_negative_sizes_and_no_rows(spark):
    frame = spark.createDataFrame([(0, None), (1, -5), (2, 70_000), (3, 1)], "pos long, size long")
    assert [r.batch for r in pack_batches(frame).orderBy("pos").collect()] == [0, 0, 1, 2]
    assert pack_batches(frame.limit(0)).collect() == []
