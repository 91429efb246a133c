import math
import random

import pytest
from litmill.llm import vector_search as search
from litmill.llm.vector_search import integer_vectors, top_k


def brute(vectors, wanted, k):
    out = {}
    for q, w in wanted:
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in vectors if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_against_brute_force_with_ties_and_bad_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.001, -0.5, 0.25, rng.random()]) for _ in range(7)], 0) for i in range(300)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(30)]  # ties
    rows += [(2000, None, 0), (2100, [], 0), (2200, [1.0, None], 0), (2300, [float("nan")] * 7, 0), (2400, [float("inf")] * 7, 0), (None, [1.0] * 7, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, weights int").repartition(3)
    vectors = integer_vectors(table.drop("weights"))
    weights = [(r.vec_id, r.weights) for r in vectors.collect()]
    assert len(weights) == 331  # the empty one takes part
    assert dict(weights)[0] == [math.floor(1024 * float(x)) for x in table.where("vec_id = 0").first().embedding]
    got = {}
    for r in top_k(vectors, vectors.where("vec_id % 50 = 0"), 10, block_rows=64, query_rows=2).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == brute(weights, [w for w in weights if w[0] % 50 == 0], 10)


def test_wide_sparse_rows_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_CELLS", 40)
    monkeypatch.setattr(search, "PAIRS", 2)
    rng = random.Random(6)
    rows = []
    for i in range(90):
        weights = [0] * rng.choice([0, 5, 3000])
        for _ in range(min(len(weights), 12)):
            weights[rng.randrange(len(weights))] = rng.choice([1, -3, 1 << 29])
        rows.append((i // 2 * 2 if i == 81 else i, weights))
    vectors = spark.createDataFrame(rows, "vec_id long, weights array<long>").repartition(5)
    got = {}
    for r in top_k(vectors, vectors.where("vec_id % 7 = 0"), 10, block_rows=16, query_rows=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute(rows, [w for w in rows if w[0] % 7 == 0], 10)
    assert search.grid(10**9, 10**7, 4096, 512, 200)[0] > 1000


def test_sparse_rows_few_rows_and_no_rows(spark):
    vectors = spark.createDataFrame([(0, [0, 3, 0]), (1, [2, 0]), (2, [0, 1, 5])], "vec_id long, weights array<long>")
    got = {(r.query_id, r.vec_id): r.score for r in top_k(vectors, vectors, 10).collect()}
    assert got == {(0, 1): 0, (0, 2): 3, (1, 0): 0, (1, 2): 0, (2, 0): 3, (2, 1): 0}
    assert top_k(vectors.limit(0), vectors.limit(0), 10).collect() == []


def test_numbers_beyond_64_bits(spark):
    """Scores that fit are exact, others and weights that don't fit are errors."""
    big = 1 << 40
    fits = spark.createDataFrame([(0, [big, big, 3]), (1, [big, -big, 5]), (2, [1 << 22, 7, 0])], "vec_id long, weights array<long>")
    got = {(r.query_id, r.vec_id): r.score for r in top_k(fits, fits, 10).collect()}
    assert got[0, 1] == 15 and got[0, 2] == (big << 22) + 7 * big and got[1, 2] == (big << 22) - 7 * big
    wraps = spark.createDataFrame([(0, [big]), (1, [big])], "vec_id long, weights array<long>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_k(wraps, wraps, 10).collect()
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        integer_vectors(huge).collect()
