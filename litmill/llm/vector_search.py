"""Exact top-k by integer inner product, one term after another.

A vector is a sparse row of integer weights by component. For a block of
candidates each component that occurs has a postings list (row, weight); a few
queries at a time add their own weights times each posting to a dense array of
scores, one entry for each query and row of the block, component after
component. Each block keeps its best k for a query and the lists are merged.

Scale: candidates are packed in blocks of at most ``block_rows`` rows, queries,
a stated share of the rows, in blocks of at most ``query_rows``, either with at
most ``BLOCK_CELLS`` weights other than zero, so wide vectors make small blocks.
Blocks of candidates are dealt to the rows of a grid and blocks of queries to
its columns; a row of candidates is copied once for each column and a column of
queries once for each row, the grid being shaped so that both cost alike. A task
holds one pair of blocks at a time. The k rows a query and block are all that is
shuffled for the merge, and Spark cuts them to k a task before that.

Defined cases: vectors that are null or hold a null or non-finite component take
no part; empty ones take part with scores of zero; a query never meets rows of
its own id; ties go to the smaller id; fewer candidates than k give fewer rows;
components that only one side has count as zero; rows that repeat an id are
ranked as rows of their own, and queries that repeat one share a list; a weight
or a score that 64 bits do not hold is an error, as it is in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.llm.common import per_batch, table

SCALE = 1024.0
#: Weights are less than this.
LARGEST = float(1 << 63)
TOP_K = 10
BLOCK_ROWS = 4096
QUERY_ROWS = 512
BLOCK_CELLS = 1 << 19
#: Pairs of blocks that one cell of the grid has at most.
PAIRS = 64
#: Queries that are scored together, so that their scores stay in the processor's cache.
TOGETHER = 16
#: A block: ids of its rows, the terms that occur, where their postings begin, rows and weights of those.
PARTS = (("ids", np.int64), ("terms", np.int32), ("starts", np.int64), ("rows", np.int32), ("weights", np.int64))


def integer_vectors(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``(vec_id, weights array<long>)`` of the vectors that take part."""
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = lambda x: F.when(F.abs(x) < LARGEST, F.floor(x)).otherwise(F.raise_error(F.lit("a weight is beyond 64 bits")).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull()).where(good).select("vec_id", F.transform("embedding", lambda x: whole(x.cast("double") * scale)).alias("weights"))


def postings(ids: list[int], rows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The parts of a block."""
    held = [np.flatnonzero(r) for r in rows]
    term = np.concatenate([*held, np.empty(0, np.int64)]).astype(np.int32)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(h) for h in held])
    weight = np.concatenate([*(r[h] for r, h in zip(rows, held)), np.empty(0, np.int64)])
    order = np.argsort(term, kind="stable")
    terms, starts = np.unique(term[order], return_index=True)
    return np.array(ids, np.int64), terms, np.append(starts, len(term)), row[order], weight[order]


def blocks(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Pack the vectors of each partition in numbered blocks of postings."""

    def one(number: int, ids: list[int], held: list[np.ndarray]) -> pa.RecordBatch:
        parts = [np.ascontiguousarray(x, t).tobytes() for x, (_, t) in zip(postings(ids, held), PARTS)]
        return pa.record_batch([[number], *([x] for x in parts)], names=["number", *(f"{name}_{x}" for x, _ in PARTS)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        ids, held, cells = [], [], 0
        for batch in batches:
            for i, weights in zip(batch.column(0).to_pylist(), batch.column(1)):
                weights = weights.values.to_numpy()
                more = np.count_nonzero(weights)
                if ids and (len(ids) == rows or cells + more > BLOCK_CELLS):
                    yield one(number, ids, held)
                    number, ids, held, cells = number + 1, [], [], 0
                ids.append(i)
                held.append(weights)
                cells += more
        if ids:
            yield one(number, ids, held)

    return vectors.select("vec_id", "weights").mapInArrow(pack, f"number long, {', '.join(f'{name}_{x} binary' for x, _ in PARTS)}")


def scores_of(queries: tuple[np.ndarray, ...], block: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For a few queries at a time their ids and scores of every row of the block."""
    ids, terms, starts, rows, weights = block
    q_ids, q_terms, q_starts, q_rows, q_weights = queries
    both, at, q_at = np.intersect1d(terms, q_terms, assume_unique=True, return_indices=True)
    most = lambda x: max(-int(x.min(initial=0)), int(x.max(initial=0)))
    bound = most(weights) * most(q_weights) * len(both)
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object  # Python's own numbers don't wrap
    asked = np.zeros((len(both), len(q_ids)), kind)
    for j, t in enumerate(q_at):
        mine = slice(q_starts[t], q_starts[t + 1])
        asked[j, q_rows[mine]] = q_weights[mine]
    lists = [(rows[starts[t] : starts[t + 1]], weights[starts[t] : starts[t + 1]].astype(kind)) for t in at]
    for first in range(0, len(q_ids), TOGETHER):
        some = asked[:, first : first + TOGETHER]
        scores = np.zeros((some.shape[1], len(ids)), kind)
        for asking, (where, weight) in zip(some, lists):
            if len(where) == len(ids):
                scores += asking[:, None] * weight
            elif asking.any():
                scores[:, where] += asking[:, None] * weight
        if kind is object:
            scores[q_ids[first : first + TOGETHER, None] == ids] = 0  # never looked at
            if any(abs(s) >= 1 << 63 for s in scores.ravel()):
                raise OverflowError("a score is beyond 64 bits")
            scores = scores.astype(np.int64)
        yield q_ids[first : first + TOGETHER], scores


def best_of_block(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows for each query: a partition selection, then a sort of
    those at least as good as the k-th so that ties go to smaller ids."""
    out = []
    for query, row in zip(query_ids, scores):
        other = np.flatnonzero(ids != query)
        if len(other) > k:
            floor = np.partition(row[other], len(other) - k)[len(other) - k]
            other = other[row[other] >= floor]
        order = other[np.lexsort((ids[other], -row[other].astype(np.int64)))[:k]]
        out.append((np.full(len(order), query), ids[order], row[order].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def grid(n_rows: int, n_queries: int, block_rows: int, query_rows: int, parts: int) -> tuple[int, int]:
    """Rows and columns of the grid: cells for all tasks and of bounded size,
    candidates and queries copied about as much."""
    row_blocks, query_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    cells = max(parts, -(-row_blocks * query_blocks // PAIRS))
    down = math.ceil(math.sqrt(cells * n_rows / max(1, n_queries)))
    down = max(1, min(down, row_blocks, cells))
    return down, max(1, min(-(-cells // down), query_blocks))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP_K, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; both inputs are ``(vec_id, weights)``."""
    parts = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n_rows, n_queries = vectors.count(), queries.count()
    block_rows = max(1, min(block_rows, -(-n_rows // parts)))  # few rows still fill all tasks
    down, across = grid(n_rows, n_queries, block_rows, query_rows, parts)
    copied = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = blocks(vectors, block_rows, "row").withColumn("down", F.pmod("number", F.lit(down)).cast("int")).drop("number").withColumn("across", copied(across))
    asking = blocks(queries, query_rows, "query").withColumn("across", F.pmod("number", F.lit(across)).cast("int")).drop("number").withColumn("down", copied(down))

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            block, asked = (tuple(np.frombuffer(batch.column(f"{name}_{x}")[i].as_py(), t) for x, t in PARTS) for name in ("row", "query"))
            for q_ids, scores in scores_of(asked, block):
                found = best_of_block(q_ids, block[0], scores, k)
                yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    near = rows.join(asking, ["down", "across"]).mapInArrow(per_batch(score), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT), 0) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
