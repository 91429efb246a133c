"""Quality from compressed sizes: good text is shorter under a dictionary of
good text than under one of bad text.

Two zstandard dictionaries are built from labelled good and bad texts. A text
is cut in windows of ``WINDOW`` bytes, each compressed alone with either
dictionary, so that the dictionaries count throughout a long text; the
difference of the two sums over the length of the text is the one feature, and
a logistic curve fitted on labelled rows that built no dictionary makes it a
probability.

Scale: the fit takes at most ``SAMPLE_ROWS`` labelled rows and ``SAMPLE_BYTES``
of text a class, by hash of the id, whatever the corpus holds; texts longer than
``1 / LONG`` of that come in only where shorter ones leave room. Only that sample
and the two dictionaries (``DICT_BYTES`` each) pass through the driver. Scoring
is one scan without a shuffle.

Defined cases: null and empty texts get the score of a zero difference; labels
that are null or neither 0 nor 1 are ignored; without labelled rows of both
classes every score is 0.5; rows that repeat an id are each scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.llm.common import crc_of_id, encoded, per_batch, table, tidy

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 6 << 20
LONG = 8
#: Parts that the labelled rows are dealt to before they are ranked.
DEALS = 64
DICT_BYTES = 64 << 10
WINDOW = 2048
LEVEL = 3


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, size: int) -> DataFrame:
    """``(doc_id, label, text)`` of at most so many rows and bytes a class, by
    hash of the id; texts over ``1 / LONG`` of the bytes come after all others,
    the shortest first, so that none of them ends the sample before it is full. Of
    rows that repeat an id the one of the shortest place and first text counts."""
    known = labels.where(f"doc_id is not null and {label} in (0, 1)").groupBy("doc_id").agg(F.min(label).alias("label"))
    length, order = F.octet_length("text"), F.xxhash64("doc_id")
    held = docs.where("text is not null").select("doc_id", "text", F.when(length > size // LONG, length).otherwise(0).alias("late"))
    ids = held.select("doc_id", "late").join(known, "doc_id").groupBy("doc_id", "label").agg(F.min("late").alias("late"))
    bucket = F.when(F.col("late") == 0, F.shiftright(order, 52)).otherwise(2048 + F.floor(F.log2("late") * 64)).cast("int")  # grows with the order
    ids = ids.withColumn("bucket", bucket)
    before = F.sum("n").over(Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = ids.groupBy("label", "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))
    first = counts.where(F.col("before") < rows).select("label", "bucket")  # some thousand buckets a label, whatever the corpus holds
    best = ids.join(F.broadcast(first), ["label", "bucket"]).withColumn("deal", F.pmod(order, F.lit(DEALS)))
    for key in (["label", "deal"], ["label"]):  # and where a bucket is large, only the best of each deal are ranked together
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("late", order, "doc_id"))
        best = best.withColumn("rank", rank).where(F.col("rank") <= rows).drop("rank")
    chosen = best.select("doc_id", "label")
    texts = held.join(F.broadcast(chosen), "doc_id")  # at most 2 * rows ids
    texts = texts.groupBy("doc_id", "label").agg(F.min_by(F.struct("late", "text"), F.struct("late", "text")).alias("t")).select("doc_id", "label", "t.*")
    sums = F.sum(length).over(Window.partitionBy("label").orderBy("late", order, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return texts.withColumn("bytes", sums).where(F.col("bytes") <= size).select("doc_id", "label", "text")


def windows(text: bytes, size: int = WINDOW) -> Iterator[bytes]:
    for start in range(0, len(text), size):
        yield text[start : start + size]


class Difference:
    """The normalised difference of compressed sizes under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.by = [zstandard.ZstdCompressor(level=LEVEL, dict_data=self.known(d), write_content_size=False, write_dict_id=False) for d in (good, bad)]

    @staticmethod
    def known(data: bytes) -> zstandard.ZstdCompressionDict:
        out = zstandard.ZstdCompressionDict(data)
        out.precompute_compress(level=LEVEL)
        return out

    def __call__(self, text: bytes) -> float:
        good, bad = (sum(len(c.compress(w)) for w in windows(text)) for c in self.by)
        return (bad - good) / max(len(text), 64)


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or raw content where there is too little text."""
    pieces = [w for t in texts for w in windows(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICT_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method; x has a column of ones."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[int, int, bytes]]) -> dict:
    """Dictionaries from one half of the sample, the curve from the other."""
    half = {side: [r for i, r in enumerate(sorted(sample)) if i % 2 == side] for side in (0, 1)}
    if any(len({r[1] for r in rows}) < 2 for rows in half.values()):
        return {"good": b"", "bad": b"", "scale": 1.0, "weights": [0.0, 0.0]}
    good, bad = (dictionary([t for _, y, t in half[0] if y == label]) for label in (1, 0))
    feature = Difference(good, bad)
    x = np.array([feature(t) for _, _, t in half[1]])
    scale = float(np.abs(x).mean()) or 1.0
    weights = logistic(np.stack([np.ones(len(x)), x / scale], 1), np.array([y for _, y, _ in half[1]], float))
    return {"good": good, "bad": bad, "scale": scale, "weights": weights.tolist()}


def quality_scores(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, score)``: the probability that a text is good."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature = Difference(model["good"], model["bad"])
        for batch in batches:
            x = np.array([feature(t) for t in encoded(batch.column(1))])
            z = model["weights"][0] + model["weights"][1] * x / model["scale"]
            yield pa.record_batch({"doc_id": batch.column(0), "score": pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(score), "doc_id long, score double")


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> dict:
    sample = labelled_sample(docs, labels, label, rows, size).collect()
    return fit([(r.doc_id, r.label, r.text.encode()) for r in sample])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = crc_of_id() % 3 == 1
    model = fit_quality(docs, labels.where(~held))
    scores = quality_scores(docs, model)
    return scores.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
