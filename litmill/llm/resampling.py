"""Importance resampling towards a target distribution, on hashed word n-grams.

Each text is normalised once: words in lower case with one space between. One
scan stores the running CRC of the text at every word's end; the CRC of any run
of words follows from two of those: the earlier one, shifted by the run's bytes
over GF(2), cancels out of the later one. Shifts are done for all runs of a
block at once, a table lookup for each binary digit of their lengths, so no
n-gram is ever built as a string.

N-grams count into buckets, over all documents and over the whole target. The
gain of a bucket is the logarithm of how much likelier it is in the target, a
document's weight is the mean gain of its n-grams, and a Gumbel number from a
hash of its id makes drawing without replacement a choice of the highest scores.

Scale: two scans of the texts, for counts and for weights. A task counts into one
array and sends at most a row for each bucket, so the tables that are joined and
broadcast have ``BUCKETS`` rows, whatever the corpus holds. Ranks are counted
over sorted, written ranges of ids and scores; texts never move.

Defined cases: a null text has no words; a document without features weighs 0;
texts with fewer than ``MIN_WORDS`` words are counted and weighed but not drawn;
a null id is hashed as an empty string and comes first among ties; rows that
repeat an id are each counted, weighed and drawn; an empty target makes all gains
follow the smoothing alone; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import encoded, sliced, table
from litmill.operators.components import numbered
from litmill.sources.scratch import Scratch

BUCKETS = 10_000
LONGEST = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
BYTES_AT_ONCE = 2 << 20
#: Letters in lower case, digits and all bytes over ASCII stay; other bytes part words.
SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@lru_cache
def byte_steps() -> np.ndarray:
    """What one zero byte makes of a CRC, by its lowest byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


def through(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of CRCs, given as its values for each byte of a CRC."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


@lru_cache
def shift_tables() -> np.ndarray:
    """For each ``k`` the map that ``2**k`` zero bytes are: each is the one before it, twice."""
    places = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    tables = [byte_steps()[places & 255] ^ places >> 8]
    for _ in range(31):
        tables.append(through(tables[-1], tables[-1]))
    return np.stack(tables)


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of the same bytes with ``length`` zero bytes after them, less those of the zeros alone."""
    crc, tables = crc.copy(), shift_tables()
    for k in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero(length >> k & 1)
        crc[some] = through(tables[k], crc[some])
    return crc


def prefix_crcs(words: list[bytes]) -> Iterator[int]:
    """The CRC of the normalised text up to the end of each word."""
    crc32 = zlib.crc32
    crc = 0
    for i, word in enumerate(words):
        crc = crc32(word, crc32(b" ", crc) if i else 0)
        yield crc


def ngram_crcs(texts: pa.Array, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For ``n`` from 1 on, the row and the CRC of each run of ``n`` words."""
    ends, sizes, counts = [], [], []
    for text in encoded(texts):
        words = text.translate(SEPARATED).split()
        ends.append(np.fromiter(prefix_crcs(words), np.uint32, len(words)))
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        counts.append(len(words))
    end, size = np.concatenate(ends), np.concatenate(sizes)
    row = np.repeat(np.arange(len(counts)), counts)
    # Before a word stands what was before its space; one more byte is one more step of the CRC.
    inverse = ~end
    start = np.append(np.uint32(0), ~(byte_steps()[(inverse ^ np.uint32(32)) & 255] ^ inverse >> 8)[:-1])[: len(end)]
    start[np.flatnonzero(np.diff(row, prepend=-1))] = 0
    length = size
    for n in range(1, longest + 1):
        if n > 1:  # one word more, and the space before it
            inside = row[n - 1 :] == row[: len(row) - n + 1]
            length = length[:-1] + size[n - 1 :] + 1
        else:
            inside = np.ones(len(row), bool)
        at = np.flatnonzero(inside)
        yield row[at], end[at + n - 1] ^ shifted(start[at], length[at])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``(bucket, n)``: the features of all texts; buckets without one are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in sliced(batch, "text", BYTES_AT_ONCE):
                for _, crc in ngram_crcs(some.column("text"), longest):
                    seen += np.bincount(crc % buckets, minlength=buckets)
        held = np.flatnonzero(seen)
        yield pa.record_batch({"bucket": pa.array(held, pa.int32()), "n": pa.array(seen[held])})

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """For each bucket a thousand times the logarithm of how much likelier a
    feature of the target falls in it than one of the documents, floored."""
    both = bucket_counts(docs, buckets, longest).withColumnRenamed("n", "s").join(bucket_counts(target, buckets, longest).withColumnRenamed("n", "t"), "bucket", "full")
    counts = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left").fillna(0, ["s", "t"])
    d = lambda c: F.col(c).cast("double")
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))  # one row
    ratio = (d("t") + 1) * (d("all_s") + buckets) / ((d("s") + 1) * (d("all_t") + buckets))
    gains = counts.crossJoin(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))
    out = np.zeros(buckets, np.int64)
    for r in gains.collect():  # one row a bucket
        out[r.bucket] = r.gain
    return out


def weighed(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the floored mean gain of each document's features."""
    held, buckets = docs.sparkSession.sparkContext.broadcast(gains), len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in sliced(batch, "text", BYTES_AT_ONCE):
                total, n, words = (np.zeros(some.num_rows, np.int64) for _ in range(3))
                for k, (row, crc) in enumerate(ngram_crcs(some.column("text"), longest)):
                    gain = held.value[crc % buckets]
                    sums = np.append(0, np.cumsum(gain))
                    bounds = np.searchsorted(row, np.arange(some.num_rows + 1))
                    total += sums[bounds[1:]] - sums[bounds[:-1]]
                    n += np.diff(bounds)
                    words = np.diff(bounds) if k == 0 else words
                yield pa.record_batch([some.column("doc_id"), pa.array(words), pa.array(n), pa.array(total // np.maximum(n, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``weights`` with ``score``: the weight and a Gumbel number from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return weights.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every document;
    ``rank`` counts those drawn, from the highest score on."""
    scratch = Scratch(docs.sparkSession, "resampling")
    rows = scratch.save(scored(weighed(docs, bucket_gains(docs, target, buckets, longest), longest), seed), "scores")
    enough = F.col("n_words") >= min_words
    drawn = percent * rows.where(enough).count() // 100
    placed = numbered(rows.where(enough).withColumn("_least", -F.col("score")), ["_least", "doc_id"])
    ranked = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("_least", "place")
    return ranked.unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = r"""
WITH steps AS (  -- the table of CRC-32, a step for each bit
  SELECT list(list_reduce(list_prepend(CAST(i AS UBIGINT), [CAST(0 AS UBIGINT) FOR k IN range(8)]),
         lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) t(i)
), words AS (
  SELECT 's' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 't', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
  SELECT side, id, feature, count(*) AS n
  FROM (SELECT side, id, unnest(w) AS feature FROM words
        UNION ALL SELECT side, id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words)
  GROUP BY ALL
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST('0x' || substr(hex(encode(feature)), CAST(2 * k + 1 AS INT), 2) AS UBIGINT) FOR k IN range(octet_length(encode(feature)))]),
         lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INT) + 1])), CAST(4294967295 AS UBIGINT)) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM features), steps
), counts AS (
  SELECT bucket, sum(n) FILTER (WHERE side = 's') AS s, sum(n) FILTER (WHERE side = 't') AS t
  FROM features JOIN hashed USING (feature) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM counts) + 10000)::DOUBLE
         / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts
), weights AS (
  SELECT id, sum(n) AS n, CAST(floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE) AS BIGINT) AS weight
  FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 's' GROUP BY id
), scores AS (
  SELECT w.id AS doc_id, len(w.w) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_features, coalesce(g.weight, 0) AS weight,
         coalesce(g.weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || CAST(w.id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words w LEFT JOIN weights g ON g.id = w.id WHERE w.side = 's'
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r.place <= (25 * r.n) // 100 THEN r.place END AS rank
FROM scores s LEFT JOIN ranked r ON r.doc_id = s.doc_id
"""
