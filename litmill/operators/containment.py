"""Joins on containment: which texts of a key hold which strings.

Keys with few pairs of a string and a text are joined as they are. For all others
an inverted index of character q-grams finds candidates. Each string is looked up
by the one of its grams that the fewest texts of its key hold, and only texts
that hold this gram are compared with it. Grams are hashed with their key, so a
row of the index is two numbers; a string has grams of the largest power of two
up to ``LONGEST`` that fits in it, so short strings find texts as well, and a
string with a gram that no text holds is done at once.

Scale: a key is joined as it is up to ``DIRECT`` pairs, which is at most half the
root of that for each of its rows. Beyond, the index has a row for each distinct gram of a text and size that any
string asks for, and only grams that are asked for are kept. It is written, so
that Spark counts it with partial sums and splits the rows of a frequent gram
between tasks. What is compared is what holds the rarest gram, never all texts
of a key.

Defined cases: null and empty strings are in no text, null texts and keys hold
nothing; texts and strings are compared as they are unless ``fold`` is set, which
finds candidates without regard to case and leaves the test to the caller;
repeated strings and texts are each found, so give distinct ones.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmill.sources.scratch import Scratch

#: Code points of the longest grams.
LONGEST = 8
#: Pairs of a key that are compared without an index.
DIRECT = 4096
ASK, TEXT, KEYED, GRAM = "__ask", "__text", "__keyed", "__gram"


@functools.lru_cache(65_536)
def _fold(sign: str) -> str:
    return (sign.upper() if len(sign.upper()) == 1 else sign).lower()[0]


def folded(text: str) -> str:
    """Signs that a comparison without regard to case takes for equal, made equal, one for one."""
    return text.lower() if text.isascii() else "".join(map(_fold, text))


def gram_size(length: int) -> int:
    return min(LONGEST, 1 << length.bit_length() - 1) if length else 0


def grams(text: str, size: int, key: int) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` code points, with the key mixed in."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    room = len(codes) - size + 1
    if room < 1:
        return np.empty(0, np.int64)
    mixed = np.full(room, size, np.uint64)
    for i in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + room]
    mixed ^= mixed >> np.uint64(32)
    mixed = (mixed ^ np.uint64(key & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mixed ^ mixed >> np.uint64(29)).view(np.int64)


def _gram_rows(rows: DataFrame, name: str, text: str, sizes: Sequence[int] | None, fold: bool) -> DataFrame:
    """``(gram, name)`` of ``rows (name, key hash, text)``; without sizes each string has its own."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for row, key, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                value = folded(value) if fold else value
                for size in sizes or [gram_size(len(value))]:
                    found.append(grams(value, size, key))
                    ids.append(np.full(len(found[-1]), row, np.int64))
                if sum(map(len, found)) > 500_000:
                    yield pa.record_batch([pa.array(np.concatenate(found)), pa.array(np.concatenate(ids))], names=[GRAM, name])
                    found, ids = [], []
            if found:
                yield pa.record_batch([pa.array(np.concatenate(found)), pa.array(np.concatenate(ids))], names=[GRAM, name])

    return rows.select(name, KEYED, text).mapInArrow(explode, f"{GRAM} long, {name} long")


def candidates(asks: DataFrame, texts: DataFrame, key: Sequence[str], asked: str, text: str, fold: bool = False) -> DataFrame:
    """Rows of ``asks`` beside the rows of ``texts`` of the same key that may hold
    all strings of the array ``asked``; all columns of both come back, so their
    names must differ but for the key's."""
    scratch = Scratch(asks.sparkSession, "containment")
    asks = scratch.save(asks.dropna(subset=list(key)).withColumn(asked, F.filter(asked, lambda s: s != "")).where(F.size(asked) > 0), "asks")
    texts = scratch.save(texts.dropna(subset=[*key, text]), "texts")
    count = lambda rows, name: rows.groupBy(*key).agg(F.count("*").alias(name))
    large = scratch.save(count(asks, "__n").join(count(texts, "__m"), list(key)).where(F.col("__n") * F.col("__m") > DIRECT).select(*key), "large")
    if large.isEmpty():
        return asks.join(texts, list(key))
    few = asks.join(large, list(key), "left_anti").join(texts, list(key))
    many = _indexed(scratch, asks.join(large, list(key), "left_semi"), texts.join(large, list(key), "left_semi"), key, asked, text, fold)
    return few.unionByName(many)


def _indexed(scratch: Scratch, asks: DataFrame, texts: DataFrame, key: Sequence[str], asked: str, text: str, fold: bool) -> DataFrame:
    """``candidates`` by the index; ``asks`` and ``texts`` hold nothing null or empty."""
    keyed = F.xxhash64(*key)
    asks = scratch.save(asks.withColumn(ASK, F.monotonically_increasing_id()), "numbered")
    texts = scratch.save(texts.withColumn(TEXT, F.monotonically_increasing_id()), "numbered")
    strings = asks.select(ASK, keyed.alias(KEYED), F.explode(asked).alias("s"))
    longest = F.least(F.length("s"), F.lit(LONGEST))
    sizes = [gram_size(r[0]) for r in strings.select(longest).distinct().collect()]  # at most LONGEST rows
    if not sizes:
        return asks.join(texts, list(key)).where("false").drop(ASK, TEXT)
    wanted = scratch.save(_gram_rows(strings, ASK, "s", None, fold).distinct(), "asked")
    index = _gram_rows(texts.withColumn(KEYED, keyed), TEXT, text, sorted(set(sizes)), fold)
    index = scratch.save(index.join(wanted.select(GRAM).distinct(), GRAM, "left_semi"), "index")
    held = index.groupBy(GRAM).agg(F.count("*").alias("n"))
    looked_up = wanted.join(held, GRAM, "left").groupBy(ASK).agg(F.min_by(GRAM, F.struct("n", GRAM)).alias(GRAM), F.bool_and(F.col("n").isNotNull()).alias("all"))
    looked_up = scratch.save(looked_up.where("all").drop("all"), "rarest")
    found = scratch.save(looked_up.join(index, GRAM).select(ASK, TEXT), "candidates")
    both = found.join(asks.withColumnsRenamed({k: f"__of_{k}" for k in key}), ASK).join(texts, TEXT)
    for k in key:
        both = both.where(F.col(k) == F.col(f"__of_{k}"))
    return both.drop(ASK, TEXT, *(f"__of_{k}" for k in key))


def containment_join(strings: DataFrame, texts: DataFrame, key: Sequence[str], string: str, text: str) -> DataFrame:
    """Rows of ``strings`` beside the rows of ``texts`` of the same key that hold ``string``."""
    return candidates(strings.withColumn("__asked", F.array(string)), texts, key, "__asked", text).where(F.contains(text, F.col(string))).drop("__asked")
