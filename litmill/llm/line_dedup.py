"""Drop lines that several documents share.

Normalised lines are exploded to ``(document, hash)`` rows, the documents of a
hash are counted, lines over the threshold are dropped everywhere but in the
smallest document that holds them, and the others are joined again by position.

Scale: what is shuffled for the count is 16 bytes of hash and an id for each
distinct line of a document, and a hash is summed up on the map side as the
smallest and largest id with a distinct count only above two, so a line that a
third of all documents hold costs one row a task. Texts move once, by their
document's id.

Defined cases: a null or empty text is one empty line; empty lines and lines
with keys of fewer than ``min_chars`` code points always stay; a document with
null id is kept whole and never counted; rows that repeat an id are one
document for the count and each keeps its own row; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import LOWER, SPACE, encoded, per_batch, table
from litmill.sources.scratch import Scratch

MIN_CHARS = 10
MIN_DOCS = 2
#: Names beside those of the documents' own columns.
ID, GONE = "__line_doc", "__line_gone"


def line_keys(text: bytes, min_chars: int) -> Iterator[bytes | None]:
    """128-bit hash of each line's key; None where the line always stays."""
    for line in text.translate(LOWER).split(b"\n"):
        key = line.strip(SPACE)
        long = len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode()) >= min_chars
        yield xxhash.xxh3_128_digest(key) if long else None


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(doc_id, drop)``: hashes of the lines that each document loses."""

    def explode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys = [], []
        for doc, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1))):
            found = set(line_keys(text, min_chars)) - {None}
            ids += [doc] * len(found)
            keys += found
        yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "line": pa.array(keys, pa.binary())})

    lines = docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(per_batch(explode), "doc_id long, line binary")
    if min_docs <= 2:  # two different ids are all there is to know
        held = lines.groupBy("line").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("other")).where("keeper < other")
    else:
        held = lines.distinct().groupBy("line").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    # As a written table the shared lines are a side of their own: Spark can split the rows of a very common line.
    held = Scratch(docs.sparkSession, "lines").save(held.select("line", "keeper"), "shared")
    lost = lines.join(held, "line").where("doc_id > keeper")
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("drop"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` replaced and ``n_lines``, ``n_dropped`` added."""
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    drops = shared_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias(ID), F.col("drop").alias(GONE))
    both = docs.select(*rest, "text").join(drops, F.col("doc_id") == F.col(ID), "left").select(*rest, "text", GONE)

    def reassemble(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, lines, dropped = [], [], []
        for text, drop in zip(encoded(batch.column("text")), batch.column(GONE).to_pylist()):
            n = text.count(b"\n") + 1
            lines.append(n)
            if drop:
                gone = set(drop)
                kept = [line for line, key in zip(text.split(b"\n"), line_keys(text, min_chars)) if key not in gone]
                n -= len(kept)
                text = b"\n".join(kept)
            else:
                n = 0
            dropped.append(n)
            texts.append(text)
        columns = {c: batch.column(c) for c in rest}
        columns |= {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
        yield pa.record_batch(columns)

    schema = both.drop(GONE).withColumns({"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}).schema
    return both.mapInArrow(per_batch(reassemble), schema)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), held AS (
  SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.pos, l.line, (h.key IS NOT NULL AND l.doc_id <> h.keeper) AS dropped
  FROM lines l LEFT JOIN held h ON l.key = h.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
