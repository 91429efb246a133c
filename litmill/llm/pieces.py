"""SentencePiece ids and texts by a table of distinct chunks.

A chunk is a run of white-space markers with the signs up to the next run. The
vocabulary is read to see that no piece goes from other signs on to a marker;
then no merge crosses the border of a chunk, a text's ids are the ids of its
chunks in order, and each distinct chunk is segmented once: texts of a block are
cut by one scan for markers, an Arrow dictionary finds the distinct chunks,
those not in the task's table yet are given to the library, and a take by
position lays out all ids. For a vocabulary with other pieces a whole text is
the chunk. Decoding looks pieces up in the vocabulary's own table, by id; only
texts with unknown ids or broken byte runs go to the library one by one.

Scale: one scan without a shuffle. The table of distinct chunks is a task's own
and is emptied at ``CACHE_BYTES``, so memory is bounded whatever the corpus
holds; a table for the whole corpus would have to be joined to every single
word of it, which moves more than the texts themselves.

Defined cases: a null or empty text has the begin and the end id alone; a
literal marker is what white space becomes; strings of control pieces are
ordinary text; rows that repeat an id are each encoded; a null id stays; other
columns pass through, but for those that an operator writes. Ids beyond the
vocabulary are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import TABLES, flat, per_batch, sliced, table, unflat

MARKER = "▁"
BYTES_AT_ONCE = 4 << 20
CACHE_BYTES = 96 << 20
#: What an entry of the table takes beside its own bytes.
ENTRY = 150
#: Chunks that the library segments in one call.
CHUNKS_AT_ONCE = 4096
MADE = {"ids": "binary", "n_tokens": "long"}


class Vocabulary:
    """A model with what is known of its pieces; made once in a worker."""

    kept: dict[bytes, Vocabulary] = {}

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_proto=model)
        every = range(sp.vocab_size())
        pieces = [sp.id_to_piece(i) for i in every]
        control = np.array([sp.is_control(i) for i in every])
        byte = np.array([sp.is_byte(i) for i in every])
        plain = [i for i in every if not (control[i] or byte[i] or sp.is_unknown(i))]
        # White space must become one marker each, and one must come first.
        marked = all(sp.normalize(t) == MARKER + t.replace(" ", MARKER) for t in ("a", " a  b ", f"{MARKER}a \tÅﬁ"))
        self.splits = marked and not any(MARKER in pieces[i].lstrip(MARKER) for i in plain)
        self.table: dict[bytes, bytes] = {}
        self.held = 0
        # Texts of pieces, then the same without the marker that a text begins with.
        text = [b"" if control[i] else bytes([int(p[3:-1], 16)]) if byte[i] else p.replace(MARKER, " ").encode() for i, p in enumerate(pieces)]
        leads = set(i for i in plain if pieces[i].startswith(MARKER))
        self.texts = pa.array(text + [t[1:] if i in leads else t for i, t in enumerate(text)], pa.large_binary())
        self.control, self.byte = control, byte
        self.unknown = np.array([sp.is_unknown(i) for i in every])

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        if model not in cls.kept:
            cls.kept.clear()
            cls.kept[model] = cls(model)
        return cls.kept[model]

    def encoded(self, texts: pa.Array, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and where each text's begin and end."""
        data, bounds = flat(self.marked(texts))
        starts = self.chunks(data, bounds)
        known = unflat(data, np.append(starts, len(data)), pa.binary()).dictionary_encode()
        ids, ends = flat(self.ids_of(known.dictionary).take(known.indices))
        ids, cuts = ids.view("<u4"), ends[np.searchsorted(starts, bounds)] // 4
        rows = np.arange(len(texts))
        out_bounds = cuts + 2 * np.arange(len(cuts))
        out = np.empty(out_bounds[-1], "<u4")
        out[np.arange(len(ids)) + np.repeat(2 * rows + 1, np.diff(cuts))] = ids
        out[out_bounds[:-1]], out[out_bounds[1:] - 1] = begin, end
        return out, out_bounds

    def marked(self, texts: pa.Array) -> pa.Array:
        """Texts with a blank for each marker, the first one included."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        if not self.splits:
            return texts
        texts = pc.replace_substring(texts, MARKER.encode(), b" ")
        first = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary()))
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, first)

    def chunks(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where chunks begin; together they are all of ``data``."""
        if not self.splits:
            return bounds[:-1][np.diff(bounds) > 0]
        blank = data == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        return np.flatnonzero(begins)

    def ids_of(self, chunks: pa.Array) -> pa.Array:
        chunks = chunks.to_pylist()
        new = [c for c in chunks if c not in self.table]
        if self.held > CACHE_BYTES:
            self.table, self.held, new = {}, 0, chunks
        for k in range(0, len(new), CHUNKS_AT_ONCE):
            some = new[k : k + CHUNKS_AT_ONCE]
            # The library puts a marker first; alone it does so only for a text that is not empty.
            codes = self.library.encode([c[1:] for c in some] if self.splits else some, num_threads=1)
            for chunk, code in zip(some, codes):
                self.table[chunk] = np.array(code or self.library.piece_to_id([MARKER]), "<u4").tobytes()
                self.held += len(chunk) + 4 * len(code) + ENTRY
        return pa.array([self.table[c] for c in chunks], pa.large_binary())

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts of rows of ids, end to end, and their bounds."""
        if len(ids) and ids.max() >= len(self.control):
            raise ValueError("an id is beyond the vocabulary")
        seen = np.append(np.flatnonzero(~self.control[ids]), len(ids))
        first = seen[np.searchsorted(seen, bounds[:-1])]
        first = first[first < bounds[1:]]
        takes = ids.astype(np.int64)
        takes[first] += len(self.control)
        data, ends = flat(self.texts.take(pa.array(takes)))
        text_bounds = ends[bounds]
        odd = np.flatnonzero(self.byte[ids] | self.unknown[ids])
        broken = {}
        for row in np.unique(np.searchsorted(bounds, odd, "right") - 1):
            own = ids[bounds[row] : bounds[row + 1]]
            try:
                data[text_bounds[row] : text_bounds[row + 1]].tobytes().decode()
                bad = self.unknown[own].any() or self.control[own[1:-1]].any()  # a control id ends a run of bytes
            except UnicodeDecodeError:
                bad = True
            if bad:
                broken[row] = self.library.decode(own.tolist()).encode()
        if broken:
            parts = [broken.get(r, data[a:b].tobytes()) for r, (a, b) in enumerate(zip(text_bounds, text_bounds[1:]))]
            data, text_bounds = flat(pa.array(parts, pa.large_binary()))
        return data, text_bounds


TABLES["pieces"] = Vocabulary.kept.clear


def model_of(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())  # the file's size


def encode(docs: DataFrame, model: str, begin: int = 1, end: int = 2) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (little-endian unsigned 32-bit
    numbers) and ``n_tokens``. ``model`` is the path of a model file."""
    rest = [c for c in docs.columns if c not in (*MADE, "text")]
    held = model_of(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = Vocabulary.of(held.value)
        for some in sliced(batch, "text", BYTES_AT_ONCE):
            ids, bounds = known.encoded(some.column("text"), begin, end)
            made = {"ids": unflat(ids.view(np.uint8), 4 * bounds, pa.binary()), "n_tokens": pa.array(np.diff(bounds), pa.int64())}
            yield pa.record_batch({c: some.column(c) for c in rest} | made)

    schema = docs.select(*rest, *(F.lit(None).cast(t).alias(c) for c, t in MADE.items())).schema
    return docs.select(*rest, "text").mapInArrow(per_batch(run, "pieces"), schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``; null ids are none."""
    rest = [c for c in rows.columns if c != "decoded"]
    held = model_of(rows.sparkSession, model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = Vocabulary.of(held.value)
        for some in sliced(batch, "ids", BYTES_AT_ONCE):
            data, bounds = flat(some.column("ids"))
            text = known.decoded(np.frombuffer(data.tobytes(), "<u4"), bounds // 4)
            yield pa.record_batch({c: some.column(c) for c in rest} | {"decoded": unflat(*text, pa.string())})

    return rows.select(*rest).mapInArrow(per_batch(run, "pieces"), rows.select(*rest, F.lit("").alias("decoded")).schema)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    out = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
