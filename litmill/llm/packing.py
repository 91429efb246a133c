"""Pack tokenised documents in sequences of a fixed length by best fit.

Documents longer than a sequence are cut; what is left of them and all others
are items to be placed. Items of over half a sequence open one each; as many
more are opened as the total of the tokens asks for in any case. Then, round by
round, items and gaps are range-sorted together from large to small and swept:
an item takes the smallest gap before it that is free, its successor in size,
and a gap takes one item, the larger first. A sweep is a match of brackets, so
each range partition sweeps its own rows, and only how many items and gaps a
partition has left decides, by rank, which items of one meet which gaps of
another. Gaps shrink by what they took and the next round follows. A gap that
holds any remaining item several times over takes part as that many equal
slots, which keeps the rounds few when texts are short.

Scale: a row of state is an id and a size; texts and tokens never move. Sorting
is by size and id, so a length that a third of all documents have is split
between partitions. The driver sees two counts for each range partition.

Defined cases: a null or empty text is the end token alone; strings of control
tokens inside a text are ordinary text; rows that repeat a doc_id are packed
each; a null doc_id is packed as any other; extra columns are left out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.llm.common import TABLES, give_back, table, tidy
from litmill.sources.scratch import Scratch

LENGTH = 4096
END_ID = 1
CACHE = 600_000
#: Texts are encoded together up to so many bytes; a longer one alone.
BYTES_AT_ONCE = 6 << 20
WORDS_AT_ONCE = 1000
GROUPS_AT_ONCE = 8
#: Letters before this one are one code point in every form that the tokenizer makes of them.
LAST_PLAIN = "\u0130"
#: Plain letters before the last sign.
SIGNED = "[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f][.,]$"
#: Rows that make a range worth a task, and the most that one sweeps.
ROWS_PER_TASK = 4000
MOST_ROWS = 1_000_000
MAX_SLOTS = 64
BATCH_ROWS = 10_000


class Words:
    """Token ids of words, learned as they come and kept for the worker's later
    tasks while they are at most ``CACHE``."""

    kept: dict[str, dict[str, bytes]] = {}

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_str(vocabulary)
        self.encoder.encode_special_tokens = True
        known = self.encoder.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)
        self.ends[[i for token, i in known.items() if token.endswith("</w>")]] = True
        self.codes = Words.kept.setdefault(str(hash(vocabulary)), {})

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text. Texts are cut only at white space that every
        definition of it has."""
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        known = words.flatten().dictionary_encode()
        # A word's codes are bytes, so taking them by index lays out all ids in order.
        every = self.codes_of(known.dictionary).take(known.indices)
        ends = np.frombuffer(every.buffers()[1], np.int64, len(every) + 1, 8 * every.offset) // 4
        data = every.buffers()[2]
        every = np.frombuffer(data, "<u4") if data is not None and data.size else np.empty(0, "<u4")
        cuts = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        for start, end in zip(cuts, cuts[1:]):
            yield every[start:end]

    def codes_of(self, words: pa.Array) -> pa.Array:
        """Codes of words; a letter before a last comma or full stop ends its
        token, so the sign is a word of its own, and ASCII is lower-cased."""
        words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        signed = pc.match_substring_regex(words, SIGNED)
        bodies = pc.if_else(signed, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        signs = pc.if_else(signed, pc.utf8_slice_codeunits(words, -1), "").dictionary_encode()
        return pc.binary_join_element_wise(self.known(bodies), self.known(signs), pa.scalar(b"", pa.large_binary()))

    def known(self, words: pa.DictionaryArray) -> pa.Array:
        distinct = words.dictionary.to_pylist()
        self.learn(set(distinct))
        return pa.array([self.codes[w] for w in distinct], pa.large_binary()).take(words.indices)

    def learn(self, words: set[str]) -> None:
        """Encode the words that are new, many in one string: a token belongs
        to the word in which it starts."""
        new = list(words.difference(self.codes))
        if len(self.codes) + len(new) > CACHE:
            self.codes.clear()
            new = list(words)
        # A word of plain letters is one unit of the vocabulary, which marks the ends of units.
        letters = [w for w in new if w.isalpha() and max(w) < LAST_PLAIN]
        plain = set(letters)
        for words, units in ((letters, True), ([w for w in new if w not in plain], False)):
            encode = self.encoder.encode_batch_fast if units else self.encoder.encode_batch  # the fast one tells no places
            for k in range(0, len(words), WORDS_AT_ONCE * GROUPS_AT_ONCE):  # few at a time: the encoder's own results are large
                some = words[k : k + WORDS_AT_ONCE * GROUPS_AT_ONCE]
                groups = [some[i : i + WORDS_AT_ONCE] for i in range(0, len(some), WORDS_AT_ONCE)]
                for group, code in zip(groups, encode([" ".join(g) for g in groups], add_special_tokens=False)):
                    ids = np.array(code.ids, "<u4")
                    cuts = np.flatnonzero(self.ends[ids]) + 1
                    if not units or len(cuts) != len(group):
                        offsets = code.offsets if not units else self.encoder.encode(" ".join(group), add_special_tokens=False).offsets
                        starts = np.fromiter((o[0] for o in offsets), np.int64)
                        cuts = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in group]))
                    data, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
                    self.codes.update(zip(group, (data[a:b] for a, b in zip(cuts, cuts[1:]))))


TABLES["packing"] = Words.kept.clear


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy())
    starts = np.flatnonzero(np.diff(size // BYTES_AT_ONCE, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def tokenized(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``; ids are little-endian unsigned
    32-bit numbers. ``tokenizer`` is the path of a vocabulary whose tokens
    never cross white space, so that a text is the sum of its words."""
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())  # the file's size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(vocabulary.value)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
            for some in slices(batch):
                for doc, ids in zip(some.column(0).to_pylist(), known.ids(some.column(1))):
                    ids = np.concatenate([ids, end])
                    for piece, first in enumerate(range(0, len(ids), length)):
                        part = ids[first : first + length]
                        for name, value in zip(rows, (doc, piece, first, len(part), part.tobytes())):
                            rows[name].append(value)
            yield pa.record_batch([pa.array(rows["doc_id"], pa.int64()), pa.array(rows["piece"], pa.int32()), pa.array(rows["start"], pa.int64()), pa.array(rows["length"], pa.int64()), pa.array(rows["ids"], pa.binary())], names=list(rows))
            give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(cut, "packing"), "doc_id long, piece int, start long, length long, ids binary")


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Match items with the nearest free gap before them. Rows come from large
    to small, gaps (kind 0) before items (kind 1) of their size. Out: kind 2
    for a match of item ``id`` with gap ``other``; what is left of either kind
    with its rank, gaps ranked from the last, which is taken first."""
    part = TaskContext.get().partitionId()
    gaps: list[tuple[int, int]] = []  # those still free, in order of their size
    items_left = 0

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "kind", "rank", "id", "other", "size"])

    for batch in batches:
        rows: list[tuple] = []
        for size, kind, name in zip(*(batch.column(c).to_pylist() for c in ("size", "kind", "id"))):
            if kind == 0:
                gaps.append((name, size))
            elif gaps:
                rows.append((part, 2, 0, name, gaps.pop()[0], size))
            else:
                rows.append((part, 1, items_left, name, None, size))
                items_left += 1
        yield told(rows)
    for first in range(0, len(gaps), BATCH_ROWS):
        some = reversed(gaps[max(0, len(gaps) - first - BATCH_ROWS) : len(gaps) - first])
        yield told([(part, 0, first + r, g, None, s) for r, (g, s) in enumerate(some)])


SWEPT = "part int, kind int, rank long, id long, other long, size long"


def across(left: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(part, first, gap_part, gap_first, n)`` that match the items that
    partitions have left with gaps that partitions before them have left.
    ``left`` has (items, gaps) by partition."""
    stack: list[list[int]] = []  # partition, next rank, gaps left
    runs = []
    for part in sorted(left):
        items, gaps = left[part]
        first = 0
        while first < items and stack:
            top = stack[-1]
            n = min(items - first, top[2])
            runs.append((part, first, top[0], top[1], n))
            first, top[1], top[2] = first + n, top[1] + n, top[2] - n
            if not top[2]:
                stack.pop()
        if gaps:
            stack.append([part, 0, gaps])
    return runs


def best_fit(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(id, bin)`` for ``(id, size)`` with unique ids of at least 0 and sizes from 1 to ``length``."""
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = F.col("size") * 2 > length
    sums = items.agg(F.sum("size").alias("all"), F.sum(F.when(large, length)).alias("opened"), F.max(F.when(~large, F.col("size"))).alias("m"), F.count(F.when(~large, 1)).alias("n"), F.count("*").alias("rows")).first()
    if not sums["rows"]:
        return items.select("id", F.col("id").alias("bin"))
    placed = [items.where(large).select("id", F.col("id").alias("bin"))]
    rest = items.where(~large).select("id", "size")
    gaps = items.where(large & (F.col("size") < length)).select(F.col("id").alias("bin"), (length - F.col("size")).alias("gap"))
    left, most, total = sums["n"], sums["m"] or 0, sums["all"] - (sums["opened"] or 0)
    n_gaps, made = sums["rows"] - left, 0
    opened = max(0, -(-total // length))
    while left:
        if opened:
            fresh = spark.range(opened).select((-1 - made - F.col("id")).alias("bin"), F.lit(length).cast("long").alias("gap"))
            gaps, made, n_gaps = gaps.unionAll(fresh), made + opened, n_gaps + opened
        # A gap that holds the largest item k times takes part as k slots.
        k = F.least(F.greatest(F.floor(F.col("gap") / most), F.lit(1)), F.lit(MAX_SLOTS))
        slots = gaps.select(F.floor(F.col("gap") / k).alias("size"), F.lit(0).alias("kind"), F.col("bin").alias("id"), F.explode(F.sequence(F.lit(1).cast("long"), k)).alias("slot"))
        both = slots.unionAll(rest.select("size", F.lit(1).alias("kind"), "id", F.lit(0).cast("long")))
        order = [F.desc("size"), F.asc("kind"), F.asc("id"), F.asc("slot")]
        n = max(1, min(parts, (left + n_gaps) // ROWS_PER_TASK), -(-(left + n_gaps) // MOST_ROWS))
        swept = scratch.save(both.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(sweep, SWEPT), "sweep")
        counts: dict[int, list[int]] = {}
        for row in swept.where("kind < 2").groupBy("part", "kind").count().collect():  # two rows a range partition
            counts.setdefault(row["part"], [0, 0])[1 - row["kind"]] = row["count"]
        runs = across({p: tuple(c) for p, c in counts.items()})
        runs = spark.createDataFrame(runs, "part int, first long, gap_part int, gap_first long, n long")
        free = swept.where("kind = 0").select(F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"), F.col("id").alias("bin"))
        over = swept.where("kind = 1").select("part", "rank", "id", "size")
        over = over.join(F.broadcast(runs), (over["part"] == runs["part"]) & (over["rank"] >= runs["first"]) & (over["rank"] < runs["first"] + runs["n"]), "left")
        over = over.select("id", "size", "gap_part", (F.col("gap_first") + F.col("rank") - F.col("first")).alias("gap_rank"))
        done = scratch.save(over.join(free, ["gap_part", "gap_rank"], "left").select("id", "size", "bin"), "across")
        new = swept.where("kind = 2").select("id", "size", F.col("other").alias("bin")).unionAll(done.where("bin is not null"))
        placed.append(new.select("id", "bin"))
        used = new.groupBy("bin").agg(F.sum("size").alias("used"))
        after = scratch.save(gaps.join(used, "bin", "left").select("bin", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")).where("gap > 0"), "gaps")
        rest = done.where("bin is null").select("id", "size")
        now = rest.agg(F.count("*").alias("n"), F.max("size").alias("m"), F.sum("size").alias("all")).first()
        # Without progress no gap holds what is left: open what its tokens ask for.
        opened = -(-now["all"] // length) if now["n"] == left else 0
        left, most, gaps = now["n"], now["m"], after.where(F.col("gap") > 0)
        n_gaps = after.count()
    out = placed[0]
    for more in placed[1:]:
        out = out.unionAll(more)
    return out


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces``, which have a unique ``id`` and a ``length``, with
    ``sequence_id`` and ``offset``."""
    bins = best_fit(pieces.select("id", F.col("length").alias("size")), length)
    both = pieces.join(bins.withColumnRenamed("bin", "sequence_id"), "id")
    before = Window.partitionBy("sequence_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the tokens of each sequence in order, from packed
    pieces that kept theirs."""
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return whole.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    pieces = tokenized(docs, tokenizer, length).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    pieces = Scratch(docs.sparkSession, "packing").save(pieces.withColumn("id", F.monotonically_increasing_id()), "pieces")
    return pack(pieces, length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
