"""Join documents whose sets of word shingles have a Jaccard similarity of at
least 0.8, by vertical partitions of the shingles.

The order of shingle hashes is cut in fragments, ranges of that order, and a
fragment sees only its part of every set.

1. Each fragment tells for each document how many of its shingles there occur
   in any other document; the counts are summed per document. Four fifths of
   the larger set must be shared, so a document with fewer repeated shingles
   links with nothing and goes no further. A shingle that repeats within one
   block of a map task is counted there and sent once, so what is common costs
   no more than what is rare.
2. Documents of equal sets become one class, known by a hash of the set.
3. Fragments count for the remaining classes how often each shingle occurs. By
   the order of that count, then hash, a set has a prefix so long that two sets
   that link share a shingle of their prefixes; classes with a common one are
   candidates, bounded by their sizes, the shingle's place in either order and
   parity sketches of the sets.
4. Candidates of a shingle are never paired off with each other. A hub meets
   the others, those it links with merge, and further hubs, many times as many
   each round, come from the classes outside the largest merged group; a class
   that was a hub is done with. So a group of near copies costs a few rows a
   member, and still every pair that isn't connected yet is looked at.
5. Overlaps of pairs are counted fragment by fragment and summed per pair.

Scale: the first pass shuffles 4 to 8 bytes a shingle. Fragments are as many as
the shuffle has partitions and more where one would hold over ``FRAGMENT_BYTES``
of text, so that the largest does not grow with the corpus. No stage gathers a
group: buckets, hubs and links are joins and aggregates on keys; the rows of a
shingle with over ``HOT_ROWS`` are dealt by a salt, and what they meet is
repeated for each.

Defined cases: words are runs without ASCII white space, A-Z lower-cased; null
and empty texts have no shingles and link with nothing; documents of fewer than
five words have one shingle, their words; rows that repeat a doc_id stay rows
and are compared by text; a null doc_id is labelled if its text links with a
document that has one. Blocks know documents by their place, so an input that a
task run again might read in another order (one behind a shuffle) is written
first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.llm.common import encoded, per_batch, table, tidy, tidy_group
from litmill.llm.shingles import mix, shingle_set
from litmill.operators.components import components
from litmill.sources.scratch import Scratch

PERCENT = 80
BLOCK_SHINGLES = 1 << 20
FRAGMENT_SHINGLES = 2_000_000
FRAGMENT_BYTES = 96 << 20
HOT_ROWS = 2000
LEAST_FRAGMENTS = 8
MORE_HUBS = 16
SKETCH = 16
SKETCHES = [f"s{i}" for i in range(SKETCH)]
#: Names beside those of the documents' own columns.
ID, KEY, OWN = "__near_id", "__near_key", "__near_own"


def set_key(found: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    with np.errstate(over="ignore"):
        return tuple(np.array([mix(found).sum(), mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).view(np.int64).tolist())


def raw(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


# 1. Repeated shingles -------------------------------------------------------

PART = "part long, block long, docs binary, dense boolean, owners binary, single binary, again binary"


def fragment_of(shingles: np.ndarray, fragments: int) -> np.ndarray:
    """The range of the order of hashes that a shingle lies in."""
    return (shingles >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)


def packed(owners: np.ndarray, n: int) -> tuple[bool, bytes]:
    """Sorted owners out of ``n``, as counts of all of them where that is shorter."""
    dense = len(owners) >= n
    return dense, raw((np.bincount(owners, minlength=n) if dense else owners).astype(np.uint32))


def unpacked(dense: bool, data: bytes) -> np.ndarray:
    found = np.frombuffer(data, np.uint32)
    return np.repeat(np.arange(len(found)), found) if dense else found


def split_sets(fragments: int):
    """Blocks of sets, cut by fragment: shingles that occur once in the block
    with counts by document, and once each those that occur again."""

    def block(number: int, ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
        doc = np.repeat(np.arange(len(sets)), sizes)
        values, back, times = np.unique(every, return_inverse=True, return_counts=True)
        alone = times[back] == 1
        known = np.bincount(doc[~alone], minlength=len(sets))
        keys = np.array([set_key(s) for s in sets], np.int64).reshape(-1, 2)
        null = np.array([i is None for i in ids], np.int64)
        about = np.stack([np.array([i or 0 for i in ids], np.int64), null, sizes, keys[:, 0], keys[:, 1], known], 1)
        part = fragment_of(every[alone], fragments)
        order = np.lexsort((doc[alone], part))
        part, value, owner = part[order], every[alone][order].astype(np.uint32), doc[alone][order]
        twice = values[times > 1]
        twice_part = fragment_of(twice, fragments)
        cuts = np.searchsorted(part, np.arange(fragments + 1, dtype=np.uint64))
        twice_cuts = np.searchsorted(twice_part, np.arange(fragments + 1, dtype=np.uint64))  # hashes in order are fragments in order
        rows = [(number % fragments, number, raw(about), True, b"", b"", b"")]
        for p in range(fragments):
            lo, hi = cuts[p], cuts[p + 1]
            again = twice[twice_cuts[p] : twice_cuts[p + 1]].astype(np.uint32)
            if hi > lo or len(again):
                rows.append((p, number, None, *packed(owner[lo:hi], len(sets)), raw(value[lo:hi]), raw(again)))
        names = [x.split()[0] for x in PART.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), *[pa.binary()] * 3]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, sets, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), encoded(batch.column(1))):
                ids.append(doc)
                sets.append(shingle_set(text))
                size += len(sets[-1])
                if size >= BLOCK_SHINGLES:
                    yield block(number, ids, sets)
                    number, ids, sets, size = number + 1, [], [], 0
        if ids:
            yield block(number, ids, sets)

    return run


def count_repeats(group: pa.Table) -> pa.Table:
    """For each block of a fragment how many shingles of each document repeat."""
    rows = group.to_pylist()
    parts = [r for r in rows if r["docs"] is None]
    single = [np.frombuffer(r["single"], np.uint32) for r in parts]
    again = np.unique(np.concatenate([np.frombuffer(r["again"], np.uint32) for r in parts] or [np.empty(0, np.uint32)]))
    values, times = np.unique(np.concatenate(single or [again]), return_counts=True)
    repeated = np.union1d(values[times > 1], again)
    out = [(r["block"], r["docs"], True, None) for r in rows if r["docs"] is not None]
    for r, own in zip(parts, single):
        at = np.minimum(np.searchsorted(repeated, own), max(0, len(repeated) - 1))
        hit = repeated[at] == own if len(repeated) else np.zeros(len(own), bool)
        n = len(r["owners"]) // 4 if r["dense"] else len(own) + 1
        out.append((r["block"], None, *packed(unpacked(r["dense"], r["owners"])[hit], n)))
    kinds = (pa.int64(), pa.binary(), pa.bool_(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["block", "docs", "dense", "repeats"])


def sum_repeats(group: pa.Table) -> pa.Table:
    """A row for each document of a block with its repeated shingles summed."""
    rows = group.to_pylist()
    about = np.frombuffer(next(r["docs"] for r in rows if r["docs"] is not None), np.int64).reshape(-1, 6)
    total = about[:, 5].copy()
    for r in rows:
        if r["repeats"] is not None:
            total += np.bincount(unpacked(r["dense"], r["repeats"]), minlength=len(total))
    names = ("doc_id", "n", "key", "key2", "repeated")
    columns = (pa.array(about[:, 0], pa.int64(), mask=about[:, 1] == 1), *map(pa.array, (about[:, 2], about[:, 3], about[:, 4], total)))
    return pa.table(list(columns), names=list(names))


def profiles(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, key, key2, repeated)``, a row for each row of ``docs``."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    fragments = max(LEAST_FRAGMENTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FRAGMENT_BYTES))
    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(split_sets(fragments)), PART)
    counts = parts.groupBy("part").applyInArrow(tidy_group(count_repeats), "block long, docs binary, dense boolean, repeats binary")
    return counts.groupBy("block").applyInArrow(sum_repeats, "doc_id long, n long, key long, key2 long, repeated long")


# 3. Segments and prefixes ---------------------------------------------------

SEGMENT = "part long, node long, n long, shingles array<long>, times array<int>"


def segments(texts: DataFrame, fragments: int) -> DataFrame:
    """``(part, node, n, shingles, times)``: the shingles of a class in a
    fragment that occur in other classes too, and in how many."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, n, key, key2 in zip(encoded(batch.column("text")), *(batch.column(c).to_pylist() for c in ("n", "key", "key2"))):
                found = shingle_set(text)
                if (len(found), *set_key(found)) != (n, key, key2):
                    continue  # another text with the same id
                part = fragment_of(found, fragments)
                first = np.flatnonzero(np.diff(part, prepend=np.uint64(fragments)))
                rows += [(int(part[a]), key, n, raw(found[a:b])) for a, b in zip(first, [*first[1:], len(found)])]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.binary()))], names=["part", "node", "n", "found"])

    def count(group: pa.Table) -> pa.Table:
        found = [np.frombuffer(x, np.uint64) for x in group.column("found").to_pylist()]
        values, back, times = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        times = times[back]
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        kept = times > 1
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=len(found)))]), pa.int32())
        lists = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (np.concatenate(found)[kept].view(np.int64), np.minimum(times[kept], 1 << 30).astype(np.int32)))
        return pa.table([*(group.column(c).combine_chunks() for c in ("part", "node", "n")), *lists], names=["part", "node", "n", "shingles", "times"])

    return texts.mapInArrow(tidy(cut), "part long, node long, n long, found binary").groupBy("part").applyInArrow(tidy_group(count), SEGMENT)


def outlines(parts: DataFrame) -> DataFrame:
    """``(node, n, alone, prefix, s0 ...)``: how many shingles of a class are in
    no other; of the others the rare ones that it must share with a class it
    links with, in order; and a parity sketch, in which every bit tells whether
    an odd number of them falls there."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sketches = [], []
            for node, n, shingles, times in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "shingles", "times"))):
                shingles, times = np.concatenate([np.array(x, np.int64) for x in shingles]), np.concatenate([np.array(x, np.int64) for x in times])
                alone = n - len(shingles)
                length = max(0, n - -(-PERCENT * n // 100) + 1 - alone)
                rows.append((node, n, alone, shingles[np.lexsort((shingles, times))[:length]]))
                bits = np.bincount((mix(shingles.view(np.uint64)) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) % 2
                sketches.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
            sketch = np.array(sketches, np.int64).reshape(-1, SKETCH)
            columns = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.list_(pa.int64())), *map(pa.array, np.ascontiguousarray(sketch.T))], names=["node", "n", "alone", "prefix", *SKETCHES])

    whole = parts.groupBy("node", "n").agg(F.collect_list("shingles").alias("shingles"), F.collect_list("times").alias("times"))
    return whole.mapInArrow(tidy(choose), "node long, n long, alone long, prefix array<long>, " + ", ".join(f"{s} long" for s in SKETCHES))


# 4. and 5. Hubs and links ---------------------------------------------------


def overlapping(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that link: partial overlaps summed over fragments."""
    one = parts.select("part", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("of_a"))
    two = parts.select("part", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("of_b"))
    partial = pairs.join(one, "a").join(two, ["b", "part"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("of_a", "of_b")).alias("both"))
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    return whole.where(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * PERCENT).select("a", "b")


def may_link(n_a, n_b, place_a, place_b):
    """Whether sizes and places of a first common shingle leave enough overlap."""
    least = F.ceil((n_a + n_b) * PERCENT / (100 + PERCENT) - 1e-6)
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT) & (F.least(n_a - place_a, n_b - place_b) >= least)


def near_enough():
    """Whether the sketches of a class and a hub leave room for a link: bits
    that differ and shingles of their own are in one of the two sets only."""
    differ = F.col("alone") + F.col("hub_alone")
    for s in SKETCHES:
        differ = differ + F.bit_count(F.col(s).bitwiseXOR(F.col(f"hub_{s}")))
    total = F.col("n") + F.col("hub_n")
    return differ <= total - 2 * F.ceil(total * PERCENT / (100 + PERCENT) - 1e-6)


def links(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of classes that link: enough of them to connect all that do."""
    sets = scratch.save(outlines(parts), "sets")
    rows = sets.select("node", "n", "alone", F.posexplode("prefix").alias("place", "shingle"))
    rows = scratch.save(rows.select("shingle", "node", "n", (F.col("alone") + F.col("place")).alias("place"), F.col("node").alias("group")), "prefixes")
    hot = rows.groupBy("shingle").agg(F.count("*").alias("rows")).where(F.col("rows") > HOT_ROWS)
    hot = scratch.save(hot.select("shingle", F.ceil(F.col("rows") / HOT_ROWS).cast("int").alias("salts")), "hot")
    rows = rows.join(hot, "shingle", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    rows = scratch.save(rows.withColumn("salt", F.pmod(F.xxhash64("node"), "salts").cast("int")), "bucket")
    found, wave, hubs_wanted = None, 0, 1
    while True:
        if wave == 0:  # all are groups of their own: the first is the hub
            hubs = rows.groupBy("shingle", "salts").agg(F.min(F.struct("node", "n", "place", "group")).alias("h"), F.count("*").alias("members")).where("members > 1")
            hubs = hubs.select("shingle", "salts", "h.*")
        else:
            groups = rows.groupBy("shingle", "salts", "group").agg(F.count("*").alias("members"))
            main = groups.groupBy("shingle", "salts").agg(F.max(F.struct("members", (-F.col("group")).alias("minus"))).alias("main"), F.count("*").alias("groups")).where("groups > 1")
            main = for_each_salt(main.select("shingle", "salts", (-F.col("main.minus")).alias("main_group"))).drop("salts")
            outside = rows.join(main, ["shingle", "salt"]).where("group <> main_group")
            rank = F.row_number().over(Window.partitionBy("shingle", "salt").orderBy("node"))
            hubs = outside.withColumn("rank", rank).where(F.col("rank") <= F.ceil(F.lit(hubs_wanted) / F.col("salts"))).select("shingle", "salts", "node", "n", "place", "group")
        hubs = hubs.select("shingle", "salts", *(F.col(c).alias(h) for c, h in (("node", "hub"), ("n", "hub_n"), ("place", "hub_place"), ("group", "hub_group"))))
        hubs = scratch.save(hubs, "hubs")
        if hubs.isEmpty():
            break
        apart = (F.col("group") != F.col("hub_group")) & may_link(F.col("n"), F.col("hub_n"), F.col("place"), F.col("hub_place"))
        meeting = for_each_salt(hubs).drop("salts")
        if wave == 0:
            met = rows.join(meeting, ["shingle", "salt"]).where(apart)
        else:  # fewer rows, more of them for nothing: compare sketches before a pair is made
            own = sets.select("node", "alone", *SKETCHES)
            theirs = sets.select(F.col("node").alias("hub"), F.col("alone").alias("hub_alone"), *(F.col(x).alias(f"hub_{x}") for x in SKETCHES))
            met = rows.join(own, "node").join(meeting.join(theirs, "hub"), ["shingle", "salt"]).where(apart & near_enough())
        pairs = scratch.save(met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
        linked = scratch.save(overlapping(pairs, parts), "links")
        found = linked if found is None else found.unionAll(linked)
        # Hubs leave their buckets; groups merge along the new links.
        merged = joined_groups(rows, linked, scratch)
        left = rows.join(hubs.select("shingle", F.col("hub").alias("node")), ["shingle", "node"], "left_anti")
        left = left.join(merged, "group", "left").select("shingle", "node", "n", "place", F.coalesce("to", "group").alias("group"), "salts", "salt")
        still = left.groupBy("shingle", "salts").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high")
        after = scratch.save(left.join(for_each_salt(still).select("shingle", "salt"), ["shingle", "salt"], "left_semi"), "bucket")
        scratch.drop(rows)
        rows, wave = after, wave + 1
        hubs_wanted = MORE_HUBS**wave
        if rows.isEmpty():
            break
    return found


def for_each_salt(frame: DataFrame) -> DataFrame:
    return frame.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def joined_groups(rows: DataFrame, linked: DataFrame, scratch: Scratch) -> DataFrame:
    """``(group, to)``: groups that a link joins with a smaller one, two steps
    on. As written tables their size is known before the rows of a large group
    are dealt by it: where they are small, those rows stay where they are."""
    of = rows.select("node", "group").distinct()
    ends = linked.join(of.toDF("a", "group_a"), "a").join(of.toDF("b", "group_b"), "b").where("group_a <> group_b")
    step = scratch.save(ends.groupBy(F.greatest("group_a", "group_b").alias("group")).agg(F.min(F.least("group_a", "group_b")).alias("to")), "step")
    return scratch.save(step.join(step.toDF("to", "further"), "to", "left").select("group", F.coalesce("further", "to").alias("to")), "merged")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, a row for each row of ``docs``."""
    return classified(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def classified(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, key, key2, component_id)``: ``near_duplicates`` with the hashes of each row's set."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = scratch.save(docs, "input")
    profile = scratch.save(profiles(docs), "profiles")
    classes = profile.where("n > 0").groupBy("n", "key", "key2").agg(F.min("doc_id").alias("first"), F.max("repeated").alias("repeated"))
    classes = scratch.save(classes, "classes")
    known = classes.where((F.col("repeated") * 100 >= F.col("n") * PERCENT) & F.col("first").isNotNull())
    size = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    fragments = max(LEAST_FRAGMENTS // 2, -(-size // FRAGMENT_SHINGLES))
    texts = docs.join(known.select(F.col("first").alias("doc_id"), "n", "key", "key2"), "doc_id").dropDuplicates(["doc_id", "text", "key"])
    parts = scratch.save(segments(texts, fragments), "segments")
    found = links(parts, scratch)
    labels = None
    if found is not None:
        roots = components(found, scratch).toDF("key", "root")
        reach = roots.join(known.select("key", "first"), "key")
        least = reach.groupBy("root").agg(F.min("first").alias("label"))
        labels = reach.join(least, "root").select("key", "first", "label")
    named = classes if labels is None else classes.join(labels, ["key", "first"], "left")
    named = scratch.save(named.select("n", "key", "key2", (F.col("first") if labels is None else F.coalesce("label", "first")).alias("component")), "named")
    out = profile.join(named, ["n", "key", "key2"], "left")
    return out.select("doc_id", "n", "key", "key2", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that a smaller doc_id represents; rows without a
    doc_id stay. Where rows of one doc_id differ in text, each has its own fate."""
    scratch = Scratch(docs.sparkSession, "each")
    rows = classified(docs).select("doc_id", "key", "key2", F.coalesce(F.col("component_id") != F.col("doc_id"), F.lit(False)).alias("gone"))
    lost = scratch.save(rows.groupBy("doc_id").agg(F.max("gone").alias("gone"), F.min("gone").alias("all")).where("gone"), "lost")
    kept = docs.join(lost.select(F.col("doc_id").alias(ID)), F.col("doc_id").cast("long") == F.col(ID), "left_anti")
    mixed = lost.where("not all").select("doc_id")
    if mixed.isEmpty():
        return kept
    twice = rows.where("gone").join(mixed, "doc_id", "left_semi").select(F.col("doc_id").alias(ID), F.col("key").alias(KEY)).distinct()
    some = docs.join(mixed.select(F.col("doc_id").alias(ID)), F.col("doc_id").cast("long") == F.col(ID), "left_semi")

    def keyed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys = [set_key(shingle_set(text))[0] for text in encoded(batch.column("text"))]
        yield pa.record_batch({**{c: batch.column(c) for c in batch.schema.names}, OWN: pa.array(keys, pa.int64())})

    some = some.mapInArrow(per_batch(keyed), some.withColumn(OWN, F.lit(0).cast("long")).schema)
    some = some.join(twice, (F.col("doc_id").cast("long") == F.col(ID)) & (F.col(OWN) == F.col(KEY)), "left_anti")
    return kept.unionAll(some.select(*docs.columns))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) END AS s
  FROM w
), t AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
f AS MATERIALIZED (SELECT doc_id, n, g FROM t WHERE g IN (SELECT g FROM t GROUP BY g HAVING count(*) > 1)),
o AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i
  FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL
), l AS MATERIALIZED (SELECT a, b FROM o WHERE 100 * i >= 80 * (na + nb - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, x.c AS component_id
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) x USING (doc_id)
"""
