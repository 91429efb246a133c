"""Find documents that hold benchmark items, words replaced here and there.

Texts and items are lower-cased and cut in words of letters and digits. A
spaced seed is a mask that reads some of the words from a position on and
ignores the others, so a hash over it survives replaced words that fall in its
holes; the masks are chosen so that one of them misses every second, third or
fourth word. Hashes of the items are joined with those of the documents. Each
hit puts an item on a diagonal of a document. A document holds an item

* if at least ``MIN_WORDS`` and ``MIN_SHARE`` of the item's words agree all
  along one diagonal, or
* if it holds a stretch of the item: ``MIN_WORDS`` words that agree beside seeds,
  ``STRETCH_SHARE`` of the words from the first to the last of them, on
  diagonals at most ``SHIFT`` apart, so that words may be put in or left out.

Only Spark expressions run. Seeds of a document leave the scan as one array,
are exploded and meet the items' seeds in a hash join within one stage, so rows
that hit nothing are never written. Words beside a hit are taken from the
array in the same row. The items' side is broadcast while its seeds number at
most ``BROADCAST_SEEDS`` (about 32 bytes each); beyond that Spark joins by
shuffle: seeds travel without words, and the hits that remain, each once, meet
the words of their document again.

Where ``SPAN`` words of a text are those at most ``PERIOD`` words before them,
it repeats itself and has no seed there: the first period lies on the diagonals
along which the repetition agrees with an item from its beginning, so one word
written a thousand times costs no more hits than the item has words.

Defined cases: null and empty texts and items hold no words and match nothing;
items shorter than ``MIN_WORDS`` match if all their words agree, those shorter
than every mask by one hash of all their words; rows that repeat a doc_id or
item_id count as one pair with the better match, one along a whole diagonal
before a stretch; null ids are ignored; other columns pass through
``decontaminate`` and are left out of the pairs.

Not found: pieces of which none has six words in a row and no mask fits (words
put in, left out or replaced more often than that).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.llm.common import table

#: Word positions that a seed reads.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 4, 6), (0, 2, 4, 6, 8))
SPAN = 1 + max(max(m) for m in MASKS)
MIN_WORDS = 10
MIN_SHARE = 0.5
STRETCH_SHARE = 2 / 3
SHIFT = 8
PERIOD = 4
BROADCAST_SEEDS = 2_000_000


def words(text: Column) -> Column:
    """Hashes of the words; without words one hash of nothing."""
    cut = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.transform(cut, lambda w: F.xxhash64(w))


def repeats(hashes: Column) -> Column:
    """For each place whether the ``SPAN`` words from there on are those at most
    ``PERIOD`` words before them."""

    def same(h: Column, i: Column, k: int) -> Column:
        return (h == F.get(hashes, i - k)) & F.forall(F.sequence(i + 1, i + (SPAN - 1)), lambda j: F.coalesce(F.get(hashes, j) == F.get(hashes, j - k), F.lit(False)))

    return F.transform(hashes, lambda h, i: F.coalesce(functools.reduce(Column.__or__, (same(h, i, k) for k in range(1, PERIOD + 1))), F.lit(False)))


def seeds(hashes: Column, skipped: Column | None, masks: tuple[tuple[int, ...], ...] = MASKS) -> Column:
    """The seeds of all masks at all positions, mask after mask; null past the
    end and where skipped."""

    def at(number: int, mask: tuple[int, ...]) -> Column:
        def one(h: Column, i: Column) -> Column:
            inside = i + mask[-1] < F.size(hashes)
            return F.when(inside if skipped is None else inside & ~F.get(skipped, i), F.xxhash64(F.lit(number), h, *(F.get(hashes, i + k) for k in mask[1:])))

        return F.transform(hashes, one)

    return F.concat(*(at(i, m) for i, m in enumerate(masks)))


def seeded(texts: DataFrame, name: str, masks: tuple[tuple[int, ...], ...] = MASKS, skip: bool = False) -> DataFrame:
    """``(name, copy, words, at, seed, mask)``, a row for each mask and position
    that has a seed; ``skip`` leaves out those of repetitions."""
    hashed = texts.where(f"{name} is not null").select(name, words(F.col("text")).alias("words"))
    hashed = hashed.select("*", F.xxhash64("words").alias("copy"), *([repeats(F.col("words")).alias("skipped")] if skip else []))
    # The outer form keeps Spark from computing the array once more for a filter on its size.
    rows = hashed.select(name, "copy", "words", seeds(F.col("words"), F.col("skipped") if skip else None, masks).alias("seeds")).select(name, "copy", "words", F.posexplode_outer("seeds").alias("nth", "seed"))
    rows = rows.select(name, "copy", "words", F.pmod("nth", F.size("words")).alias("at"), "seed", F.floor(F.col("nth") / F.size("words")).alias("mask"))
    return rows.where("seed is not null")


def whole_masks(items: DataFrame) -> tuple[tuple[int, ...], ...]:
    """For each length of items that no mask fits, a mask of all their words."""
    length = items.where("item_id is not null").select(F.size(words(F.col("text"))).alias("n"))
    return tuple(tuple(range(r.n)) for r in length.where(F.col("n") <= min(m[-1] for m in MASKS)).distinct().orderBy("n").collect())


def holds_stretch(places: Column, min_words: Column) -> Column:
    """Whether among sorted places some ``min_words`` or more are ``STRETCH_SHARE``
    of those from the first to the last: for each last one the best first one is
    the running least of what lies far enough before it."""
    last = min_words - 1

    def step(state: Column, j: Column) -> Column:
        i = j - last
        least = F.least(state["least"], i - STRETCH_SHARE * F.get(places, i))
        return F.struct(least.alias("least"), (state["found"] | (j + 1 - STRETCH_SHARE * (F.get(places, j) + 1) >= least - 1e-9)).alias("found"))

    start = F.struct(F.lit(float("inf")).alias("least"), F.lit(False).alias("found"))
    return F.when(F.size(places) >= min_words, F.aggregate(F.sequence(last, F.size(places) - 1), start, step, lambda s: s["found"])).otherwise(False)


def leaks(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """``(doc_id, item_id, n_words, n_matched, start)``: items that documents
    hold, their words, how many agree and the word of the text where they begin
    (where only a stretch is held, where the item would begin)."""
    masks = MASKS + whole_masks(items)
    known = seeded(items.select("item_id", "text"), "item_id", masks)
    # A mask of all words is for items of that length alone, and no words are no item.
    known = known.where((F.col("mask") < len(MASKS)) | (F.size("words") == F.get(F.array(*(F.lit(len(m)) for m in masks)), F.col("mask").cast("int"))))
    known = known.where((F.size("words") > 1) | (F.get("words", F.lit(0)) != F.xxhash64(F.lit(""))))
    items_of = known.select("item_id", "copy", F.col("words").alias("item_words")).dropDuplicates(["item_id", "copy"])
    known = known.select("seed", "item_id", "copy", F.col("at").alias("item_at"), F.size("words").alias("n_words"))
    rows = seeded(docs.select("doc_id", "text"), "doc_id", masks, skip=True).withColumnRenamed("copy", "text")
    start = F.col("at") - F.col("item_at")
    # The words of a text beside the item: no more of them go along with a hit.
    beside = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("n_words") + F.least(start, F.lit(0)))
    hit = ["doc_id", "text", "item_id", "copy", "n_words", "item_at", start.alias("start"), beside.alias("beside")]
    if known.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        hits = rows.join(F.broadcast(known), "seed").select(*hit).join(F.broadcast(items_of), ["item_id", "copy"])
    else:
        met = rows.select("doc_id", "text", "at", "seed").join(known, "seed").drop("seed").distinct()
        whole = docs.where("doc_id is not null").join(met.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("words"))
        whole = whole.withColumn("text", F.xxhash64("words")).dropDuplicates(["doc_id", "text"])
        hits = met.join(whole, ["doc_id", "text"]).select(*hit).join(items_of, ["item_id", "copy"])
    before = F.greatest(-F.col("start"), F.lit(0))
    agree = F.size(F.filter(F.zip_with("beside", F.slice("item_words", before + 1, F.col("n_words")), lambda a, b: a == b), lambda same: same))
    near = F.filter(F.sequence(F.col("item_at"), F.least(F.col("item_at") + SPAN, F.col("n_words")) - 1), lambda p: F.get("item_words", p) == F.get("beside", p - before))
    # Rows that repeat a doc_id may differ in text: a diagonal belongs to one text.
    found = hits.select("doc_id", "text", "item_id", "copy", "start", "n_words", agree.alias("n_matched"), near.alias("near"))
    diagonals = found.groupBy("doc_id", "text", "item_id", "copy", "start", "n_words").agg(F.max("n_matched").alias("n_matched"), F.array_distinct(F.flatten(F.collect_set("near"))).alias("near"))
    beside_it = Window.partitionBy("doc_id", "text", "item_id", "copy").orderBy("start").rangeBetween(0, SHIFT)
    diagonals = diagonals.withColumn("places", F.array_sort(F.array_distinct(F.flatten(F.collect_list("near").over(beside_it)))))
    least = F.least(F.lit(min_words), F.col("n_words"))
    along = (F.col("n_matched") >= least) & (F.col("n_matched") >= min_share * F.col("n_words"))
    judged = diagonals.withColumn("along", along).where(F.col("along") | holds_stretch(F.col("places"), least))
    judged = judged.withColumn("n_matched", F.when(F.col("along"), F.col("n_matched")).otherwise(F.size("places")))
    best = judged.groupBy("doc_id", "item_id").agg(F.max(F.struct("along", "n_matched", (-F.col("n_words")).alias("fewer"), (-F.col("start")).alias("before"))).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.fewer")).cast("long").alias("n_words"), F.col("best.n_matched").cast("long").alias("n_matched"), (-F.col("best.before")).cast("long").alias("start"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without those that hold an item."""
    return docs.join(leaks(docs, items).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    def words_of(name: str, source: str) -> str:
        return rf"SELECT {name}, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM {source} WHERE {name} IS NOT NULL"

    def seeds_of(name: str, source: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {name}, p, {i} AS mask, " + " || ' ' || ".join(f"w[p + {k + 1}]" for k in m) + f" AS seed FROM (SELECT {name}, w, unnest(range(len(w) - {m[-1]})) AS p FROM {source})"
            for i, m in enumerate(MASKS)
        )

    def fresh(p: str) -> str:
        """The SPAN words from ``p`` on are not those at most PERIOD words before them."""
        return " AND ".join(f"NOT ({p} >= {k} AND {p} + {SPAN} <= len(d.w) AND d.w[{p} + 1:{p} + {SPAN}] = d.w[{p} + 1 - {k}:{p} + {SPAN} - {k}])" for k in range(1, PERIOD + 1))

    return f"""
WITH d AS MATERIALIZED ({words_of('doc_id', 'documents')}),
b AS MATERIALIZED ({words_of('item_id', 'benchmark')}),
ds AS ({seeds_of('doc_id', 'd')}), bs AS ({seeds_of('item_id', 'b')}),
found AS MATERIALIZED (SELECT ds.doc_id, bs.item_id, ds.p, bs.p AS q, mask FROM ds JOIN bs USING (mask, seed)),
short AS (
  SELECT t.doc_id, b.item_id, t.p FROM (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d) t JOIN b ON t.w[t.p + 1] = b.w[1]
  WHERE len(b.w) <= {min(m[-1] for m in MASKS)} AND b.w <> [''] AND t.w[t.p + 1:t.p + len(b.w)] = b.w
),
hits AS MATERIALIZED (
  SELECT DISTINCT doc_id, item_id, p - q AS start, q FROM found JOIN d USING (doc_id) WHERE {fresh('p')}
  UNION SELECT doc_id, item_id, p, 0 FROM short JOIN d USING (doc_id) WHERE {fresh('p')}
),
diagonals AS MATERIALIZED (
  SELECT doc_id, item_id, start, len(b.w) AS n_words,
         len(list_filter(range(len(b.w)), lambda j: j + start >= 0 AND j + start < len(d.w) AND d.w[j + start + 1] = b.w[j + 1])) AS n_matched
  FROM (SELECT DISTINCT doc_id, item_id, start FROM hits) JOIN d USING (doc_id) JOIN b USING (item_id)
),
near AS (
  SELECT DISTINCT doc_id, item_id, start, unnest(list_filter(range(q, least(q + {SPAN}, len(b.w))), lambda j: j + start >= 0 AND j + start < len(d.w) AND d.w[j + start + 1] = b.w[j + 1])) AS place
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)
),
places AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, start ORDER BY place) AS r, count(*) OVER (PARTITION BY doc_id, item_id, start) AS n
  FROM (SELECT DISTINCT x.doc_id, x.item_id, x.start, x.n_words, y.place FROM diagonals x JOIN near y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND y.start BETWEEN x.start AND x.start + {SHIFT})
),
stretches AS (
  SELECT DISTINCT i.doc_id, i.item_id, i.start, i.n_words, i.n FROM places i JOIN places j ON i.doc_id = j.doc_id AND i.item_id = j.item_id AND i.start = j.start
  WHERE j.r - i.r + 1 >= least({MIN_WORDS}, i.n_words) AND 3 * (j.r - i.r + 1) >= 2 * (j.place - i.place + 1)
),
judged AS (
  SELECT doc_id, item_id, start, n_words, n_matched, true AS along FROM diagonals WHERE n_matched >= least({MIN_WORDS}, n_words) AND n_matched >= {MIN_SHARE} * n_words
  UNION ALL SELECT doc_id, item_id, start, n_words, n, false FROM stretches
)
SELECT doc_id, item_id, n_words, n_matched, start
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY along DESC, n_matched DESC, n_words, start) AS r FROM judged)
WHERE r = 1
"""


OP3_SQL = _sql()
