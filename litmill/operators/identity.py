"""Which records are the same, and what is left of them when they are merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litmill.functions.text import normalize_doi
from litmill.operators.components import components
from litmill.sources.scratch import Scratch


def uid_conflicts(records: DataFrame) -> DataFrame:
    """``(uid, doi_candidates)`` of uids that carry more than one DOI."""
    keyed = records.select(F.upper(F.trim("uid")).alias("uid"), normalize_doi(F.col("doi")).alias("doi")).where("uid is not null and doi is not null")
    return keyed.distinct().groupBy("uid").agg(F.sort_array(F.collect_list("doi")).alias("doi_candidates")).where(F.size("doi_candidates") > 1)


def conflicted_uids(records: DataFrame) -> DataFrame:
    """``(uid)`` of the uids in conflict: two different DOIs are all there is to know."""
    doi = normalize_doi(F.col("doi"))
    return records.groupBy(F.upper(F.trim("uid")).alias("uid")).agg(F.min(doi).alias("low"), F.max(doi).alias("high")).where("uid is not null and low < high").select("uid")


def identity_keys(records: DataFrame, title_key: Column) -> DataFrame:
    """``(pos, key)``: DOI and uid of a record; title and year only without
    either. A uid in conflict is a key that merges nothing."""
    conflicts = conflicted_uids(records).select(F.col("uid").alias("_bad"))
    keyed = records.select("pos", normalize_doi(F.col("doi")).alias("doi"), F.upper(F.trim("uid")).alias("uid"), title_key.alias("t"), F.col("publish_year").alias("y"))
    keyed = keyed.join(conflicts, F.col("uid") == F.col("_bad"), "left")
    title = F.when(F.col("doi").isNull() & F.col("uid").isNull() & (F.col("t") != "") & F.col("y").isNotNull(), F.concat(F.lit("t:"), "t", F.lit("|"), F.col("y").cast("string")))
    keys = F.array_compact(F.array(F.concat(F.lit("d:"), "doi"), F.when(F.col("_bad").isNull(), F.concat(F.lit("u:"), "uid")), title))
    return keyed.select("pos", F.explode(keys).alias("key"))


def identity_groups(records: DataFrame, title_key: Column) -> DataFrame:
    """``(pos, group)``: records that share keys, directly or through others,
    under the smallest position. A key points at its smallest record, so a key
    that a third of all records share makes a star, not pairs."""
    scratch = Scratch(records.sparkSession, "identity")
    keys = scratch.save(identity_keys(records, title_key), "keys")
    first = keys.groupBy("key").agg(F.min("pos").alias("b"), F.max("pos").alias("last")).where("b < last").select("key", "b")
    edges = keys.join(first, "key").where("pos <> b").select(F.col("pos").alias("a"), "b")
    roots = scratch.save(components(edges, scratch), "roots")
    return records.select("pos").join(roots.withColumnRenamed("node", "pos"), "pos", "left").select("pos", F.coalesce("root", "pos").alias("group"))


def first_filled(column: str, order: str, empty: Sequence[str] = ("",)) -> Column:
    """The first value in order that is not empty, else the last not null."""
    c = F.col(column)
    filled = c.isNotNull() & ~c.cast("string").isin(*empty) if empty else c.isNotNull()
    return F.coalesce(F.min_by(F.when(filled, c), F.when(filled, F.col(order))), F.max_by(F.when(c.isNotNull(), c), F.when(c.isNotNull(), F.col(order))))


def merge_groups(grouped: DataFrame, values: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """One record for each ``group``: values by ``first_filled``, lists as
    their distinct elements in the order of rows. The rows of a group are only
    ever summed up: of an element the first place is kept, so a group that a third
    of all records share costs its distinct elements."""
    out = grouped.groupBy("group").agg(*(first_filled(c, "pos").alias(c) for c in values), F.count("*").alias("copies"))
    for c in lists:
        held = grouped.select("group", "pos", F.posexplode(c).alias("i", "e")).groupBy("group", "e").agg(F.min(F.struct("pos", "i")).alias("at"))
        ordered = held.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "e"))), lambda x: x["e"]).alias(c))
        out = out.join(ordered, "group", "left").withColumn(c, F.coalesce(c, F.array().cast(dict(grouped.dtypes)[c])))
    return out.select("group", *values, *lists, "copies")


def duplicate_members(records: DataFrame, key: Column, kind: str, apart: Column | None = None) -> DataFrame:
    """``(kind, key, n, pos)``: a row for each record whose key others have too;
    with ``apart`` only keys under which that column has two values."""
    keyed = records.select(key.alias("key"), "pos", (F.lit(None).cast("string") if apart is None else apart).alias("apart")).where("key is not null")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high"))
    counts = counts.where("n > 1" if apart is None else "low < high").select("key", "n")
    # A written table: Spark can split the records of a key that many have.
    counts = Scratch(records.sparkSession, "identity").save(counts, "counts")
    return keyed.join(counts, "key").select(F.lit(kind).alias("kind"), "key", "n", "pos")


def keep_first(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_that(rows: DataFrame, key: str, order: str, good: Column, else_first: bool, columns: Sequence[str]) -> DataFrame:
    """For each key the last row that is ``good``; without one the first or
    the last of all."""
    row = F.struct(order, *columns)
    other = F.min_by(row, F.col(order)) if else_first else F.max_by(row, F.col(order))
    best = F.coalesce(F.max_by(F.when(good, row), F.when(good, F.col(order))), other)
    return rows.groupBy(key).agg(best.alias("r")).select(key, "r.*")


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How far two tables are from having the same keys once each."""
    counts = left.groupBy(key).agg(F.count("*").alias("l")).join(right.groupBy(key).agg(F.count("*").alias("r")), key, "full_outer")
    n = lambda c: F.coalesce(F.count(F.when(c, 1)), F.lit(0)).cast("long")
    return counts.agg(n(F.col("r").isNull()).alias("left_only"), n(F.col("l").isNull()).alias("right_only"), n(F.col("l") > 1).alias("left_duplicates"), n(F.col("r") > 1).alias("right_duplicates"), n((F.col("l") == 1) & (F.col("r") == 1)).alias("matched"))


def cardinality(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Left rows with how many right ones they have: missing, one or duplicate,
    and the smallest value of a column there."""
    known = right.groupBy(key).agg(F.count("*").alias("n_right"), F.min(value).alias(value))
    kind = F.when(F.col("n_right").isNull(), "missing").when(F.col("n_right") == 1, "one").otherwise("duplicate")
    return left.join(known, key, "left").withColumn("cardinality", kind).withColumn("n_right", F.coalesce("n_right", F.lit(0).cast("long")))


def without_reserved(rows: DataFrame, reserved: DataFrame) -> DataFrame:
    """Rows that share neither uid nor DOI with a reserved one."""
    by_uid = rows.join(reserved.select("uid").where("uid is not null"), "uid", "left_anti")
    return by_uid.join(reserved.select("doi").where("doi is not null"), "doi", "left_anti")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def partition_check(parts: Sequence[DataFrame], whole: DataFrame, key: str) -> DataFrame:
    """Whether parts are disjoint and together the whole: keys in several parts,
    keys in none, keys beyond the whole."""
    tagged = parts[0].select(key, F.lit(0).alias("part"))
    for i, p in enumerate(parts[1:], 1):
        tagged = tagged.unionByName(p.select(key, F.lit(i).alias("part")))
    held = tagged.distinct().groupBy(key).agg(F.count("*").alias("parts")).join(whole.select(key).distinct().withColumn("w", F.lit(True)), key, "full_outer")
    n = lambda c: F.count(F.when(c, 1)).alias
    return held.agg(n(F.col("parts") > 1)("overlapping"), n(F.col("parts").isNull())("uncovered"), n(F.col("w").isNull())("unexpected"))
