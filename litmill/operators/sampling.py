"""Batches, queues and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litmill.operators.folds import BLOCK_ROWS, greedy_batches


def pack_batches(records: DataFrame, most: int = 8, chars: int = 60_000, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Batches of records in order, closed at ``most`` records or before
    ``chars``; a long record is alone."""
    return greedy_batches(records.select("pos", F.col("size").cast("long").alias("size")), ["pos"], "size", most, chars, block_rows).select("pos", "size", "batch")


def priority_queue(rows: DataFrame, first: Sequence, key: str, n: int) -> DataFrame:
    """The first ``n`` by the given tests, true first, then by key."""
    order = [F.desc(F.coalesce(t, F.lit(False))) for t in first] + [F.asc(key)]
    top = rows.orderBy(*order).limit(n).select(key, F.lit("taken").alias("state"))
    return rows.join(F.broadcast(top), key, "left").withColumn("state", F.coalesce("state", F.lit("pending")))


def candidates_per_signature(rows: DataFrame, signature: Sequence[str], key: str, seed: int, n: int) -> DataFrame:
    """At most ``n`` rows of each signature, by a seeded hash; no sample of n
    rows that only looks at signatures can need more."""
    tied = rows.withColumn("tie", F.xxhash64(F.col(key), F.lit(seed)))
    rank = F.row_number().over(Window.partitionBy(*signature).orderBy(F.desc("tie"), F.desc(key)))
    return tied.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def stratified(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A sample of ``n`` of ``(key, year, type, queries, journal)`` that follows
    the population in years, types and queries, with a bonus for new journals.
    Only the rows that can matter for n picks reach the driver."""
    none = F.array().cast("array<string>")
    rows = rows.withColumn("queries", F.filter(F.coalesce("queries", none), lambda q: q.isNotNull()))
    total = rows.count()
    target = {}
    for group, column in (("year", F.array(F.col("year").cast("string"))), ("type", F.array("type")), ("query", F.col("queries"))):
        for r in rows.select(F.explode(column).alias("v")).groupBy("v").count().collect():  # distinct strata
            target[group, r["v"]] = r["count"] * n / total
    pool = candidates_per_signature(rows.withColumn("queries", F.array_sort("queries")), ["year", "type", "queries", "journal"], key, seed, n).collect()
    features = {r[key]: {"year": [str(r["year"])], "type": [r["type"]], "query": list(r["queries"])} for r in pool}
    taken: dict[tuple[str, str], int] = {}
    journals, chosen, left = set(), [], {r[key]: r for r in pool}
    while left and len(chosen) < n:

        def score(r) -> float:
            groups = [sum(max(0.0, target[g, v] - taken.get((g, v), 0)) / max(target[g, v], 1.0) for v in vs) for g, vs in features[r[key]].items()]
            return sum(groups) / 3 + 0.35 * (r["journal"] not in journals)

        best = max(left.values(), key=lambda r: (score(r), r["tie"], r[key]))
        del left[best[key]]
        journals.add(best["journal"])
        for g, vs in features[best[key]].items():
            for v in vs:
                taken[g, v] = taken.get((g, v), 0) + 1
        chosen.append(best[key])
    spark = rows.sparkSession
    picked = spark.createDataFrame([(k,) for k in chosen], f"{key} {dict(rows.dtypes)[key]}")
    return rows.join(F.broadcast(picked), key).select(key, "year", "type", "journal")


def coverage_sample(rows: DataFrame, key: str, tags: str, prefix: str, n: int) -> DataFrame:
    """A sample that covers tags first, then prefixes not seen, then by key."""
    rows = rows.withColumn(tags, F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda x: x.isNotNull()))
    pool = rows.groupBy(F.array_sort(tags).alias("tags"), prefix).agg(F.slice(F.array_sort(F.collect_set(key)), 1, n).alias("keys")).collect()  # signatures, n keys each
    left = {k: (set(r["tags"]), r[prefix]) for r in pool for k in r["keys"]}
    covered, seen, chosen = set(), set(), []
    while left and len(chosen) < n:
        best = min(left, key=lambda k: (-len(left[k][0] - covered), left[k][1] in seen, k))
        t, p = left.pop(best)
        covered |= t
        seen.add(p)
        chosen.append((len(chosen), best))
    return rows.sparkSession.createDataFrame(chosen, f"pick long, {key} {dict(rows.dtypes)[key]}")
