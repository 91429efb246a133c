"""Connected components by alternating large and small stars, and places in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litmill.sources.scratch import Scratch

#: Edges of a node that one task may join; a node with more is a hub.
HUB_EDGES = 50_000
#: There are never more hubs than this, so they can be broadcast.
MOST_HUBS = 4_000


def beside_least(edges: DataFrame, count: int, hub_edges: int) -> DataFrame:
    """``(u, v, m)``: edges ``(u, v)`` with the least ``v`` of their ``u``. Minima
    are summed up before the shuffle. Of ``count`` edges only ``count / limit``
    nodes can have over ``limit``: these few get theirs by broadcast, where their
    edges lie, so no task holds all edges of a hub; others are joined by node."""
    limit = max(hub_edges, -(-count // MOST_HUBS))
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if count <= limit:
        return edges.join(least.drop("n"), "u")
    hubs = F.broadcast(least.where(F.col("n") > limit).select("u", F.col("m").alias("hub")))
    marked = edges.join(hubs, "u", "left")
    rest = marked.where("hub is null").drop("hub").join(least.where(F.col("n") <= limit).drop("n"), "u")
    return marked.where("hub is not null").select("u", "v", F.col("hub").alias("m")).unionAll(rest.select("u", "v", "m"))


def components(edges: DataFrame, scratch: Scratch, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the
    smallest node that can be reached. Rounds grow with the logarithm of the
    size; a node's neighbours are aggregated, never gathered or joined in one
    task, and each round is written to the shared folder."""
    now = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        # Large star: every larger neighbour of a node points at the smallest around it.
        ways = now.unionAll(now.select("v", "u")).toDF("u", "v")
        large = beside_least(ways, 2 * mark[0], hub_edges).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        # Small star: a node and its smaller neighbours point at the smallest of them.
        around = beside_least(large, mark[0], hub_edges)
        small = around.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        after = scratch.save(small.where("u <> v").distinct(), "stars")
        scratch.drop(now)
        now = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(now.select("v", "v").distinct())


def numbered(rows: DataFrame, order: Sequence[str], label: Sequence[str] = ()) -> DataFrame:
    """Rows with ``place``, from 1 in the given order, within each label. Ranges
    of label and order are sorted apart and written, then the sizes of a label's
    ranges are summed, so no task orders a whole label. Ties stand in any order."""
    scratch = Scratch(rows.sparkSession, "numbered")
    row = F.monotonically_increasing_id()  # the partition in the upper bits, the row within it in the lower 33
    ranges = rows.repartitionByRange(*label, *order).sortWithinPartitions(*label, *order)
    kept = scratch.save(ranges.withColumns({"_range": F.shiftrightunsigned(row, 33), "_row": row.bitwiseAND(F.lit((1 << 33) - 1))}), "ranges")
    sizes = kept.groupBy(*label, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0).cast("long"))).withColumnsRenamed({c: f"_of_{c}" for c in (*label, "_range")})
    same = F.col("_range") == F.col("_of__range")
    for c in label:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return kept.join(sizes, same).select(*rows.columns, (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("place"))
