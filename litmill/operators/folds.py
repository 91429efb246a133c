"""Greedy batches over an order, exact and in parallel.

A batch takes rows in order until it has ``most`` of them or the next would take
it over ``limit``; a row that is larger alone is a batch alone. Where the next
batch starts depends on nothing but where this one does, and that is at most
``most`` rows further. So a block of positions is a small table: for each of the
``most`` places at its head where a batch may start, the place at the head of the
next block where one then starts, and how many batches start in between. Such
tables compose: runs of ``FAN`` are made one, level by level, until a single one
is left; then the start of the first block is handed down, and every block marks
its own batches knowing where it begins. The result is that of one fold over all
rows, however they are partitioned.

Scale: rows are numbered by sorted ranges; a task holds the sizes of one block
and the ``most - 1`` after it, or ``FAN`` tables of ``most`` entries. Levels grow
with the logarithm of the rows.

Defined cases: null and negative sizes count as zero; ties in the order stand in
any order; no rows give no batches; other columns pass through, but for
``place`` and ``batch``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmill.operators.components import numbered
from litmill.sources.scratch import Scratch

BLOCK_ROWS = 65_536
FAN = 1024


def next_starts(sizes: np.ndarray, most: int, limit: int) -> np.ndarray:
    """For each place where the batch after the one that starts there begins."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(len(sizes))
    fits = np.searchsorted(sums, sums[:-1] + limit, "right") - 1
    return np.minimum(np.maximum(fits, at + 1), at + most)


def block_table(sizes: np.ndarray, rows: int, most: int, limit: int) -> tuple[list[int], list[int]]:
    """Exits and counts of starts of a block of ``rows`` rows for every entry;
    ``sizes`` goes on for those after it. An entry beyond the rows is its own exit."""
    after = next_starts(sizes, most, limit)[:rows].tolist()
    exits, starts = [0] * rows, [0] * rows
    for i in range(rows - 1, -1, -1):
        j = after[i]
        exits[i], starts[i] = (j - rows, 1) if j >= rows else (exits[j], starts[j] + 1)
    beyond = range(max(0, most - rows))
    return [*exits[:most], *beyond], [*starts[:most], *(0 for _ in beyond)]


TABLE = "block long, exits array<long>, starts array<long>"


def composed(tables: pd.DataFrame) -> tuple[list[int], list[int]]:
    """The table of a run of blocks out of theirs, in order."""
    place = np.arange(len(tables["exits"].iloc[0]))
    count = np.zeros(len(place), np.int64)
    for exits, starts in zip(tables["exits"], tables["starts"]):
        count += np.asarray(starts)[place]
        place = np.asarray(exits)[place]
    return place.tolist(), count.tolist()


def greedy_batches(rows: DataFrame, order: Sequence[str], size: str, most: int, limit: int, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """``rows`` with ``place``, from 0 in the given order, and ``batch``, from 0."""
    scratch, block_rows = Scratch(rows.sparkSession, "fold"), max(block_rows, most)
    held = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    placed = scratch.save(numbered(rows.drop("place", "batch"), order).withColumn("place", F.col("place") - 1), "placed")
    n = placed.count()
    own = placed.select("place", held.alias("size"), F.floor(F.col("place") / block_rows).cast("long").alias("block"))
    # The rows at the head of a block are also the end of what the block before it looks at.
    head = own.where((F.col("place") % block_rows < most - 1) & (F.col("block") > 0)).withColumn("block", F.col("block") - 1)
    sizes = own.unionByName(head)

    def tabled(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        block = int(group["block"].iloc[0])
        inside = int((group["place"] < (block + 1) * block_rows).sum())
        exits, starts = block_table(group["size"].to_numpy(), inside, most, limit)
        return pd.DataFrame({"block": [block], "exits": [exits], "starts": [starts]})

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        exits, starts = composed(group.sort_values("block"))
        return pd.DataFrame({"block": [int(group["block"].iloc[0]) // fan], "exits": [exits], "starts": [starts]})

    def handed_down(run: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        at, batch, out = int(entry["at"].iloc[0]), int(entry["batch"].iloc[0]), []
        for block, exits, starts in run.sort_values("block")[["block", "exits", "starts"]].itertuples(index=False):
            out.append((block, at, batch))
            at, batch = exits[at], batch + starts[at]
        return pd.DataFrame(out, columns=["block", "at", "batch"])

    def marked(group: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        block, at, batch = (int(entry[c].iloc[0]) for c in ("block", "at", "batch"))
        inside = int((group["place"] < (block + 1) * block_rows).sum())
        after, started = next_starts(group["size"].to_numpy(), most, limit), np.zeros(inside, np.int64)
        while at < inside:
            started[at] = 1
            at = int(after[at])
        return pd.DataFrame({"place": group["place"].to_numpy()[:inside], "batch": batch - 1 + np.cumsum(started)})

    levels = [scratch.save(sizes.groupBy("block").applyInPandas(tabled, TABLE), "blocks")]
    blocks = -(-n // block_rows)
    while blocks > 1:
        levels.append(scratch.save(levels[-1].groupBy(F.floor(F.col("block") / fan)).applyInPandas(merged, TABLE), "level"))
        blocks = -(-blocks // fan)
    entries = rows.sparkSession.createDataFrame([(0, 0, 0)], "block long, at long, batch long")
    for level in reversed(levels[:-1]):
        run = F.floor(F.col("block") / fan).cast("long")
        entries = scratch.save(level.withColumn("run", run).groupBy("run").cogroup(entries.withColumn("run", F.col("block")).groupBy("run")).applyInPandas(handed_down, "block long, at long, batch long"), "entries")
    batches = sizes.groupBy("block").cogroup(entries.groupBy("block")).applyInPandas(marked, "place long, batch long") if n else own.select("place", F.lit(0).cast("long").alias("batch"))
    return placed.join(batches, "place").select(*(c for c in placed.columns if c != "place"), "place", "batch")
