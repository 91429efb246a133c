"""Joins on intervals over a grid: spans that overlap, points within boxes.

A span's level is that of the smallest power of two that holds it. Where spans are
of like lengths and counts by key and bin show that few meet, bins have one width.
Else the grid has bins of a few widths. Spans stand on one of them, chosen by their
level, and a span touches two bins there, or more where that makes fewer rows than
another width would, as each width has a copy of all shorter spans of the other side. Two
spans that overlap meet on the wider bins of their two: each side is laid out on
its own and on the other side's wider ones, and the rest is an equi-join on key,
level and bin. A pair is reported in the bin of the later start alone. Bins spread
what one key holds, so a document of any number of spans is many small groups, and
what is compared stays in proportion to what overlaps.

Scale: a row is copied for each width of the other side, at most 64 and one or two
in practice; what spans are laid out over beyond that is less than the copies it
saves. Counts of levels, and of what meets in bins of one width, are the only thing
that reaches the driver.

Defined cases: empty and reversed spans overlap nothing and boxes without extent
hold nothing; null keys, ends or coordinates never match; repeated rows pair each
on its own; boxes may be open to infinity; NaN is in no box. All columns of both
sides come back, so their names must differ but for the key's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL, BIN, OWN = "__level", "__bin", "__own"


def _levels(*frames: tuple[DataFrame, Sequence[Column]]) -> list[tuple]:
    """The levels that rows have; a few dozen at most, whatever their number."""
    found: set[tuple] = set()
    for frame, columns in frames:
        found |= {tuple(r) for r in frame.select(*columns).distinct().collect()}
    return sorted(found)


def span_level(start: Column, end: Column) -> Column:
    """The exponent of the smallest power of two that is as long as a span."""
    length = (end - start).cast("long")
    return F.when(length > 1, F.length(F.bin(length - 1))).otherwise(0)


#: The narrowest bins are so many powers of two wider than the shortest spans: few of those then touch two.
SLACK = 3
#: A span touches at most two to this power of bins, and one.
REACH = 10


def _grid(left: dict[int, int], right: dict[int, int], lengths: dict[int, float]) -> list[tuple[int, int]]:
    """The grid for spans counted by level, with the sum of their lengths: the lowest
    level of spans and that of the bins they and longer ones stand on, ascending.
    Shorter spans stand on the bins of longer ones where even all their pairs are no
    more than the longer ones. Bins of another width come in where to lay longer spans
    out on the narrower ones makes more rows than to copy what the other side has below."""
    grid: list[tuple[int, int]] = []
    below, stand, spent = [0, 0], [0, 0], 0.0
    for level in sorted({*left, *right}):
        here = [left.get(level, 0), right.get(level, 0)]
        if stand[0] * below[1] + stand[1] * below[0] <= sum(here):
            low = grid.pop()[0] if grid else level
            grid.append((low, level if grid else min(level + SLACK, 63)))
            spent = 0.0
        else:
            bins = grid[-1][1]
            more = lengths[level] / 2.0**bins if level > bins else 0.0
            copies = below[1] * (here[0] > 0) + below[0] * (here[1] > 0)
            if level - bins > REACH or spent + more > copies:
                grid.append((level, level))
                stand, spent = [0, 0], 0.0
            else:
                spent += more
        stand, below = ([n + k for n, k in zip(held, here)] for held in (stand, below))
    return grid or [(0, 0)]


#: One width of bins holds so many times the mean length, so that few spans touch two,
WIDE = 8
#: and is taken if rows are compared with so many others at most, on the mean.
COMPARED = 64


def _one_width(left: DataFrame, right: DataFrame, key: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], counts: Sequence[dict[int, int]], length: float) -> int | None:
    """The level of bins that all spans of both sides can stand on, none of them
    longer than a bin, if what meets there by key and bin is counted to be in
    proportion to the rows; no span is then copied for any other width."""
    rows = sum(sum(side.values()) for side in counts)
    if not all(counts):
        return None
    width = max(0, math.ceil(math.log2(WIDE * length / rows)))
    if width > 63 or max(max(side) for side in counts) > width:
        return None
    sides = [t.select(*key, F.lit(width).alias(LEVEL), F.col(s).alias("s"), F.col(e).alias("e"), F.lit(side).alias("side")) for side, t, (s, e) in ((0, left, left_span), (1, right, right_span))]
    met = _in_bins(sides[0].unionAll(sides[1]), "s", "e").groupBy(*key, BIN).agg(F.count_if(F.col("side") == 0).alias("n"), F.count_if(F.col("side") == 1).alias("m"))
    pairs = met.agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0.0
    return width if pairs <= COMPARED * rows else None


def _stands(start: Column, end: Column, grid: list[tuple[int, int]]) -> Column:
    """The level of the bins that a span stands on."""
    length = (end - start).cast("long")
    (_, first), *more = grid
    return F.coalesce(*(F.when(length > 1 << (low - 1), bins) for low, bins in reversed(more)), F.lit(first))


def _in_bins(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Spans in the bins that they touch on the level of their row."""
    return rows.withColumn(BIN, F.explode(F.sequence(_span_bin(F.col(start)), _span_bin(F.col(end) - 1))))


def _laid_out(spans: DataFrame, start: str, end: str, levels: list[int], own: Column | None = None) -> DataFrame:
    """Spans in the bins of their own level and of the higher ones of ``levels``."""
    own = span_level(F.col(start), F.col(end)) if own is None else own
    every = F.array(*(F.lit(k) for k in levels)).cast("array<int>")
    rows = spans.withColumn(OWN, own).withColumn(LEVEL, F.explode(F.filter(every, lambda k: k >= F.col(OWN))))
    return _in_bins(rows, start, end)


def _span_bin(value: Column) -> Column:
    """The bin of a place on the level of its row; an arithmetic shift rounds down."""
    return F.call_function("shiftright", value.cast("long"), F.col(LEVEL))


def overlap_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], counted: Sequence[DataFrame] | None = None) -> DataFrame:
    """Pairs of rows of equal ``key`` whose spans ``[start, end)`` share a place.
    Bins are chosen by the keys and spans of ``counted``, which has those of both
    sides and may have more, if rows themselves cost more to make."""
    (s1, e1), (s2, e2) = left_span, right_span
    spans = lambda rows: [t.where(F.col(s) < F.col(e)) for t, s, e in zip(rows, (s1, s2), (e1, e2))]
    left, right = spans((left, right))
    some, others = spans(counted) if counted else (left, right)
    level1, level2 = span_level(F.col(s1), F.col(e1)), span_level(F.col(s2), F.col(e2))
    found = [t.select(F.lit(side).alias("side"), level.alias("level"), (F.col(e) - F.col(s)).cast("double").alias("n")) for side, t, level, s, e in ((0, some, level1, s1, e1), (1, others, level2, s2, e2))]
    counts: tuple[dict[int, int], dict[int, int]] = {}, {}
    lengths: dict[int, float] = {}
    for side, level, n, length in found[0].unionAll(found[1]).groupBy("side", "level").agg(F.count("*"), F.sum("n")).collect():
        counts[side][level] = n
        lengths[level] = lengths.get(level, 0.0) + length
    width = _one_width(some, others, key, (s1, e1), (s2, e2), counts, sum(lengths.values()))
    grid = _grid(*counts, lengths) if width is None else [(0, width)]
    # The bins that each side's spans stand on.
    of1, of2 = (sorted({max(g for g in grid if g[0] <= k)[1] for k in side}) for side in counts)
    own1, own2 = _stands(F.col(s1), F.col(e1), grid), _stands(F.col(s2), F.col(e2), grid)
    a, b = (_in_bins(t.withColumn(LEVEL, own), s, e) for t, own, s, e in ((left, own1, s1, e1), (right, own2, s2, e2)))
    late = F.greatest(s1, s2)
    met = (late < F.least(e1, e2)) & (_span_bin(late) == F.col(BIN))
    # Bins multiply the spans, which a file's size doesn't tell; no side goes through the driver.
    if len(grid) == 1:
        return a.join(b.drop(LEVEL).hint("merge"), [*key, BIN]).where(met).drop(LEVEL, BIN)
    on = [*key, LEVEL, BIN]
    # The longer span stands on its own level; of two on the same level the left one does.
    pairs = a.join(_laid_out(right, s2, e2, of1, own2).drop(OWN).hint("merge"), on)
    if of1 and of2 and of2[-1] > of1[0]:
        pairs = pairs.unionByName(_laid_out(left, s1, e1, of2, own1).where(F.col(LEVEL) > F.col(OWN)).drop(OWN).join(b.hint("merge"), on))
    return pairs.where(met).drop(LEVEL, BIN)


#: A level above that of any number, with one bin.
OPEN = 4096
#: Bins further out than this are one.
FAR = float(1 << 60)


def _box_level(low: Column, high: Column) -> Column:
    width = high - low
    finite = (F.abs(low) < float("inf")) & (F.abs(high) < float("inf")) & (width < float("inf"))
    return F.when(finite, F.ceil(F.log2(width)).cast("int")).otherwise(OPEN)


def _box_bin(value: Column, level: Column) -> Column:
    """Grows with the value, so a box covers the bins between those of its ends."""
    scaled = value / F.pow(F.lit(2.0), F.greatest(level, F.lit(-1000)).cast("double"))
    return F.when(level == OPEN, F.lit(0).cast("long")).otherwise(F.floor(F.greatest(F.least(scaled, F.lit(FAR)), F.lit(-FAR))).cast("long"))


def points_in_boxes(points: DataFrame, boxes: DataFrame, key: Sequence[str], axes: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Points with the boxes of equal ``key`` that hold them. An axis is the name
    of a point's coordinate and of a box's low and high end, ``[low, high)``."""
    grows = [F.col(low) < F.col(high) for _, low, high in axes]
    levels = [f"{LEVEL}{i}" for i in range(len(axes))]
    bins = [f"{BIN}{i}" for i in range(len(axes))]
    for test in grows:
        boxes = boxes.where(test)
    for name, (_, low, high) in zip(levels, axes):
        boxes = boxes.withColumn(name, _box_level(F.col(low), F.col(high)))
    found = _levels((boxes, [F.col(c) for c in levels]))
    for name, level, (_, low, high) in zip(bins, levels, axes):
        boxes = boxes.withColumn(name, F.explode(F.sequence(_box_bin(F.col(low), F.col(level)), _box_bin(F.col(high), F.col(level)))))
    grid = F.array(*(F.struct(*(F.lit(k).cast("int").alias(n) for n, k in zip(levels, ks))) for ks in found)) if found else F.array().cast(f"array<struct<{', '.join(f'{n}: int' for n in levels)}>>")
    placed = points.withColumn("__grid", F.explode(grid))
    for name, level, (at, _, _) in zip(bins, levels, axes):
        placed = placed.withColumn(level, F.col(f"__grid.{level}")).withColumn(name, _box_bin(F.col(at), F.col(level)))
    # Bins multiply the boxes, which a file's size doesn't tell; no side goes through the driver.
    pairs = placed.drop("__grid").join(boxes.hint("merge"), [*key, *levels, *bins])
    for at, low, high in axes:
        pairs = pairs.where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high)) & ~F.isnan(F.col(at).cast("double")))
    return pairs.drop(*levels, *bins)
