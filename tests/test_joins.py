"""Joins on intervals and on containment against brute force, also with one key that holds nearly all rows."""

import math
import random
import re

from pyspark.sql import functions as F

from litmill.operators import intervals
from litmill.operators.containment import candidates, containment_join, folded, gram_size
from litmill.operators.documents import line_cooccurrence, relocate
from litmill.operators.intervals import overlap_join, points_in_boxes, span_level


def spans(rng, n, far=10**6):
    out = []
    for i in range(n):
        s = rng.randrange(-far, far)
        out.append((rng.choice("ab"), i, s, s + rng.choice([0, -5, 1, 2, 3, 8, 9, 100, 1000, 70_000])))
    return out + [(None, -1, 0, 10), ("a", -2, None, 5), ("a", -3, 5, None)]


def test_spans_that_overlap(spark):
    rng = random.Random(2)
    left, right = spans(rng, 300, 3000), spans(rng, 300, 3000)
    right += right[:20] + [("a", 900, -(10**12), 10**12)]
    a, b = spark.createDataFrame(left, "k string, i int, s1 long, e1 long"), spark.createDataFrame(right, "k string, j int, s2 long, e2 long")
    got = sorted((r.i, r.j) for r in overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2")).collect())
    whole = lambda r: None not in r
    want = sorted((x[1], y[1]) for x in filter(whole, left) for y in filter(whole, right) if x[0] == y[0] and max(x[2], y[2]) < min(x[3], y[3]))
    assert got == want and len(got) > 500
    assert overlap_join(a.limit(0), b, ["k"], ("s1", "e1"), ("s2", "e2")).collect() == []


def test_spans_on_any_grid(spark):
    """Sides of one length and of many, few short ones among long and few long ones among short."""
    rng = random.Random(5)
    kinds = {"short": [3, 4], "long": [700, 1000], "many": [1, 2, 30, 900, 40_000], "few long": [9] * 40 + [5000, 70_000], "few short": [300] * 40 + [1, 2], "none": [0]}
    made = {kind: [(rng.choice("ab"), i, s, s + rng.choice(lengths)) for i in range(120) for s in [rng.randrange(-1500, 1500)]] for kind, lengths in kinds.items()}
    grids = set()
    for left, right in (("short", "short"), ("short", "many"), ("many", "short"), ("few long", "few short"), ("few short", "few long"), ("long", "few long"), ("many", "many"), ("short", "long"), ("none", "many"), ("many", "none")):
        a, b = spark.createDataFrame(made[left], "k string, i int, s1 long, e1 long"), spark.createDataFrame(made[right], "k string, j int, s2 long, e2 long")
        out = overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2"))
        assert out.columns == ["k", "i", "s1", "e1", "j", "s2", "e2"]
        want = sorted((x[1], y[1]) for x in made[left] for y in made[right] if x[0] == y[0] and max(x[2], y[2]) < min(x[3], y[3]))
        assert sorted((r.i, r.j) for r in out.collect()) == want, (left, right)
        grids.add(out._jdf.queryExecution().optimizedPlan().toString().count("Join Inner"))
    assert grids == {1, 2}


def test_grid_of_few_widths():
    """Bins are as wide as most spans ask for; a width more comes in where it makes fewer rows."""
    grid = lambda left, right, most=1.0: intervals._grid(left, right, {k: (left.get(k, 0) + right.get(k, 0)) * most * 2.0**k for k in {*left, *right}})
    assert grid({}, {}) == [(0, 0)]
    assert grid({5: 1000}, {0: 1, 1: 2, 5: 700, 10: 100, 11: 3, 14: 2}) == [(0, 8)]
    assert grid({5: 1000}, {5: 1000, 10: 1000}) == [(5, 8), (10, 10)]
    assert grid({5: 10**9}, {5: 10**9, 40: 1}) == [(5, 8), (40, 40)]  # no span over millions of bins
    assert grid({2: 10}, {9: 1000}) == [(2, 12)]
    assert grid({0: 1000}, {0: 1000, 20: 5000}) == [(0, 3), (20, 20)]  # short ones may all be of one key
    assert grid({0: 1000}, {0: 1000, 20: 5000, 24: 9000}) == [(0, 3), (20, 20), (24, 24)]
    assert grid({62: 1}, {63: 1}) == [(62, 63)]


def test_levels_hold_their_spans(spark):
    rows = [(0, n) for n in (1, 2, 3, 4, 5, 1024, 1025, (1 << 62) + 1)]
    got = [r[0] for r in spark.createDataFrame(rows, "s long, e long").select(span_level(F.col("s"), F.col("e"))).collect()]
    assert got == [0, 1, 2, 2, 3, 10, 11, 63]


def test_a_document_of_a_hundred_thousand_spans(spark):
    """What is compared stays in proportion to what overlaps: bins are small."""
    n = 100_000
    a = spark.range(n).selectExpr("'d' AS k", "id AS i", "id * 10 AS s1", "id * 10 + CASE WHEN id % 1000 = 0 THEN 50000 ELSE 12 END AS e1")
    b = spark.range(n).selectExpr("'d' AS k", "id AS j", "id * 10 + 5 AS s2", "id * 10 + 9 AS e2")
    out = overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2"))
    got = {r.long: r.n for r in out.groupBy((F.col("i") % 1000 == 0).alias("long")).agg(F.count("*").alias("n")).collect()}
    # A short span [10i, 10i + 12) holds [10i + 5, 10i + 9) and nothing else; a long one 5000 of them.
    assert got == {False: n - n // 1000, True: sum(min(5000, n - i) for i in range(0, n, 1000))}
    rows = intervals._laid_out(a, "s1", "e1", [4, 16]).groupBy("k", intervals.LEVEL, intervals.BIN).count().agg(F.max("count")).first()[0]
    assert rows < 8000  # of 100 000


def test_points_in_boxes(spark):
    rng = random.Random(3)
    inf = float("inf")
    points = [(rng.choice("pq"), i, rng.choice([rng.uniform(-50, 50), float(rng.randrange(-5, 5))]), rng.uniform(-1, 1)) for i in range(400)]
    points += [("p", 1000, math.nan, 0.0), ("p", 1001, None, 0.0), ("p", 1002, 1e300, 0.0), ("p", 1003, -0.0, -0.0)]
    boxes = []
    for j in range(60):
        x, y = rng.uniform(-50, 50), rng.uniform(-1, 1)
        boxes.append((rng.choice("pq"), j, x, x + rng.choice([0.001, 0.5, 1.0, 7.0, 90.0]), y, y + rng.choice([0.01, 0.3, 2.0])))
    boxes += [("p", 90, -inf, inf, -inf, inf), ("p", 91, 0.0, inf, -1.0, 1.0), ("p", 92, 3.0, 3.0, 0.0, 1.0), ("p", 93, 4.0, 1.0, 0.0, 1.0), ("p", 94, 0.0, 1e-310, -1.0, 1.0), ("p", 95, -1e308, 1e308, -1.0, 1.0), (None, 96, -inf, inf, -inf, inf)]
    p, b = spark.createDataFrame(points, "page string, i int, x double, y double"), spark.createDataFrame(boxes, "page string, j int, xl double, xh double, yl double, yh double")
    out = points_in_boxes(p, b, ["page"], [("x", "xl", "xh"), ("y", "yl", "yh")])
    got = sorted((r.i, r.j) for r in out.collect())
    want = sorted((i, j) for k, i, x, y in points for q, j, xl, xh, yl, yh in boxes if k == q and None not in (x, y) and xl <= x < xh and yl <= y < yh)
    assert got == want
    assert points_in_boxes(p, b.limit(0), ["page"], [("x", "xl", "xh"), ("y", "yl", "yh")]).collect() == []


def test_containment(spark):
    rng = random.Random(4)
    sign = ["a", "b", "é", "日", " ", "😀", "A"]
    make = lambda n: "".join(rng.choices(sign, k=n))
    texts = list({(rng.choice("xy"), make(rng.randrange(60))) for _ in range(150)}) + [("x", None), (None, "aaaa")]
    strings = list({(rng.choice("xy"), rng.choice([make(rng.randrange(6)), t[1][k : k + rng.randrange(1, 25)] if t[1] else "a"])) for t in texts if t[1] is not None for k in (0, 3, 11)}) + [("x", None), (None, "a")]
    s, t = spark.createDataFrame(strings, "k string, s string"), spark.createDataFrame(texts, "k string, t string")
    got = sorted((r.k, r.s, r.t) for r in containment_join(s, t, ["k"], "s", "t").collect())
    want = sorted((k, x, y) for k, x in strings for q, y in texts if k == q and k and x and y is not None and x in y)
    assert got == want and len(got) > 300
    assert containment_join(s.limit(0), t, ["k"], "s", "t").collect() == []
    assert [gram_size(n) for n in (0, 1, 2, 3, 4, 7, 8, 50)] == [0, 1, 2, 2, 4, 4, 8, 8]


def test_a_hot_document_of_ten_thousand_quotes_and_paragraphs(spark):
    n = 10_000
    texts = spark.range(n).selectExpr("'hot' AS k", "id AS p", "concat('Boilerplate of every paragraph. Sample ', sha2(cast(id AS string), 256), ' was kept.') AS t")
    strings = spark.range(n).selectExpr("'hot' AS k", "id AS q", "concat('Sample ', substr(sha2(cast(id + 5 AS string), 256), 1, 20)) AS s")
    near = candidates(strings.selectExpr("*", "array(s) AS asked"), texts, ["k"], "asked", "t")
    assert near.count() < 4 * n  # of a hundred million pairs
    got = {(r.q, r.p) for r in containment_join(strings, texts, ["k"], "s", "t").collect()}
    assert got == {(q, q + 5) for q in range(n - 5)}


def test_relocated_quotes(spark):
    paras = [("d", "p1", 1, "Alpha beta  gamma."), ("d", "p2", 1, "Delta epsilon zeta"), ("d", "p3", 2, "Delta epsilon zeta"), ("d", "p4", 2, None), ("e", "p1", 1, "beta")]
    quotes = [
        ("d", "q1", "p1", 1, "beta gamma", "verified", None),
        ("d", "q2", "p2", 1, "betagam ma", "relocated", "p1"),
        ("d", "q3", "p1", 1, "epsilon", "unverified", None),  # in two
        ("d", "q4", "p3", 2, "epsilon", "verified", None),
        ("d", "q5", "p3", 1, "epsilon", "unverified", None),  # other page
        ("d", "q6", "p1", 1, "eta epsilon", "unverified", None),
        ("d", "q7", "p1", 1, "", "unverified", None),
        ("d", "q8", "p1", 1, None, "unverified", None),
        ("e", "q1", "p9", 1, "ｂｅｔａ", "relocated", "p1"),  # wide letters
        ("f", "q1", "p1", 1, "beta", "unverified", None),
    ]
    p = spark.createDataFrame(paras, "doc string, paragraph_id string, page int, text string")
    q = spark.createDataFrame([r[:5] for r in quotes], "doc string, quote_id string, paragraph_id string, page int, quote string")
    got = {(r.doc, r.quote_id): (r.status, r.proposed) for r in relocate(q, p).collect()}
    assert got == {(r[0], r[1]): r[5:] for r in quotes}


def test_lines_that_hold_a_label_and_a_number(spark):
    pages = [(1, "CK 3.5 and T1 4\nT10 4\r\nt1: 40, 4.0\x85ck 3.5\nck 3.5"), (2, "Straſse 7\nKELVIN K2 9 (a+b) [x]"), (3, None)]
    rows = [(1, "ck", "3.5"), (1, "t1", "4"), (1, "T1", "40"), (1, "T1", "4.0"), (1, "T", "4"), (1, "ck", "3"), (2, "STRASSE", "7"), (2, "(A+B)", "9"), (2, "[x]", "K2"), (3, "a", "1"), (1, "", "4"), (1, None, "4")]
    frame = spark.createDataFrame(rows, "page int, label string, number string")
    out = line_cooccurrence(frame, spark.createDataFrame(pages, "page int, text string")).collect()
    on = lambda line, t: re.search(rf"(?<![A-Za-z0-9]){re.escape(t)}(?![A-Za-z0-9])", line, re.I)
    want = {(p, lab, num): sum(bool(on(x, lab) and on(x, num)) for x in (dict(pages)[p] or "").splitlines()) if lab else 0 for p, lab, num in rows}
    assert {(r.page, r.label, r.number): r.lines for r in out} == want
    assert want[1, "ck", "3.5"] == 3 and want[2, "STRASSE", "7"] == 1 and want[1, "T", "4"] == 0
    assert {r.status for r in out if r.lines} == {"both_share_a_line"}
    assert folded("Kſµİ") == folded("kSμi") and len(folded("ßẞŉ")) == 3


def test_few_pairs_of_a_key_need_no_index(spark, monkeypatch):
    """Keys of few strings and texts are joined as they are, beside one that is indexed."""
    from litmill.operators import containment

    made = []
    monkeypatch.setattr(containment, "_gram_rows", lambda *args, plain=containment._gram_rows: made.append(1) or plain(*args))
    s = spark.range(200).selectExpr("id div 2 AS k", "concat('s', id % 2) AS s")
    t = spark.range(200).selectExpr("id div 2 AS k", "concat('a s', id % 3) AS t")
    find = lambda: sorted((r.k, r.s, r.t) for r in containment_join(s, t, ["k"], "s", "t").collect())
    want = sorted((i // 2, f"s{j}", f"a s{i % 3}") for i in range(200) for j in (0, 1) if i % 3 == j)
    assert find() == want and not made
    hot = spark.range(100).selectExpr("7 AS k", "concat('h', id) AS s")
    s, t = s.unionByName(hot), t.unionByName(hot.selectExpr("k", "concat(s, '.') AS t"))
    got = sorted((r.k, r.s, r.t) for r in containment_join(s, t, ["k"], "s", "t").collect())
    assert made and got == sorted(want + [(7, f"h{i}", f"h{j}.") for i in range(100) for j in range(100) if f"h{i}" in f"h{j}."])
