"""What moves between tasks, and exact ways that replaced slower ones."""

from __future__ import annotations

import difflib
import random
import re
import time
from collections import namedtuple

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from litmill.functions.blocks import Blocks, matching_share
from litmill.operators import documents, enrich, grounding, metrics, review
from litmill.operators.intervals import overlap_join, points_in_boxes
from litmill.plans import ingest, registry
from litmill.sources.digests import digests
from tests.oracle import same

SPAN = "uid int, field string, place long, value string, quote string, a_start long, a_end long, source_text string"


@pytest.mark.parametrize("name", ["boundary_match", "pair_compare"])
def test_sources_stay_where_they_are(spark, name):
    """Documents do not move with each of their spans; quotes that their source
    does not hold match by no boundary."""
    text = "Saline soil and rice, with a longer end"
    gold = [(1, "f", 0, "saline soil", text[:15], 0, 15, text), (2, "f", 0, "saline soil", "Saline soil!", 0, 12, text)]
    pred = [(1, "f", 0, "Saline", text[:11], 0, 11, text), (2, "f", 0, "Saline", text[:11], 0, 11, text)]
    a, b = spark.createDataFrame(gold, SPAN), spark.createDataFrame(pred, SPAN)
    out = metrics.boundary_match(a, b, ["uid", "field"]) if name == "boundary_match" else review.pair_compare(a, b, "uid")
    assert {r.uid for r in out.where("level = 'boundary'").collect()} == {1}
    moved = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "FlatMapCoGroups" in line]
    assert moved and not any("source_text" in line for line in moved)


def test_boxes_do_not_go_through_the_driver(spark):
    """Whatever the files' sizes say, neither points nor boxes are broadcast."""
    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 2.5, 0.5)], "page int, x double, y double")
    boxes = spark.createDataFrame([(1, 0.0, 1.0, 0.0, 1.0, 7)], "page int, xl double, xh double, yl double, yh double, box int")
    out = points_in_boxes(points, boxes, ["page"], [("x", "xl", "xh"), ("y", "yl", "yh")])
    assert [(r.x, r.box) for r in out.collect()] == [(0.5, 7)]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    spans = spark.createDataFrame([(1, 0, 9), (1, 20, 30)], "k int, s int, e int")
    both = overlap_join(spans, spans.toDF("k", "s2", "e2"), ["k"], ("s", "e"), ("s2", "e2"))
    assert sorted((r.s, r.s2) for r in both.collect()) == [(0, 0), (20, 20)]
    assert "Broadcast" not in both._jdf.queryExecution().executedPlan().toString()


def moved_rows(plan):
    """Rows that the shuffles of a plan that has run have written."""
    name, inner = plan.nodeName(), None
    if name == "Exchange":
        return plan.metrics().apply("shuffleRecordsWritten").value()
    if name == "AdaptiveSparkPlan":
        inner = plan.executedPlan()
    elif name.endswith("QueryStage"):
        inner = plan.plan()
    if inner is not None:
        return moved_rows(inner)
    children = plan.children()
    return sum(moved_rows(children.apply(i)) for i in range(children.size()))


def test_spans_are_copied_a_few_times(spark):
    """Lengths of a dozen powers of two don't copy each span a dozen times (F24)."""
    n, end = 5000, 200_000
    a = spark.range(n).selectExpr("1 AS k", "id * 40 AS s1", "id * 40 + 30 AS e1")
    b = spark.range(n).selectExpr("1 AS k", "id * 40 + 25 AS s2", f"CASE WHEN id % 600 = 7 THEN {end} WHEN id % 700 = 3 THEN id * 40 + 25 + (1 << (id % 13)) WHEN id % 7 = 3 THEN id * 40 + 625 ELSE id * 40 + 45 END AS e2")
    out = overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2"))
    got = {(r.s1, r.s2) for r in out.collect()}
    starts, spans = np.arange(n) * 40, [(r.s2, r.e2) for r in b.collect()]
    assert got == {(int(s), s2) for s2, e2 in spans for s in starts[(starts < e2) & (starts + 30 > s2)]}
    assert 2 * n < moved_rows(out._jdf.queryExecution().executedPlan()) < 10 * n


@pytest.mark.parametrize("name", ["boundary_match", "pair_compare"])
def test_spans_that_none_contests_form_no_group(spark, name):
    """Spans of a document are compared where they lie; only rows that contest a
    reference are grouped, and a source may be given in parts (F1, F2, F3)."""
    words, n = ("saline", "soil", "paddy", "water"), 400
    text = " ".join(words[i % 4] for i in range(2 * n + 2))
    at = [m.start() for m in re.finditer(r"\S+", text)]
    schema = SPAN.replace("source_text string", "source_text string, source_from long, source_chars long")
    make = lambda last: [(1, None if i % 9 == 0 else "f", i, text[at[2 * i] : at[2 * i + last]].strip(), text[at[2 * i] : at[2 * i + last]], at[2 * i], at[2 * i + last], text[at[2 * i] : at[2 * i + 2] + 9], at[2 * i], len(text)) for i in range(n)]
    a, b = spark.createDataFrame(make(2), schema), spark.createDataFrame(make(1), schema)
    out = metrics.boundary_match(a, b, ["uid", "field"]) if name == "boundary_match" else review.pair_compare(a, b, "uid")
    left, right = ("gold_place", "pred_place") if name == "boundary_match" else ("a_place", "b_place")
    assert sorted((r.level, r[left], r[right]) for r in out.collect()) == [("boundary", i, i) for i in range(n)]
    assert moved_rows(out._jdf.queryExecution().executedPlan()) == 0


def test_contested_references_are_dealt_in_order(spark):
    """Against the rules tried row by row, with nulls among the fields."""
    rng, text = random.Random(3), "saline soil, paddy soil; water of saline soil, paddy water and saline paddy soil"
    Span = namedtuple("Span", ["uid", "field", "place", "value", "quote", "a_start", "a_end", "source_text"])

    def side(n):
        spans = ((rng.randrange(70), rng.randrange(4, 30)) for _ in range(n))
        return [Span(rng.randrange(3), rng.choice(["f", None]), i, rng.choice(["soil", "saline soil", "paddy", "water", "paddy soil"]) + rng.choice([",", ".", "", ";"]), text[s : s + k], s, min(s + k, len(text)), text) for i, (s, k) in enumerate(spans)]

    gold, pred = side(90), side(90)
    out = metrics.boundary_match(spark.createDataFrame(gold, SPAN), spark.createDataFrame(pred, SPAN), ["uid", "field"])
    got = {(r.uid, r.field, r.gold_place, r.pred_place, r.level) for r in out.collect()}
    want, free = set(), {}
    for g in gold:
        free.setdefault((g.uid, g.field), []).append(g)
    for level, same in (("exact", lambda g, p: g.field is not None and g.value == p.value), ("boundary", metrics.boundary_equal)):
        for p in pred:
            key, taken = (p.uid, p.field), {w[3] for w in want if w[:2] == (p.uid, p.field)}
            found = next((g for g in free.get(key, []) if p.place not in taken and same(g, p)), None)
            if found:
                free[key].remove(found)
                want.add((*key, found.place, p.place, level))
    assert got == want and len({w for w in want if w[4] == "boundary"}) > 4


def test_bins_of_one_width_where_few_meet(spark):
    """Spans of like lengths are not copied for a width of short ones; where all lie
    in one place, the grid that spares their pairs is used (F1)."""
    n = 4000
    a = spark.range(n).selectExpr("id DIV 100 AS k", "id % 100 * 40 AS s1", "id % 100 * 40 + if(id % 100 = 99, 3, 30) AS e1")
    b = spark.range(n).selectExpr("id DIV 100 AS k", "id % 100 * 40 + 2 AS s2", "id % 100 * 40 + if(id % 100 = 99, 3, 37) AS e2")
    out = overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2"))
    assert {(r.k, r.s1, r.s2) for r in out.collect()} == {(k, 40 * i, 40 * i + 2) for k in range(n // 100) for i in range(100)}
    assert moved_rows(out._jdf.queryExecution().executedPlan()) < 2.4 * n
    a, b = spark.range(n).selectExpr("1 AS k", "id % 2 AS s1", "id % 2 + 1 AS e1"), spark.range(n).selectExpr("1 AS k", "id % 8 + 2 AS s2", "id % 8 + 3 AS e2")
    assert overlap_join(a, b, ["k"], ("s1", "e1"), ("s2", "e2")).count() == 0


def test_a_cut_title_gives_no_topic(spark, tmp_path):
    """A title that ends within a word is no other word's title."""
    text = "x" * 57 + " TOgether with more"
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate((text, text + " to", "to " + text))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    frame = registry.queries()["topic_tags"](spark, str(tmp_path))
    same(frame, con, registry.oracle_sql()["topic_tags"])
    assert {(r.pos, r.topic) for r in frame.collect()} == {(1, "salinity"), (2, "salinity")}


def test_blocks_are_those_of_difflib():
    """The search by arrays finds what the search by lists does, in its order."""
    rng = random.Random(7)

    for case in range(300):
        a, b = ([rng.choice("abcdef"[: 1 + case % 6]) for _ in range(rng.randrange(1, 60))] for _ in range(2))
        if case % 3 == 0:
            b = a[:10] + b[:5] + a[12:]
        want, got = difflib.SequenceMatcher(None, a, b, autojunk=False), Blocks(a, b)
        got.work = got.work * 10**9 + np.arange(len(got.work)) * 10**9  # never by lists
        assert got.get_opcodes() == want.get_opcodes()
        left, right = "".join(a) + "ωψφ"[case % 3 :], "xyz"[case % 3 :] + "".join(b)
        assert matching_share(left, right) == difflib.SequenceMatcher(None, left, right, autojunk=False).ratio()


def test_frequent_words_do_not_make_a_diff_quadratic():
    """Lists of places would be walked 25 million times for each block."""
    a = ["the"] * 5000
    b = a[:2500] + ["new"] + a[2500:]
    began = time.process_time()
    assert [c for c in Blocks(a, b).get_opcodes() if c[0] != "equal"] == [("insert", 2500, 2500, 2500, 2501)]
    assert time.process_time() - began < 2


def test_a_long_text_is_split_once(spark, tmp_path):
    """Each word of a text would split it again if the split stood in the function of a word."""
    text = " ".join(f"w{i}" for i in range(12000))
    spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    began = time.time()
    (row,) = registry.queries()["token_diff"](spark, str(tmp_path)).collect()
    assert row.changes == "replace: w6000 -> w6000☃|insert:  -> put in"
    assert time.time() - began < 15


def test_lines_by_runs_are_those_of_the_pattern():
    """Runs find every line that holds both tokens, whatever signs and cases they have."""
    rng, signs = random.Random(3), ["a", "B", "7", "-", " ", "ſ", "s", "K", "é", ".", "☃"]
    word = lambda n: "".join(rng.choice(signs) for _ in range(rng.randrange(1, n)))
    for _ in range(60):
        page = [word(9) for _ in range(30)]
        index = documents._Lines(page)
        for _ in range(40):
            x, y = word(4), word(3)
            assert index.holding(x, y) == sum(documents.token_on_line(line, x) and documents.token_on_line(line, y) for line in page)


def test_frequent_runs_are_not_walked_for_each_pair(spark):
    """A page is given once for thousands of pairs, not a row for each pair and line."""
    page = spark.createDataFrame([(1, "\n".join(f"T{i % 50} is {i // 50}.5" for i in range(4000)))], "page int, text string")
    asked = spark.createDataFrame([(1, f"t{i % 50}", f"{i // 50}.5") for i in range(4000)], "page int, label string, number string")
    out = documents.line_cooccurrence(asked, page)
    assert out.where("lines = 1").count() == 4000
    assert "lines_holding" in out._jdf.queryExecution().optimizedPlan().toString()


def _shuffles(frame):
    """Exchanges of rows and what they deal out by."""
    return [line for line in frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].split("\n") if "Exchange hashpartitioning" in line]


def test_both_readings_move_at_once(spark):
    """A value moves once for both sides, and a null meets nothing."""
    rows = [(1, "a", 0), (1, "a", 3), (1, "a", None), (1, None, 1), (None, "a", 2), (2, "b", 5)]
    other = [(1, "a", 7), (1, "a", 4), (1, None, 1), (None, "a", 2), (2, "c", 5), (1, "x", None)]
    gold, pred = (spark.createDataFrame(r, "uid int, value string, place int") for r in (rows, other))
    out = metrics.exact_pairs(gold, pred, ["uid"])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a", 0, 7), (1, "a", None, 4)]
    assert dict(out.dtypes)["gold_place"] == "int" and len(_shuffles(out)) == 1
    counts = metrics.set_metric(gold, pred, ["uid"])
    assert {r.uid: (r.tp, r.fp, r.fn) for r in counts.collect()} == {1: (1, 2, 1), 2: (0, 1, 1), None: (0, 1, 1)}
    assert len(_shuffles(counts)) == 2
    flags = gold.withColumns({"g": F.col("place") != 3, "p": F.col("place") < 4})
    assert {r.uid: (r.tp, r.fp, r.fn) for r in metrics.flagged_metric(flags, ["uid"]).collect()}[1] == (1, 1, 1)


def test_facts_and_supports_move_at_once(spark):
    facts = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None)], "k int, pointer string")
    supports = spark.createDataFrame([(1, "b"), (1, "c"), (None, "a"), (2, None)], "k int, pointer string")
    out = grounding.orphans(facts, supports, "k")
    missing, orphan = "missing_support", "orphan_support"
    want = [(1, "a", missing), (1, "c", orphan), (None, "a", missing), (None, "a", orphan), (2, None, missing), (2, None, orphan)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert len(_shuffles(out)) == 1


def test_pages_move_as_lines(spark, tmp_path):
    """Hits are made where a page's lines have come together, and pages are written packed."""
    frame = ingest.nested_pages(spark, "/root/testdata/sf0.001")
    after, before = frame._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert "hits" in after and "hit" not in before and "l_partkey" in before
    path = ingest.written(spark, "pages", frame, "gzip")
    read = spark.read.schema(frame.schema).json(path)
    assert read.inputFiles() and all(name.endswith(".gz") for name in read.inputFiles())
    assert sorted(map(str, read.collect())) == sorted(map(str, frame.collect()))


def test_a_word_moves_once(spark):
    """Texts are rebuilt without a shuffle by position; places that are missing, double or null give none."""
    rows = [(1, "b", 1), (1, "a", 0), (2, "a", 1), (3, "a", 0), (3, "b", 0), (4, "a", 0), (4, "b", None), (5, "", 0), (5, "x", 1), (5, "y", 2), (6, "a", 0), (6, "b", 2)]
    out = enrich.rebuild_text(spark.createDataFrame(rows, "k int, word string, position int"), "k")
    assert {r.k: r.text for r in out.collect()} == {1: "a b", 2: None, 3: None, 4: None, 5: " x y", 6: None}
    assert len(_shuffles(out)) == 1


def test_slices_meet_windows(spark):
    """A text does not move with each of its slices, however they lie to its windows."""
    text = "".join(chr(97 + i * i % 26) for i in range(3 * grounding.WINDOW + 7)) + "é日"
    n, w = len(text), grounding.WINDOW
    cuts = [(0, 5), (w - 1, w + 1), (w, w + grounding.SHORT), (w - 1, w + grounding.SHORT), (5, 3 * w), (n - 3, n), (0, n), (n - 3, n + 1), (n, n + 1), (-1, 3), (7, 7), (9, 8), (None, 4)]
    good = lambda s, e: s is not None and 0 <= s < e <= n
    rows = [(i, s, e, (text[s:e] if good(s, e) else "x") + ("!" if wrong else "")) for i, (s, e, wrong) in enumerate((*c, wrong) for c in cuts for wrong in (False, True))]
    facts = spark.createDataFrame([(1, f"/evidence/a/{i}", "") for i, *_ in rows] + [(2, "/evidence/a/0", "")], "k int, pointer string, value string")
    supports = spark.createDataFrame([(1, f"/evidence/a/{i}", q, s, e) for i, s, e, q in rows] + [(2, "/evidence/a/0", "x", 0, 1)], "k int, pointer string, quote string, a_start long, a_end long")
    records = spark.createDataFrame([(1, text, "include"), (2, None, "needs_fulltext")], "k int, text string, screening string")
    none = spark.createDataFrame([], "k int, place long, claim string, quote string, a_start long, a_end long, pointer string")
    out = grounding.document_faults(records, facts, supports, none.drop("pointer"), none.select("k", "pointer"), "k")
    off = sum(not good(s, e) for _, s, e, _ in rows)
    assert {r.k: (r.first_fault, r.n_faults) for r in out.collect()} == {1: ("invalid_offsets", off + len(cuts) - off // 2), 2: ("content_without_text", 1)}
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line and "_w" in line]
    assert len(joins) == 1


def test_parts_of_a_source_stand_for_it(spark):
    """An item beside the part of its source that holds its slice, and the source's length."""
    rows = [("fact", "cd", 102, 104, "abcd", 100, 104), ("fact", "cx", 102, 104, "abcd", 100, 104), ("fact", "cd", 102, 105, "abcd", 100, 104)]
    items = spark.createDataFrame(rows, "kind string, said string, a_start long, a_end long, text string, text_from long, text_chars long")
    items = items.selectExpr("*", "said AS claim", "'x' AS claim_type", "'crop' AS field")
    assert [r.faults for r in grounding.fulltext_faults(items).collect()] == [[], ["fact_outside_quote"], ["invalid_offsets"]]
    with pytest.raises(Exception, match="not in the part"):
        grounding.fulltext_faults(items.withColumn("text_chars", F.col("text_chars") + 1)).collect()


def test_words_in_order_of_a_long_text(spark):
    frame = spark.createDataFrame([("a c", "a b c"), ("c a", "a b c"), ("", "a"), ("", "a "), ("a a", "a b"), (None, "a"), ("a", None)], "x string, y string")
    assert [r[0] for r in frame.select(documents.token_subsequence(F.col("x"), F.col("y"))).collect()] == [True, False, False, True, False, None, None]
    words = " ".join(f"w{i}" for i in range(200_000))
    began = time.time()
    assert spark.createDataFrame([(words,)], "y string").select(documents.token_subsequence(F.col("y"), F.col("y"))).first()[0]
    assert time.time() - began < 5


def test_findings_match_as_if_all_were_tried(spark):
    """The first free reference with the text, else the first that holds it or lies in it."""
    rng = random.Random(8)
    make = lambda: "".join(rng.choices("abé", k=rng.choice([0, 1, 2, 3, 5, 9, 14])))
    gold, pred = ([(u, i, rng.choice([make(), "ab" * rng.randrange(9), None])) for u in range(30) for i in range(40)] for _ in range(2))
    pred += [(u, 100 + i, t[: rng.randrange(1, 9)] if t else t) for u, i, t in gold if i % 3]
    want = []
    for u in range(30):
        free = {i: t for k, i, t in gold if k == u}
        for _, place, text in sorted((r for r in pred if r[0] == u), key=lambda r: r[1]):
            same = next((i for i, t in free.items() if t == text), None)
            near = next((i for i, t in free.items() if t and text and (t in text or text in t)), None) if same is None else same
            want.append((u, place, near, "exact" if same is not None else "contained" if near is not None else "none"))
            free.pop(near, None)
    schema = "uid long, place long, text string"
    indexed = type("Indexed", (metrics._Free,), {"FEW": 0})
    for u in range(30):
        texts = {i: t for k, i, t in gold if k == u}
        free = indexed(texts)
        for _, _, text in (r for r in pred if r[0] == u and r[2]):
            near = next((i for i, t in texts.items() if t and (t in text or text in t)), None)
            assert free.holding(text) == near
            free.take(near)
            texts.pop(near, None)
    out = metrics.finding_match(spark.createDataFrame(gold, schema), spark.createDataFrame(pred, schema), "uid")
    assert sorted((r.uid, r.pred_place, r.gold_place, r.level) for r in out.collect()) == sorted(want)
    many = metrics._Free({i: f"sentence {i} of many that begin alike {i * 7919 % 10_007}" for i in range(10_000)})
    began = time.time()
    assert [many.holding(f"alike {i * 7919 % 10_007}x") for i in range(10_000)] == [None] * 10_000
    assert time.time() - began < 8


def test_small_files_are_dealt_out(spark, tmp_path):
    """A task opens a bounded number of files, however small they are."""
    for i in range(2000):
        (tmp_path / f"{i}.txt").write_text(str(i))
    out = digests(spark, f"file://{tmp_path}", "*.txt")
    assert out.rdd.getNumPartitions() >= 2
    assert {r.path: r.size for r in out.collect()} == {f"{i}.txt": len(str(i)) for i in range(2000)}


def test_quotes_beside_their_paragraphs(spark, monkeypatch):
    """Documents in a row give what the search by joins gives, with ids of quotes
    and paragraphs that are there twice, nulls and letters that are folded (F4)."""
    rng = random.Random(11)
    texts = ["Yield rose by 12.5 kg", "  rose by\t12.5", "ﬁeld of ３ plots", "field of 3 plots", "", None, "Yield rose"]
    paras = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, 4, None]), rng.choice([1, 2]), rng.choice(texts)) for _ in range(24)]
    said = ["rose by", "rose by 12.5 kg", "field", "ﬁeld of 3", "plots", "", None, "nowhere", "Yieldrose"]
    quotes = [(rng.choice(["a", "b", "c", "d", None]), rng.choice([*range(40), None]), rng.choice([1, 2, 3, 5, None]), rng.choice([1, 2]), rng.choice(said), i) for i in range(160)]
    p = spark.createDataFrame(paras, "doc string, paragraph_id int, page int, text string")
    q = spark.createDataFrame(quotes, "doc string, quote_id int, paragraph_id int, page int, quote string, i int")
    key = ["doc", "quote_id"]
    found = [[tuple(r) for r in documents.bind(q, p, key).orderBy("i").collect()]]
    located = documents._searched(q, p)
    found.append([tuple(r) for r in located.join(documents.bound_texts(located, p, key), key, "left").select(*q.columns, "status", "proposed", "bound").orderBy("i").collect()])
    monkeypatch.setattr(documents, "DIRECT", 200)  # some of the documents
    assert 0 < documents._large(q, p).count() < 3
    found.append([tuple(r) for r in documents.bind(q, p, key).orderBy("i").collect()])
    assert found[0] == found[1] == found[2] and {r[6] for r in found[0]} == {"verified", "relocated", "unverified"}
    assert [tuple(r) for r in documents.relocate(q, p).orderBy("i").collect()] == [r[:8] for r in found[0]]


def test_an_audit_moves_lines_once(spark):
    """Results move with their quotes and orders as rows, whatever the sizes say (F4)."""
    where, set_to = "/root/testdata/sf0.001", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = registry.queries()["response_audit"](spark, where)
        n = len(out.collect())
        assert n == spark.read.parquet(f"{where}/lineitem.parquet").count()
        assert n <= moved_rows(out._jdf.queryExecution().executedPlan()) < 2 * n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", set_to)
