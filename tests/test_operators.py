"""Small literal tables against rules worked out by hand."""

import difflib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from litmill.functions import text as t
from litmill.operators import documents, enrich, grounding, identity, ingest, metrics, plugins, quality, review, sampling
from litmill.operators.components import components, numbered
from litmill.sources import files
from litmill.sources.scratch import Scratch
from litmill.streaming import pages as stream

RECORDS = "pos long, doi string, uid string, title string, publish_year int, tags array<string>"
KEY = lambda: F.trim(F.regexp_replace(F.lower("title"), "[^a-z0-9]+", " "))


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def one(spark, expression, *values):
    """A column function of string columns a, b ... on one row."""
    frame = spark.createDataFrame([values], ", ".join(f"{c} string" for c, _ in zip("abcd", values)))
    return frame.select(expression(*(F.col(c) for c, _ in zip("abcd", values))).alias("x")).first().x


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    found = dict(rows(components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")), "node", "root"))
    assert set(found.values()) == {0, 1000} and found[60] == 0 and len(found) == 111
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).collect() == []


def test_records_merge_through_keys(spark):
    data = [
        (0, "https://doi.org/10.1/A", "u1", "First", 2020, ["a"]),
        (1, "doi: 10.1/a", None, "", 2020, ["b", "a"]),
        (2, None, " U1 ", "Third", 2021, ["c"]),
        (3, None, None, "Same: Title", 2020, []),
        (4, None, None, "same title", 2020, []),
        (5, None, None, "same title", 2021, []),
        (6, None, None, None, None, None),
        (7, "10.1/x", "u9", "x", 2020, []),
        (8, "10.1/y", "u9", "y", 2020, []),
        (9, None, "u9", "x", 2020, []),
    ]
    table = spark.createDataFrame(data, RECORDS)
    assert rows(identity.uid_conflicts(table), "uid", "doi_candidates") == [("U9", ["10.1/x", "10.1/y"])]
    groups = identity.identity_groups(table.repartition(4), KEY())
    assert dict(rows(groups, "pos", "group")) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9}
    merged = {r.group: r for r in identity.merge_groups(table.join(groups, "pos"), ["title", "uid"], ["tags"]).collect()}
    assert (merged[0].title, merged[0].tags, merged[0].copies) == ("First", ["a", "b", "c"], 3)


@pytest.mark.parametrize("parts", [1, 4])
def test_order_not_partitions_decides(spark, parts):
    table = spark.createDataFrame([(1, 5, "late", False), (1, 2, "early", False), (1, 3, "good", True), (2, 9, "z", False), (2, 1, "a", False)], "k int, pos int, v string, ok boolean").repartition(parts)
    assert rows(identity.keep_first(table, ["k"], ["pos"]), "k", "v") == [(1, "early"), (2, "a")]
    assert rows(identity.last_that(table, "k", "pos", F.col("ok"), True, ["v"]), "k", "v") == [(1, "good"), (2, "a")]
    assert rows(identity.last_that(table, "k", "pos", F.col("ok"), False, ["v"]), "k", "v") == [(1, "good"), (2, "z")]


def test_keys_and_text_functions(spark):
    assert one(spark, t.normalize_doi, " HTTPS://dx.doi.org/10.1234/AbC ") == "10.1234/abc"
    assert one(spark, t.normalize_doi, "\t10.1234/ab\u00a0\n") == "10.1234/ab"
    assert one(spark, t.normalize_doi, "doi:") is None and one(spark, t.valid_doi, "10.12/x") is False
    assert one(spark, t.title_key, "The  Ｓtraße: A-Test_é") == "the strasse a test é"
    assert one(spark, t.title_key, "A (b)  c!") == "a b c"
    assert one(spark, t.identity_key, "A – /one.tnum/two.tnum") == "a-12"
    assert one(spark, t.find_dois, "see 10.5555/ab). and 10.1234/c;") == ["10.5555/ab", "10.1234/c"]
    assert one(spark, t.slug, " Été 2 & more ") == "t-2-more" and one(spark, t.slug, "!!") == "section"
    assert one(spark, t.formula_guard, " =1+1") == "' =1+1" and one(spark, t.formula_guard, "a=1") == "a=1"
    assert one(spark, t.visible_text, "<p>a&amp;b<script>x</script></p><div>c</div>") == "a&b c"
    assert one(spark, t.visible_text, '<!DOCTYPE x><head><title>t</title></head><b title="a>b">x</b>y<br/>1 < 2 &eacute;<!-- <p> --><STYLE>z</STYLE >!<script>never') == "xy 1 < 2 é!"
    scored = [one(spark, t.similarity, *pair) for pair in (("abcdefghij", "abcdefghiX"), ("ab", "abcdefgh"), ("abcd", "wxyz"), ("x" * 5000, "x" * 5200), ("", "a"))]
    assert scored == [0.9, 0.4, 0.0, 10000 / 10200, 0.0]
    long = " ".join(f"w{i}" for i in range(2000))
    assert one(spark, t.changed_blocks, long, long.replace("w700 ", "").replace("w710 ", "new ")) == ["delete: w700 -> ", "replace: w710 -> new"]
    assert one(spark, lambda a, b: t.unique_position(a, b), "abcab", "ab") is None
    assert one(spark, lambda a, b: t.unique_position(a, b), "x🙂bc", "bc") == 2
    assert one(spark, t.public_url, "https://a.org/x?token=1&b=2#f") == "https://a.org/x?b=2"
    for said, kept in (("HTTPS://a.org/x", "https://a.org/x"), ("https://a.org/?%74oken=s&a=b+c&d", "https://a.org/?a=b+c&d="), ("https://8.8.8.8:443/p;q", "https://8.8.8.8:443/p;q"), ("https://[2600::1]/x?u=~*%2F%", "https://[2600::1]/x?u=~%2A%2F%25"), ("https://@a.org", "https://@a.org")):
        assert one(spark, t.public_url, said) == kept
    private = ("https://[::1]/x", "https://100.64.0.1/x", "https://192.0.2.9/", "https://[fd00::1]/", "https://[::1/", "https://metadata.google.internal/", "https://x.Local/", "https://sci-hub.se/x", "https://a.org/?%73ig=1", "https:///x", "a.org/x")
    for url in (*private, "http://a.org/", "https://u:p@a.org/", "https://localhost/", "https://10.0.0.1/", "https://a.org/?X-Amz-Signature=1", None):
        assert one(spark, t.public_url, url) is None
    assert one(spark, t.section_scope, "Materials and Methods") == "methods" and one(spark, t.section_scope, "Intro") == "other"
    assert one(spark, t.zoned, "2024-01-01T00:00:00+02:00") and not one(spark, t.zoned, "2024-01-01T00:00:00") and not one(spark, t.zoned, "not a time Z")
    assert one(spark, lambda a: t.sentence(a, F.lit(8), F.lit(10)), "One. Two three? Four.") == " Two three?"
    assert round(one(spark, t.similarity, "abcd", "bcde"), 2) == 0.75 and one(spark, t.similarity, "", "x") == 0
    assert one(spark, t.changed_blocks, "a b c", "a x c") == ["replace: b -> x"]


def test_text_gate_limits(spark):
    said = {"": "empty", "a" * 119: "short", "a" * 120: "ok", "a" * 60_001: "oversized", "<p>" + "a" * 200: "markup", "1" * 90 + "a" * 40: "few_letters", "a" * 200 + "\x01" * 5: "control_characters"}
    said |= {"a" * 110 + " " * 15: "short", "\u2003\n": "empty", "<!-- x -->" + "a" * 200: "ok", "a < b and c> " + "a" * 200: "ok", "</P>" + "a" * 200: "markup", "a" * 200 + " " * 60_000: "oversized", "a" * 200 + " " * 380: "few_letters"}
    for text, why in said.items():
        assert one(spark, quality.text_gate, text) == why
    assert one(spark, quality.text_gate, None) == "empty"


def test_validation_folds_titles_and_dois(spark):
    """Spellings of one title and DOI are accepted, other ones are not."""
    text = "An abstract of a paper on salt stress in rice. " * 4
    kinds = "i int, doi string, title string, publish_year int, candidate_doi string, candidate_title string, candidate_year int, candidate_text string, parse_warning string"
    data = [
        (0, "10.1/a", "SALT STRESS IN RICE, A REVIEW", 2020, "https://doi.org/10.1/A", "Salt stress in rice: a review", 2020, text, None),
        (1, "DOI: 10.1/a", "Salt &amp; rice", 2020, "10.1/a", "<i>Salt</i> &amp; rice ", 2021, text, ""),
        (2, "10.1/a", "Ｗｉｄｅ straße", 2020, "10.1/a", "wide STRASSE", None, text, "odd page"),
        (3, "10.1/a", "Salt stress in rice", 2020, "10.1/b", "Growth of maize and its water", 2022, text, None),
        (4, None, None, None, None, None, None, None, None),
        (5, "10.1/a", "Salt stress in rice", 2020, "10.1/a", "Salt stress in the rice", 2019, text, None),
    ]
    got = {r.i: (r.accepted, r.reasons, r.warnings) for r in enrich.validate(spark.createDataFrame(data, kinds)).collect()}
    assert got == {
        0: (True, [], []),
        1: (False, ["title_mismatch"], ["publication_year_differs"]),  # an entity in a record's own title is text
        2: (True, [], ["year_missing", "odd page"]),
        3: (False, ["doi_mismatch", "title_mismatch", "year_mismatch"], ["publication_year_differs"]),
        4: (False, ["doi_mismatch", "title_missing", "text_unusable"], ["year_missing"]),
        5: (True, [], ["publication_year_differs"]),
    }


def test_candidates_agree_without_regard_to_case(spark):
    """Capitals and signs are no conflict; of texts that differ the ratio itself is told."""
    one_text = "Salt stress in rice; a study."
    data = [(1, 1, one_text), (1, 2, one_text.upper() + "!!"), (2, 1, one_text), (2, 2, "Growth of maize."), (3, 1, one_text)]
    pairs = enrich.agreement(spark.createDataFrame(data, "pos int, priority int, candidate_text string"), "pos")
    ratio = round(difflib.SequenceMatcher(None, "salt stress in rice a study", "growth of maize", autojunk=False).ratio(), 6)
    assert {(r.pos, r.a, r.b): r.similarity for r in pairs.collect()} == {(1, 1, 2): 1.0, (2, 1, 2): ratio} and ratio < 0.6
    records = spark.createDataFrame([(1, "d", None), (2, "d", "old"), (3, "d", None)], "pos int, doi string, previous string")
    answers = spark.createDataFrame([(*r, f"p{r[1]}", True, False) for r in data], "pos int, priority int, candidate_text string, provider string, accepted boolean, failed boolean")
    out = {r.pos: (r.status, r.provider, r.abstract) for r in enrich.select_source(records, answers, pairs, "pos").collect()}
    assert out == {1: ("found", "p1", one_text), 2: ("conflict", None, "old"), 3: ("found", "p1", one_text)}


def test_candidates_and_selection(spark):
    good = "a" * 150
    data = [(1, "10.1/a", "T", 2020, "10.1/a", "T", 2021, good, "p1", 1, False), (1, "10.1/a", "T", 2020, "10.1/a", "T", None, good[:-40] + "b" * 40, "p2", 2, False), (2, "10.1/b", "T", 2020, "10.1/b", None, 2020, good, "p1", 1, True), (3, "10.1/c", "T", 2020, "10.1/c", "Other", 2022, "x", "p1", 1, False)]
    table = spark.createDataFrame(data, "k long, doi string, title string, publish_year int, candidate_doi string, candidate_title string, candidate_year int, candidate_text string, provider string, priority int, failed boolean")
    out = enrich.validate(table)
    assert [tuple(r.reasons) for r in out.orderBy("k", "priority").collect()] == [(), (), ("title_missing",), ("title_mismatch", "year_mismatch", "text_unusable")]
    records = spark.createDataFrame([(1, "10.1/a", None), (2, "10.1/b", None), (3, "10.1/c", "old"), (4, None, "x")], "k long, doi string, previous string")
    chosen = enrich.select_source(records, out, enrich.agreement(out.where("accepted"), "k"), "k")
    assert dict(rows(chosen, "k", "status")) == {1: "conflict", 2: "missing_with_errors", 3: "retained_previous", 4: "no_doi"}


def test_batches_prove_absence_only_when_complete(spark):
    asked = spark.createDataFrame([(1, "a", 2), (1, "b", 2), (1, "c", 2), (2, "d", 3)], "batch int, k string, declared int")
    answers = spark.createDataFrame([(1, "a", "x"), (1, "z", "y"), (2, "e", "1"), (2, "e", "2")], "batch int, k string, payload string")
    assert dict((r.k, r.outcome) for r in enrich.map_batch(asked, answers, "batch", "k", "payload").collect()) == {"a": "found", "b": "not_found", "c": "not_found", "z": "unexpected", "d": "error", "e": "unexpected"}
    words = spark.createDataFrame([(1, "b", 1), (1, "a", 0), (2, "x", 0), (2, "y", 2), (3, "x", 0), (3, "y", 0)], "k int, word string, position int")
    assert rows(enrich.rebuild_text(words, "k"), "k", "text") == [(1, "a b"), (2, None), (3, None)]


def test_grounding_counts_code_points(spark):
    data = [(1, "🙂abc", 1, 3, "ab"), (2, "abc", 2, 2, ""), (3, "abc", 1, 9, "bc"), (4, None, 0, 1, "a"), (5, "abc", 0, 2, "bc")]
    table = spark.createDataFrame(data, "uid int, text string, a_start int, a_end int, quote string")
    faults = {r.uid: r.faults for r in grounding.ground(table).collect()}
    assert faults == {1: [], 2: ["invalid_offsets"], 3: ["invalid_offsets"], 4: ["source_missing"], 5: ["quote_mismatch"]}
    assert {r.uid: (r.new_start, r.repair) for r in grounding.repaired(table.where("uid in (1, 5)")).collect()} == {1: (1, "unchanged"), 5: (1, "moved")}


def test_scales_and_roles(spark):
    assert one(spark, grounding.scales_in, "A Field experiment and a pot study") == ["field", "pot"]
    assert one(spark, lambda a: grounding.role_projection(F.array(a), F.lit("/evidence/study_system/x")), "Review").system_value_role == "scope_descriptor"


def test_metric_rules(spark):
    counts = spark.createDataFrame([(0, 0, 0), (0, 2, 0), (0, 0, 2), (1, 1, 1)], "tp long, fp long, fn long")
    got = {(r.tp, r.fp, r.fn): (r.precision, r.recall, r.f1) for r in metrics.with_prf(counts).collect()}
    assert got == {(0, 0, 0): (1, 1, 1), (0, 2, 0): (0, 1, 0), (0, 0, 2): (0, 0, 0), (1, 1, 1): (0.5, 0.5, 0.5)}
    gold = spark.createDataFrame([(1, "x", 0), (1, "x", 1), (1, "y", 2)], "uid int, value string, place long")
    pred = spark.createDataFrame([(1, "x", 5), (1, "z", 6)], "uid int, value string, place long")
    assert rows(metrics.exact_pairs(gold, pred, ["uid"]), "gold_place", "pred_place") == [(0, 5)]
    left = spark.createDataFrame([(1, 0, "long text here"), (1, 1, "text")], "uid int, place long, text string")
    right = spark.createDataFrame([(1, 0, "text here"), (1, 1, "text")], "uid int, place long, text string")
    assert rows(metrics.finding_match(left, right, "uid"), "pred_place", "gold_place", "level") == [(0, 0, "contained"), (1, 1, "exact")]


def test_boundary_rules(spark):
    """Pairs that the rules accept or refuse, one document each."""
    source = "Soil organic carbon, paddy field yield and carbon soil data"
    cases = [
        ("carbon", (0, 20), "organic carbon", (5, 20), "boundary"),  # a comma after the word
        ("ORGANIC  Carbon", (0, 20), "organic carbon", (30, 45), "exact"),
        ("organic carbon", (0, 19), "carbon organic", (0, 20), None),  # the same number of words, another order
        ("soil carbon", (0, 19), "soil organic carbon", (0, 19), "boundary"),
        ("carbon", (0, 19), "organic carbon", (43, 59), None),  # quotes apart
        ("carbon", (0, 19), "organic carbon", (0, 999), None),  # no slice of the source
        ("paddy yield", (21, 38), "field yield", (21, 38), None),
        ("paddy field", (21, 38), "field yield", (20, 42), "boundary"),  # one quote within the other
        ("%", (0, 19), "% carbon", (0, 20), None),
    ]
    schema = "uid int, field string, place long, value string, quote string, a_start long, a_end long, source_text string"
    make = lambda v, q: spark.createDataFrame([(i, "f", 0, c[v], source[slice(*c[q])], *c[q], source) for i, c in enumerate(cases)], schema)
    found = {r.uid: r.level for r in metrics.boundary_match(make(0, 1), make(2, 3), ["uid", "field"]).collect()}
    assert found == {i: c[4] for i, c in enumerate(cases) if c[4]}
    scale = metrics.boundary_match(make(0, 1), make(2, 3), ["uid", "field"], scale=F.col("field") == "f")
    assert scale.collect() == []


def test_error_classes(spark):
    m = "/evidence/measurements/"
    cases = [(m + "plant_growth", "FP", m + "other", "WRONG_CATEGORY"), (m + "plant_growth", "FN", m + "other", "PLANT_TO_OTHER"), (m + "other", "FP", m + "carbon", "CARBON_ROUTING"), ("/t/treatments/irrigation", "FP", None, "REVIEW_ATTRIBUTION"), ("/t/treatments/irrigation", "FN", None, "TRUE_OMISSION"), ("/s/soil_type", "FP", None, "TRUE_OVEREXTRACTION")]
    table = spark.createDataFrame([(*c, ["Article", "REVIEW"]) for c in cases], "p string, k string, r string, want string, types array<string>")
    assert [r for r in table.select("want", metrics.error_class(F.col("p"), F.col("k"), F.col("r"), F.col("types")).alias("got")).collect() if r.want != r.got] == []
    texts = [("a paddy field", ["x"], "land-use ambiguity"), ("pot", ["x"], "explicit studied-soil descriptor"), ("any", ["Review"], "review scope"), ("the site", [], "actual-system linkage missing"), ("none", [], "worker abstention")]
    table = spark.createDataFrame(texts, "t string, types array<string>, want string")
    assert [r for r in table.select("want", metrics.soil_miss_class(F.col("t"), F.col("types")).alias("got")).collect() if r.want != r.got] == []
    assert one(spark, metrics.physiology_class, "Na+ and proline") == "plant_ions" and one(spark, metrics.physiology_class, "x") == "other_physiology"
    assert one(spark, lambda c: metrics.salinity_class(F.lit("FN"), c, F.array(F.lit("a"))), "Salt stress") == "treatment-induced salinity"
    assert one(spark, lambda c: metrics.salinity_class(F.lit("FP"), c, F.array(F.lit("review"))), "x") == "review_scope_errors"


def test_boundary_pairs_follow_shared_source(spark):
    schema = "uid int, field string, place long, value string, quote string, a_start long, a_end long, source_text string"
    source = "Soil organic carbon was measured in paddy fields"
    gold = spark.createDataFrame([(1, "f", 0, "soil organic carbon", source[:19], 0, 19, source), (1, "f", 1, "paddy", source[36:41], 36, 41, source)], schema)
    pred = spark.createDataFrame([(1, "f", 0, "organic carbon", source[5:19], 5, 19, source), (1, "f", 1, "paddy", source[:4], 0, 4, source), (1, "f", 2, "fields", source[42:], 42, 48, source)], schema)
    assert rows(metrics.boundary_match(gold, pred, ["uid", "field"]), "gold_place", "pred_place", "level") == [(0, 0, "boundary"), (1, 1, "exact")]


def test_reviews(spark):
    tasks = spark.createDataFrame([("x", 1, "h"), ("x", 2, "h"), ("x", 3, "h"), ("x", 4, "h")], "type string, uid int, object_sha256 string")
    answers = spark.createDataFrame([("x", 1, "h", "k"), ("x", 2, "old", "k"), ("x", 3, "h", "k"), ("x", 3, "h", "k"), ("x", 9, "h", "k")], "type string, uid int, object_sha256 string, decision string")
    assert dict(rows(review.decisions_on_tasks(tasks, answers), "uid", "state")) == {1: "ok", 2: "object_changed", 3: "answered_twice", 4: "unanswered", 9: "unknown_task"}
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b", "b"]), (3, ["c"])], "k int, items array<string>")
    decided = spark.createDataFrame([(1, "a", ["b"]), (2, "a", ["b"])], "k int, keep string, remove array<string>")
    assert dict((r.k, r.after) for r in review.apply_decisions(lists, decided, "k").collect()) == {1: ["a"], 2: ["a", "b", "b"], 3: ["c"]}
    numbered = review.case_numbers(spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "f string, n int"), ["f", "n"])
    assert rows(numbered, "case_id", "f", "n") == [("F001", "a", 1), ("F002", "a", 2), ("F003", "b", 1)]


def test_documents(spark):
    xml = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head>Methods</head><p>a  <b>b</b></p></div><div><head>Plots</head><p>c</p><p>d</p></div></body></text></TEI>'
    parsed = documents.parse_tei(spark.createDataFrame([(1, xml)], "doc int, xml string"))
    assert rows(parsed, "section_ord", "para_ord", "text") == [(0, 0, "a b"), (1, 0, "c"), (1, 1, "d")]
    sections = parsed.select("doc", "section_ord", "heading").distinct()
    assert rows(documents.carried_scope(sections, "heading"), "section_ord", "scope") == [(0, "methods"), (1, "methods")]
    paragraphs = spark.createDataFrame([(1, 0, 0, "a" * 25), (1, 0, 1, "b" * 3), (1, 1, 0, "c")], "doc int, section_ord int, para_ord int, text string")
    assert rows(documents.chunks(paragraphs, 10), "section_ord", "char_start", "chars", "chunk") == [(0, 0, 10, 0), (0, 0, 3, 2), (0, 10, 10, 1), (0, 20, 5, 2), (1, 0, 1, 0)]
    for said, status in {"(5 - 4) / 4 × 100 = 25%": "consistent", "(5 - 4) / 4 x 100 = 26%": "mismatch", "(5 - 4) / 0 * 100 = 1%": "zero_denominator", "none": "no_formula"}.items():
        assert one(spark, documents.percent_check, said) == status
    assert one(spark, documents.letter_conflict, "a vs A", "significant") and not one(spark, documents.letter_conflict, "a vs a", "not significant")
    assert one(spark, documents.token_subsequence, "a c", "a b c") and not one(spark, documents.token_subsequence, "c a", "a b c")
    assert one(spark, lambda a: documents.heading_span(a)[1], "Abstract\nshort.\nKeywords: x") == "length"


def test_packing_and_samples(spark):
    records = spark.createDataFrame([(i, 10) for i in range(20)] + [(20, 70_000), (21, 10)], "pos long, size long")
    out = sampling.pack_batches(records)
    assert [r["n"] for r in out.groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch").collect()] == [8, 8, 4, 1, 1]
    pool = spark.createDataFrame([(i, 2020 + i % 3, "t", ["q"], f"j{i % 4}") for i in range(40)], "k long, year int, type string, queries array<string>, journal string")
    picks = [rows(sampling.stratified(pool.repartition(n), "k", 6, 1), "k", "year", "journal") for n in (1, 3)]
    assert picks[0] == picks[1] and len({j for _, _, j in picks[0]}) == 4 and len({y for _, y, _ in picks[0]}) == 3
    tagged = spark.createDataFrame([("b", ["x"], "p"), ("a", ["x"], "p"), ("c", ["x", "y"], "p"), ("d", [], "q")], "k string, tags array<string>, pre string")
    assert rows(sampling.coverage_sample(tagged, "k", "tags", "pre", 3), "pick", "k") == [(0, "c"), (1, "d"), (2, "a")]


def test_sources_refuse_to_guess(spark, tmp_path):
    (tmp_path / "ok.json").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert rows(files.read_strict_json(spark, f"{tmp_path}/ok.json", "a int"), "a") == [(1,), (2,)]
    (tmp_path / "bad.json").write_text('{"a": 1}\nnot json\n')
    with pytest.raises(Exception):
        files.read_strict_json(spark, f"{tmp_path}/bad.json", "a int").collect()
    assert files.read_reporting_json(spark, f"{tmp_path}/bad.json", "a int").cache().where("_corrupt_record is not null").count() == 1
    frame = spark.createDataFrame([(1, " x ")], "a int, b string")
    files.write_new_json(frame, f"{tmp_path}/new")
    with pytest.raises(Exception):
        files.write_new_json(frame, f"{tmp_path}/new")
    with pytest.raises(KeyError):
        plugins.extract("none", frame, ["a"])


def test_caps_and_statuses(spark):
    table = spark.createDataFrame([("q", i, i % 3, i // 2) for i in range(5)], "q string, seq int, hit int, page int")
    assert rows(ingest.capped(table, "q", 3), "total", "kept", "omitted", "stop") == [(5, 3, 2, "record_cap")]
    assert rows(ingest.cumulative_unique(table, "q", "page", "hit"), "page", "new", "unique_so_far") == [(0, 2, 2), (1, 1, 3), (2, 0, 3)]
    assert isinstance(ingest.overlap_pairs(table, "hit", "page").toPandas(), pd.DataFrame)


def test_token_subsequence_reads_whole_texts(spark, tmp_path, monkeypatch):
    from litmill.plans import documents as plans

    texts = [(i, " ".join(f"w{i}" for i in range(n))) for i, n in enumerate((1, 60, 61, 5000))] + [(4, None), (5, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(plans.token_subsequence(spark, str(tmp_path)), "doc_id", "within") == [(i, i % 2 == 0) for i in (0, 1, 2, 3, 5)]
    monkeypatch.setattr(plans.ops, "token_subsequence", lambda a, b: F.size(F.split(b, " ")))
    assert rows(plans.token_subsequence(spark, str(tmp_path)), "doc_id", "within") == [(0, 1), (1, 60), (2, 61), (3, 5000), (5, 1)]


def test_places_count_over_ranges(spark):
    table = spark.createDataFrame([("a", i) for i in range(700)] + [(None, i) for i in range(20)] + [("b", 5)], "q string, i int").repartition(7)
    found = numbered(table, ["i"], ["q"])
    assert {(r.q, r.i, r.place) for r in found.collect()} == {("a", i, i + 1) for i in range(700)} | {(None, i, i + 1) for i in range(20)} | {("b", 5, 1)}
    assert [r.place for r in numbered(table.where("q = 'a'"), ["i"]).orderBy("i").collect()] == list(range(1, 701))
    assert numbered(table.limit(0), ["i"], ["q"]).count() == 0


def test_runs_end_for_the_first_reason(spark):
    """Pages of two hits: reached total, cap of records, cap of pages, and a changed total."""
    hits = [("all", i, i // 2 + 1, 4) for i in range(4)] + [("cap", i, i // 2 + 1, 20) for i in range(20)] + [("same", 1, i // 2 + 1, 20) for i in range(20)] + [("odd", i, i // 2 + 1, 4 + i // 2) for i in range(4)] + [("odd", 9, 3, 5)]
    out = ingest.capped_runs(spark.createDataFrame(hits, "q string, hit int, page int, total int"), "q", "page", "hit", "total", 2, 5, 4)
    assert rows(out, "q", "stop_reason", "pages", "collected", "omitted", "duplicates", "complete") == [
        ("all", "total_exhausted", 2, 4, 0, 0, True),
        ("cap", "record_cap", 3, 5, 1, 0, False),
        ("odd", "total_exhausted", 2, 4, 0, 0, False),
        ("same", "page_cap", 4, 1, 0, 7, False),
    ]


def test_pages_are_summed_over_blocks(spark):
    """Two hits a page, one of them new, over more pages than a block holds."""
    table = spark.range(2500).selectExpr("'q' as q", "id as page", "explode(array(id, 0)) as hit")
    found = {r.page: (r.new, r.unique_so_far) for r in ingest.cumulative_unique(table, "q", "page", "hit").collect()}
    assert found == {i: (1, i + 1) for i in range(2500)}


def test_documents_fail_by_the_first_rule(spark):
    records = spark.createDataFrame([(1, "a field trial of rice", "include"), (2, "a field trial of rice", "include"), (3, None, "needs_fulltext"), (4, "", "include"), (5, None, "needs_fulltext"), (6, "rice", "include")], "k int, text string, screening string")
    facts = spark.createDataFrame([(1, "/evidence/study_system/experimental_scale", "field"), (1, "/evidence/crop/0", "RICE"), (2, "/evidence/study_system/experimental_scale", "pot"), (2, "/evidence/crop/0", "maize"), (5, "/evidence/crop/0", "x")], "k int, pointer string, value string")
    supports = spark.createDataFrame([(k, "/evidence/study_system/experimental_scale", "a field trial", 0, 13) for k in (1, 2)] + [(k, "/evidence/crop/0", "rice", 17, 21) for k in (1, 2)] + [(6, "/evidence/crop/0", "rice", 0, 9)], "k int, pointer string, quote string, a_start int, a_end int")
    findings = spark.createDataFrame([(1, 0, "rice", "of rice", 14, 21), (6, 0, "rice", "rice", 0, 9)], "k int, place int, claim string, quote string, a_start int, a_end int")
    anchors = spark.createDataFrame([(1, "/evidence/findings/0"), (1, "/evidence/crop/0"), (6, "/inference/0")], "k int, pointer string")
    out = grounding.document_faults(records, facts, supports, findings, anchors, "k")
    assert rows(out, "k", "first_fault", "n_faults") == [(1, None, 0), (2, "scale_unsupported", 2), (3, None, 0), (4, "fulltext_not_asked", 1), (5, "content_without_text", 1), (6, "orphan_support", 3)]


def test_findings_keep_their_anchors(spark):
    found = grounding.dedup_findings(spark.createDataFrame([(1, 0, "s", "x"), (1, 1, "s", "x"), (1, 2, "s", "y"), (1, 3, "t", "x")], "k int, place int, source string, evidence_text string"), "k")
    assert rows(found, "place", "new_place") == [(0, 0), (1, 0), (2, 1), (3, 2)]
    anchors = spark.createDataFrame([(1, 0, 0, "/evidence/findings/1"), (1, 0, 1, "/evidence/findings/0"), (1, 0, 2, "/evidence/findings/3"), (1, 0, 3, "/evidence/crop/0"), (1, 0, 4, "/evidence/findings/7")], "k int, item int, pos int, pointer string")
    assert rows(grounding.remapped(anchors, found, "k"), "pos", "pointer") == [(0, "/evidence/findings/0"), (2, "/evidence/findings/2"), (3, "/evidence/crop/0"), (4, "/evidence/findings/7")]


def test_pages_advertise_documents(spark):
    html = """<META content='a.pdf?x=1&amp;token=s' name=citation_pdf_url><link href="/b.pdf" type="application/pdf"><link href="/b.pdf" type="application/pdf"><link type="text/css" href="c"><a href="/d.pdf">d</a><link type="application/pdf" href="https://127.0.0.1/e.pdf"><link type="application/pdf" href="f.pdf">"""
    pages = spark.createDataFrame([(1, "https://h.org/p/q", html), (2, "https://h.org/", None), (3, "ftp://h.org/", html)], "k int, url string, html string")
    assert rows(documents.pdf_links(pages, "k", "html", "url"), "k", "links") == [(1, ["https://h.org/p/a.pdf?x=1", "https://h.org/b.pdf"]), (2, []), (3, [])]


def test_tei_parts_and_faults(spark):
    good = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt></fileDesc><profileDesc><abstract><p>A b</p></abstract></profileDesc></teiHeader><text><body><p>loose</p><div><head>H</head><p>c</p><figure><head>F</head><figDesc>plot</figDesc></figure></div></body><back><listBibl><bibl>R 1</bibl></listBibl></back></text></TEI>'
    parsed = documents.parse_tei(spark.createDataFrame([(1, good), (2, "<TEI>"), (3, None), (4, '<!DOCTYPE x [<!ENTITY a "b">]><x>&a;</x>')], "doc int, xml string"))
    assert rows(parsed.where("doc = 1"), "part", "section_ord", "heading", "text") == [("abstract", None, None, "A b"), ("caption", 0, "F", "plot"), ("paragraph", -1, None, "loose"), ("paragraph", 0, "H", "c"), ("reference", None, None, "R 1"), ("title", None, None, "T")]
    assert rows(parsed.where("doc > 1"), "doc", "part") == [(2, "malformed"), (3, "malformed"), (4, "malformed")]


def test_streams_go_on_where_they_were(spark, tmp_path):
    """A second run reads only what came since, and merges it with what was known."""
    table, home, schema = f"{tmp_path}/in", f"file://{tmp_path}/home", "k string, seq int, v string"
    write = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(table)
    write([("a", 5, "five"), ("b", 2, "two")])
    assert rows(stream.merged_pages(spark, table, schema, ["k"], "seq", home=f"{home}/m"), "k", "v") == [("a", "five"), ("b", "two")]
    assert rows(stream.last_status(spark, table, schema, "k", "v", "seq", home=f"{home}/s"), "k", "v", "n") == [("a", "five", 1), ("b", "two", 1)]
    write([("a", 3, "three"), ("c", 1, "one")])
    for _ in range(2):  # the second time there is nothing new
        assert rows(stream.merged_pages(spark, table, schema, ["k"], "seq", home=f"{home}/m"), "k", "v") == [("a", "three"), ("b", "two"), ("c", "one")]
        assert rows(stream.last_status(spark, table, schema, "k", "v", "seq", home=f"{home}/s"), "k", "v", "n") == [("a", "five", 2), ("b", "two", 1), ("c", "one", 1)]


def test_batches_of_keys_rewrite_only_their_buckets(spark, tmp_path):
    """Files of buckets that no key of a batch falls in stay as they are; a batch that runs again changes nothing."""
    table, home, schema = f"{tmp_path}/in", f"{tmp_path}/home", "k string, seq int, v string"
    write = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(table)
    held = lambda: {f.parent.name + f.name for f in (tmp_path / "home" / "m" / "merged").rglob("*.parquet")}
    run = lambda: rows(stream.merged_pages(spark, table, schema, ["k"], "seq", home=f"file://{home}/m", buckets=32), "k", "seq", "v")
    write([(f"k{i}", i + 10, "old") for i in range(200)])
    assert len(run()) == 200
    before = held()
    assert len(before) == 32
    write([("k7", 1, "new"), ("k8", 99, "later"), ("z", 5, "z")])
    want = sorted([(f"k{i}", i + 10, "old") for i in range(200) if i != 7] + [("k7", 1, "new"), ("z", 5, "z")], key=str)
    assert run() == want
    after = held()
    assert len(before - after) <= 3 and len(after - before) <= 3 and len(before & after) >= 29
    assert run() == want and held() == after  # nothing new came
    again = stream.Buckets(spark, f"file://{home}/m/merged", stream._schema(spark, schema), ["k"], 32)
    batch = spark.createDataFrame([("k7", 1, "new")], schema)
    for _ in range(2):
        again.merge(batch, 9, lambda known, new: known.unionByName(new).groupBy("k").agg(F.min_by(F.struct("seq", "v"), "seq").alias("r")).select("k", "r.*"))
        assert rows(again.read(), "k", "seq", "v") == want
