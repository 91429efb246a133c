"""Rules of records, results and full texts on small tables, and sinks on small files."""

import hashlib
import random
from collections import namedtuple

from pyspark.sql import functions as F

from litmill.operators import documents, grounding, ingest, metrics, plugins, quality, review, sampling
from litmill.sources import digests, files

NONE = "cast(array() as array<string>)"


def test_triage_tells_incidents_from_issues(spark):
    """A provider's failure is no issue of a record; a year outside the query is for a reader."""
    answers = "array<struct<provider:string,status:string>>"
    data = [
        (1, ["publication_year_outside_query_range"], ["rice_paddy", "salinity"], "sourced", "accepted", [("a", "error"), ("b", "found"), ("c", "parse_error")]),
        (2, [], ["water"], "missing", "not_available", []),
        (3, ["admission:pdf_identity_x", "admission:late", "duplicate_doi"], [], "needs_source_review", None, None),
    ]
    rows = spark.createDataFrame(data, f"i int, issues array<string>, tags array<string>, state string, admission string, answers {answers}")
    got = {r.i: r.t for r in rows.select("i", quality.triage(F.col("issues"), F.col("tags"), F.col("state"), F.col("admission"), F.col("answers")).alias("t")).collect()}
    assert got[1].scientific == ["screening_pending", "publication_year_rule_review"] and got[1].completeness == []
    assert [tuple(x) for x in got[1].incidents] == [("a", "error"), ("c", "parse_error")] and got[1].identity == got[1].content == []
    assert got[2].completeness == ["abstract_missing", "fulltext_unavailable"] and got[2].scientific == ["screening_pending"] and got[2].priority == "medium_review"
    assert got[3].identity == ["admission:pdf_identity_x", "duplicate_doi"] and got[3].content == ["admission:late"] and got[3].completeness == ["abstract_source_missing"]


def test_themes_context_and_anchors(spark):
    row = spark.sql("SELECT array('x') AS water, cast(null as array<string>) AS yields, array('yield', 'odd', 'irrigation') AS stated, array('Saline SOIL', 'x') AS soil, array('/crop/0') AS system, array('m', 'n') AS methods")
    out = row.select(
        quality.themes({"irrigation": F.col("water"), "yield": F.col("yields")}, F.col("stated"), ("yield", "irrigation")).alias("themes"),
        quality.in_context(F.col("soil"), ("saline soil",)).alias("saline"),
        quality.in_context(F.col("yields"), ("a",)).alias("nothing"),
        quality.evidence_anchors(F.lit(None).cast("array<string>"), F.col("system"), {"methods": F.col("methods"), "findings": F.col("yields")}).alias("anchors"),
    ).first()
    assert out.themes == ["irrigation", "yield"] and out.saline and not out.nothing
    assert out.anchors == ["/fulltext_evidence/crop/0", "/fulltext_evidence/methods/0", "/fulltext_evidence/methods/1"]


def test_a_history_names_the_file_of_its_row(spark):
    entry = "array<struct<query_id:string,query:string,database:string,processed_source_file:string>>"
    data = [(1, []), (2, [("q", "x", "d", None), ("q", "x", "d", None)]), (3, [("q", "x", "d", "first")]), (4, [("other", "x", "d", None)])]
    rows = spark.createDataFrame(data, f"i int, history {entry}").selectExpr("i", "history", "'x' AS query", "'d' AS database", "'q' AS own_id", f"{NONE} AS matched_queries")
    out = ingest.prepare_provenance(rows, F.lit(None).cast("string"), F.lit("file.json"))
    got = {r.i: [(h.query_id, h.processed_source_file) for h in r.history] for r in out.collect()}
    assert got == {1: [("q", "file.json")], 2: [("q", "file.json"), ("q", None)], 3: [("q", "first")], 4: [("other", None), ("q", "file.json")]}


def test_results_against_their_bound_paragraphs(spark):
    paras = spark.createDataFrame([("d", "p1", 1, "Yield rose by 12.5 kg/hm2."), ("d", "p2", 1, "Depth was -3 mm · d of water"), ("d", "p3", 2, "nothing")], "doc string, paragraph_id string, page int, text string")
    quotes = spark.createDataFrame([("d", "r1", 1, "p1", 1, "rose by 12.5"), ("d", "r1", 2, "p3", 2, "Depth was"), ("d", "r2", 1, "p9", 1, "nowhere"), ("d", "r3", 1, "p3", 1, "nothing")], "doc string, path string, quote_id int, paragraph_id string, page int, quote string")
    located = documents.relocate(quotes.withColumn("quote_id", F.concat_ws("-", "path", "quote_id")), paras)
    bound = documents.bound_texts(located, paras, ["doc", "path"])
    assert {r.path: r.bound for r in bound.collect()} == {"r1": "Yield rose by 12.5 kg/hm2. Depth was -3 mm · d of water", "r3": "nothing"}
    data = [
        ("r1", "12.5 and 3", "kg/ha", "p < 0.05", "salt", "none"),
        ("r1", "12.5", "mm/d", "not significant; significant", " ", None),
        ("r1", "99", "dS/m", "unspecified", "x", "not reported"),
        ("r2", "1", None, None, "x", "y"),
        ("r3", "none", "", "p", "x", "y"),
    ]
    results = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, path string, value string, unit string, significance string, treatment string, comparator string")
    got = {r.i: r.issues for r in documents.response_issues(results.join(bound, "path", "left")).collect()}
    assert got == {
        0: [],
        1: ["missing_or_uncertain_treatment", "missing_or_uncertain_comparator", "mixed_significance_language"],
        2: ["numbers_not_in_bound_paragraphs", "missing_or_uncertain_comparator", "missing_or_uncertain_significance", "unit_not_text_verified"],
        3: ["numbers_not_in_bound_paragraphs", "missing_or_uncertain_unit", "missing_or_uncertain_significance"],
        4: ["missing_or_uncertain_unit"],
    }


def test_the_other_route_of_a_missed_item(spark):
    gold = [("d", 1, 0, 5, "Soil Salt"), ("d", 2, 10, 20, "a"), ("d", 3, 30, 40, "STRASSE x"), ("d", 4, 50, 60, "alone"), ("d", 5, None, None, "soil"), ("e", 1, 0, 5, "soil")]
    pred = [("d", 0, None, None, "soil"), ("d", 1, 90, 95, "salt"), ("d", 2, 0, 5, "q"), ("d", 3, 12, 13, "q"), ("d", 4, 10, 20, "q"), ("d", 5, 70, 71, "straße")]
    g, p = spark.createDataFrame(gold, "k string, item int, a_start int, a_end int, value string"), spark.createDataFrame(pred, "k string, place int, a_start int, a_end int, value string")
    got = {(r.k, r.item): (r.place, r.route) for r in metrics.other_routes(g, p, ["k"]).collect()}
    # The first prediction that has anything in common decides, a word before a span as well.
    assert got == {("d", 1): (1, "semantic_only"), ("d", 2): (3, "partial_span"), ("d", 3): (5, "semantic_only"), ("d", 4): (None, None), ("d", 5): (None, None), ("e", 1): (None, None)}


def test_support_of_the_study_system_and_documents_of_anchors(spark):
    docs = spark.createDataFrame([(1, ["rice", "unknown", "", None, "maize"], "field"), (2, [], "unknown")], "uid int, crop array<string>, experimental_scale string")
    supports = spark.createDataFrame([(1, "/study_system/crop/0"), (1, "/study_system/crop/1"), (2, "/study_system/experimental_scale")], "uid int, pointer string")
    got = sorted(tuple(r) for r in grounding.system_support_gaps(docs, supports, "uid", ["crop"], ["experimental_scale"]).collect())
    assert got == [(1, "/study_system/crop/1", "orphan_support"), (1, "/study_system/crop/4", "missing_support"), (1, "/study_system/experimental_scale", "missing_support"), (2, "/study_system/experimental_scale", "orphan_support")]
    items = [(1, "a", "a"), (2, "a", "b"), (3, None, "a")]
    rows = spark.createDataFrame(items, "i int, anchor_sha256 string, document_sha256 string").withColumns({c: F.lit(v) for c, v in {"kind": "fact", "said": "x", "claim": "x", "claim_type": "", "field": "", "a_start": 0, "a_end": 3, "text": "a x b"}.items()})
    assert {r.i: r.faults for r in grounding.fulltext_faults(rows).collect()} == {1: [], 2: ["wrong_document"], 3: ["wrong_document"]}


def test_samples_of_records_without_lists(spark):
    pool = spark.createDataFrame([(1, 2020, "t", None, "j"), (2, 2021, "t", ["q", None], "j"), (3, 2021, None, [], None)], "k long, year int, type string, queries array<string>, journal string")
    assert sampling.stratified(pool, "k", 2, 1).count() == 2
    tagged = spark.createDataFrame([("a", None, "p"), ("b", ["x", None], "p"), ("c", [], "q")], "k string, tags array<string>, pre string")
    assert [tuple(r) for r in sampling.coverage_sample(tagged, "k", "tags", "pre", 3).orderBy("pick").collect()] == [(0, "b"), (1, "c"), (2, "a")]


def test_queues_are_written_once_and_read_apart(spark, tmp_path):
    rows, path = spark.range(100).selectExpr("id", "cast(id AS string) AS text"), f"{tmp_path}/q"
    files.write_queues(rows, {"even": F.col("id") % 2 == 0, "third": F.col("id") % 3 == 0, "none": F.col("id") < 0, "odd one": F.expr("CASE WHEN id = 1 THEN true END")}, path)
    one = files.read_queue(spark, path, rows.schema, "third")
    assert {r.id for r in one.collect()} == set(range(0, 100, 3)) and one.columns == ["id", "text"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(queue" in plan and sorted(p.name for p in (tmp_path / "q").iterdir() if p.is_dir()) == ["queue=even", "queue=odd one", "queue=third"]
    assert files.read_queue(spark, path, rows.schema).count() == 50 + 34 + 1


def test_what_is_observed_is_what_was_written(spark, tmp_path):
    for n, frame in enumerate((spark.range(1000).selectExpr("id", "concat('text ', id) AS text").union(spark.sql("SELECT null, null")).repartition(7), spark.sql("SELECT 1L AS id, 'x' AS text").where("false"))):
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"observed{n}", "")
        seen = files.write_observed(frame, f"{tmp_path}/out{n}", "id", "text").first()
        assert len(jobs.getJobIdsForGroup(f"observed{n}")) <= 4  # the write, with those of its shuffles, and the row itself
        back = files.manifest(spark.read.parquet(f"{tmp_path}/out{n}"), "id", "text").first()
        assert (seen.rows, seen.key_sum, seen.content_sum) == (back.rows, back.key_sum, back.content_sum)
    spark.sparkContext.setJobGroup("", "")


def test_digests_of_files(spark, tmp_path, monkeypatch):
    held = {"a/small.txt": b"x", "a/empty.bin": b"", "b/large.bin": bytes(range(256)) * 70_000, "_SUCCESS": b"1", "b/.hidden": b"2"}
    for name, data in held.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    seen = digests.digests(spark, f"file://{tmp_path}", partition_bytes=1000)
    assert seen.rdd.getNumPartitions() == 2
    want = {n: (hashlib.sha256(d).hexdigest(), len(d)) for n, d in held.items() if n[0] != "_" and "/." not in n}
    assert {r.path: (r.sha256, r.size) for r in seen.collect()} == want
    binary = {r.path.rsplit("/", 1)[1]: r.h for r in spark.read.format("binaryFile").load(f"{tmp_path}/*/*").selectExpr("path", "sha2(content, 256) AS h").collect()}
    assert len(binary) >= 2 and binary.items() <= {n.split("/")[1]: h for n, (h, _) in want.items()}.items()
    assert [r.path for r in digests.digests(spark, f"file://{tmp_path}", "*.txt").collect()] == ["a/small.txt"]
    (tmp_path / "none").mkdir()
    assert digests.digests(spark, f"file://{tmp_path}/none").collect() == []


def test_extractors_yield_any_number_of_rows(spark):
    import litmill.plans.documents  # noqa: F401  registers the extractor

    rows = spark.createDataFrame([(1, "a incomprehensible b unquestionably"), (2, None), (3, "short")], "pos int, abstract string")
    assert sorted(map(tuple, plugins.extract("long_words", rows, ["pos"]).collect())) == [(1, 1, "incomprehensible"), (1, 3, "unquestionably")]
    plugins.publish(spark, "long_words")
    rows.createOrReplaceTempView("some_records")
    assert spark.sql("SELECT r.pos, count(*) AS n FROM some_records r, LATERAL long_words(r.abstract) GROUP BY r.pos").collect()[0].n == 2


def test_links_of_a_page_however_they_are_written(spark):
    from litmill.functions.text import page_links

    page = """<A class="x" HREF='/one'>a</A><a href=two>b</a><abbr href="no"><a data-x="<a href='no'>" href = "https://o.org/3">c</a><a href="">d</a><a name=y><a href='/one'>"""
    row = spark.createDataFrame([(page, "http://h.org/p?q")], "page string, base string")
    assert row.select(page_links(F.col("page"), F.col("base"), 9).alias("x")).first().x == ["http://h.org/one", "two", "https://o.org/3"]


def test_items_of_two_annotators(spark):
    """Against the levels tried one after the other, item by item."""
    text, rng = "the saline soil of the paddy field was flooded " * 3, random.Random(5)

    def items(n):
        out = []
        for place in range(n):
            start = rng.randrange(0, 20) * 3
            end = start + rng.choice([4, 9])
            out.append((rng.choice("de"), rng.choice(["soil", "water", "salt", "crop"]), place, text[start:end].strip() or "x", start, end, text[start:end], text))
        return out

    names = ["uid", "field", "place", "value", "a_start", "a_end", "quote", "source_text"]
    Item = namedtuple("Item", names)
    x, y = ([Item(*r) for r in items(60)] for _ in range(2))
    want = set()
    for uid in "de":
        left, right = [g for g in x if g.uid == uid], [p for p in y if p.uid == uid]
        for level, same in (
            ("exact", lambda g, p: (g.field, g.value) == (p.field, p.value)),
            ("boundary", lambda g, p: g.field == p.field and g.a_start < p.a_end and p.a_start < g.a_end and metrics.boundary_equal(g, p)),
            ("category", lambda g, p: g.field != p.field and (g.a_start, g.a_end) == (p.a_start, p.a_end)),
        ):
            for g in list(left):
                p = next((p for p in right if same(g, p)), None)
                if p:
                    want.add((uid, level, g.field, g.place, p.place))
                    left.remove(g)
                    right.remove(p)
        want |= {(uid, "a_only", g.field, g.place, None) for g in left} | {(uid, "b_only", p.field, None, p.place) for p in right}
    kinds = "uid string, field string, place long, value string, a_start int, a_end int, quote string, source_text string"
    got = {tuple(r) for r in review.pair_compare(spark.createDataFrame(x, kinds), spark.createDataFrame(y, kinds), "uid").select("uid", "level", "field", "a_place", "b_place").collect()}
    assert got == want and {w[1] for w in want} == {"exact", "boundary", "category", "a_only", "b_only"}


def test_a_line_end_that_is_not_ascii_is_white_space(spark):
    from litmill.functions.text import item_key, packed_text

    row = spark.createDataFrame([("A b\u0085",)], "t string").select(item_key(F.col("t")), packed_text(F.col("t"))).first()
    assert tuple(row) == ("a b", "Ab")
