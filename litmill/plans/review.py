"""Queries on review and adjudication."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmill.functions import text as t
from litmill.operators import review as ops
from litmill.plans import adapters as a
from litmill.plans.grounding import sourced_spans
from litmill.plans.registry import query

TASKS = "t AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'y' END AS type, doc_id AS uid, md5(text) AS object_sha256 FROM documents)"


def tasks(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y").alias("type"), F.col("doc_id").alias("uid"), F.md5("text").alias("object_sha256"), "text")


@query(
    "decision_join",
    f"""WITH {TASKS}, d AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'y' END AS type, doc_id + CASE WHEN doc_id % 17 = 0 THEN 10000000 ELSE 0 END AS uid, quality, 1 + CAST(doc_id % 19 = 0 AS INT) AS answers, doc_id % 5 = 0 AS old FROM labels),
j AS (SELECT type, uid, t.object_sha256, d.answers, d.old FROM t FULL JOIN d USING (type, uid))
SELECT type, uid, CASE WHEN object_sha256 IS NULL THEN 'unknown_task' WHEN answers IS NULL THEN 'unanswered' WHEN answers > 1 THEN 'answered_twice' WHEN old THEN 'object_changed' ELSE 'ok' END AS state FROM j""",
)
def decision_join(spark, sf_dir):
    rows = tasks(spark, sf_dir)
    labels = a.table(spark, sf_dir, "labels").join(rows.select(F.col("uid").alias("doc_id"), "object_sha256"), "doc_id")
    doc = F.col("doc_id")
    answers = labels.select(
        F.when(doc % 2 == 0, "x").otherwise("y").alias("type"),
        (doc + F.when(doc % 17 == 0, 10000000).otherwise(0)).alias("uid"),
        F.when(doc % 5 == 0, "old").otherwise(F.col("object_sha256")).alias("object_sha256"),
        F.col("quality").cast("string").alias("decision"),
        F.when(doc % 19 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"),
    )
    return ops.decisions_on_tasks(rows.drop("text"), answers.withColumn("copy", F.explode("copies")).drop("copies", "copy")).select("type", "uid", "state")


@query(
    "decision_rules",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN CASE WHEN value > 20 THEN 'pending_with_data' ELSE '' END ELSE concat_ws(',', CASE WHEN value <= 20 OR event_type = 'error' THEN 'choice_not_allowed' END, CASE WHEN user_id % 10 = 0 THEN 'reviewer_missing' END,
 CASE WHEN event_id % 6 = 0 THEN 'time_without_zone' END, CASE WHEN event_id % 6 = 1 THEN 'time_in_future' END, CASE WHEN value > 20 AND event_type <> 'error' AND event_type <> 'click' AND event_id % 4 > 0 THEN 'notes_missing' END) END AS faults FROM events""",
)
def decision_rules(spark, sf_dir):
    n, kind = F.col("event_id"), F.col("event_type")
    rows = a.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", "pending").otherwise("done").alias("status"),
        F.when(F.col("value") > 20, F.when(kind == "error", "maybe").when(kind == "click", "keep").otherwise("reject")).alias("decision"),
        F.when(F.col("user_id") % 10 == 0, " ").otherwise("r").alias("reviewer"),
        F.when(n % 6 == 0, "2024-01-01T00:00:00").when(n % 6 == 1, "2999-01-01T00:00:00Z").otherwise("2024-01-01T00:00:00+02:00").alias("reviewed_at"),
        F.when(n % 4 == 0, "because").alias("notes"),
    )
    return ops.decision_faults(rows, ("keep", "reject"), ("reject",), F.lit("2026-01-01 00:00:00").cast("timestamp")).select("event_id", F.array_join("faults", ",").alias("faults"))


@query("zoned_time", "SELECT event_id, event_id % 3 > 0 AS zoned FROM events")
def zoned_time(spark, sf_dir):
    n = F.col("event_id")
    said = F.when(n % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(n % 3 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
    return a.table(spark, sf_dir, "events").select("event_id", t.zoned(said).alias("zoned"))


REVIEWS = "r AS (SELECT doc_id AS case_id, lang AS case_type, quality AS a, CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS b FROM labels JOIN documents USING (doc_id))"


def reviews(spark, sf_dir):
    rows = a.table(spark, sf_dir, "labels").join(a.table(spark, sf_dir, "documents"), "doc_id")
    sides = F.explode(F.array(F.struct(F.lit("A").alias("reviewer"), F.col("quality").alias("category")), F.struct(F.lit("B").alias("reviewer"), F.when(F.col("n_chars") > 800, 1).otherwise(0).alias("category"))))
    return rows.select(F.col("doc_id").alias("case_id"), F.col("lang").alias("case_type"), sides.alias("s")).select("case_id", "case_type", "s.reviewer", F.col("s.category").cast("string").alias("category"))


@query("consensus", f"WITH {REVIEWS} SELECT case_id, case_type, CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, a = b AS agree, CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE 'needs_human_review' END AS label FROM r")
def consensus(spark, sf_dir):
    return ops.consensus(reviews(spark, sf_dir))


@query("agreement", f"WITH {REVIEWS} SELECT case_type, count(*) AS n, round(avg(CAST(a = b AS INT)), 6) AS rate FROM r GROUP BY case_type")
def agreement(spark, sf_dir):
    return ops.consensus(reviews(spark, sf_dir)).groupBy("case_type").agg(F.count("*").alias("n"), F.round(F.avg(F.col("agree").cast("int")), 6).alias("rate"))


LEVELS = ("exact", "boundary", "category", "a_only", "b_only")


@query("agreement_levels", "SELECT source AS field, " + ", ".join(f"count(*) FILTER (WHERE n_chars % 7 {'>= 4' if i == 4 else f'= {i}'}) AS {level}" for i, level in enumerate(LEVELS)) + " FROM documents GROUP BY source")
def agreement_levels(spark, sf_dir):
    level = F.get(F.array(*map(F.lit, LEVELS)), F.least(F.col("n_chars") % 7, F.lit(4)))
    return ops.agreement_levels(a.table(spark, sf_dir, "documents").select(F.col("source").alias("field"), level.alias("level")), "field")


@query("pair_compare")
def pair_compare(spark, sf_dir):
    other = sourced_spans(spark, sf_dir, 2, 5).withColumn("field", F.when(F.col("uid") % 3 == 0, F.lit("other")).otherwise(F.col("field")))
    return ops.pair_compare(sourced_spans(spark, sf_dir, 0, 0), other, "uid")


@query(
    "assemble",
    f"""WITH {REVIEWS}, g AS (SELECT case_id, case_type, CAST(a AS VARCHAR) AS value FROM r WHERE a = b UNION SELECT case_id, case_type, CASE case_id % 4 WHEN 0 THEN CAST(a AS VARCHAR) WHEN 1 THEN CAST(b AS VARCHAR) ELSE 'new' END FROM r WHERE a <> b AND case_id % 4 < 3)
SELECT case_id, case_type, value, 'assembled' AS part FROM g UNION ALL SELECT case_id, case_type, CAST(a AS VARCHAR) || '/' || CAST(b AS VARCHAR), 'review' FROM r WHERE a <> b AND case_id % 4 = 3""",
)
def assemble(spark, sf_dir):
    both, key = ops.consensus(reviews(spark, sf_dir)), ["case_id", "case_type"]
    agreed = both.where("agree").select(*key, F.col("a").alias("value"))
    disputed = both.where("not agree").select(*key, F.col("a").alias("a_value"), F.col("b").alias("b_value"))
    n = F.col("case_id") % 4
    decided = disputed.where(n < 3).select(*key, F.when(n == 0, "A").when(n == 1, "B").otherwise("MODIFY").alias("choice"), F.lit("new").alias("new_value"))
    done, left = ops.assemble(agreed, disputed, decided, key)
    return done.withColumn("part", F.lit("assembled")).unionByName(left.select(*key, F.concat_ws("/", "a_value", "b_value").alias("value"), F.lit("review").alias("part")))


@query("case_numbers", "SELECT o_orderstatus, o_orderkey, printf('F%03d', row_number() OVER (ORDER BY o_orderstatus, o_orderkey)) AS case_id FROM orders")
def case_numbers(spark, sf_dir):
    return ops.case_numbers(a.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus", "o_orderkey"])


@query(
    "fk_check",
    """SELECT 'foreign_key' AS "check", count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20) UNION ALL SELECT 'empty_o_orderpriority', count(*) FROM orders WHERE o_orderpriority IS NULL OR trim(o_orderpriority) = ''
UNION ALL SELECT 'not_allowed_o_orderstatus', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL SELECT 'primary_key', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)""",
)
def fk_check(spark, sf_dir):
    parents = a.table(spark, sf_dir, "customer").where("c_nationkey < 20")
    return ops.key_checks(a.table(spark, sf_dir, "orders"), parents, "o_custkey", "c_custkey", ["o_orderpriority"], {"o_orderstatus": ("F", "O")}, "o_orderkey")


@query("review_clusters", "SELECT event_type AS field, CAST(user_id % 3 AS VARCHAR) AS kind, count(*) AS n, count(DISTINCT user_id) AS papers, arg_min(props, event_id) AS example FROM events GROUP BY ALL")
def review_clusters(spark, sf_dir):
    items = a.table(spark, sf_dir, "events").select(F.col("event_type").alias("field"), (F.col("user_id") % 3).cast("string").alias("kind"), F.col("user_id").alias("uid"), F.col("props").alias("item"), F.col("event_id").alias("pos"))
    return ops.clusters(items)


@query(
    "sheet_rules",
    """WITH r AS (SELECT event_id, CAST(CASE WHEN event_id % 29 = 0 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS uid, ['pending', 'reported', 'not_reported', 'not_applicable', 'uncertain', 'other'][event_id % 6 + 1] AS status, CASE WHEN user_id % 4 > 0 THEN 'r' END AS reviewer, CASE WHEN value > 10 THEN 'v' ELSE '' END AS value, CASE WHEN value > 20 THEN 'e' END AS evidence FROM events),
c AS (SELECT *, count(*) OVER (PARTITION BY uid) AS copies FROM r)
SELECT event_id, CASE WHEN copies > 1 THEN 'duplicate_or_missing_occurrence' WHEN status = 'pending' THEN NULL WHEN status = 'other' THEN 'invalid_status' WHEN reviewer IS NULL THEN 'reviewer_required' WHEN status = 'reported' AND (value = '' OR evidence IS NULL) THEN 'reported_needs_evidence' WHEN status LIKE 'not_%' AND value <> '' THEN 'absence_has_value' END AS fault FROM c""",
)
def sheet_rules(spark, sf_dir):
    n = F.col("event_id")
    statuses = F.array(*map(F.lit, ("pending", *ops.REFERENCE_STATUSES, "other")))
    rows = a.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(n % 29 == 0, n - 1).otherwise(n).cast("string").alias("uid"),
        F.lit("scale").alias("field"),
        F.lit("1").alias("occurrence"),
        F.get(statuses, n % 6).alias("status"),
        F.when(F.col("user_id") % 4 > 0, "r").alias("reviewer"),
        F.when(F.col("value") > 10, "v").otherwise("").alias("value"),
        F.when(F.col("value") > 20, "e").alias("evidence_text"),
    )
    return ops.sheet_faults(rows).select("event_id", "fault")


@query("flag_tasks", "SELECT l_orderkey AS doi, l_returnflag AS path, bool_or(l_linenumber = 5) AS high, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS types, count(*) AS n, left(sha256(CAST(l_orderkey AS VARCHAR) || '|' || l_returnflag), 24) AS task_key FROM lineitem GROUP BY l_orderkey, l_returnflag")
def flag_tasks(spark, sf_dir):
    rows = a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doi"), F.col("l_returnflag").alias("path"), F.when(F.col("l_linenumber") == 5, "high").otherwise("medium").alias("severity"), F.col("l_linestatus").alias("type"))
    return ops.flag_tasks(rows)


@query("apply_decisions", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a' WHEN o_orderkey % 3 = 1 THEN 'a,b,b' ELSE 'a,b' END AS before, o_orderkey % 3 = 2 AND o_orderkey % 5 > 0 AS applied, CASE WHEN o_orderkey % 3 = 0 THEN 'a' WHEN o_orderkey % 3 = 1 THEN 'a,b,b' WHEN o_orderkey % 5 > 0 THEN 'a' ELSE 'a,b' END AS after FROM orders")
def apply_decisions(spark, sf_dir):
    k = F.col("o_orderkey")
    items = F.when(k % 3 == 0, F.array(F.lit("a"))).when(k % 3 == 1, F.array(F.lit("a"), F.lit("b"), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    orders = a.table(spark, sf_dir, "orders").select("o_orderkey", items.alias("items"))
    decided = orders.where(k % 5 > 0).select("o_orderkey", F.lit("a").alias("keep"), F.array(F.lit("b")).alias("remove"))
    out = ops.apply_decisions(orders, decided, "o_orderkey")
    return out.select("o_orderkey", F.array_join("items", ",").alias("before"), "applied", F.array_join("after", ",").alias("after"))


@query("backfill", f"WITH {a.view('anchors', a.ANCHORS, 'documents')} SELECT uid, CASE WHEN lang = 'de' THEN 'kept' WHEN uid % 2 = 0 AND substr(text, a_start + 1, a_end - a_start) = quote THEN 'set' ELSE 'not_eligible' END AS change FROM anchors")
def backfill(spark, sf_dir):
    rows = a.shaped(spark, sf_dir, "documents", a.ANCHORS).withColumn("claim", F.when(F.col("uid") % 2 == 0, F.col("quote")).otherwise("other"))
    return ops.backfill(rows.withColumn("certainty", F.when(F.col("lang") == "de", "explicit"))).select("uid", "change")


@query("registry_drift", "SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'missing' ELSE concat_ws(',', CASE WHEN c_custkey % 7 = 0 THEN 'c_mktsegment' END, CASE WHEN c_custkey % 11 = 0 THEN 'c_nationkey' END) END AS drift FROM customer WHERE c_custkey % 50 = 0 OR c_custkey % 7 = 0 OR c_custkey % 11 = 0")
def registry_drift(spark, sf_dir):
    registry = a.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    pool = registry.where(k % 50 > 0).withColumn("c_mktsegment", F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))).withColumn("c_nationkey", F.when(k % 11 == 0, F.lit(-1)).otherwise(F.col("c_nationkey")))
    return ops.registry_drift(registry, pool, "c_custkey", ["c_mktsegment", "c_nationkey"]).select("c_custkey", F.array_join("drift", ",").alias("drift"))
