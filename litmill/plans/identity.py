"""Queries on identity, merging and set relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmill.functions import text as t
from litmill.operators import identity as ops
from litmill.plans import adapters as a
from litmill.plans.registry import query

#: Plain titles, as both engines fold them.
TITLE = "trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))"


def ascii_title():
    return F.trim(F.regexp_replace(F.lower("title"), r"[^a-z0-9]+", " "))



GROUPS_CTE = f"""{a.RECORDS_CTE},
bad AS (SELECT uid FROM records WHERE uid IS NOT NULL AND doi IS NOT NULL GROUP BY uid HAVING count(DISTINCT doi) > 1),
keys AS (
  SELECT pos, 'd:' || doi AS k FROM records WHERE doi IS NOT NULL
  UNION ALL SELECT pos, 'u:' || uid FROM records WHERE uid IS NOT NULL AND uid NOT IN (SELECT uid FROM bad)
  UNION ALL SELECT pos, 't:' || {TITLE} || '|' || publish_year FROM records WHERE doi IS NULL AND uid IS NULL AND {TITLE} <> ''
), firsts AS (SELECT k, min(pos) AS f FROM keys GROUP BY k),
e AS (SELECT DISTINCT pos AS x, f AS y FROM keys JOIN firsts USING (k) WHERE pos <> f),
b AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r(x, y) AS (SELECT pos, pos FROM records UNION SELECT b.y, r.y FROM r JOIN b ON b.x = r.x),
groups AS (SELECT x AS pos, min(y) AS grp FROM r GROUP BY x)"""


@query("dedup_components", f'WITH RECURSIVE {GROUPS_CTE} SELECT pos, grp AS "group" FROM groups')
def dedup_components(spark, sf_dir):
    return ops.identity_groups(a.records(spark, sf_dir), ascii_title())


def merged(spark, sf_dir):
    rows = a.records(spark, sf_dir)
    grouped = rows.join(ops.identity_groups(rows, ascii_title()), "pos").withColumn("langs", F.array("lang"))
    return ops.merge_groups(grouped, ["doi", "uid", "title", "publish_year", "source_title"], ["langs"])


@query(
    "dedup_merge",
    f"""WITH RECURSIVE {GROUPS_CTE}, g AS (SELECT r.*, grp FROM records r JOIN groups USING (pos)),
l AS (SELECT grp, string_agg(lang, ',' ORDER BY p) AS langs FROM (SELECT grp, lang, min(pos) AS p FROM g GROUP BY ALL) GROUP BY grp)
SELECT grp AS "group", coalesce(arg_min(doi, pos) FILTER (WHERE doi <> ''), arg_max(doi, pos) FILTER (WHERE doi IS NOT NULL)) AS doi,
  coalesce(arg_min(uid, pos) FILTER (WHERE uid <> ''), arg_max(uid, pos) FILTER (WHERE uid IS NOT NULL)) AS uid,
  coalesce(arg_min(title, pos) FILTER (WHERE title <> ''), arg_max(title, pos) FILTER (WHERE title IS NOT NULL)) AS title,
  arg_min(publish_year, pos) AS publish_year, arg_min(source_title, pos) FILTER (WHERE source_title <> '') AS source_title,
  any_value(langs) AS langs, count(*) AS copies
FROM g JOIN l USING (grp) GROUP BY grp""",
)
def dedup_merge(spark, sf_dir):
    return merged(spark, sf_dir).withColumn("langs", F.array_join("langs", ","))


@query(
    "corpus_dedup",
    f"""WITH RECURSIVE {GROUPS_CTE}, g AS (SELECT grp, arg_min(source_title, pos) FILTER (WHERE source_title <> '') AS source_title, count(*) AS copies FROM records JOIN groups USING (pos) GROUP BY grp)
SELECT source_title, count(*) AS n_unique, CAST(sum(copies) AS BIGINT) AS n_records FROM g GROUP BY source_title""",
)
def corpus_dedup(spark, sf_dir):
    return merged(spark, sf_dir).groupBy("source_title").agg(F.count("*").alias("n_unique"), F.sum("copies").alias("n_records"))


@query(
    "uid_conflicts",
    f"""WITH {a.RECORDS_CTE}, bad AS (SELECT uid, string_agg(doi, ';' ORDER BY doi) AS doi_candidates FROM (SELECT DISTINCT uid, doi FROM records WHERE uid IS NOT NULL AND doi IS NOT NULL) GROUP BY uid HAVING count(*) > 1)
SELECT r.pos, r.uid, b.doi_candidates FROM records r LEFT JOIN bad b ON r.uid = b.uid""",
)
def uid_conflicts(spark, sf_dir):
    rows = a.records(spark, sf_dir)
    bad = ops.uid_conflicts(rows).select(F.col("uid").alias("u"), F.array_join("doi_candidates", ";").alias("doi_candidates"))
    return rows.join(bad, F.col("uid") == F.col("u"), "left").select("pos", "uid", "doi_candidates")


@query("keep_first", f"WITH {a.MATCHED_CTE} SELECT source_title, query_id, min(pos) AS pos, arg_min(title, pos) AS title FROM matched GROUP BY ALL")
def keep_first(spark, sf_dir):
    return ops.keep_first(a.matched(spark, sf_dir), ["source_title", "query_id"], ["pos"]).select("source_title", "query_id", "pos", "title")


RUNS_CTE = a.view("runs", a.RUNS, "events")


@query(
    "last_available",
    f"WITH {RUNS_CTE} SELECT uid, coalesce(arg_max(pos, pos) FILTER (WHERE available), min(pos)) AS pos, coalesce(arg_max(status, pos) FILTER (WHERE available), arg_min(status, pos)) AS status FROM runs GROUP BY uid",
)
def last_available(spark, sf_dir):
    return ops.last_that(a.shaped(spark, sf_dir, "events", a.RUNS), "uid", "pos", F.col("available"), True, ["status"])


@query(
    "last_checked",
    f"WITH {RUNS_CTE} SELECT uid, coalesce(max(pos) FILTER (WHERE status <> 'error'), max(pos)) AS pos, coalesce(arg_max(status, pos) FILTER (WHERE status <> 'error'), arg_max(status, pos)) AS status FROM runs GROUP BY uid",
)
def last_checked(spark, sf_dir):
    return ops.last_that(a.shaped(spark, sf_dir, "events", a.RUNS), "uid", "pos", F.col("status") != "error", False, ["status"])


@query(
    "one_to_one",
    """WITH c AS (SELECT l, r FROM (SELECT c_custkey AS k, count(*) AS l FROM customer GROUP BY 1) FULL JOIN (SELECT o_custkey AS k, count(*) AS r FROM orders GROUP BY 1) USING (k))
SELECT count(*) FILTER (WHERE r IS NULL) AS left_only, count(*) FILTER (WHERE l IS NULL) AS right_only, count(*) FILTER (WHERE l > 1) AS left_duplicates,
  count(*) FILTER (WHERE r > 1) AS right_duplicates, count(*) FILTER (WHERE l = 1 AND r = 1) AS matched FROM c""",
)
def one_to_one(spark, sf_dir):
    left, right = a.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), a.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return ops.one_to_one(left, right, "k")


LEFT, RIGHT = a.view("inv", a.INVENTORY_LEFT, "orders"), a.view("held", a.INVENTORY_RIGHT, "lineitem")


@query(
    "cardinality",
    f"""WITH {LEFT}, {RIGHT}, k AS (SELECT uid, count(*) AS n_right, min(doi) AS doi FROM held GROUP BY uid)
SELECT uid, owner, priority, total, coalesce(n_right, 0) AS n_right, doi, CASE WHEN n_right IS NULL THEN 'missing' WHEN n_right = 1 THEN 'one' ELSE 'duplicate' END AS cardinality FROM inv LEFT JOIN k USING (uid)""",
)
def cardinality(spark, sf_dir):
    return ops.cardinality(a.shaped(spark, sf_dir, "orders", a.INVENTORY_LEFT), a.shaped(spark, sf_dir, "lineitem", a.INVENTORY_RIGHT), "uid", "doi")


@query("orphan_right", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def orphan_right(spark, sf_dir):
    known = a.table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return a.table(spark, sf_dir, "orders").join(known, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


RESERVED = "publish_year = 2023"


@query(
    "anti_reserved",
    f"WITH {a.RECORDS_CTE}, x AS (SELECT * FROM records WHERE {RESERVED}) SELECT pos, uid, doi FROM records r WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.uid = r.uid) AND NOT EXISTS (SELECT 1 FROM x WHERE x.doi = r.doi)",
)
def anti_reserved(spark, sf_dir):
    rows = a.records(spark, sf_dir)
    return ops.without_reserved(rows, rows.where(RESERVED)).select("pos", "uid", "doi")


@query(
    "semi_requested",
    """WITH asked AS (SELECT DISTINCT user_id FROM events) SELECT user_id, CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN 'known' ELSE 'unknown' END AS state FROM asked""",
)
def semi_requested(spark, sf_dir):
    asked, known = a.table(spark, sf_dir, "events").select("user_id").distinct(), a.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return asked.join(known, "user_id", "left_semi").withColumn("state", F.lit("known")).unionAll(asked.join(known, "user_id", "left_anti").withColumn("state", F.lit("unknown")))


@query(
    "overlap_check",
    f"WITH {a.RECORDS_CTE}, o AS (SELECT * FROM records WHERE publish_year <= 2022), n AS (SELECT * FROM records WHERE publish_year > 2022) SELECT (SELECT count(*) FROM n WHERE uid IN (SELECT uid FROM o WHERE uid IS NOT NULL)) AS same_uid, (SELECT count(*) FROM n WHERE doi IN (SELECT doi FROM o WHERE doi IS NOT NULL)) AS same_doi",
)
def overlap_check(spark, sf_dir):
    rows = a.records(spark, sf_dir)
    old, new = rows.where("publish_year <= 2022"), rows.where("publish_year > 2022")
    shared = [new.join(old.select(k), k, "left_semi").agg(F.count("*").alias(f"same_{k}")) for k in ("uid", "doi")]
    return shared[0].join(shared[1])  # one row each


@query("set_equal", "SELECT key, side FROM (SELECT doc_id AS key, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))")
def set_equal(spark, sf_dir):
    key = F.col("doc_id").alias("key")
    return ops.set_difference(a.table(spark, sf_dir, "documents").select(key), a.table(spark, sf_dir, "labels").select(key), "key")


@query(
    "partition_check",
    """WITH p AS (SELECT doc_id AS k, 0 AS part FROM labels WHERE quality = 1 UNION SELECT doc_id, 1 FROM labels WHERE toxic = 1 UNION SELECT doc_id, 2 FROM labels WHERE quality = 0 AND toxic = 0),
h AS (SELECT k, parts, w FROM (SELECT k, count(*) AS parts FROM p GROUP BY k) FULL JOIN (SELECT DISTINCT doc_id AS k, true AS w FROM documents) USING (k))
SELECT count(*) FILTER (WHERE parts > 1) AS overlapping, count(*) FILTER (WHERE parts IS NULL) AS uncovered, count(*) FILTER (WHERE w IS NULL) AS unexpected FROM h""",
)
def partition_check(spark, sf_dir):
    labels = a.table(spark, sf_dir, "labels")
    parts = [labels.where(c).select("doc_id") for c in ("quality = 1", "toxic = 1", "quality = 0 and toxic = 0")]
    return ops.partition_check(parts, a.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("union_all", "SELECT c_custkey AS k, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier UNION ALL SELECT p_partkey, 'part' FROM part")
def union_all(spark, sf_dir):
    named = [a.table(spark, sf_dir, n).select(F.col(k).alias("k"), F.lit(n).alias("source")) for n, k in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    "duplicate_groups",
    f"""WITH {a.RECORDS_CTE}, k AS (SELECT pos, doi, uid, {TITLE} AS tt FROM records), t AS (SELECT tt FROM k GROUP BY tt HAVING count(DISTINCT doi) > 1)
SELECT 'doi' AS kind, doi AS key, count(*) OVER (PARTITION BY doi) AS n, pos FROM k WHERE doi IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doi) > 1
UNION ALL SELECT 'uid', uid, count(*) OVER (PARTITION BY uid), pos FROM k WHERE uid IS NOT NULL QUALIFY count(*) OVER (PARTITION BY uid) > 1
UNION ALL SELECT 'title', tt, count(*) OVER (PARTITION BY tt), pos FROM k WHERE tt IN (SELECT tt FROM t)""",
)
def duplicate_groups(spark, sf_dir):
    """A row for each member, so that a key that many share is no single row."""
    rows = a.records(spark, sf_dir)
    out = ops.duplicate_members(rows, F.col("doi"), "doi").unionByName(ops.duplicate_members(rows, F.col("uid"), "uid"))
    return out.unionByName(ops.duplicate_members(rows, ascii_title(), "title", F.col("doi")))


@query("doi_normalise", "SELECT page_id, nullif(trim(regexp_replace(lower(trim(url)), '^(https?://(dx\\.)?doi\\.org/|doi\\s*:\\s*)', '')), '') AS doi, regexp_full_match(nullif(trim(regexp_replace(lower(trim(url)), '^(https?://(dx\\.)?doi\\.org/|doi\\s*:\\s*)', '')), ''), '10\\.\\d{4,9}/\\S+') AS valid FROM pages")
def doi_normalise(spark, sf_dir):
    return a.table(spark, sf_dir, "pages").select("page_id", t.normalize_doi(F.col("url")).alias("doi"), t.valid_doi(F.col("url")).alias("valid"))
