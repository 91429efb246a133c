"""Queries on scans, records and outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmill.functions import text as t
from litmill.operators import ingest as ops
from litmill.operators.components import numbered
from litmill.plans import adapters as a
from litmill.plans.registry import query
from litmill.sources import files
from litmill.sources.scratch import Scratch


@query("records_per_group", f"WITH {a.MATCHED_CTE} SELECT 'year' AS kind, CAST(publish_year AS VARCHAR) AS value, count(DISTINCT pos) AS n FROM matched GROUP BY publish_year UNION ALL SELECT 'source', source_title, count(DISTINCT pos) FROM matched GROUP BY source_title UNION ALL SELECT 'query', query_id, count(DISTINCT pos) FROM matched GROUP BY query_id")
def records_per_group(spark, sf_dir):
    rows = a.matched(spark, sf_dir).withColumn("year", F.col("publish_year").cast("string"))
    sets = rows.groupingSets([["year"], ["source_title"], ["query_id"]], "year", "source_title", "query_id").agg(F.countDistinct("pos").alias("n"), F.grouping_id().alias("g"))
    kind = F.when(F.col("g") == 3, "year").when(F.col("g") == 5, "source").otherwise("query")
    return sets.select(kind.alias("kind"), F.when(F.col("g") == 3, F.col("year")).when(F.col("g") == 5, F.col("source_title")).otherwise(F.col("query_id")).alias("value"), "n")


@query("overlap_pairs", f"WITH {a.MATCHED_CTE} SELECT x.query_id AS a, y.query_id AS b, count(*) AS n FROM matched x JOIN matched y ON x.pos = y.pos AND x.query_id <= y.query_id GROUP BY ALL")
def overlap_pairs(spark, sf_dir):
    return ops.overlap_pairs(a.matched(spark, sf_dir), "pos", "query_id")


@query("overlap_matrix", f"WITH {a.MATCHED_CTE} SELECT x.query_id AS a, " + ", ".join(f"count(*) FILTER (WHERE y.query_id = '{w}') AS n_{w}" for w in a.KEYWORDS) + " FROM matched x JOIN matched y USING (pos) GROUP BY x.query_id")
def overlap_matrix(spark, sf_dir):
    half = ops.overlap_pairs(a.matched(spark, sf_dir), "pos", "query_id")
    whole = half.unionByName(half.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    wide = whole.groupBy("a").pivot("b", list(a.KEYWORDS)).agg(F.sum("n"))
    return wide.select("a", *(F.coalesce(w, F.lit(0).cast("long")).alias(f"n_{w}") for w in a.KEYWORDS))


HITS = a.view("h", a.HITS, "events") + ", hits AS (SELECT *, 1 + CAST(floor((row_number() OVER (PARTITION BY query_id ORDER BY seq) - 1) / 50) AS BIGINT) AS page FROM h)"


def hits(spark, sf_dir):
    rows = a.shaped(spark, sf_dir, "events", a.HITS)
    return numbered(rows, ["seq"], ["query_id"]).withColumn("page", 1 + F.floor((F.col("place") - 1) / 50)).drop("place")


@query("cumulative_unique", f"WITH {HITS}, f AS (SELECT query_id, hit, min(page) AS page FROM hits GROUP BY ALL), n AS (SELECT query_id, page, count(*) AS new FROM f GROUP BY ALL) SELECT query_id, page, coalesce(new, 0) AS new, CAST(sum(coalesce(new, 0)) OVER (PARTITION BY query_id ORDER BY page) AS BIGINT) AS unique_so_far FROM (SELECT DISTINCT query_id, page FROM hits) LEFT JOIN n USING (query_id, page)")
def cumulative_unique(spark, sf_dir):
    return ops.cumulative_unique(hits(spark, sf_dir), "query_id", "page", "hit")


@query("cap", f"WITH {HITS} SELECT query_id, count(*) AS total, least(count(*), 500) AS kept, greatest(count(*) - 500, 0) AS omitted, CASE WHEN count(*) > 500 THEN 'record_cap' ELSE 'exhausted' END AS stop FROM hits GROUP BY query_id")
def cap(spark, sf_dir):
    return ops.capped(a.shaped(spark, sf_dir, "events", a.HITS), "query_id", 500)


RUNS = f"""{HITS}, t AS (SELECT query_id, count(*) AS total FROM hits GROUP BY 1), d AS (SELECT h.*, t.total + CASE WHEN page > 2 AND query_id = 'error' THEN 1 ELSE 0 END AS declared FROM hits h JOIN t USING (query_id)),
f AS (SELECT query_id, hit, min(page) AS page FROM hits GROUP BY ALL), n AS (SELECT query_id, page, count(*) AS new FROM f GROUP BY ALL), u AS (SELECT query_id, page, sum(coalesce(new, 0)) OVER (PARTITION BY query_id ORDER BY page) AS u FROM (SELECT DISTINCT query_id, page FROM hits) LEFT JOIN n USING (query_id, page)),
r AS (SELECT query_id, page, u, total, CASE WHEN page * 50 >= total THEN 'total_exhausted' WHEN u >= 300 THEN 'record_cap' WHEN page >= 12 THEN 'page_cap' END AS reason FROM u JOIN t USING (query_id)),
e AS (SELECT * FROM r WHERE reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY page) = 1), g AS (SELECT e.query_id, count(*) AS hits, min(declared) <> max(declared) AS changed FROM d JOIN e ON d.query_id = e.query_id AND d.page <= e.page GROUP BY 1)"""


@query("capped_runs", f"WITH {RUNS} SELECT query_id, reason AS stop_reason, page AS pages, total AS total_hits, hits, CAST(u AS BIGINT) AS unique_records, changed AS total_changed, CAST(least(u, 300) AS BIGINT) AS collected, CAST(hits - u AS BIGINT) AS duplicates, CAST(greatest(u - 300, 0) AS BIGINT) AS omitted, reason = 'total_exhausted' AND u <= 300 AND NOT changed AS complete FROM e JOIN g USING (query_id)")
def capped_runs(spark, sf_dir):
    rows = hits(spark, sf_dir)
    totals = rows.groupBy("query_id").agg(F.count("*").alias("total"))
    changed = F.when((F.col("page") > 2) & (F.col("query_id") == "error"), 1).otherwise(0)
    return ops.capped_runs(rows.join(totals, "query_id").withColumn("declared", F.col("total") + changed), "query_id", "page", "hit", "declared", 50, 300, 12)


@query("run_rollup", "SELECT user_id, CASE WHEN bool_or(event_type = 'error') THEN 'completed_with_errors' WHEN bool_or(value > 50) THEN 'truncated' ELSE 'completed' END AS status, count(*) AS n FROM events GROUP BY user_id")
def run_rollup(spark, sf_dir):
    rows = a.table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("status"), (F.col("value") > 50).alias("truncated"))
    return ops.run_status(rows, "user_id")


def written(spark, name, frame, codec="none"):
    """A table as JSON lines in the shared folder."""
    path = Scratch(spark, "files").path(name)
    files.write_new_json(frame, path, codec)
    return path


@query("scan_strict", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_strict(spark, sf_dir):
    rows = a.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return files.read_strict_json(spark, written(spark, "orders", rows), "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double")


@query("json_out", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def json_out(spark, sf_dir):
    rows = a.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    return files.read_reporting_json(spark, written(spark, "documents", rows), "doc_id long, lang string, source string, n_chars long, text string").select("doc_id", "lang", "source", "n_chars", "text")


@query("narrow_scan", "SELECT doc_id, lang, source, (text IS NOT NULL AND text <> '') AS has_text FROM documents")
def narrow_scan(spark, sf_dir):
    path = written(spark, "documents", a.table(spark, sf_dir, "documents"))
    return ops.narrow(spark, path, "doc_id long, lang string, source string", "text")


LINE = ("l_linenumber", "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


def nested(of=F.col):
    """An order line as a nested hit; ``of`` gives its columns by their names."""
    line, part = of("l_linenumber"), of("l_partkey").cast("string")
    author = F.struct(of("l_returnflag").alias("displayName"), of("l_linestatus").alias("wosStandard"), F.when(line == 3, part).alias("researcherId"))
    return F.struct(
        F.concat(F.lit("l"), line).alias("uid"),
        of("l_returnflag").alias("title"),
        F.when(line > 1, F.array(of("l_linestatus"))).alias("types"),
        F.when(line > 2, F.array(of("l_returnflag"), of("l_linestatus"))).alias("sourceTypes"),
        F.struct(F.when(of("l_quantity") > 10, F.array(author, F.struct(F.lit("").alias("displayName"), F.lit(None).cast("string").alias("wosStandard"), F.lit(None).cast("string").alias("researcherId")))).alias("authors")).alias("names"),
        F.struct(
            of("l_linestatus").alias("sourceTitle"),
            F.year(of("l_shipdate")).alias("publishYear"),
            F.date_format(of("l_shipdate"), "MM-dd").alias("publishMonth"),
            F.when(line != 4, part).alias("volume"),
            of("l_suppkey").cast("string").alias("issue"),
            F.when(line == 5, part).alias("articleNumber"),
            F.when(line < 6, F.struct(of("l_quantity").cast("int").alias("count"))).alias("pages"),
        ).alias("source"),
        F.when(line != 2, F.struct(F.concat(F.lit("https://doi.org/10.5555/A"), part).alias("doi"), part.alias("issn"), F.when(line == 1, part).alias("pmid"))).alias("identifiers"),
        F.array(F.struct(F.lit("SIDE").alias("db"), line.alias("count")), F.struct(F.when(of("l_quantity") > 25, "MAIN").alias("db"), of("l_quantity").cast("int").alias("count"))).alias("citations"),
        F.struct(F.when(line == 2, F.array(of("l_returnflag"), of("l_linestatus"))).alias("authorKeywords")).alias("keywords"),
        F.struct(F.concat(F.lit("https://x.org/"), part).alias("record"), F.lit(None).cast("string").alias("related")).alias("links"),
    )


def nested_pages(spark, sf_dir):
    """Orders as pages and their lines as nested hits, which are made where a
    page's lines have come together."""
    rows = a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.struct(*LINE).alias("line"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.count("*").cast("int").alias("total"))
    pages = pages.withColumn("hits", F.transform("lines", lambda x: nested(lambda name: x[name])))
    return pages.select(F.lit("q").alias("query_id"), "page", F.struct("total", F.col("page").alias("page"), F.lit(50).alias("limit")).alias("metadata"), "hits")


@query("pages_explode", "SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag) - 1 AS place, concat('l', l_linenumber) AS uid FROM lineitem")
def pages_explode(spark, sf_dir):
    pages = nested_pages(spark, sf_dir)
    path = written(spark, "pages", pages, "gzip")
    read = spark.read.schema(pages.schema).json(path)
    return ops.explode_pages(read).select("page", F.col("place").cast("long").alias("place"), F.col("hit.uid").alias("uid"))


@query("page_faults", "SELECT l_orderkey AS page, 'too_many_hits' AS faults FROM lineitem GROUP BY l_orderkey HAVING count(*) > 5")
def page_faults(spark, sf_dir):
    pages = nested_pages(spark, sf_dir).withColumn("metadata", F.struct(F.col("metadata.total"), F.col("metadata.page"), F.lit(5).alias("limit")))
    return ops.page_faults(pages, 5).select("page", F.array_join("faults", ",").alias("faults"))


@query(
    "project_canonical",
    """WITH l AS (SELECT *, CAST(l_partkey AS VARCHAR) AS part FROM lineitem) SELECT l_orderkey AS page, concat('l', l_linenumber) AS uid, l_returnflag AS title, CASE WHEN l_linenumber > 1 THEN l_linestatus ELSE '' END AS document_types, CASE WHEN l_linenumber > 2 THEN l_returnflag || ';' || l_linestatus ELSE '' END AS source_types,
CASE WHEN l_quantity > 10 THEN l_returnflag ELSE '' END AS author_names, CASE WHEN l_quantity > 10 AND l_linenumber = 3 THEN part ELSE '' END AS researcher_ids, CASE WHEN l_quantity > 10 THEN 2 ELSE 0 END AS authors, l_linestatus AS source_title, CAST(year(l_shipdate) AS INT) AS publish_year, strftime(l_shipdate, '%m-%d') AS publication_date_raw,
CASE WHEN l_linenumber <> 4 THEN part END AS volume, CAST(l_suppkey AS VARCHAR) AS issue, CASE WHEN l_linenumber = 5 THEN part END AS article_number, CASE WHEN l_linenumber < 6 THEN CAST(l_quantity AS INT) END AS page_count, CASE WHEN l_linenumber <> 2 THEN '10.5555/a' || part END AS doi, CASE WHEN l_linenumber <> 2 THEN part END AS issn, CASE WHEN l_linenumber = 1 THEN part END AS pmid,
CAST(NULL AS VARCHAR) AS eissn, CAST(NULL AS VARCHAR) AS isbn, CAST(NULL AS VARCHAR) AS references_url, CAST(NULL AS VARCHAR) AS related_url, CAST(NULL AS VARCHAR) AS abstract, CAST(NULL AS VARCHAR) AS abstract_source, CAST(NULL AS VARCHAR) AS abstract_retrieved_at, 'https://x.org/' || part AS record_url,
CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INT) END AS times_cited, CASE WHEN l_linenumber = 2 THEN l_returnflag || ';' || l_linestatus ELSE '' END AS author_keywords FROM l""",
)
def project_canonical(spark, sf_dir):
    """Hits as JSON, as a provider sends them."""
    sent = a.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.from_json(F.to_json(nested()), ops.HIT).alias("hit"))
    lists = ("document_types", "source_types", "author_names", "researcher_ids", "author_keywords")
    return ops.canonical(sent, "page").withColumns({c: F.array_join(c, ";") for c in lists}).withColumn("authors", F.size("authors"))


@query("first_match", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN CAST(l_quantity AS INT) END AS cited FROM lineitem")
def first_match(spark, sf_dir):
    rows = a.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", nested().alias("hit"))
    return rows.select("l_orderkey", "l_linenumber", ops.first_match(F.col("hit.citations"), "db", "MAIN", "count").alias("cited"))


@query(
    "provenance_prepare",
    f"""WITH {a.MATCHED_CTE} SELECT pos, query_id AS word, CASE WHEN publish_year = 2020 THEN 'given' WHEN publish_year = 2021 THEN source_title WHEN publish_year < 2024 THEN query_id
 ELSE 'legacy_' || substr(sha256('["' || lang || '","' || query_id || '"]'), 1, 12) END AS query_id,
 CASE WHEN publish_year IN (2020, 2021) THEN 2 WHEN publish_year < 2024 THEN 1 ELSE 3 END AS query_match_count FROM matched""",
)
def provenance_prepare(spark, sf_dir):
    year = F.col("publish_year")
    rows = a.matched(spark, sf_dir).select(
        "pos",
        F.col("query_id").alias("word"),
        F.col("query_id").alias("query"),
        F.col("lang").alias("database"),
        F.when(year == 2020, "given").alias("given"),
        F.when(year == 2021, F.col("source_title")).alias("own_id"),
        F.when(year < 2024, F.array("query_id")).otherwise(F.array("query_id", F.lit("other"))).alias("matched_queries"),
        F.array().cast("array<struct<query_id:string,query:string,database:string>>").alias("history"),
    )
    return ops.prepare_provenance(rows, F.col("given")).select("pos", "word", "query_id", "query_match_count")


@query("allow_list", f"WITH {a.RECORDS_CTE} SELECT uid, doi, title, abstract, publish_year, source_title, lang FROM records")
def allow_list(spark, sf_dir):
    return a.records(spark, sf_dir).select("uid", "doi", "title", "abstract", "publish_year", "source_title", "lang")


FLAT = f"WITH {a.RECORDS_CTE} SELECT pos, CASE WHEN regexp_matches(ltrim(title), '^[=+\\-@]') THEN '''' || title ELSE title END AS title, lang || '; ' || source_title AS tags, abstract IS NOT NULL AS available FROM records"


def flat(spark, sf_dir):
    rows = a.records(spark, sf_dir).select("pos", "title", F.array("lang", "source_title").alias("tags"), F.col("abstract").isNotNull().alias("available"))
    return ops.export_flat(rows, ["tags"], ["title"])


@query("export_flat", FLAT)
def export_flat(spark, sf_dir):
    return flat(spark, sf_dir)


@query("csv_out", FLAT.replace("abstract IS NOT NULL AS available", "CASE WHEN abstract IS NOT NULL THEN 'true' ELSE 'false' END AS available").replace("SELECT pos,", "SELECT CAST(pos AS VARCHAR) AS pos,"))
def csv_out(spark, sf_dir):
    path = Scratch(spark, "files").path("csv")
    files.write_new_csv(flat(spark, sf_dir), path)
    return files.read_decisions(spark, path)


@query("decisions_in", "SELECT CAST(doc_id AS VARCHAR) AS uid, CASE WHEN quality = 1 THEN 'keep' ELSE 'drop' END AS decision FROM labels")
def decisions_in(spark, sf_dir):
    rows = a.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("﻿uid"), F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("decision"))
    path = Scratch(spark, "files").path("csv")
    files.write_new_csv(rows, path)
    return files.read_decisions(spark, path)


@query("formula_guard", "SELECT event_id, CASE WHEN value > 30 THEN '''-' || event_type ELSE event_type END AS guarded FROM events")
def formula_guard(spark, sf_dir):
    rows = a.table(spark, sf_dir, "events")
    said = F.when(F.col("value") > 30, F.concat(F.lit("-"), "event_type")).otherwise(F.col("event_type"))
    return rows.select("event_id", t.formula_guard(said).alias("guarded"))


@query("responses_left", "SELECT d.doc_id, l.quality AS response, l.doc_id IS NOT NULL AS answered FROM documents d LEFT JOIN labels l USING (doc_id)")
def responses_left(spark, sf_dir):
    answers = a.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("response"))
    path = written(spark, "responses", answers)
    return ops.with_responses(a.table(spark, sf_dir, "documents").select("doc_id"), files.read_strict_json(spark, path, "doc_id long, response int"), "doc_id")


@query(
    "labelled_union",
    """WITH d AS (SELECT doc_id, coalesce(lang, 'none') AS query_id, CASE WHEN lang = 'en' THEN source END AS source FROM documents)
SELECT query_id, doc_id, source, CASE WHEN doc_id % 3 = 0 THEN 'old.json' ELSE 'query_id=' || query_id END AS files, 1 AS query_match_count FROM d""",
)
def labelled_union(spark, sf_dir):
    """Files by language, read in one scan; the history of each row names its
    file, also where it had an entry without one."""
    docs = a.table(spark, sf_dir, "documents")
    path = Scratch(spark, "labelled").path("searches")
    docs.select("doc_id", F.when(F.col("lang") == "en", F.col("source")).alias("source"), F.coalesce("lang", F.lit("none")).alias("query_id")).write.partitionBy("query_id").parquet(path)
    rows = spark.read.parquet(path).withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), "(query_id=[^/]*)/", 1))
    n = F.col("doc_id") % 3
    entry = lambda file: F.array(F.struct("query_id", F.lit("q").alias("query"), F.lit("main").alias("database"), F.lit(file).cast("string").alias(ops.SOURCE_FILE)))
    history = F.when(n == 0, entry("old.json")).when(n == 1, entry(None)).otherwise(F.slice(entry(None), 1, 0))
    rows = rows.withColumns({"query": F.lit("q"), "database": F.lit("main"), "own_id": F.lit(None).cast("string"), "matched_queries": F.array().cast("array<string>"), "history": history})
    out = ops.prepare_provenance(rows, F.col("query_id"), F.col("file"))
    return out.select("query_id", "doc_id", "source", F.array_join(F.transform("history", lambda h: h[ops.SOURCE_FILE]), ",").alias("files"), "query_match_count")


HASH_SUM = "CAST(sum(CAST('0x' || left(sha256({}), 8) AS BIGINT)) AS BIGINT) AS content_sum"


@query("manifest_rows", f"SELECT 'documents' AS output, count(*) AS rows, count(DISTINCT doc_id) AS keys, {HASH_SUM.format('text')} FROM documents UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), {HASH_SUM.format('o_orderpriority')} FROM orders UNION ALL SELECT 'pages', count(*), count(DISTINCT page_id), {HASH_SUM.format('html')} FROM pages")
def manifest_rows(spark, sf_dir):
    """Manifests written beside their outputs and read back."""
    outputs = (("documents", "doc_id", "text"), ("orders", "o_orderkey", "o_orderpriority"), ("pages", "page_id", "html"))
    scratch = Scratch(spark, "manifests")
    made = [scratch.save(files.manifest(a.table(spark, sf_dir, n), k, c).select(F.lit(n).alias("output"), "rows", "keys", "content_sum"), n) for n, k, c in outputs]
    return made[0].unionByName(made[1]).unionByName(made[2])


OBSERVED = "CAST(count(*) AS BIGINT) AS rows, " + HASH_SUM


@query("observed_manifests", f"SELECT 'documents' AS output, {OBSERVED.format('text')} FROM documents UNION ALL SELECT 'orders', {OBSERVED.format('o_orderpriority')} FROM orders UNION ALL SELECT 'pages', {OBSERVED.format('html')} FROM pages")
def observed_manifests(spark, sf_dir):
    """Outputs written, and what was counted as they were."""
    outputs = (("documents", "doc_id", "text"), ("orders", "o_orderkey", "o_orderpriority"), ("pages", "page_id", "html"))
    scratch = Scratch(spark, "observed")
    made = [files.write_observed(a.table(spark, sf_dir, n), scratch.path(n), k, c).select(F.lit(n).alias("output"), "rows", "content_sum") for n, k, c in outputs]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query("search_manifests", f"WITH {a.MATCHED_CTE}, h AS (SELECT query_id || '-' || lang AS manifest, query_id, lang, count(*) AS total_hits FROM matched GROUP BY ALL) SELECT manifest, CASE WHEN lang <> 'fr' THEN query_id END AS query_id, CASE WHEN lang <> 'fr' THEN total_hits END AS total_hits, CASE WHEN lang = 'fr' THEN 'missing' ELSE 'read' END AS state FROM h")
def search_manifests(spark, sf_dir):
    """Manifests that the histories of records name, each read once; those of one
    language are not there."""
    rows = a.matched(spark, sf_dir).where("lang is not null").withColumn("manifest", F.concat_ws("-", "query_id", "lang"))
    there = rows.where("lang <> 'fr'").groupBy("manifest", "query_id").agg(F.count("*").alias("total_hits"))
    path = Scratch(spark, "files").path("manifests")
    there.write.partitionBy("manifest").json(path)
    histories = rows.groupBy("pos").agg(F.collect_set("manifest").alias("manifests"))
    return ops.named_manifests(histories, "manifests", spark.read.schema("query_id string, total_hits long, manifest string").json(path))


@query("content_store", "SELECT DISTINCT sha256(text) AS sha256, CAST(length(text) AS INT) AS chars FROM documents WHERE text IS NOT NULL")
def content_store(spark, sf_dir):
    return files.content_store(a.table(spark, sf_dir, "documents"), "text").select("sha256", F.length("text").alias("chars"))


@query("store_conflicts", "SELECT sha256(source) AS sha256, count(DISTINCT lang) AS n FROM documents WHERE source IS NOT NULL GROUP BY source HAVING count(DISTINCT lang) > 1")
def store_conflicts(spark, sf_dir):
    """Languages stored under the hash of their source."""
    rows = a.table(spark, sf_dir, "documents").where("source is not null").select(F.sha2("source", 256).alias("sha256"), "lang")
    return files.store_conflicts(rows, "lang")


@query("fingerprints", "SELECT CAST(c_custkey // 20 AS VARCHAR) AS file, sha256(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS sha256, CAST(sum(length(c_name) + 1) AS BIGINT) AS size FROM customer GROUP BY 1")
def fingerprints(spark, sf_dir):
    """Customers in files of twenty keys, and what the files themselves say."""
    rows = a.table(spark, sf_dir, "customer").select(F.expr("c_custkey div 20").alias("part"), "c_custkey", "c_name")
    path = Scratch(spark, "files").path("parts")
    rows.repartition("part").sortWithinPartitions("part", "c_custkey").select("part", "c_name").write.partitionBy("part").text(path)
    seen = files.fingerprints(spark, path, within=2, pattern="*.txt")
    return seen.withColumn("file", F.regexp_extract("file", "part=([^/]*)", 1))


@query("snapshot_drift", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'changed' END AS drift FROM documents WHERE text IS NOT NULL AND (doc_id % 5 = 0 OR doc_id % 7 = 0)")
def snapshot_drift(spark, sf_dir):
    rows = a.table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    now = rows.where("doc_id % 5 <> 0").withColumn("sha256", F.when(F.col("doc_id") % 7 == 0, F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256")))
    return files.drift(rows, now, "doc_id", "sha256").select("doc_id", "drift")


@query("content_hash", """SELECT doc_id, sha256('{"lang":"' || lang || '","n_chars":' || n_chars || ',"nothing":null,"source":"' || source || '"}') AS hash FROM documents""")
def content_hash(spark, sf_dir):
    rows = a.table(spark, sf_dir, "documents").withColumn("nothing", F.lit(None).cast("string"))
    return rows.select("doc_id", t.content_hash("lang", "n_chars", "nothing", "source").alias("hash"))


@query("legacy_id", """SELECT DISTINCT 'legacy_' || substr(sha256('["' || lang || '","' || source || '"]'), 1, 12) AS id FROM documents""")
def legacy_ids(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").select(t.legacy_id(F.col("lang"), F.col("source")).alias("id")).distinct()


@query("ordered_distinct", f"WITH {a.MATCHED_CTE}, f AS (SELECT source_title, lang, min(pos) AS p FROM matched GROUP BY ALL) SELECT source_title, string_agg(lang, ',' ORDER BY p) AS langs FROM f GROUP BY source_title")
def ordered_distinct(spark, sf_dir):
    rows = a.matched(spark, sf_dir).groupBy("source_title", "lang").agg(F.min("pos").alias("pos"))
    langs = F.array_sort(F.collect_list(F.struct("pos", "lang"))).getField("lang")
    return rows.groupBy("source_title").agg(F.array_join(F.array_distinct(langs), ",").alias("langs"))


@query("slug", "SELECT doc_id, CASE WHEN trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') = '' THEN 'section' ELSE trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') END AS slug FROM documents")
def slug(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").select("doc_id", t.slug(F.col("text")).alias("slug"))


@query("doi_find", f"WITH {a.view('s', a.SENTENCES, 'lineitem')} SELECT doc, n, '10.5555/' || doc AS dois FROM s")
def doi_find(spark, sf_dir):
    return a.shaped(spark, sf_dir, "lineitem", a.SENTENCES).select("doc", "n", F.array_join(t.find_dois(F.col("txt")), ",").alias("dois"))


for _name, _function in (("title_key", t.title_key), ("item_key", t.item_key), ("identity_key", t.identity_key)):

    def _keyed(spark, sf_dir, function=_function, name=_name):
        return a.table(spark, sf_dir, "documents").select("doc_id", function(F.col("text")).alias(name))

    query(_name)(_keyed)
