"""Search pages to canonical records, and records to outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmill.functions.text import formula_guard, legacy_id, normalize_doi

#: The shape of a search hit.
HIT = (
    "uid string, title string, types array<string>, sourceTypes array<string>,"
    " source struct<sourceTitle: string, publishYear: int, publishMonth: string, volume: string, issue: string, articleNumber: string, pages: struct<count: int>>,"
    " names struct<authors: array<struct<displayName: string, wosStandard: string, researcherId: string>>>,"
    " identifiers struct<doi: string, issn: string, eissn: string, isbn: string, pmid: string>,"
    " keywords struct<authorKeywords: array<string>>, citations array<struct<db: string, count: int>>,"
    " links struct<record: string, references: string, related: string>"
)


def explode_pages(pages: DataFrame) -> DataFrame:
    """A row for each hit of ``(query_id, page, hits)``, in order."""
    return pages.select("query_id", "page", F.posexplode("hits").alias("place", "hit"))


def page_faults(pages: DataFrame, limit: int) -> DataFrame:
    """Pages whose declared numbers don't fit what they hold."""
    faults = F.array_compact(
        F.array(
            F.when(F.col("metadata.total").isNull(), "total_missing"),
            F.when(F.col("hits").isNull(), "hits_missing"),
            F.when(F.col("metadata.page") != F.col("page"), "other_page"),
            F.when(F.col("metadata.limit") != limit, "other_limit"),
            F.when(F.size("hits") > limit, "too_many_hits"),
        )
    )
    return pages.withColumn("faults", faults).where(F.size("faults") > 0)


def canonical(hits: DataFrame, *beside: str, database: str = "MAIN") -> DataFrame:
    """Hits of the shape ``HIT`` as flat records: a missing value is null, a
    missing list empty. Abstracts come later."""
    none = F.array().cast("array<string>")
    said = lambda name: F.filter(F.coalesce(F.transform("hit.names.authors", lambda x: x[name]), none), lambda x: x != "")
    authors = F.transform("hit.names.authors", lambda x: F.struct(x["displayName"].alias("display_name"), x["wosStandard"].alias("standard_name"), x["researcherId"].alias("researcher_id")))
    return hits.select(
        *beside,
        F.col("hit.uid").alias("uid"),
        F.col("hit.title").alias("title"),
        F.coalesce("hit.types", none).alias("document_types"),
        F.coalesce("hit.sourceTypes", none).alias("source_types"),
        F.col("hit.source.sourceTitle").alias("source_title"),
        F.col("hit.source.publishYear").alias("publish_year"),
        F.col("hit.source.publishMonth").alias("publication_date_raw"),
        F.col("hit.source.volume").alias("volume"),
        F.col("hit.source.issue").alias("issue"),
        F.col("hit.source.articleNumber").alias("article_number"),
        F.col("hit.source.pages.count").alias("page_count"),
        F.coalesce(authors, F.array().cast("array<struct<display_name: string, standard_name: string, researcher_id: string>>")).alias("authors"),
        said("displayName").alias("author_names"),
        said("researcherId").alias("researcher_ids"),
        normalize_doi(F.col("hit.identifiers.doi")).alias("doi"),
        *(F.col(f"hit.identifiers.{c}").alias(c) for c in ("issn", "eissn", "isbn", "pmid")),
        F.coalesce("hit.keywords.authorKeywords", none).alias("author_keywords"),
        first_match(F.col("hit.citations"), "db", database, "count").alias("times_cited"),
        *(F.col(f"hit.links.{c}").alias(n) for c, n in (("record", "record_url"), ("references", "references_url"), ("related", "related_url"))),
        *(F.lit(None).cast("string").alias(c) for c in ("abstract", "abstract_source", "abstract_retrieved_at")),
    )


def first_match(items: Column, field: str, value: str, take: str) -> Column:
    """A field of the first struct of a list whose other field has a value."""
    return F.get(F.filter(items, lambda x: x[field] == value), F.lit(0))[take]


#: The field of a history entry that names the file a row came from.
SOURCE_FILE = "processed_source_file"


def prepare_provenance(rows: DataFrame, query_id: Column, source_file: Column | None = None) -> DataFrame:
    """The query id of a row - given, its own, its single match, else a hash -
    a history entry for it unless one is there, and the matches recounted. With
    ``source_file`` the entry names it, and so does one that was there already
    and named none; the history's structs then have that field."""
    single = F.when(F.size("matched_queries") == 1, F.get("matched_queries", F.lit(0)))
    resolved = F.coalesce(query_id, F.col("own_id"), single, legacy_id(F.col("database"), F.col("query")))
    out = rows.withColumn("query_id", resolved)
    own = lambda h: (h["query_id"] == F.col("query_id")) & h["query"].eqNullSafe(F.col("query")) & h["database"].eqNullSafe(F.col("database"))
    fields, kept = ["query_id", "query", "database"], F.col("history")
    if source_file is not None:
        fields.append(SOURCE_FILE)
        out = out.withColumn(SOURCE_FILE, source_file)
        before = lambda i: F.exists(F.slice("history", F.lit(1), i), own)
        kept = F.transform("history", lambda h, i: F.when(own(h) & ~before(i), h.withField(SOURCE_FILE, F.coalesce(h[SOURCE_FILE], F.col(SOURCE_FILE)))).otherwise(h))
    out = out.withColumn("history", F.when(F.exists("history", own), kept).otherwise(F.concat("history", F.array(F.struct(*fields)))))
    matched = F.array_distinct(F.concat("matched_queries", F.transform("history", lambda h: h["query_id"])))
    return out.withColumn("matched_queries", matched).withColumn("query_match_count", F.size("matched_queries"))


def labelled_union(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Tables of one kind under their labels; columns may be missing in some."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (p.withColumn("query_id", F.lit(k)) for k, p in parts.items()))


def named_manifests(histories: DataFrame, names: str, manifests: DataFrame) -> DataFrame:
    """The manifests that histories name, each once, and whether they are there."""
    named = histories.select(F.explode(names).alias("manifest")).distinct()
    out = named.join(manifests.withColumn("_there", F.lit(True)), "manifest", "left")
    return out.withColumn("state", F.when(F.col("_there"), "read").otherwise("missing")).drop("_there")


def export_flat(records: DataFrame, lists: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Lists joined, text kept from being read as formulas."""
    out = records.select(*(F.array_join(c, "; ").alias(c) if c in lists else formula_guard(F.col(c)).alias(c) if c in texts else F.col(c) for c in records.columns))
    return out


def narrow(spark: SparkSession, path: str, schema: str, text: str) -> DataFrame:
    """Named columns of JSON lines and whether a text is there, without the text."""
    read = spark.read.schema(f"{schema}, {text} string").json(path)
    keep = [c for c in read.columns if c != text]
    return read.select(*keep, (F.col(text).isNotNull() & (F.col(text) != "")).alias(f"has_{text}"))


def with_responses(requests: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Requests with what answered them; those without an answer stay."""
    return requests.join(responses, key, "left").withColumn("answered", F.col("response").isNotNull())


def overlap_pairs(matched: DataFrame, key: str, label: str) -> DataFrame:
    """How many keys each two labels share; a label with itself is its size."""
    rows = matched.select(key, label).distinct()
    labels = rows.groupBy(key).agg(F.sort_array(F.collect_list(label)).alias("held"))  # as many as there are labels
    pairs = labels.select(F.explode("held").alias("a"), "held").select("a", F.explode("held").alias("b")).where("a <= b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


#: Pages that one task sums up.
PAGES_SUMMED = 1000


def cumulative_unique(rows: DataFrame, label: str, page: str, key: str) -> DataFrame:
    """For each numbered page how many keys were seen first there, and up to it.
    Pages are summed in blocks, and the blocks' sums added, so that a label with
    many pages is no single task."""
    first = rows.groupBy(label, key).agg(F.min(page).alias(page)).groupBy(label, page).agg(F.count("*").alias("new"))
    pages = rows.select(label, page).distinct().join(first, [label, page], "left").withColumn("new", F.coalesce("new", F.lit(0).cast("long")))
    pages = pages.withColumn("_block", F.floor(F.col(page) / PAGES_SUMMED))
    before = F.sum("_n").over(Window.partitionBy(label).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = pages.groupBy(label, "_block").agg(F.sum("new").alias("_n")).select(label, "_block", F.coalesce(before, F.lit(0).cast("long")).alias("_before"))
    within = F.sum("new").over(Window.partitionBy(label, "_block").orderBy(page).rowsBetween(Window.unboundedPreceding, 0))
    return pages.withColumn("_within", within).join(blocks, [label, "_block"]).select(label, page, "new", (F.col("_within") + F.col("_before")).alias("unique_so_far"))


def capped(rows: DataFrame, label: str, cap: int) -> DataFrame:
    """For each label how many rows a cap keeps and leaves out, and why it ended."""
    out = rows.groupBy(label).agg(F.count("*").alias("total"))
    omitted = F.greatest(F.col("total") - cap, F.lit(0).cast("long"))
    return out.withColumn("kept", F.col("total") - omitted).withColumn("omitted", omitted).withColumn("stop", F.when(omitted == 0, "exhausted").otherwise("record_cap"))


def capped_runs(rows: DataFrame, label: str, page: str, key: str, declared: str, page_size: int, record_cap: int, page_cap: int) -> DataFrame:
    """Where the run of each label ends and what it has then. It ends on the
    first page that reaches the declared total, the cap of distinct records or
    that of pages, in this order; it is complete if the total was reached,
    nothing left out and the declared total never changed."""
    totals = rows.groupBy(label).agg(F.min_by(declared, page).alias("total_hits"))
    seen = cumulative_unique(rows, label, page, key).join(totals, label)
    reason = F.when(F.col(page) * page_size >= F.col("total_hits"), "total_exhausted").when(F.col("unique_so_far") >= record_cap, "record_cap").when(F.col(page) >= page_cap, "page_cap")
    ends = seen.withColumn("stop_reason", reason).where("stop_reason is not null").groupBy(label).agg(F.min_by(F.struct("stop_reason", page, "unique_so_far", "total_hits"), page).alias("end"))
    fetched = rows.join(ends.select(label, F.col(f"end.{page}").alias("_last")), label).where(F.col(page) <= F.col("_last"))
    read = fetched.groupBy(label).agg(F.count("*").alias("hits"), (F.min(declared) != F.max(declared)).alias("total_changed"))
    out = ends.join(read, label).select(label, "end.stop_reason", F.col(f"end.{page}").alias("pages"), "end.total_hits", "hits", F.col("end.unique_so_far").alias("unique_records"), "total_changed")
    omitted = F.greatest(F.col("unique_records") - record_cap, F.lit(0).cast("long"))
    out = out.withColumn("collected", F.col("unique_records") - omitted).withColumn("duplicates", F.col("hits") - F.col("unique_records")).withColumn("omitted", omitted)
    return out.withColumn("complete", (F.col("stop_reason") == "total_exhausted") & (F.col("omitted") == 0) & ~F.col("total_changed"))


def run_status(runs: DataFrame, label: str) -> DataFrame:
    """One status for each label: errors before truncation before done."""
    bad, cut = F.bool_or(F.col("status") == "error"), F.bool_or(F.col("truncated"))
    return runs.groupBy(label).agg(F.when(bad, "completed_with_errors").when(cut, "truncated").otherwise("completed").alias("status"), F.count("*").alias("n"))


def fan_out(rows: DataFrame, queues: Mapping[str, Column], key: str) -> DataFrame:
    """``(queue, key)``: each row in all the queues that it belongs to, in one pass."""
    names = F.array_compact(F.array(*(F.when(c, name) for name, c in queues.items())))
    return rows.select(F.explode(names).alias("queue"), key)
