"""Driver tables in the shapes that the operators take.

Each adapter is a list of expressions that Spark and DuckDB read alike, so that
the same words make the frame here and the view of an oracle query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORDS = [
    "doc_id AS pos",
    "CASE WHEN doc_id % 3 <> 0 THEN concat('10.5555/', substr(md5(text), 1, 12)) END AS doi",
    "CASE WHEN doc_id % 4 <> 0 THEN concat('U', CAST(floor(doc_id / 2) AS BIGINT)) END AS uid",
    "substr(text, 1, 60) AS title",
    "2020 + doc_id % 7 AS publish_year",
    "source AS source_title",
    "lang",
    "text AS abstract",
    "n_chars",
]
KEYWORDS = ("the", "sch", "que", "les", "ion")
HITS = ["event_type AS query_id", "event_id AS seq", "user_id AS hit", "ts"]
ANCHORS = [
    "doc_id AS uid",
    "text",
    "CASE WHEN doc_id % 11 = 0 THEN 11 ELSE 10 END AS a_start",
    "CASE WHEN doc_id % 11 = 0 THEN 41 ELSE 40 END AS a_end",
    "CASE WHEN doc_id % 13 = 0 THEN concat(substr(text, 11, 29), '#') ELSE substr(text, 11, 30) END AS quote",
    "lang",
    "source",
]
PARAGRAPHS = ["conv_id AS doc", "turn AS section_ord", "role", "text"]
INVENTORY_LEFT = ["o_orderkey AS uid", "o_custkey AS owner", "o_orderpriority AS priority", "o_totalprice AS total"]
INVENTORY_RIGHT = ["l_orderkey AS uid", "l_linenumber AS n", "l_returnflag AS status", "l_partkey AS doi"]
RUNS = ["user_id AS uid", "ts", "event_id AS pos", "event_type AS status", "event_type = 'purchase' AS available", "value"]
SENTENCES = [
    "l_orderkey AS doc",
    "l_linenumber AS n",
    "concat('See 10.5555/', CAST(l_orderkey AS VARCHAR(20)), '). Then (', CAST(CAST(l_quantity AS INT) AS VARCHAR(20)), ' - ', CAST(l_linenumber AS VARCHAR(20)), ') / ',"
    " CASE WHEN l_linenumber = 5 THEN '0' ELSE CAST(l_linenumber AS VARCHAR(20)) END, ' * 100 = ',"
    " CAST(CASE WHEN l_linenumber = 3 THEN 7 ELSE CAST(floor((CAST(l_quantity AS INT) - l_linenumber) * 100 / l_linenumber) AS INT) END AS VARCHAR(20)), '%') AS txt",
    "concat(lower(l_returnflag), ' vs ', lower(l_linestatus)) AS letters",
    "CASE WHEN l_quantity > 25 THEN 'significant' ELSE 'not significant' END AS claim",
    "CAST(CAST(l_quantity AS INT) AS VARCHAR(20)) AS amount",
    "CASE WHEN l_returnflag = 'A' THEN '%' ELSE 'kg' END AS unit",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*RECORDS)


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each record and keyword that its text holds."""
    from pyspark.sql import functions as F

    words = F.filter(F.array(*map(F.lit, KEYWORDS)), lambda w: F.contains(F.lower("abstract"), w))
    return records(spark, sf_dir).withColumn("query_id", F.explode(words))


def shaped(spark: SparkSession, sf_dir: str, name: str, expressions: list[str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*expressions)


def view(name: str, expressions: list[str], source: str) -> str:
    """The same adapter as a common table expression."""
    return f"{name} AS (SELECT {', '.join(expressions)} FROM {source})"


RECORDS_CTE = view("records", RECORDS, "documents")
MATCHED_CTE = RECORDS_CTE + ", matched AS (SELECT r.*, k.query_id FROM records r JOIN (SELECT unnest(['" + "', '".join(KEYWORDS) + "']) AS query_id) k ON contains(lower(r.abstract), k.query_id))"
