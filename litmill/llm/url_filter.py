"""Allow and block pages by rules on their urls, and by links where none fits.

Hosts with pages that an allow rule fits are trusted seeds, those with pages
that a block rule fits distrusted ones, each in proportion to the pages. Trust
flows along links between hosts, distrust against them: personalised PageRank,
in rounds until ``STEPS`` of them reach no further host and move less than
``TOLERANCE`` of the scores' sum, which only grows. A host is blocked if distrust
is more than ``THRESHOLD`` of the two; a host that neither reaches is allowed.

Scale: links are summed to weighted edges between hosts before they are
shuffled, so a host with a third of all pages costs a row for each of its
neighbours and task. A round joins edges with the scores of their sources and
sums by target, also combined on the map side; the edges of hubs, of which there
are ``MOST_HUBS`` at most, get their scores by broadcast, so no task holds all
edges of a host; lineage is cut in the shared folder. Verdicts of hosts join pages as a written table, whose large keys Spark
can split.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule and no part in the graph, and is allowed; a null html has no links; links
without a host stay within theirs and make no edge; rows that repeat a page
count as often; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import table
from litmill.sources.scratch import Scratch

#: (host, path, verdict); a rule fits a host and its subdomains, the longest wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING = 0.85
STEPS = 6
TOLERANCE = 1e-3
#: Edges of a host that one task may join, and hosts that can have more.
HUB_EDGES = 50_000
MOST_HUBS = 4_000
#: Rounds in the SQL, which can't tell when to stop.
SQL_ROUNDS = 48
THRESHOLD = 0.5
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWERED)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    out = pages.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return out.withColumn("rule", rule).withColumn("ruled", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """``(src, dst, p)``: links from a host to others, as shares of its own."""
    target = F.explode(F.regexp_extract_all("html", F.lit(LINK), 1))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), target.alias("dst")).withColumn("dst", F.translate("dst", UPPER, LOWERED))
    edges = links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    total = edges.groupBy("src").agg(F.sum("n").alias("total"))
    return edges.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("p"))


def seeds(pages: DataFrame) -> DataFrame:
    """``(kind, host, share)`` of pages that rules allow and block."""
    counts = pages.where("host <> '' and ruled is not null").groupBy(F.col("ruled").alias("kind"), "host").agg(F.count("*").alias("n"))
    total = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("share"))  # two rows


def propagate(edges: DataFrame, start: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``(kind, host, score)``: allow follows the edges, block goes back."""
    scratch = Scratch(edges.sparkSession, "hosts")
    back = edges.groupBy("dst").agg(F.sum("p").alias("all"))
    forward = edges.select(F.lit("allow").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "p")
    reverse = edges.join(back, "dst").select(F.lit("block").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), (F.col("p") / F.col("all")).alias("p"))
    both = scratch.save(forward.unionAll(reverse), "edges")
    own = scratch.save(start.select("kind", "host", ((1 - damping) * F.col("share")).alias("score")), "seeds")
    score, before = own, None
    count = both.count()
    if not count:
        return score
    limit = max(hub_edges, -(-count // MOST_HUBS))
    key, hubs = ["kind", "host"], None
    if count > limit:  # no more than count / limit hosts have over limit edges
        degrees = both.groupBy(*key).agg(F.count("*").alias("n"))
        hubs = scratch.save(degrees.where(F.col("n") > limit).select(*key), "hubs")
        of_hubs = scratch.save(both.join(F.broadcast(hubs), key, "left_semi"), "hub_edges")
        both = scratch.save(both.join(F.broadcast(hubs), key, "left_anti"), "other_edges")

    def beside_scores(score: DataFrame) -> DataFrame:
        joined = both.join(score, key)
        if hubs is None:
            return joined
        few = score.join(F.broadcast(hubs), key, "left_semi")
        return joined.unionByName(of_hubs.join(F.broadcast(few), key))

    while True:
        now = score.agg(F.count("*").alias("hosts"), F.coalesce(F.sum("score"), F.lit(0.0)).alias("sum")).first()
        if before and now.hosts == before.hosts and now.sum - before.sum < tolerance * now.sum or not now.hosts:
            return score
        before = now
        for _ in range(STEPS):
            moved = beside_scores(score).select("kind", F.col("to").alias("host"), (damping * F.col("p") * F.col("score")).alias("score"))
            score = own.unionAll(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        score = scratch.save(score, "score")


def url_filter(pages: DataFrame, rules: tuple = RULES, threshold: float = THRESHOLD) -> DataFrame:
    pages = judged(pages, rules)
    scores = propagate(host_edges(pages), seeds(pages))
    hosts = scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "allow", F.col("score")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == "block", F.col("score")).otherwise(0.0)).alias("distrust"))
    blocked = hosts.where(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))).select("host", F.lit("block").alias("method"))
    blocked = Scratch(pages.sparkSession, "hosts").save(blocked, "blocked")
    out = pages.select("page_id", "host", "path", "rule", "ruled").join(blocked, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "method", F.lit("allow")).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def _sql() -> str:
    """The rounds of the propagation, one after another."""
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest)
    ruled = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest)
    link = LINK.replace("'", "''")
    rounds = "".join(
        f""", s{k + 1} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (
  SELECT * FROM s0 UNION ALL SELECT b.kind, b.nxt, {DAMPING} * b.p * s.score FROM both_ways b JOIN s{k} s ON s.kind = b.kind AND s.host = b.host) GROUP BY ALL)"""
        for k in range(SQL_ROUNDS)
    )
    return rf"""
WITH u AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id, html, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWERED}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u
), j AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM h),
links AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWERED}') AS dst FROM j WHERE host <> ''),
e AS (SELECT src, dst, count(*) AS n FROM links WHERE src <> dst GROUP BY ALL),
p AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS p FROM e),
both_ways AS MATERIALIZED (
  SELECT 'allow' AS kind, src AS host, dst AS nxt, p FROM p
  UNION ALL SELECT 'block', dst, src, p / sum(p) OVER (PARTITION BY dst) FROM p
), c AS (SELECT ruled AS kind, host, count(*) AS n FROM j WHERE host <> '' AND ruled IS NOT NULL GROUP BY ALL),
s0 AS MATERIALIZED (SELECT kind, host, {1 - DAMPING} * (n / sum(n) OVER (PARTITION BY kind)) AS score FROM c){rounds},
t AS (SELECT host, coalesce(sum(score) FILTER (WHERE kind = 'allow'), 0) AS trust, coalesce(sum(score) FILTER (WHERE kind = 'block'), 0) AS distrust FROM s{SQL_ROUNDS} GROUP BY host)
SELECT page_id, j.host, path, rule,
       coalesce(ruled, CASE WHEN distrust > {THRESHOLD} * (trust + distrust) THEN 'block' END, 'allow') AS verdict
FROM j LEFT JOIN t ON t.host = j.host
"""


OP2_SQL = _sql()
