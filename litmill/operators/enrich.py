"""Abstracts from several providers: validated, compared, selected."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmill.functions.text import empty_to_null, normalize_doi, similarity, title_key, unmarked
from litmill.operators.quality import all_true, text_gate

TITLE_RATIO, AGREEMENT = 0.85, 0.90


def folded_similarity(a: Column, b: Column) -> Column:
    """Similarity of two texts that are folded already, to six digits; equal ones need no matching."""
    same = (a == b) & (a != "")
    return F.when(same, 1.0).otherwise(F.round(similarity(F.when(~F.coalesce(same, F.lit(False)), a), b), 6))


def validate(candidates: DataFrame) -> DataFrame:
    """Candidates with ``accepted``, the reasons against and warnings. DOIs are
    compared in their canonical form, titles folded and without markup; a year
    that is one off is a warning, a larger gap a reason. A ``parse_warning`` of
    the provider's answer is a warning too, where there is such a column."""
    doi, year = normalize_doi(F.col("doi")), F.col("candidate_year") - F.col("publish_year")
    ratio = folded_similarity(title_key(F.col("title")), title_key(unmarked(F.col("candidate_title"))))
    rows = candidates.withColumn("ratio", ratio).withColumn("gate", text_gate(F.col("candidate_text")))
    reasons = all_true(
        {
            "doi_mismatch": ~F.coalesce(doi == normalize_doi(F.col("candidate_doi")), F.lit(False)),
            "title_missing": F.col("candidate_title").isNull(),
            "title_mismatch": F.col("candidate_title").isNotNull() & (F.col("ratio") < TITLE_RATIO),
            "year_mismatch": F.abs(year) > 1,
            "text_unusable": F.col("gate") != "ok",
        }
    )
    warnings = all_true({"year_missing": year.isNull(), "publication_year_differs": year != 0})
    if "parse_warning" in candidates.columns:
        warnings = F.array_compact(F.array_append(warnings, empty_to_null(F.col("parse_warning"))))
    return rows.withColumn("reasons", reasons).withColumn("warnings", warnings).withColumn("accepted", F.size("reasons") == 0)


def by_provider(records: DataFrame, answers: DataFrame, providers: Sequence[str], key: str = "doi") -> DataFrame:
    """Records with one outcome a provider: found, not_found, or error; a
    provider's failure keeps the record."""
    seen = answers.groupBy(key).pivot("provider", list(providers)).agg(F.min("outcome"))
    out = records.join(seen, key, "left")
    return out.withColumns({p: F.when(F.col(key).isNull(), "no_key").otherwise(F.coalesce(p, F.lit("not_found"))) for p in providers})


def agreement(accepted: DataFrame, key: str) -> DataFrame:
    """Similarity of every two accepted candidates of a record, case, width and
    punctuation aside. A record has as many as there are providers."""
    folded = accepted.select(key, "priority", title_key(F.col("candidate_text")).alias("folded"))
    left, right = (folded.select(key, F.col("priority").alias(n), F.col("folded").alias(f"text_{n}")) for n in "ab")
    pairs = left.join(right, key).where("a < b")
    return pairs.select(key, "a", "b", folded_similarity(F.col("text_a"), F.col("text_b")).alias("similarity"))


def select_source(records: DataFrame, candidates: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """The abstract of each record: none on conflict, else the accepted one of
    the first provider, else the one it had."""
    good = candidates.where("accepted")
    first = good.groupBy(key).agg(F.min_by(F.struct("provider", "candidate_text"), "priority").alias("best"))
    low = pairs.groupBy(key).agg(F.min("similarity").alias("lowest"))
    failed = candidates.groupBy(key).agg(F.bool_or("failed").alias("failed"))
    rows = records.join(first, key, "left").join(low, key, "left").join(failed, key, "left")
    status = (
        F.when(F.col("doi").isNull(), "no_doi")
        .when(F.col("lowest") < AGREEMENT, "conflict")
        .when(F.col("best").isNotNull(), "found")
        .when(F.col("previous").isNotNull(), "retained_previous")
        .when(F.coalesce("failed", F.lit(False)), "missing_with_errors")
        .otherwise("missing")
    )
    chosen = F.when(status == "found", F.col("best.candidate_text")).when(status.isin("retained_previous", "conflict"), F.col("previous"))
    return rows.select(key, status.alias("status"), F.when(status == "found", F.col("best.provider")).alias("provider"), chosen.alias("abstract"))


def coverage(selected: DataFrame) -> DataFrame:
    """Found and missing abstracts, in all and by provider."""
    found = F.count(F.when(F.col("status").isin("found", "retained_previous"), 1))
    out = selected.rollup("provider").agg(F.count("*").alias("n"), found.alias("found"), F.grouping("provider").alias("total"))
    return out.withColumn("percent", F.round(100 * F.col("found") / F.col("n"), 2))


def provider_overlaps(accepted: DataFrame, key: str, providers: Sequence[str]) -> DataFrame:
    """For every set of providers how many records all of them answer, in one pass."""
    flags = accepted.groupBy(key).agg(*(F.bool_or(F.col("provider") == p).alias(p) for p in providers))
    sets = [s for n in range(1, len(providers) + 1) for s in itertools.combinations(providers, n)]
    counts = flags.agg(*(F.count_if(reduce(lambda x, y: x & y, map(F.col, s))).alias("+".join(s)) for s in sets))
    each = F.array(*(F.struct(F.lit("+".join(s)).alias("providers"), F.col(f"`{'+'.join(s)}`").alias("n")) for s in sets))
    return counts.select(F.explode(each).alias("x")).select("x.*")


def cache_split(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Requests with whether the cache answers them."""
    known = requests.join(cache.select(key).distinct(), key, "left_semi").withColumn("state", F.lit("cached"))
    return known.unionByName(requests.join(cache.select(key), key, "left_anti").withColumn("state", F.lit("to_fetch")))


def map_batch(asked: DataFrame, answers: DataFrame, batch: str, key: str, payload: str) -> DataFrame:
    """The outcome of each key of each batch. Absence is proven only by a batch
    that answers as many rows as it declares."""
    per_key = answers.groupBy(batch, key).agg(F.count("*").alias("rows"), F.countDistinct(payload).alias("different"), F.min(payload).alias(payload))
    sizes = asked.groupBy(batch).agg(F.max("declared").alias("declared")).join(answers.groupBy(batch).agg(F.count("*").alias("got")), batch, "left")
    both = asked.select(batch, key).distinct().withColumn("asked", F.lit(True)).join(per_key, [batch, key], "full_outer").join(sizes, batch, "left")
    complete = F.coalesce(F.col("declared") == F.coalesce("got", F.lit(0)), F.lit(False))
    outcome = F.when(F.col("asked").isNull(), "unexpected").when(F.col("different") > 1, "ambiguous").when(F.col("rows") > 0, "found").when(complete, "not_found").otherwise("error")
    return both.select(batch, key, outcome.alias("outcome"), payload)


def negative_proof(claims: DataFrame, archive: DataFrame) -> DataFrame:
    """Claims of absence with whether the archived batch has the hash they name
    and holds nothing in their place."""
    both = claims.join(archive, ["batch", "place"], "left")
    good = F.coalesce((F.col("claimed_sha256") == F.col("sha256")) & F.col("payload").isNull(), F.lit(False))
    return both.withColumn("proven", good)


def rebuild_text(index: DataFrame, key: str) -> DataFrame:
    """Texts from ``(key, word, position)``; null unless the positions are 0 to n-1."""
    words = index.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("position").cast("long").alias("position"), "word"))).alias("words"))
    # Without a distinct count a word moves once, in the list of its text.
    good = F.coalesce(F.col("words.position") == F.sequence(F.lit(0).cast("long"), F.size("words").cast("long") - 1), F.lit(False))
    return words.select(key, F.when(good, F.array_join("words.word", " ")).alias("text"))
