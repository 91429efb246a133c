"""Tasks, decisions and reviewers."""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litmill.functions.text import zoned
from litmill.operators.components import numbered
from litmill.operators.metrics import boundary_pairs, exact_pairs, in_source, one_to_one, without
from litmill.operators.quality import all_true
from litmill.sources.scratch import Scratch


def decisions_on_tasks(tasks: DataFrame, decisions: DataFrame) -> DataFrame:
    """Every task and decision with how they meet."""
    d = decisions.groupBy("type", "uid").agg(F.count("*").alias("answers"), F.min("object_sha256").alias("answered_sha256"), F.min("decision").alias("decision"))
    both = tasks.join(d, ["type", "uid"], "full_outer")
    state = F.when(F.col("object_sha256").isNull(), "unknown_task").when(F.col("answers").isNull(), "unanswered").when(F.col("answers") > 1, "answered_twice").when(F.col("object_sha256") != F.col("answered_sha256"), "object_changed").otherwise("ok")
    return both.withColumn("state", state)


def decision_faults(decisions: DataFrame, choices: Sequence[str], need_notes: Sequence[str], now: Column) -> DataFrame:
    """Decisions with the rules they break; a pending one must be empty."""
    pending = F.col("status") == "pending"
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    late = F.coalesce(F.try_to_timestamp("reviewed_at") > now, F.lit(False))
    rules = {
        "pending_with_data": pending & ~blank("decision"),
        "choice_not_allowed": ~pending & ~F.coalesce(F.col("decision").isin(*choices), F.lit(False)),
        "reviewer_missing": ~pending & blank("reviewer"),
        "time_without_zone": ~pending & ~zoned(F.col("reviewed_at")),
        "time_in_future": ~pending & late,
        "notes_missing": ~pending & F.col("decision").isin(*need_notes) & blank("notes"),
    }
    return decisions.withColumn("faults", all_true(rules))


def agreement_levels(rows: DataFrame, field: str) -> DataFrame:
    """Counts of match levels by field."""
    return rows.groupBy(field).pivot("level", ["exact", "boundary", "category", "a_only", "b_only"]).agg(F.count(F.lit(1))).na.fill(0)


def consensus(reviews: DataFrame) -> DataFrame:
    """Cases with what two reviewers agree on."""
    sides = reviews.groupBy("case_id", "case_type").agg(F.max(F.when(F.col("reviewer") == "A", F.col("category"))).alias("a"), F.max(F.when(F.col("reviewer") == "B", F.col("category"))).alias("b"))
    return sides.withColumn("agree", F.coalesce(F.col("a") == F.col("b"), F.lit(False))).withColumn("label", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise("needs_human_review"))


def pair_compare(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two annotators' items one to one. Equal values of a field pair off, the k-th
    with the k-th; what that leaves of a document is matched by boundaries, then by
    the same span under another field, the first of a side first. Sources are looked
    at before any row moves and stay where they are; spans that no item of the other
    side has under another field are done without a group of their own."""
    on, names = [key, "field"], {"gold_place": "a_place", "pred_place": "b_place"}
    a, b = (in_source(t.withColumn("place", F.col("place").cast("long"))) for t in (a, b))
    scratch = Scratch(a.sparkSession, "compare")
    exact = scratch.save(exact_pairs(a, b, on).drop("value"), "exact")
    rest = [without(t, exact, on, c) for t, c in ((a, "gold_place"), (b, "pred_place"))]
    near = boundary_pairs(*(t.where("__sound") for t in rest), on, (a, b))
    near = scratch.save(one_to_one(near, on, "gold_place", "pred_place"), "boundary")
    rest = [without(t, near, on, c).select(*on, "place", "a_start", "a_end", F.lit(left).alias("left")) for t, c, left in ((rest[0], "gold_place", True), (rest[1], "pred_place", False))]
    place = Window.partitionBy(key, "a_start", "a_end")
    both = F.bool_or("left").over(place) & F.bool_or(~F.col("left")).over(place)
    named = F.count("field").over(place)
    fields = (F.min("field").over(place) != F.max("field").over(place)) | ((named > 0) & (named < F.count("*").over(place)))
    met = F.col("a_start").isNotNull() & F.col("a_end").isNotNull() & both & F.coalesce(fields, F.lit(False))
    rows = rest[0].unionByName(rest[1]).repartition(key).withColumn("met", met)
    only = lambda c, left: F.when(F.col("left") == left, F.col("place")).alias(c)
    alone = rows.where("not met").select(key, F.when(F.col("left"), "a_only").otherwise("b_only").alias("level"), "field", only("a_place", True), only("b_place", False))
    met_rows = rows.where("met").select(key, "a_start", "a_end", "left", "field", "place")
    kind = dict(a.dtypes)[key]

    def match(x: pa.Table, y: pa.Table) -> pa.Table:
        order = lambda t: sorted(zip(t["place"].to_pylist(), (f or "" for f in t["field"].to_pylist()), t["field"].to_pylist()))
        free: dict[str | None, deque] = {}
        for item in order(y):
            free.setdefault(item[2], deque()).append(item[:2])
        out = []
        for at, _, field in order(x):
            found = min(((held[0], f) for f, held in free.items() if held and f != field), key=lambda h: h[0], default=None)
            out.append(("a_only", field, at, None) if found is None else ("category", field, at, free[found[1]].popleft()[0]))
        out += [("b_only", field, None, at) for field, held in free.items() for at, _ in held]
        of = pa.array([x[key][0].as_py()] * len(out), x.schema.field(key).type)
        return pa.table([of, *map(pa.array, zip(*out), (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=[key, "level", "field", "a_place", "b_place"])

    left, right = (met_rows.where(F.col("left") == side).select(*(F.col(c).alias(c) for c in (key, "a_start", "a_end", "field", "place"))) for side in (True, False))
    category = left.groupBy(key, "a_start", "a_end").cogroup(right.groupBy(key, "a_start", "a_end")).applyInArrow(match, f"`{key}` {kind}, level string, field string, a_place long, b_place long")
    done = [t.withColumnsRenamed(names).select(key, F.lit(level).alias("level"), "field", "a_place", "b_place") for t, level in ((exact, "exact"), (near, "boundary"))]
    return done[0].unionByName(done[1]).unionByName(alone).unionByName(category)


def assemble(agreed: DataFrame, disputed: DataFrame, decisions: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Agreed items with the side that a decision chose of disputed ones; and
    the disputed without a decision, for review."""
    judged = disputed.join(decisions, list(key), "left")
    value = F.when(F.col("choice") == "A", F.col("a_value")).when(F.col("choice") == "B", F.col("b_value")).when(F.col("choice") == "MODIFY", F.col("new_value"))
    chosen = judged.where("choice is not null").select(*key, value.alias("value")).where("value is not null")
    return agreed.select(*key, "value").unionByName(chosen).distinct(), judged.where("choice is null").select(*key, "a_value", "b_value")


def case_numbers(rows: DataFrame, order: Sequence[str], prefix: str = "F") -> DataFrame:
    """Cases numbered in order."""
    return numbered(rows, order).withColumn("case_id", F.format_string(f"{prefix}%03d", "place")).drop("place")


#: What a reference row can say of its field.
REFERENCE_STATUSES = ("reported", "not_reported", "not_applicable", "uncertain")


def sheet_faults(rows: DataFrame) -> DataFrame:
    """Reference rows with the first rule they break: each occurrence of a field
    once, a known status, a reviewer, evidence for what is reported and no value
    for what is absent. Pending rows need only be unique."""
    blank = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    copies = rows.groupBy("uid", "field", "occurrence").agg(F.count("*").alias("_copies"))
    both = rows.join(copies, ["uid", "field", "occurrence"], "left")
    status = F.col("status")
    fault = (
        F.when(F.col("_copies").isNull() | blank("uid") | blank("field") | blank("occurrence") | (F.col("_copies") > 1), "duplicate_or_missing_occurrence")
        .when(status == "pending", None)
        .when(~F.coalesce(status.isin(*REFERENCE_STATUSES), F.lit(False)), "invalid_status")
        .when(blank("reviewer"), "reviewer_required")
        .when((status == "reported") & (blank("value") | blank("evidence_text")), "reported_needs_evidence")
        .when(status.isin("not_reported", "not_applicable") & ~blank("value"), "absence_has_value")
    )
    return both.withColumn("fault", fault).drop("_copies")


def key_checks(child: DataFrame, parent: DataFrame, key: str, parent_key: str, filled: Sequence[str], allowed: Mapping[str, Sequence[str]], primary: str) -> DataFrame:
    """``(check, n)``: broken references, empty columns, values not allowed,
    repeated keys."""
    orphan = child.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti").agg(F.lit("foreign_key").alias("check"), F.count("*").alias("n"))
    tests = {f"empty_{c}": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in filled}
    tests |= {f"not_allowed_{c}": ~F.coalesce(F.col(c).isin(*v), F.lit(False)) for c, v in allowed.items()}
    counted = child.agg(*(F.count(F.when(t, 1)).alias(n) for n, t in tests.items()))
    wide = counted.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in tests))).alias("x")).select("x.*")
    again = child.groupBy(primary).agg(F.count("*").alias("c")).where("c > 1").agg(F.lit("primary_key").alias("check"), F.count("*").alias("n"))
    return orphan.unionByName(wide).unionByName(again)


def clusters(items: DataFrame) -> DataFrame:
    """Open items by field and kind: how many, of how many papers, one example."""
    return items.groupBy("field", "kind").agg(F.count("*").alias("n"), F.countDistinct("uid").alias("papers"), F.min_by("item", "pos").alias("example"))


def flag_tasks(flags: DataFrame) -> DataFrame:
    """One task for the flags of a place, urgent if one of them is."""
    key = F.left(F.sha2(F.concat_ws("|", F.col("doi").cast("string"), "path"), 256), F.lit(24))
    return flags.groupBy("doi", "path").agg(F.bool_or(F.col("severity") == "high").alias("high"), F.array_join(F.sort_array(F.collect_set("type")), ",").alias("types"), F.count("*").alias("n")).withColumn("task_key", key)


def apply_decisions(rows: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Lists with what reviewed decisions remove; a decision counts only if its
    kept value is there and each removed one is there once. Before and after stay."""
    both = rows.join(decisions, key, "left")
    once = F.forall("remove", lambda x: F.size(F.filter("items", lambda y: y == x)) == 1)
    good = F.col("keep").isNotNull() & F.array_contains("items", F.col("keep")) & once
    return both.withColumn("applied", F.coalesce(good, F.lit(False))).withColumn("after", F.when(F.col("applied"), F.array_except("items", "remove")).otherwise(F.col("items")))


def backfill(rows: DataFrame, text: str = "text") -> DataFrame:
    """A missing certainty set where claim, quote and source slice are the same."""
    piece = F.substring(F.col(text), F.col("a_start") + 1, F.col("a_end") - F.col("a_start"))
    eligible = F.col("certainty").isNull() & (F.col("claim") == F.col("quote")) & (piece == F.col("quote"))
    return rows.withColumn("change", F.when(eligible, "set").when(F.col("certainty").isNull(), "not_eligible").otherwise("kept")).withColumn("certainty", F.when(eligible, "explicit").otherwise(F.col("certainty")))


def registry_drift(registry: DataFrame, pool: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Registered rows whose columns changed in the pool, or that it lost."""
    now = pool.select(key, *(F.col(c).alias(f"_{c}") for c in columns), F.lit(True).alias("_there"))
    both = registry.join(now, key, "left")
    changed = all_true({c: ~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns})
    return both.select(key, F.when(F.col("_there").isNull(), F.array(F.lit("missing"))).otherwise(changed).alias("drift")).where(F.size("drift") > 0)
