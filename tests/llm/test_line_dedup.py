import hashlib
import random

from pyspark.sql import functions as F

from litmill.llm.line_dedup import line_dedup, op10_line_dedup

SPACE = " \t\n\x0b\x0c\r"


def brute(docs):
    """``{doc_id: (n_lines, kept)}`` of distinct ids by the letter of the contract."""
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    held = {}
    for doc, text in docs.items():
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(held[key(x)]) >= 2 and min(held[key(x)]) != doc)]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_against_brute_force(spark, documents, tables):
    rng = random.Random(3)
    lines = ["Shared Line of Text", "shared line of text \x0b", "\tÉcole normale été", "école normale été", "short", "", "ten chars!", "nine char", "a unique %d line here", "　wide space kept", "é" * 10]
    texts = {i: "\n".join(x % i if "%d" in x else x for x in rng.choices(lines, k=rng.randint(0, 8))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "x" * 200_000 + "\n" + "shared line of text", 63: "\n\n"}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op10_line_dedup(spark, tables(documents=documents(texts))).collect()}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in brute(texts).items()}


def test_repeats_nulls_and_clashing_columns(spark):
    rows = [(5, "a line that repeats\nmine only here", 1, "p"), (5, "a line that repeats\nmine only here", 2, "q"), (7, "a line that repeats", 3, "r"), (None, "a line that repeats", 4, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int, drop string").withColumn("_doc", F.lit(1)).withColumn("keeper", F.lit(2))
    out = {r.line: (r.text, r.n_dropped, r["drop"]) for r in line_dedup(docs).collect()}
    assert out[1] == out[1][:1] + (0, "p") and out[2][1] == 0  # one document, its rows keep the line
    assert out[3] == ("", 1, "r") and out[4] == ("a line that repeats", 0, "s")


def test_threshold_and_empty_table(spark, documents):
    docs = documents(["common line number one"] * 2 + ["common line number two"] * 3)
    assert sorted(r.n_dropped for r in line_dedup(docs, min_docs=3).collect()) == [0, 0, 0, 1, 1]
    assert line_dedup(documents([])).collect() == []
