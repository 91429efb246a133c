import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from litmill.llm import infill
from litmill.llm.infill import FORMS, arranged, fill_in_middle, op12_fill_in_middle, rearranged, restored


def brute(doc_id, text, seed=7, rate=100, spm_below=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text, text
    if h[3] % 100 < spm_below:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


HOSTILE = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "é\n<P\n>", "<P>", "x<M>y\nz", "<", "P>\n<S", "<S\n<", "a\r\nb c\x85d\n", "日本\n語\n\n", "<P<P\n>>", "S>", "\0\n\0"]


def test_against_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", 7)
    rng = random.Random(3)
    texts = HOSTILE + ["".join(rng.choice(["\n", "ab", "é", "<", "P>", "<S", "😀", "\r"]) for _ in range(rng.randrange(40))) for _ in range(400)]
    texts += ["word " * 200_000 + "\nend", "line\n" * 50_000]
    docs = documents(texts).repartition(3)
    for rate, spm in ((100, 50), (60, 10)):
        rows = restored(fill_in_middle(docs, rate=rate, spm_below=spm)).collect()
        got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows}
        assert got == {i: brute(i, t, rate=rate, spm_below=spm) for i, t in enumerate(texts)}
        assert {r[1] for r in got.values()} == set(FORMS)


def test_blocks_of_any_size_give_the_same_bytes(monkeypatch):
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 9, 200)
    bounds = np.append(0, np.cumsum(sizes))
    data = rng.integers(97, 100, bounds[-1]).astype(np.uint8)
    cuts = np.sort(bounds[:-1, None] + rng.integers(0, sizes[:, None] + 1, (200, 2)), 1)
    form = rng.integers(0, 3, 200)
    want = None
    for block in (1, 3, 64, 1 << 20):
        monkeypatch.setattr(infill, "BLOCK", block)
        out = arranged(data, bounds, cuts[:, 0], cuts[:, 1], form)
        want = want if want is not None else out[0].tobytes()
        assert out[0].tobytes() == want
        text, again = rearranged(*out, form)
        assert text.tobytes() == data.tobytes() and again.tolist() == bounds.tolist()


def test_an_output_without_its_signs_is_refused():
    with pytest.raises(ValueError):
        rearranged(np.frombuffer(b"<P>ab<S>c", np.uint8), np.array([0, 9]), np.array([1]))


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    rows = [(None, "a\nb", 1, "x"), (5, "a\nb\nc", 2, "y"), (5, "a\nb\nc", 3, None), (6, None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, output string").withColumn("kept", F.lit("k"))
    out = restored(fill_in_middle(docs)).collect()
    want = sorted((str(i), *map(str, brute(i, t))) for i, t, _, _ in rows)
    assert sorted(tuple(map(str, (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored))) for r in out) == want
    assert {r.kept for r in out} == {"k"}
    assert restored(fill_in_middle(docs.limit(0))).collect() == []


def test_query(spark, tables, documents):
    folder = tables(documents=documents(HOSTILE))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {tuple(r) for r in op12_fill_in_middle(spark, folder).collect()}
    assert got == {(i, *b[:4], sha(b[4]), sha(b[5])) for i, b in ((i, brute(i, t)) for i, t in enumerate(HOSTILE))}
