import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from litmill.llm import resampling
from litmill.llm.resampling import ngram_crcs, op11_importance_resampling, resampled

HOSTILE = [None, "", "   ", "One", "one two", "ÉCOLE École 日本 語", "a\0b\x7fc", "x" * 5000 + " " + "y" * 70_000, "a b " * 400]


def features(text, longest=2):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)
    return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, items, percent=25, min_words=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([d for _, d in docs], items))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words, found = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    order = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for k, r in enumerate(order[: percent * len(order) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def made(n, seed):
    rng = random.Random(seed)
    words = ["casa", "der", "The", "x1", "été", "日本", "-", "...", "B", "of"] + [f"w{i}" for i in range(40)]
    return [" ".join(rng.choices(words, k=rng.choice([3, 19, 20, 25, 80]))) for _ in range(n)]


def test_crcs_of_runs_from_two_prefixes():
    texts = HOSTILE + made(50, 1)
    got = {n: list(zip(row.tolist(), crc.tolist())) for n, (row, crc) in enumerate(ngram_crcs(pa.array(texts), 4), 1)}
    for n, found in got.items():
        want = [(r, zlib.crc32(f.encode())) for r, t in enumerate(texts) for f in (lambda x: x[len(features(t, n - 1)[1]) :])(features(t, n)[1])]
        assert found == want
    assert [len(r) for r, _ in ngram_crcs(pa.array(["", None]), 2)] == [0, 0]


def test_shifts_are_zero_bytes():
    crc = np.array([zlib.crc32(b"ab")] * 5, np.uint32)
    length = np.array([0, 1, 7, 1000, 1 << 17])
    want = [zlib.crc32(b"ab" + bytes(n)) ^ zlib.crc32(bytes(n)) for n in length.tolist()]
    assert resampling.shifted(crc, length).tolist() == want


def test_against_brute_force(spark, documents, tables, monkeypatch):
    monkeypatch.setattr(resampling, "BYTES_AT_ONCE", 900)
    texts, items = HOSTILE + made(300, 2), [None, *made(12, 3)]
    folder = tables(documents=documents(texts).repartition(5), benchmark=spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = sorted(tuple(r) for r in op11_importance_resampling(spark, folder).collect())
    assert got == sorted(brute(list(enumerate(texts)), items), key=lambda r: r[0])
    assert sum(r[4] is not None for r in got) > 20


def test_nulls_repeats_clashing_columns_and_empty_tables(spark):
    text = made(1, 5)[0] + " word" * 30
    rows = [(None, text, 1), (5, text, 2), (5, text, 3), (6, None, 4), (7, text, 5), (8, text, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, weight int")
    target = spark.createDataFrame([(0, "word word")], "item_id long, text string")
    key = lambda r: tuple(map(str, r))
    take = lambda f: sorted((tuple(r) for r in f.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key)
    assert take(resampled(docs, target, percent=60)) == sorted(brute([r[:2] for r in rows], ["word word"], 60), key=key)
    assert take(resampled(docs, target.limit(0))) == sorted(brute([r[:2] for r in rows], []), key=key)
    assert take(resampled(docs.limit(0), target)) == []
