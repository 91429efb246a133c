import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from litmill.llm import packing as p

PATH = public_tokenizers.path("word_bpe_49k.json")


def checked(rows, length):
    """Sequences without gap, overlap or overflow; their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def test_ids_pieces_and_places(spark, documents):
    texts = {0: None, 1: "", 2: "Hello, WORLD.  It's <|endoftext|> fineİ., İ.", 3: "é 　x\r\ny 12ab", 4: "word " * 9000, 5: "a", 6: "a"}
    docs = documents(texts).unionAll(documents({6: "a"})).withColumn("piece", docs_zero())
    rows = p.packed_documents(docs, PATH).collect()
    encoder = Tokenizer.from_file(PATH)
    encoder.encode_special_tokens = True
    for doc, text in texts.items():
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        want = [(i, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for i, at in enumerate(range(0, len(ids), 4096))]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc)
        assert got == (want if doc != 6 else want * 2)
    assert checked(rows, 4096) == -(-sum(r.length for r in rows) // 4096)
    assert p.packed_documents(documents([]), PATH).collect() == []


def docs_zero():
    from pyspark.sql import functions as F

    return F.lit(0)


def first_fit_decreasing(sizes, length):
    gaps = []
    for s in sorted(sizes, reverse=True):
        i = min((i for i, g in enumerate(gaps) if g >= s), key=lambda i: gaps[i], default=None)
        if i is None:
            gaps.append(length - s)
        else:
            gaps[i] -= s
    return len(gaps)


def test_as_few_sequences_as_best_fit(spark, monkeypatch):
    monkeypatch.setattr(p, "ROWS_PER_TASK", 100)  # several range partitions
    rng = random.Random(2)
    for sizes in ([rng.randint(1, 100) for _ in range(900)], [7] * 700 + [60] * 40, [100] * 20, [51] * 9, [1]):
        items = spark.createDataFrame(list(enumerate(sizes)), "id long, length long").repartition(4)
        rows = p.pack(items, 100).collect()
        assert len(rows) == len(sizes) and {r.id for r in rows} == set(range(len(sizes)))
        assert checked(rows, 100) <= first_fit_decreasing(sizes, 100) * 1.01 + 1


def test_a_range_of_many_batches_sweeps_as_one(spark, monkeypatch):
    """What a range has left is told batch by batch, with one row of ranks."""
    monkeypatch.setattr(p, "BATCH_ROWS", 7)
    monkeypatch.setattr(p, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})())}))
    rng = random.Random(6)
    rows = sorted(((rng.randint(1, 30), rng.randint(0, 1), i) for i in range(300)), key=lambda r: (-r[0], r[1], r[2]))
    batches = [p.pa.record_batch([p.pa.array(c) for c in zip(*rows[k : k + 20])], names=["size", "kind", "id"]) for k in range(0, 300, 20)]
    got = [tuple(r.values()) for b in p.sweep(iter(batches)) for r in b.to_pylist()]
    gaps, want, left = [], [], 0
    for size, kind, i in rows:
        if kind == 0:
            gaps.append((i, size))
        elif gaps:
            want.append((3, 2, 0, i, gaps.pop()[0], size))
        else:
            want.append((3, 1, left, i, None, size))
            left += 1
    assert got == want + [(3, 0, r, i, None, s) for r, (i, s) in enumerate(reversed(gaps))]


def test_across_matches_brackets():
    rng = random.Random(3)
    for _ in range(200):
        left = {k: (rng.randint(0, 4), rng.randint(0, 4)) for k in range(6)}
        stack, want = [], []
        for k, (items, gaps) in left.items():
            for i in range(items):
                if stack:
                    want.append((k, i, stack.pop()))
            stack += [(k, g) for g in reversed(range(gaps))]
        got = [(part, first + j, (gap, start + j)) for part, first, gap, start, n in p.across(left) for j in range(n)]
        assert got == want


def test_sequences_hold_the_tokens(spark, documents):
    pieces = p.tokenized(documents(["one two", "three"]), PATH).withColumn("id", p.F.monotonically_increasing_id())
    packed = p.pack(pieces)
    out = p.sequences(packed).collect()
    assert len(out) == 1 and sorted(np.frombuffer(out[0].ids, "<u4").tolist()).count(1) == 2
