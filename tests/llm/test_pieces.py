import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from litmill.llm import pieces
from litmill.llm.pieces import Vocabulary, decode, encode, op13_sentencepiece

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HOSTILE = [None, "", " ", "  ", "a", " a", "a ", "  a  b  ", "▁a▁▁b", "\n a\tb\0c", "<s> </s><unk> <0x0A>", "Å ﬁ 日本 語　x", "😀😀 \U0010ffff", " " * 40 + "x" + " " * 33, "▁", " ▁ "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def wanted(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return ids, library.decode(ids)


def unpacked(data):
    return np.frombuffer(data, "<u4").tolist()


def test_against_the_library(spark, documents, library, monkeypatch):
    monkeypatch.setattr(pieces, "BYTES_AT_ONCE", 500)
    rng = random.Random(9)
    signs = [" ", "  ", "▁", "the", "ing", "é", "ñ", "1", "\n", "\t", "日", "😀", ".", "ca", "s", "́", "\0", "<0x41>"]
    texts = HOSTILE + ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(1500)]
    texts += ["x" * 30_000, "word wort " * 30_000]
    out = decode(encode(documents(texts).repartition(3), MODEL), MODEL).collect()
    assert {r.doc_id: (unpacked(r.ids), r.decoded) for r in out} == {i: wanted(library, t) for i, t in enumerate(texts)}
    assert all(r.n_tokens * 4 == len(r.ids) for r in out)


def test_a_full_table_is_emptied(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 3000)
    known = Vocabulary(open(MODEL, "rb").read())
    assert known.splits
    for k in range(20):
        text = " ".join(f"w{k}x{i} the" for i in range(40))
        ids, bounds = known.encoded(pa.array([text, None, "the"]), 1, 2)
        assert ids[: bounds[1]].tolist() == wanted(library, text)[0] and ids[bounds[1] :].tolist() == [1, 2, *wanted(library, "the")[0]]
        assert len(known.table) < 150


def test_pieces_over_markers_make_whole_texts_chunks(library):
    known = Vocabulary(open(MODEL, "rb").read())
    known.splits = False
    texts = ["a b", "", None, " c", "a b"]
    ids, bounds = known.encoded(pa.array(texts), 1, 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [wanted(library, t)[0] for t in texts]
    assert len(known.table) == 2


def test_any_ids_decode_as_the_library_does(spark, library):
    rng = random.Random(4)
    rows = [[], [1, 2], [0], [1, 0, 500], [2, 29900, 300], [200, 130], [100, 400, 220, 221]]
    rows += [[rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(12))] for _ in range(500)]
    frame = spark.createDataFrame([(i, np.array(r, "<u4").tobytes()) for i, r in enumerate(rows)] + [(-1, None)], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in decode(frame, MODEL).collect()}
    assert got == {-1: ""} | {i: library.decode(r) if r else "" for i, r in enumerate(rows)}
    with pytest.raises(Exception, match="beyond the vocabulary"):
        decode(spark.createDataFrame([(np.array([32000], "<u4").tobytes(),)], "ids binary"), MODEL).collect()


def test_nulls_repeats_clashing_columns_and_no_rows(spark, library):
    rows = [(None, "a b", 1, "x"), (5, "c", 2, "y"), (5, "c d", 3, None), (6, None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, decoded string").withColumn("kept", F.lit("k"))
    out = decode(encode(docs, MODEL), MODEL).collect()
    assert sorted((str(r.doc_id), unpacked(r.ids), r.decoded, r.kept) for r in out) == sorted((str(i), *wanted(library, t), "k") for i, t, _, _ in rows)
    assert decode(encode(docs.limit(0), MODEL), MODEL).collect() == []


def test_query(spark, tables, documents, library):
    folder = tables(documents=documents(HOSTILE))
    want = set()
    for i, t in enumerate(HOSTILE):
        ids, text = wanted(library, t)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in op13_sentencepiece(spark, folder).collect()} == want
