import random
import zlib

from litmill.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int"
GOOD = "the committee met on monday to discuss the plans for the new school and its garden"
BAD = "CLICK HERE!! WIN $$$ NOW!! FREE %%% DEALS &&& BEST PRICE!! BUY"


def corpus(n, rng):
    docs, labels = {}, []
    for d in range(n):
        bad, toxic = rng.random() < 0.4, rng.random() < 0.4
        w = rng.choices((BAD if bad else GOOD).split(), k=rng.randint(30, 120))
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["blorf", "zanky", "bl0rf", "z a n k y", "blooorf"]))
        docs[d] = " ".join(w)
        labels.append((d, int(not bad), int(toxic)))
    return docs, labels


def held(d, n, r):
    return zlib.crc32(str(d).encode()) % n == r


def test_held_out_accuracy_and_odd_texts(spark, documents, tables):
    docs, labels = corpus(600, random.Random(1))
    docs |= {1000: None, 1001: "", 1002: GOOD * 2000}
    folder = tables(documents=documents(docs).withColumnRenamed("lang", "score").unionAll(documents({5: docs[5]})), labels=spark.createDataFrame(labels + [(7, None, None), (None, 1, 1), (8, 5, 5)], LABELS))
    for query, column, n, r in ((quality.op6_quality, 1, 3, 1), (toxicity.op7_toxicity, 2, 4, 2)):
        rows = query(spark, folder).collect()
        assert len(rows) == 604 and all(0 <= x.score <= 1 for x in rows)
        assert all(x.held_out == held(x.doc_id, n, r) for x in rows)
        truth = {row[0]: row[column] for row in labels}
        test = [x for x in rows if x.held_out and x.doc_id in truth]
        assert sum(x.predicted == truth[x.doc_id] for x in test) / len(test) >= 0.95


def test_without_labels_or_documents(spark, documents, tables):
    none = spark.createDataFrame([], LABELS)
    folder = tables(documents=documents(["a", None]), labels=none)
    assert {r.score for r in quality.op6_quality(spark, folder).collect()} == {0.5}
    assert {r.score for r in toxicity.op7_toxicity(spark, folder).collect()} == {0.0}
    folder = tables(documents=documents([]), labels=none)
    assert quality.op6_quality(spark, folder).collect() == [] and toxicity.op7_toxicity(spark, folder).collect() == []


def test_decoder_restores_disguises(spark, documents):
    import numpy as np

    text = "the idiot and the loser met a moron who said that this is stupid and worthless scum " * 50
    counts = np.zeros(toxicity.SYMBOLS**3, np.int64)
    for r in toxicity.trigram_counts(documents([text, None, ""])).collect():
        counts[r.gram] = r.n
    c = toxicity.codes(text)
    want = np.bincount((c[:-2] * toxicity.SYMBOLS + c[1:-1]) * toxicity.SYMBOLS + c[2:], minlength=len(counts))
    assert (counts == want).all()
    decode = toxicity.Decoder(toxicity.costs(counts))
    for said, meant in {"1d10t": "idiot", "l0s3r": "loser", "m0r0n": "moron", "i d i o t": "idiot", "l-o-s-e-r": "loser", "$tup1d": "stupid", "looooser": "loser", "idi0t!!": "idiot", "5cum": "scum"}.items():
        assert meant in list(decode.restored(f"the {said} and")), said
    assert list(decode.restored("plain words, nothing else")) == []


def test_the_decoder_finds_the_cheapest_path(spark):
    """Viterbi against every path of small lattices."""
    import itertools

    import numpy as np

    rng = random.Random(8)
    counts = np.array([rng.choice([0, 0, 1, 5, 40]) for _ in range(toxicity.SYMBOLS**3)])
    decoder = toxicity.Decoder(toxicity.costs(counts))
    for _ in range(60):
        text = "".join(rng.choice("abe01*$. aab\u0436") for _ in range(rng.randint(1, 6)))
        for spaced in (False, True):
            best = np.inf
            for path in itertools.product(*decoder.arcs(text, spaced)):
                out = "".join(x for x, _ in path)
                s = [0, 0, *map(toxicity.symbol, out), 0]
                cost = sum(c for _, c in path) + sum(decoder.cost[a][b][c] for a, b, c in zip(s, s[1:], s[2:]))
                if cost < best - 1e-9:
                    best, word = cost, out
            got = decoder.decode(text, spaced)
            assert got == word or price(decoder, text, spaced, got) <= best + 1e-6


def price(decoder, text, spaced, word):
    import itertools

    costs = []
    for path in itertools.product(*decoder.arcs(text, spaced)):
        if "".join(x for x, _ in path) == word:
            s = [0, 0, *map(toxicity.symbol, word), 0]
            costs.append(sum(c for _, c in path) + sum(decoder.cost[a][b][c] for a, b, c in zip(s, s[1:], s[2:])))
    return min(costs)


def test_letters_of_any_width_may_repeat():
    for letter in ("a", "\u00e9", "\u0436", "\u4e2d", "\U00010400"):
        assert toxicity.signs_of_length(f"x{letter * 3}y")[0] and not toxicity.signs_of_length(f"x{letter * 2}y")[0]


def test_extra_columns_and_a_text_above_the_bound(spark, documents, monkeypatch, tables):
    docs, labels = corpus(200, random.Random(3))
    long = [d for d, _, t in labels if not held(d, 3, 1) and not held(d, 4, 2)][:4]
    docs |= {d: docs[d] + (" " + GOOD) * 200 for d in long}
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 12_000)
    folder = tables(documents=documents(docs).withColumn("label", quality.F.lit("x")).withColumn("held", quality.F.lit(1)), labels=spark.createDataFrame(labels, LABELS))
    for rows in (quality.op6_quality(spark, folder).collect(), toxicity.op7_toxicity(spark, folder).collect()):
        assert len(rows) == 200 and len({round(r.score, 3) for r in rows}) > 1


def test_a_long_text_does_not_end_the_sample(spark, documents):
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(60).orderBy(F.xxhash64("id")).collect()]
    labels = [(d, i % 2, i % 2) for i, d in enumerate(ids)]
    long = set(ids[:12])  # first of both classes in the order of the hash
    docs = documents({d: "long " * 2000 if d in long else f"text {d} " * 10 for d in ids})
    for name in ("quality", "toxic"):
        got = quality.labelled_sample(docs, spark.createDataFrame(labels, LABELS), name, 5, 5000).collect()
        assert sorted(r.label for r in got) == [0] * 5 + [1] * 5 and not long & {r.doc_id for r in got}
        assert {r.doc_id for r in got} == set(ids[12:22])
    only = documents({d: "long " * (150 + d) for d in range(4)})
    got = quality.labelled_sample(only, spark.createDataFrame([(d, 1, 1) for d in range(4)], LABELS), "toxic", 5, 2000).collect()
    assert sorted(r.doc_id for r in got) == [0, 1]


def test_scores_find_doubled_letters_and_pieces(spark, documents):
    import numpy as np

    text = "the idiot and the loser met a moron who said that this is stupid and worthless scum, an ass " * 50
    counts = np.zeros(toxicity.SYMBOLS**3, np.int64)
    for r in toxicity.trigram_counts(documents([text])).collect():
        counts[r.gram] = r.n
    model = {"weights": {"": -5.0, "idiot": 8.0, "stupi~": 8.0, "ass": 8.0}, "costs": toxicity.costs(counts)}
    said = ["iddiot", "stuppid", "id iot", "stu pid", "st-upid", "i   d   i   o   t", "i:d:i:o:t", "i\u2013d\u2013i\u2013o\u2013t", "id\u00b7iot", "st-up-id", "idiott", "as s", "a s  s", "iddi-ott"]
    clean = ["aside it is to the", "rapid iota", "idio", "as so", "id and iot", "said io tea", "study", "id 7 iot", ""]
    rows = toxicity.toxicity_scores(documents([f"the {x} met" for x in said + clean]), model).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert [x for i, x in enumerate(said + clean) if (scores[i] >= toxicity.THRESHOLD) != (i < len(said))] == []
