import random

import corpus_pipeline

LABELS = "doc_id long, quality int, toxic int"


def test_each_stage_takes_effect_and_clean_documents_stay(spark, documents, tables):
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(3000)]
    text = lambda: " ".join(rng.choices(vocabulary, k=60))
    texts = {d: text() for d in range(80)}
    labels = []
    for d in range(100, 260):
        bad = d % 2 == 0
        texts[d] = text() + (" blorf " if bad else " ") + text()
        labels.append((d, 1, int(bad)))
    item = " ".join(rng.choices(vocabulary, k=30))
    near = texts[4].split()
    near[30] = "another"
    texts |= {300: texts[3], 301: " ".join(near), 302: text() + " " + item, 303: "one common line of text\n" + text(), 304: "one common line of text\n" + text(), 305: None, 306: ""}
    folder = tables(documents=documents(texts).withColumnRenamed("source", "score"), labels=spark.createDataFrame(labels, LABELS), benchmark=spark.createDataFrame([(0, item)], "item_id long, text string"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != "best_fit_packing":
            assert sorted(after.columns) == sorted(docs.columns)
        docs = spark.createDataFrame(after.collect(), after.schema)
        kept[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {d for d in range(100, 260) if d % 2 == 0}
    assert set(texts) - set(kept["toxicity"]) == toxic
    assert kept["line_dedup"][304].text.count("\n") == 0 and kept["line_dedup"][303].text == texts[303]
    assert set(kept["toxicity"]) - set(kept["line_dedup"]) == {300} and {305, 306} <= set(kept["line_dedup"])
    assert set(kept["line_dedup"]) - set(kept["near_duplicates"]) == {301}
    assert set(kept["near_duplicates"]) - set(kept["decontaminate"]) == {302}
    assert set(kept["best_fit_packing"]) == set(kept["decontaminate"])
    assert set(range(3)) <= set(kept["best_fit_packing"])


def test_stages_take_nulls_repeats_and_empty_tables(spark, documents, tables):
    item = " ".join(f"i{i}" for i in range(20))
    base = [f"b{i}" for i in range(60)]
    texts = [(None, "a null id with some text"), (1, None), (1, " ".join(base)), (1, " ".join(base)), (2, " ".join(base[:59] + ["z"])), (2, "another text of a repeated id"), (3, ""), (4, item), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", n, 0) for n, (i, t) in enumerate(texts)], "doc_id long, text string, lang string, score int, n_lines int")
    labels = spark.createDataFrame([(None, 1, 1), (1, 1, None), (4, 1, 0)], LABELS)
    want = {"toxicity": set(range(9)), "line_dedup": set(range(9)), "near_duplicates": set(range(9)) - {4}, "decontaminate": set(range(9)) - {4, 7}}
    for empty in (False, True):
        rows = docs.limit(0) if empty else docs
        folder = tables(documents=rows, labels=labels.limit(0) if empty else labels, benchmark=spark.createDataFrame([] if empty else [(0, item), (None, "x"), (1, None)], "item_id long, text string"))
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, rows, folder)
            got = after.collect()
            if name in want:
                assert after.columns == docs.columns and {r.score for r in got} == (set() if empty else want[name]), name
                rows = spark.createDataFrame(got, after.schema)
            else:
                assert len(got) == (0 if empty else 7)


def test_run_equals_its_stages(spark, documents, tables):
    texts = {d: " ".join(f"w{(d * 7 + i) % 97}x{d}" for i in range(40)) for d in range(20)}
    folder = tables(documents=documents(texts), labels=spark.createDataFrame([], LABELS), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(texts)
