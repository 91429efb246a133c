import random

import duckdb

from litmill.llm.decontaminate import OP3_SQL, decontaminate, leaks, op3_decontaminate

ITEM = "the quick brown fox jumps over the lazy dog while seven other animals look on in silence and wonder why".split()


def test_finds_replaced_words_and_leaves_short_overlaps(spark, documents):
    rng = random.Random(1)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    every = lambda k: [w if i % k else f"r{i}" for i, w in enumerate(ITEM)]
    texts = {
        1: " ".join(filler(50) + ITEM + filler(20)),
        2: " ".join(filler(5) + every(4)),
        3: "  ".join(w.upper() + "," for w in every(3)) + " end",
        4: " ".join(filler(30) + ITEM[:6] + filler(30)),
        5: " ".join(filler(80)),
        6: None,
        7: "",
        8: " ".join(filler(20_000) + ITEM),
        9: " ".join(every(2)),
    }
    items = spark.createDataFrame([(0, " ".join(ITEM), 1), (1, None, 1), (2, "", 1), (0, " ".join(ITEM), 1)], "item_id long, text string, words int")
    found = {r.doc_id: r for r in leaks(documents(texts), items).collect()}
    assert set(found) == {1, 2, 3, 8, 9}
    assert found[1].n_matched == len(ITEM) == found[1].n_words and found[1].start == 50
    assert found[2].n_matched == sum(i % 4 > 0 for i in range(len(ITEM)))
    kept = decontaminate(documents(texts), items)
    assert kept.columns == documents(texts).columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7]


def test_partial_item_at_an_end_and_empty_tables(spark, documents):
    items = spark.createDataFrame([(0, " ".join(ITEM))], "item_id long, text string")
    cut = documents({1: " ".join(ITEM[6:]), 2: " ".join(ITEM[:12]) + " zz", 3: " ".join(ITEM[:8])})
    assert sorted(r.doc_id for r in leaks(cut, items).collect()) == [1, 2]
    assert leaks(documents([]), items).collect() == [] and leaks(cut, items.limit(0)).collect() == []


def test_the_plan_runs_no_python(spark, documents):
    items = spark.createDataFrame([(0, " ".join(ITEM))], "item_id long, text string")
    plan = leaks(documents(["a b"]), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastNestedLoop" not in plan


def test_stretches_shifts_and_short_items(spark, documents):
    rng = random.Random(2)
    filler = lambda n: [f"f{rng.randrange(10**9)}" for _ in range(n)]
    long = [f"w{i}" for i in range(300)]
    middle = [f"m{i}" for i in range(38)]
    items = spark.createDataFrame([(0, " ".join(ITEM)), (1, " ".join(long)), (2, " ".join(middle)), (3, "Five words, and no more"), (4, "zebra"), (5, "  ")], "item_id long, text string")
    texts = {
        1: filler(40) + long[120:220] + filler(40),
        2: filler(9) + middle[10:20] + filler(9),
        3: filler(9) + middle[10:19] + filler(9),
        4: ITEM[:7] + ["put", "in"] + ITEM[7:14] + ["once", "more"] + ITEM[14:],
        5: filler(3) + ITEM[:7] + ITEM[8:15] + filler(3),
        6: ["five", "words", "and", "no", "more"],
        7: ["five", "words", "and", "so", "more"],
        8: filler(4) + ["zebra"] + filler(4),
        9: [],
        10: ITEM[:6] + filler(60) + ITEM[10:16],
        11: filler(5) + [w if i % 3 else f"r{i}" for i, w in enumerate(long[200:220])] + filler(5),
        12: filler(5) + [w if i not in (6, 7, 8, 9) else f"r{i}" for i, w in enumerate(long[30:46])] + filler(5),
    }
    for limit in (2_000_000, 0):  # hits by broadcast and by shuffle
        with_limit(limit, lambda: check(leaks(documents({d: " ".join(w) for d, w in texts.items()}), items).collect()))


def test_repeated_words_and_the_oracle(spark, documents, tables):
    """Degenerate texts stay cheap, and Spark, by either join, agrees with the SQL."""
    rng = random.Random(4)
    few = lambda n: [f"v{rng.randrange(6)}" for _ in range(n)]
    texts = {0: "same " * 500, 1: "ab cd " * 200, 2: " ".join(few(200)), 3: "x same " + "same " * 12 + "y", 4: " ".join(ITEM[:11]) + " zz " + "same " * 60, 5: "zebra zebra zebra " * 5}
    texts |= {10 + i: " ".join(few(40) + ITEM[rng.randrange(9) :] + few(9)) for i in range(10)}
    items = [(0, "same " * 60), (1, "ab cd " * 20), (2, " ".join(few(30))), (3, " ".join(ITEM)), (4, " ".join(few(12) + ITEM[:12])), (5, "zebra"), (6, "same same same"), (7, "")]
    folder = tables(documents=documents(texts), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    rows = {}
    for limit in (2_000_000, 0):
        with_limit(limit, lambda: rows.update({limit: ordered(op3_decontaminate(spark, folder))}))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    want = sorted(con.execute(f"select doc_id, item_id, n_words, n_matched, start from ({OP3_SQL})").fetchall())
    assert rows[0] == want and rows[2_000_000] == want
    assert {(0, 0), (1, 1), (0, 6), (5, 5)} <= {r[:2] for r in want}


def ordered(frame):
    return sorted((r.doc_id, r.item_id, r.n_words, r.n_matched, r.start) for r in frame.collect())


def with_limit(limit, run):
    from litmill.llm import decontaminate as module

    before, module.BROADCAST_SEEDS = module.BROADCAST_SEEDS, limit
    try:
        run()
    finally:
        module.BROADCAST_SEEDS = before


def check(rows):
    found = {(r.doc_id, r.item_id): r for r in rows}
    assert sorted(found) == [(1, 1), (2, 2), (4, 0), (5, 0), (6, 3), (8, 4), (11, 1), (12, 1)]
    assert found[1, 1].n_matched == 100 and found[1, 1].start == 40 - 120
    assert found[2, 2].n_matched == 10 and found[4, 0].n_matched == len(ITEM)
    assert found[8, 4].n_words == found[8, 4].n_matched == 1 and found[8, 4].start == 4
