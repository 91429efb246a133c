import random

import pytest

from litmill.llm import near_duplicates as near
from litmill.llm.shingles import shingle_set, word_hashes

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in SPACE else c for c in text).split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    texts = {}
    for d in range(n):
        kind = rng.random()
        if kind < 0.35 and texts:
            base = words(texts[rng.choice(list(texts))]) or ["a"]
            for _ in range(rng.randint(0, 5)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts[d] = " ".join(base)
        elif kind < 0.6:
            texts[d] = " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)) + passage)
        else:
            texts[d] = rng.choice(["\t", " ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(0, 120)))
    return texts | {n: None, n + 1: "", n + 2: "One two", n + 3: "one  TWO", n + 4: "x " * 30_000, n + 5: "X\n" * 30_001}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, documents, monkeypatch, seed):
    if seed == 2:  # many fragments, sparse counts, salted buckets
        monkeypatch.setattr(near, "HOT_ROWS", 5)
        monkeypatch.setattr(near, "FRAGMENT_BYTES", 2000)
    texts = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(documents(texts).repartition(3)).collect()}
    assert got == brute(texts)


def test_a_chain_of_near_copies_is_one_group(spark, documents, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 500)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    texts = {}
    for d in range(150):
        own = list(base)
        for _ in range(rng.randint(1, 5)):
            own[rng.randrange(150)] = f"x{d}-{rng.random()}"
        texts[d] = " ".join(own)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(documents(texts)).collect()}
    assert got == brute(texts)


def test_repeated_rows_null_ids_empty_table_and_extra_columns(spark, documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(4, text, 1, 9), (4, text, 2, 9), (4, "quite another text of some words", 3, 9), (9, text, 4, 9), (None, text, 5, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, component long")
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect()) == [(0, 26, 4), (4, 2, 4), (4, 26, 4), (4, 26, 4), (9, 26, 4)]
    assert near.near_duplicates(documents([])).collect() == []
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.key for r in kept.collect()) == [1, 2, 3, 5]


def test_rows_of_one_id_are_decided_one_by_one(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    docs = spark.createDataFrame([(3, a, 1), (4, a, 2), (4, b, 3), (5, b, 4), (4, None, 5), (6, a, 6)], "doc_id long, text string, gone int")
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.gone for r in kept.collect()) == [1, 3, 5]


def test_words_are_bytes_between_ascii_spaces():
    assert len(word_hashes("a　b\tc".encode())) == 2
    assert word_hashes(b"ABC x")[0] == word_hashes(b"x abc")[1]
    assert len(shingle_set(b"one two three")) == 1 and len(shingle_set(b" \n")) == 0
    many = {f"{a}{b}{c}" for a in "abcé" for b in "bcda" for c in "cdab"}
    assert len(set(word_hashes(" ".join(many).encode()).tolist())) == len(many)
