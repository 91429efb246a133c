"""Toxicity behind a noisy channel: restore disguised words, then score.

A character trigram model is counted over all documents. Where a text shows
signs of disguise - a digit or sign among letters, a letter three times in a
row, single letters set apart - its characters become a lattice: a sign may be
itself or a letter it stands for, one of a run of equal letters may fall away,
a separator between single letters may fall away or stay. The Viterbi path of
least cost under the trigram model restores the text. A token without such
signs has one path, itself, so it is not decoded. Doubled letters and words cut
in pieces are far too common to decode all: when texts are scored, a stretch
becomes a lattice too if its letters, joined and runs of them taken as one,
begin like a lexicon entry. Its pieces are single letters with anything but
letters and digits between them, or longer ones one such character apart.

Restored words are scored by a logistic model over a short lexicon of words and
beginnings of words. The lexicon is chosen on labelled rows: an entry must be
hardly ever in clean ones and cover toxic ones that no entry before it covers,
a few times over, so that words that merely accompany a toxic passage stay out.

Scale: the counts of a task are bounded by the alphabet (``SYMBOLS`` cubed), so
every document is counted at the cost of one small table a task; the model that
is sent out has that bound too. The fit takes at most ``SAMPLE_ROWS`` labelled
rows and ``SAMPLE_BYTES`` of text a class by hash of the id; all words and
beginnings there that toxic rows favour enough may enter the lexicon, and each
entry must add rows, so the sample bounds both. Scoring is one scan without a
shuffle.

Defined cases: null and empty texts hold no word and get the score of such
texts; a null id gets a row as any other; labels that are null or neither 0
nor 1 are ignored; without labelled rows of both classes every score is 0;
rows that repeat an id are each scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import crc_of_id, per_batch, table, tidy
from litmill.llm.quality import labelled_sample, logistic
from litmill.sources.scratch import Scratch

SAMPLE_ROWS = 2500
SAMPLE_BYTES = 10 << 20
#: Lengths of the beginnings of words that count as features beside the words.
STEMS = (4, 5, 6, 7)
DEPTH = 3
THRESHOLD = 0.3
#: The letters that a digit or sign stands for.
STANDS_FOR = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h"}
SEPARATORS = " .-_*/\\,'~"
#: Costs in nats besides those of the model.
SWAP, KEEP_SIGN, KEEP_AT_END, DROP_REPEAT, KEEP_REPEAT, DROP_SEPARATOR, KEEP_SEPARATOR = 0.5, 6.0, 0.5, 0.7, 0.7, 0.2, 1.0
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbol 0 is a break, 1 to 26 the letters, the rest letters beyond ASCII by remainder.
OTHERS = 37
SYMBOLS = 27 + OTHERS

LEET = re.escape("".join(STANDS_FOR))
#: A sign that touches a letter; the token around it is what gets decoded.
SIGN = re.compile(rf"(?<=[^\W\d_])[{LEET}]|[{LEET}](?=[^\W\d_])")
TOKEN = re.compile(rf"(?:[^\W_]|[{LEET}])+")
REPEAT = re.compile(r"([^\W\d_])\1\1")
SPACED = re.compile(rf"(?<![^\W_])(?:[^\W_]|[$@!|])(?:[{re.escape(SEPARATORS)}]{{1,2}}(?:[^\W_]|[$@!|])(?![^\W_])){{2,}}")
#: What may lie between the pieces of a word.
GAP = re.compile(r"[\W_]+")
RUN = re.compile(r"(.)\1+")
#: Two or more of one sign at an end of a token are punctuation.
EDGES = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$")
WORD = re.compile(r"[^\W\d_]+")


def symbol(char: str) -> int:
    code = ord(char)
    return code - 96 if 97 <= code <= 122 else 27 + code % OTHERS if char.isalpha() else 0


def codes(text: str) -> np.ndarray:
    """Symbols of a lower-cased text, with a break at either end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 2, np.int64)
    letter = (points >= 97) & (points <= 122)
    beyond = points >= 0xC0
    out[1:-1] = np.where(letter, points - np.uint32(96), np.where(beyond, np.uint32(27) + points % np.uint32(OTHERS), np.uint32(0)))
    return out


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``(gram, n)`` over the whole texts of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text := text.as_py():
                    c = codes(text.lower())
                    grams = (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:]
                    if len(grams) > len(total) // 8:
                        total += np.bincount(grams, minlength=len(total))
                    else:
                        np.add.at(total, grams, 1)
        seen = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(seen.astype(np.int32)), "n": pa.array(total[seen])})

    parts = docs.where("text is not null").select("text").mapInArrow(tidy(count), "gram int, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a symbol after two others, each mixed with
    the shorter histories."""
    tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    one = (uni + 1) / (uni.sum() + SYMBOLS)
    two = (bi + 2 * one) / (bi.sum(1, keepdims=True) + 2)
    three = (tri + 2 * two) / (tri.sum(2, keepdims=True) + 2)
    return -np.log(three).astype(np.float32)


class Decoder:
    """Viterbi decoding of character lattices under the trigram costs."""

    def __init__(self, table_of_costs: np.ndarray):
        self.cost = table_of_costs.tolist()
        self.memory: dict[str, str] = {}

    def arcs(self, text: str, spaced: bool) -> Iterator[list[tuple[str, float]]]:
        """For each character what may come out of it; '' falls away."""
        for i, char in enumerate(text):
            before = text[i - 1] if i else ""
            if spaced and char in SEPARATORS:
                yield [("", DROP_SEPARATOR), (" ", KEEP_SEPARATOR)]
            elif char in STANDS_FOR:
                end = not char.isdigit() and i in (0, len(text) - 1)
                yield [(x, SWAP) for x in STANDS_FOR[char]] + [(" ", KEEP_AT_END if end else KEEP_SIGN)]
            elif before and char.isalpha() and char in STANDS_FOR.get(before, before):
                yield [("", DROP_REPEAT), (char, KEEP_REPEAT)]
            else:
                yield [(char if char.isalpha() else " ", 0.0)]

    def __call__(self, text: str, spaced: bool = False) -> str:
        key = text + "\0" * spaced
        if key not in self.memory:
            if len(self.memory) > 200_000:
                self.memory.clear()
            self.memory[key] = self.decode(text, spaced)
        return self.memory[key]

    def decode(self, text: str, spaced: bool) -> str:
        # A state is the last two symbols; it keeps its cheapest history as a linked list.
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for arcs in self.arcs(text, spaced):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, past) in states.items():
                row = self.cost[a][b]
                for out, own in arcs:
                    if not out:
                        to, total, path = (a, b), so_far + own, past
                    else:
                        s = symbol(out)
                        to, total, path = (b, s), so_far + own + row[s], (past, out)
                    if to not in after or total < after[to][0]:
                        after[to] = (total, path)
            states = after
        _, path = min((c + self.cost[a][b][0], i, p) for i, ((a, b), (c, p)) in enumerate(states.items()))[1:]
        out = []
        while path:
            path, char = path
            out.append(char)
        return "".join(reversed(out))

    def restored(self, text: str) -> Iterator[str]:
        """Words that the disguised stretches of a lower-cased text stand for."""
        done = 0
        for sign in SIGN.finditer(text):
            if sign.start() >= done:
                token = around(text, sign.start())
                done = token.end()
                inner = EDGES.sub("", token[0])
                if not inner.isalpha() and not inner.isdigit():
                    yield from self(inner).split()
        again, apart = signs_of_length(text)
        if again:
            done = 0
            for run in REPEAT.finditer(text):
                if run.start() >= done:
                    token = around(text, run.start())
                    done = token.end()
                    yield from self(EDGES.sub("", token[0])).split()
        if apart:
            for found in SPACED.finditer(text):
                yield from self(found[0], True).split()
                yield "".join(c for c in found[0] if c not in SEPARATORS)


def around(text: str, at: int) -> re.Match:
    """The token that holds a position."""
    start = at
    while start and (text[start - 1].isalnum() or text[start - 1] in STANDS_FOR):
        start -= 1
    return TOKEN.match(text, start)


def signs_of_length(text: str) -> tuple[bool, bool]:
    """Whether a letter may come three times in a row, and whether three single
    characters may stand apart: a quick look before the patterns."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) < 3:
        return False, False
    same = data[1:] == data[:-1]
    again = bool((same[1:] & same[:-1] & (data[2:] >= 97)).any())
    for n, first, last in ((2, 0xC0, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xFF)):  # letters of several bytes
        if not again and len(data) >= 3 * n:
            lead, middle, end = data[: len(data) - 2 * n], data[n : len(data) - n], data[2 * n :]
            again = bool(((lead == middle) & (middle == end) & (lead >= first) & (lead <= last)).any())
    kind = LONE[data]
    word = np.concatenate([[False], kind > 0, [False]])
    lone = np.flatnonzero(word[1:-1] & ~word[:-2] & ~word[2:])
    near = np.diff(lone) <= 3
    return again, bool((near[1:] & near[:-1]).any())


LONE = np.zeros(256, np.uint8)
LONE[[*range(48, 58), *range(97, 123), *map(ord, "$@!|"), *range(128, 256)]] = 1


@cache
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Cut:
    """Stretches of a text that begin like an entry of a lexicon once pieces are
    joined and runs of a letter taken as one, and are not written plainly."""

    def __init__(self, lexicon: Iterable[str]):
        self.parts: dict[str, bool] = {}  # whether something may follow in the same token
        for entry in lexicon:
            word = entry.rstrip("~")
            for part in {word, RUN.sub(r"\1", word)}:
                self.parts[part] = self.parts.get(part, False) or entry[-1] == "~"

    def __call__(self, text: str) -> Iterator[str]:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letter_table()[points]
        kept = letter.copy()
        kept[1:] &= ~(letter[:-1] & (points[1:] == points[:-1]))
        at = np.flatnonzero(kept)
        joined = points[at].tobytes().decode("utf-32-le")
        for part, more in self.parts.items():
            found = joined.find(part)
            while found >= 0:
                start, last = int(at[found]), int(at[found + len(part) - 1])
                if not start or not letter[start - 1]:
                    end = last + 1
                    while end < len(text) and text[end] == text[last]:
                        end += 1
                    if more or end == len(text) or not letter[end]:
                        while end < len(text) and letter[end]:
                            end += 1
                        if text[start : last + 1] != part or text[last + 1 : last + 2] == text[last]:
                            pieces, gaps = GAP.split(text[start:end]), GAP.findall(text[start:end])
                            if all(p.isalpha() for p in pieces) and (all(len(g) == 1 for g in gaps) or all(len(RUN.sub(r"\1", p)) == 1 for p in pieces)):
                                yield " ".join(pieces)
                found = joined.find(part, found + 1)


def features(text: str, decoder: Decoder) -> set[str]:
    """Words of a text, restored ones too, and their first letters (``abcd~``)."""
    low = text.lower()
    words = set(WORD.findall(low)) | set(decoder.restored(low))
    return words | {w[:k] + "~" for w in words for k in STEMS if len(w) > k}


def cover(rows: list[tuple[int, set[int]]], names: list[str], depth: int = DEPTH) -> list[int]:
    """Greedy cover of the toxic rows, each ``depth`` times: the feature taken
    is in the most rows that hold fewer of those before it; of equals the
    longest. Features of which one begins the other count as one."""
    left, chosen = [[0, held] for y, held in rows if y and held], []
    least = max(4, 0.006 * sum(y for y, _ in rows))  # more than chance leaves to words of a copied passage
    stems = [name.rstrip("~") for name in names]
    barred: set[int] = set()
    while left:
        gain = Counter(x for _, held in left for x in held if x not in barred)
        best, n = max(gain.items(), key=lambda x: (x[1], len(stems[x[0]]), names[x[0]]), default=(0, 0))
        if n < least:
            break
        chosen.append(best)
        barred |= {i for i, s in enumerate(stems) if s.startswith(stems[best]) or stems[best].startswith(s)}
        for row in left:
            row[0] += best in row[1]
        left = [row for row in left if row[0] < depth]
    return chosen


def fit(rows: list[tuple[int, set[int]]], names: list[str]) -> dict[str, float]:
    """Feature weights, with the intercept under ''; empty if a class is missing."""
    y = np.array([float(label) for label, _ in rows])
    if not len(y) or y.min() == y.max():
        return {}
    chosen = cover(rows, names)
    x = np.array([[1.0, *(c in held for c in chosen)] for _, held in rows])
    weights = logistic(x, y, ridge=0.05)
    # A feature speaks for toxicity or not at all.
    return {"": float(weights[0]), **{names[c]: max(0.0, float(v)) for c, v in zip(chosen, weights[1:])}}


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> dict:
    counts = np.zeros(SYMBOLS**3, np.int64)
    for row in trigram_counts(docs).toLocalIterator():  # at most SYMBOLS cubed rows
        counts[row.gram] = row.n
    table_of_costs = costs(counts)
    sample = labelled_sample(docs, labels, "toxic", rows, size)

    def counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, total = Decoder(table_of_costs), (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[label].update(features(text, decoder))
        names = list(total[1])
        yield pa.record_batch({"feature": pa.array(names, pa.string()), "toxic": pa.array([total[1][x] for x in names], pa.int64()), "clean": pa.array([total[0][x] for x in names], pa.int64())})
        # Features that only clean rows hold can't enter, yet a task must tell of those that another task has in toxic rows.
        names = [x for x in total[0] if x not in total[1]]
        yield pa.record_batch({"feature": pa.array(names, pa.string()), "toxic": pa.array([0] * len(names), pa.int64()), "clean": pa.array([total[0][x] for x in names], pa.int64())})

    sample = Scratch(docs.sparkSession, "toxicity").save(sample.select("label", "text"), "sample")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = (F.col("toxic") / sizes.get(1, 1)) > 20 * (F.col("clean") + 0.2) / sizes.get(0, 1)
    known = sample.mapInArrow(counts_of, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    names = [r.feature for r in known.where((F.col("toxic") >= 3) & odds).orderBy(F.desc("toxic"), "feature").collect()]  # of the sample
    number = {name: i for i, name in enumerate(names)}

    def held_by(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(table_of_costs)
        held = [sorted(number[x] for x in features(t, decoder) if x in number) for t in batch.column(1).to_pylist()]
        yield pa.record_batch({"label": batch.column(0), "held": pa.array(held, pa.list_(pa.int32()))})

    read = sample.mapInArrow(per_batch(held_by), "label int, held array<int>").collect()
    weights = fit([(r.label, set(r.held)) for r in read], names)
    if weights:  # the classes were sampled apart: put the intercept at the share of toxic labels
        known = labels.where("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
        share = sum(r.label for r in read) / len(read)
        weights[""] += float(np.log(known / (1 - known)) - np.log(share / (1 - share)))
    return {"weights": weights, "costs": table_of_costs}


def toxicity_scores(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of ``docs`` and ``score``, the probability that a text is toxic."""
    weights, spark = model["weights"], docs.sparkSession
    lexicon = {w: v for w, v in weights.items() if w and v > 0}
    sent = spark.sparkContext.broadcast(model["costs"])  # SYMBOLS cubed floats
    looked_for = {w: (w.rstrip("~"), re.compile(r"(?<![^\W\d_])" + re.escape(w.rstrip("~")) + (r"(?=[^\W\d_])" if w[-1] == "~" else r"(?![^\W\d_])"))) for w in lexicon}
    docs = docs.drop("score")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, cut = Decoder(sent.value), Cut(lexicon)
        for batch in batches:
            out = []
            for value in batch.column("text"):
                low = (value.as_py() or "").lower()
                held = {w for w, (part, pattern) in looked_for.items() if part in low and pattern.search(low)}
                for w in chain(decoder.restored(low), *(decoder(x, True).split() for x in cut(low))):
                    held |= {x for x in (w, *(w[:k] + "~" for k in STEMS if len(w) > k)) if x in lexicon}
                z = weights.get("", -30.0) + sum(lexicon[w] for w in held)
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))) if weights else 0.0)
            yield pa.record_batch({**{c: batch.column(c) for c in batch.schema.names}, "score": pa.array(out, pa.float64())})

    return docs.mapInArrow(tidy(score), docs.withColumn("score", F.lit(0.0)).schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = crc_of_id() % 4 == 2
    scores = toxicity_scores(docs, fit_model(docs, labels.where(~held)))
    return scores.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
