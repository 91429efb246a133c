"""Fill-in-middle: texts cut in three at line ends, with the middle moved last.

A text of ``n`` lines is cut at two of its ``n + 1`` borders, both told by a
hash of its id. The three parts move by displacement: for a block of texts laid
end to end, a difference array holds by how much the shift of a byte differs
from that of the byte before it, its cumulative sum is the shift of every byte,
and one numpy scatter writes all outputs at once. Restoring finds the control
strings in an output, derives the same shifts from their places alone and
gathers the bytes back.

Scale: one scan without a shuffle. Rows are taken in blocks of some megabytes,
and shifts are summed over ``BLOCK`` bytes at a time, so a very long text costs
its own size and that of its output.

Defined cases: a null text is empty; an empty text, one that holds a control
string, and one beyond the rate stay plain, that is as they are; a null id is
hashed as an empty string, and rows that repeat an id are each cut alike; other
columns pass through, but for those that the operator writes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import flat, per_batch, sliced, table, unflat

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Length of a control string; its first sign stands nowhere else in one, so two never overlap.
SIGN = 3
SEED = 7
RATE = 100
SPM_BELOW = 50
BYTES_AT_ONCE = 4 << 20
#: Bytes whose shifts are held together.
BLOCK = 4 << 20
MADE = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
FORMS = ("plain", "psm", "spm")


def signs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where control strings begin, and the row of each."""
    room = max(len(data) - SIGN + 1, 0)
    found = np.zeros(room, bool)
    for sign in (PREFIX, SUFFIX, MIDDLE):
        found |= np.logical_and.reduce([data[i : room + i] == byte for i, byte in enumerate(sign)])
    at = np.flatnonzero(found)
    row = np.searchsorted(bounds, at, "right") - 1
    whole = at + SIGN <= bounds[row + 1]
    return at[whole], row[whole]


def borders(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, callable]:
    """How many lines each row has, and a function from line numbers (one a
    row) to the place where as many lines have ended."""
    ends = np.append(np.flatnonzero(data == 10) + 1, 0)
    first, last = (np.searchsorted(ends[:-1], b, "right") for b in (bounds[:-1], bounds[1:]))
    held = last - first
    open_end = (bounds[1:] > bounds[:-1]) & (np.append(0, data)[bounds[1:]] != 10)

    def place(lines: np.ndarray) -> np.ndarray:
        inside = ends[np.where((lines > 0) & (lines <= held), first + lines - 1, -1)]
        return np.where(lines == 0, bounds[:-1], np.where(lines <= held, inside, bounds[1:]))

    return held + open_end, place


def shifts(starts: np.ndarray, by: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, slice]]:
    """Where each byte goes, block by block: parts begin at ``starts``, in
    order, and move ``by`` so much. Parts that begin together are empty but for
    the last, whose shift is what their differences sum up to."""
    steps, carry = np.diff(by, prepend=0), 0
    for begin in range(0, size, BLOCK):
        end = min(begin + BLOCK, size)
        low, high = np.searchsorted(starts, (begin, end))
        moves = np.zeros(end - begin, np.int64)
        np.add.at(moves, starts[low:high] - begin, steps[low:high])
        moves[0] += carry
        np.cumsum(moves, out=moves)
        carry = moves[-1]
        moves += np.arange(begin, end)
        yield moves, slice(begin, end)


def points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points between places of UTF-8."""
    leads = np.append((data & 0xC0) != 0x80, False).astype(np.int8)
    sums = np.add.reduceat(leads, np.stack([starts, ends], 1).ravel(), dtype=np.int64)[::2]
    return np.where(ends > starts, sums, 0)


def arranged(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All outputs end to end and their bounds. Cuts are places in ``data``;
    ``form`` counts in ``FORMS``."""
    start, end = bounds[:-1], bounds[1:]
    p, m, s = first - start, second - first, end - second
    cut = form > 0
    out_bounds = np.append(0, np.cumsum(end - start + 3 * SIGN * cut))
    base, psm = out_bounds[:-1], form == 1
    prefix = np.where(psm, base + SIGN, base + 2 * SIGN + s)
    suffix = np.where(psm, base + 2 * SIGN + p, base + SIGN)
    middle = base + 3 * SIGN + p + s
    to = np.where(cut[:, None], np.stack([prefix, middle, suffix], 1), base[:, None] + np.stack([start, first, second], 1) - start[:, None])
    starts = np.stack([start, first, second], 1)
    out = np.empty(out_bounds[-1], np.uint8)
    for moves, part in shifts(starts.ravel(), (to - starts).ravel(), len(data)):
        out[moves] = data[part]
    for sign, at in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)):
        for i, byte in enumerate(sign):
            out[at[cut] - SIGN + i] = byte
    return out, out_bounds


def rearranged(out: np.ndarray, out_bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that ``arranged`` was given, from its outputs and forms."""
    cut = form > 0
    base, last = out_bounds[:-1], out_bounds[1:]
    bounds = np.append(0, np.cumsum(last - base - 3 * SIGN * cut))
    at, row = signs(out, out_bounds)
    at = at[cut[row]]
    if len(at) != 3 * cut.sum():
        raise ValueError("an output of a form other than plain holds three control strings")
    one, two, three = np.repeat(base[None, :], 3, 0)
    one[cut], two[cut], three[cut] = at[::3] + SIGN, at[1::3] + SIGN, at[2::3] + SIGN
    psm = form == 1
    here, there = (two - one - SIGN) * cut, (three - two - SIGN) * cut  # sizes of the first and the second part
    p, s = np.where(psm, here, there), np.where(psm, there, here)
    start = bounds[:-1]
    starts = np.stack([start, start + p, bounds[1:] - s], 1)
    source = np.stack([np.where(psm, one, two), three, np.where(psm, two, one)], 1)
    starts[~cut], source[~cut] = start[~cut, None], base[~cut, None]
    text = np.empty(bounds[-1], np.uint8)
    for moves, part in shifts(starts.ravel(), (source - starts).ravel(), len(text)):
        text[part] = out[moves]
    return text, bounds


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_below: int = SPM_BELOW) -> DataFrame:
    """``docs`` with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and
    ``output``. Of a hundred documents ``rate`` are cut, and of those
    ``spm_below`` get the suffix first."""
    rest = [c for c in docs.columns if c not in MADE]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"__h{i}") for i in range(4)]

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for some in sliced(batch, "text", BYTES_AT_ONCE):
            data, bounds = flat(some.column("text"))
            h = [some.column(f"__h{i}").to_numpy() for i in range(4)]
            n, place = borders(data, bounds)
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            plain = (n == 0) | (h[2] % 100 >= rate)
            plain[signs(data, bounds)[1]] = True
            form = np.where(plain, 0, np.where(h[3] % 100 < spm_below, 2, 1))
            first, second = place(np.minimum(one, two)), place(np.maximum(one, two))
            out = unflat(*arranged(data, bounds, first, second, form), pa.string())
            chars = [pa.array(points(data, a, b), mask=plain) for a, b in ((bounds[:-1], first), (first, second))]
            made = [pa.array(n, pa.int64()), pa.array(FORMS).take(pa.array(form)), *chars, out]
            yield pa.record_batch({c: some.column(c) for c in rest} | dict(zip(MADE, made)))

    schema = docs.select(*rest, *(F.lit(None).cast(t).alias(c) for c, t in MADE.items())).schema
    return docs.select(*rest, *hashes).mapInArrow(per_batch(cut), schema)


def restored(filled: DataFrame) -> DataFrame:
    """``filled`` with ``restored``: the text, from ``output`` and ``form`` alone."""
    rest = [c for c in filled.columns if c != "restored"]

    def back(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for some in sliced(batch, "output", BYTES_AT_ONCE):
            form = some.column("form").to_pylist()
            text = rearranged(*flat(some.column("output")), np.array([FORMS.index(f) for f in form], np.int64))
            yield pa.record_batch({c: some.column(c) for c in rest} | {"restored": unflat(*text, pa.string())})

    return filled.select(*rest).mapInArrow(per_batch(back), filled.select(*rest, F.lit("").alias("restored")).schema)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restored(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
         sha256('7:' || CAST(doc_id AS VARCHAR)) AS digest
  FROM documents
), sized AS (
  SELECT *, CASE WHEN text = '' THEN 0 WHEN parts[-1] = '' THEN len(parts) - 1 ELSE len(parts) END AS n,
         [CAST('0x' || substr(digest, 8 * CAST(i AS INT) + 1, 8) AS BIGINT) FOR i IN range(4)] AS h
  FROM cut
), placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
              THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM sized
), sides AS (
  SELECT doc_id, n, form, text,
         CASE WHEN a = len(parts) THEN text WHEN a = 0 THEN '' ELSE array_to_string(parts[1:a], chr(10)) || chr(10) END AS head,
         CASE WHEN b = len(parts) THEN text WHEN b = 0 THEN '' ELSE array_to_string(parts[1:b], chr(10)) || chr(10) END AS both_parts
  FROM placed
), three AS (
  SELECT doc_id, n, form, text, head, substr(both_parts, length(head) + 1) AS middle, substr(text, length(both_parts) + 1) AS tail
  FROM sides
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(head) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || middle
              ELSE '<S>' || tail || '<P>' || head || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM three
"""
