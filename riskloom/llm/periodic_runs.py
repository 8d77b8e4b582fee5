"""Periodic run detection by scale-tiled distribution (operator 11).

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are the same) of at least ``max(min_words, min_exponent * q)`` words that
no neighbouring word extends with that period.

1. Tile. Periods fall into octaves [B, 2B), B = 8, 16, ... (those below 8 take
   B = 8 too). For each octave a document is exploded into tiles: a core of
   ``max(CORE, 8 * B)`` words with ``2 * B`` words more before it and ``4 * B``
   after it. At least ``2 * B`` consecutive words of a run equal the word ``q``
   further on, so one whole aligned block of B words does.
2. Solve a tile alone. Every aligned boundary ``b`` looks for the shifts ``q`` of
   the octave whose block equals its own (one comparison of B-word hashes a
   word), drops those whose period is a power of a shorter word, and takes the
   Z values of ``b`` at ``q``: how far the words after and before ``b`` agree
   with those ``q`` further on inside the tile. Fragments that end inside their
   tile and are too short for a run go.
3. Stitch. Fragments are shuffled by (document, period); those that overlap or
   touch become one, the long ones stay, and equal stretches keep the smallest
   period. Long documents and long runs leave many fragments, never a whole.

``collapse`` keeps the first ``q`` words of each run and drops the others.
Documents without fragments are finished in the first pass and shuffle nothing;
the others are written once with their words, under a key of the written row,
so that repeated rows never share a key.

Words are compared by 64-bit hashes within one document.

Defined cases: null text has no words; a document of fewer than ``min_words``
words has no run; rows that share a doc_id, or repeat, are separate documents;
a null doc_id stays null; a very long text is a segment of its own and its
tiles bound the work arrays; other columns are ignored, whatever their names;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, written
from .rolling import text_bytes, word_bounds, word_hashes

MIN_WORDS = 24
MIN_EXPONENT = 3
#: least words of a tile's core
CORE = 4096
#: bytes of text that are solved at once (one longer text alone)
SEGMENT_BYTES = 1 << 22
FRAGMENTS = "array<struct<period:long,start:long,end:long>>"
RUNS = "array<struct<start:long,length:long,period:long>>"


def octaves(longest: int, min_exponent: int = MIN_EXPONENT):
    """(B, least period, end of periods) for documents of up to ``longest`` words."""
    yield 8, 1, 8
    b = 8
    while b * min_exponent <= longest:
        yield b, b, 2 * b
        b *= 2


def _least_primes(n: int, store: list = [np.zeros(2, np.int64)]) -> np.ndarray:  # noqa: B006
    """The least prime factor of each number up to ``n`` (kept between calls)."""
    if len(store[0]) <= n:
        out = np.arange(2 * n + 2)
        for p in range(2, int(len(out) ** 0.5) + 1):
            if out[p] == p:
                part = out[p * p::p]
                part[part == np.arange(p * p, len(out), p)] = p
        store[0] = out
    return store[0]


def _same(grams: dict, at: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` words from ``at`` and from ``other`` are the same (two overlapping grams of a power of two)."""
    out = np.ones(len(at), bool)
    for k, h in grams.items():
        pick = np.flatnonzero((size >= k) & (size < 2 * k))
        if len(pick):
            a, b, over = at[pick], other[pick], size[pick] - k
            out[pick] = (h[a] == h[b]) & (h[a + over] == h[b + over])
    return out


def _primitive(grams: dict, b: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the ``q`` words from ``b`` are no power of a shorter word."""
    out, left = np.ones(len(q), bool), q.copy()
    least = _least_primes(int(q.max())) if len(q) else None
    while len(q) and left.max() > 1:
        r = np.where(left > 1, least[left], 1)
        step = q // r
        out &= (r == 1) | ~_same(grams, b, b + step, q - step)
        while True:
            more = (r > 1) & (left % r == 0)
            if not more.any():
                break
            left = np.where(more, left // r, left)
    return out


def _candidates(h: np.ndarray, rows: np.ndarray, block: int, low: int, high: int, least: int):
    """Boundaries and shifts whose blocks of ``block`` words are the same, in documents of ``least`` words or more."""
    size = np.diff(rows)
    pick = np.flatnonzero(size >= least)
    if not len(pick):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if low < block:  # each boundary against the shifts below the block size
        count = np.maximum((size[pick] - block) // block + 1, 0)
        row = np.repeat(pick, count)
        rel = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * block
        b = rows[row] + rel
        found = [(np.flatnonzero(good), q) for q in range(low, high)
                 for good in [np.where(rel + q + block <= size[row], h[b] == h[np.minimum(b + q, len(h) - 1)], False)]]
        return (np.concatenate([b[i] for i, _ in found]), np.concatenate([np.full(len(i), q) for i, q in found]),
                np.concatenate([row[i] for i, _ in found]))
    count = size[pick] - 2 * block + 1  # partners: all words with a block before them and a whole block from them on
    keep = count > 0
    pick, count = pick[keep], count[keep]
    row = np.repeat(pick, count)
    rel = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + block
    q = block + (rel & (block - 1))
    i = rel + rows[row]
    same = np.flatnonzero(h[i] == h[i - q])
    return (i - q)[same], q[same], row[same]


def z_values(words: np.ndarray, q: int, boundaries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary: the first and the end of the consecutive words around it that equal the word ``q`` further on."""
    apart = np.flatnonzero(words[:-q] != words[q:])
    at = np.searchsorted(apart, boundaries)
    ends = np.concatenate([apart, [len(words) - q]])
    return np.concatenate([[-1], apart])[at] + 1, ends[at]


def fragments(words: np.ndarray, rows: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT, core: int = CORE):
    """Fragments (row, period, start, end) of all documents of a segment; ``rows``: each document's first word, the end last."""
    out = []
    size = np.diff(rows)
    grams, level, width = {1: words}, words, 1
    for block, low, high in octaves(int(size.max()) if len(size) else 0, min_exponent):
        while width < block:
            level = _pairs(level, width)
            width *= 2
            grams[width] = level
        for k in [k for k in grams if 2 * k < block and low >= block]:
            del grams[k]
        if len(grams[block]) == 0:
            break
        b, q, row = _candidates(grams[block], rows, block, low, high, max(min_words, min_exponent * low))
        keep = _primitive(grams, b, q)
        b, q, row = b[keep], q[keep], row[keep]
        step = max(core, 8 * block)
        tile = (b - rows[row]) // step
        order = np.lexsort((b, q, tile, row))
        b, q, row, tile = b[order], q[order], row[order], tile[order]
        new = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (tile[1:] != tile[:-1]) | (row[1:] != row[:-1])])) if len(b) else b
        for i, j in zip(new, np.concatenate([new[1:], [len(b)]]) if len(b) else new):
            base, n, period = int(rows[row[i]]), int(size[row[i]]), int(q[i])
            lo, hi = max(0, int(tile[i]) * step - 2 * block), min(n, (int(tile[i]) + 1) * step + 4 * block)
            first, end = z_values(words[base + lo:base + hi], period, b[i:j] - base - lo)
            for s, m in dict.fromkeys(zip(first.tolist(), end.tolist())):
                e = m + period
                open_ended = (s == 0 and lo > 0) or (e == hi - lo and hi < n)
                if open_ended or e - s >= max(min_words, min_exponent * period):
                    out.append((int(row[i]), period, lo + s, lo + e))
    return out


def _pairs(level: np.ndarray, width: int) -> np.ndarray:
    """Hashes of 2 * ``width`` words from those of ``width`` words."""
    if len(level) <= width:
        return level[:0]
    left, right = level[:-width], level[width:]
    return ((left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + right) ^ (right >> np.uint64(29))


def segments(batches, column: str = "text", limit: int = SEGMENT_BYTES):
    """Batches cut so that each holds about ``limit`` bytes of text (or a single row)."""
    for batch in batches:
        at, total = 0, 0
        for i, n in enumerate(np.diff(text_bytes(batch.column(column))[1]).tolist()):
            if i > at and total + n > limit:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        if batch.num_rows > at:
            yield batch.slice(at)


_FOUND = pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("n_words", pa.int64()), ("words_text", pa.string()),
                    ("collapsed", pa.string()),
                    ("fragments", pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])))])
_FOUND_SQL = f"doc_id long, key string, n_words long, words_text string, collapsed string, fragments {FRAGMENTS}"


def _finish(raw: bytes, digest: bool) -> str:
    return hashlib.sha256(raw).hexdigest() if digest else raw.decode()


def _solve(min_words: int, min_exponent: int, core: int, digest: bool):
    def run(batches):
        for batch in segments(batches):
            data, at = text_bytes(batch.column("text"))
            starts, ends, rows = word_bounds(data, at)
            found = [[] for _ in range(batch.num_rows)]
            for row, period, start, end in fragments(word_hashes(data, starts, ends), rows, min_words, min_exponent, core):
                found[row].append({"period": period, "start": start, "end": end})
            raw, name = data.tobytes(), uuid.uuid4().hex
            plain = [b" ".join(raw[at[i]:at[i + 1]].split()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([f"{name}-{i}" if f else None for i, f in enumerate(found)], pa.string()),
                pa.array(np.diff(rows)), pa.array([p.decode() if f else None for p, f in zip(plain, found)], pa.string()),
                pa.array([None if f else _finish(p, digest) for p, f in zip(plain, found)], pa.string()),
                pa.array(found, _FOUND.field("fragments").type)], schema=_FOUND)
    return run


def stitch(found: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Columns key and runs (by start, then period) from the fragments per key."""
    parts = found.select("key", F.inline("fragments"))
    by = Window.partitionBy("key", "period").orderBy("start", "end")
    # words start .. end - period - 1 equal those a period further on: parts that overlap or touch there are one
    reach = F.max(F.col("end") - F.col("period")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("reach", reach).withColumn(
        "part", F.count(F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach")), 1)).over(by))
    whole = parts.groupBy("key", "period", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    whole = whole.filter(F.expr(f"`end` - start >= greatest({min_words}, {min_exponent} * period)"))
    least = whole.groupBy("key", "start", "end").agg(F.min("period").alias("period"))
    return least.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        F.col("start"), F.col("period"), (F.col("end") - F.col("start")).alias("length")))).alias("runs")).select(
            "key", F.transform("runs", lambda r: F.struct(r.start.alias("start"), r.length.alias("length"), r.period.alias("period"))).alias("runs"))


_DROP = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("collapsed", pa.string()),
                   ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))])


def _drop(digest: bool):
    def run(batches):
        for batch in segments(batches, "words_text"):
            out = []
            for text, runs in zip(batch.column("words_text"), batch.column("runs").to_pylist()):
                words = text.as_buffer().to_pybytes().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for r in runs or ():
                    gone[r["start"] + r["period"]] += 1
                    gone[r["start"] + r["length"]] -= 1
                out.append(_finish(b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]), digest))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(out, pa.string()),
                                              batch.column("runs").cast(_DROP.field("runs").type)], schema=_DROP)
    return run


def collapse(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
             min_exponent: int = MIN_EXPONENT, core: int = CORE, digest: bool = False) -> DataFrame:
    """Columns doc_id, n_words, runs (start, length, period; by start, then period) and collapsed: the kept words joined by one space.

    With ``digest``, collapsed is the SHA-256 of that text in lowercase hex and no text is written for documents
    without fragments.
    """
    if min_words < 22 or min_exponent < 3:
        raise ValueError("aligned blocks meet every run only from 22 words and three periods on")
    spark = ship_code(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = written(spark, docs.mapInArrow(_solve(min_words, min_exponent, core, digest), _FOUND_SQL), "runs-found")
    plain = found.filter("key IS NULL").select("doc_id", "n_words", "collapsed", F.expr(f"cast(array() AS {RUNS})").alias("runs"))
    busy = found.filter("key IS NOT NULL")
    joined = busy.select("doc_id", "key", "n_words", "words_text").join(stitch(busy, min_words, min_exponent), "key", "left")
    dropped = joined.select("doc_id", "n_words", "words_text", F.coalesce("runs", F.expr(f"cast(array() AS {RUNS})")).alias("runs")).mapInArrow(
        _drop(digest), f"doc_id long, n_words long, collapsed string, runs {RUNS}")
    return plain.unionByName(dropped).select("doc_id", "n_words", "runs", "collapsed")
