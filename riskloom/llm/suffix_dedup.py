"""Suffix-array dedup over UTF-8 bytes (operator 10).

Removes each byte covered by a string of ``length`` bytes that starts anywhere
else in the corpus too.

1. Sparse suffixes. A suffix is sorted only if it starts at an anchor: the
   least ``k``-byte gram of some ``length``-byte string. Each such string
   belongs to one anchor, at a distance that depends on its bytes alone, so
   equal strings have anchors with equal suffixes. Suffixes whose leading gram
   is met once cannot repeat and go; suffixes that agree in everything their
   strings cover are merged into one (their strings are repeats of each other).
2. Range partition. The others are dealt to buckets by splitters, quantiles of
   a bounded sample of suffixes (``SAMPLE_PER_BUCKET`` each); equal suffixes
   are told apart by their document, so no bucket has to hold one hot suffix.
3. Local sort. A bucket sorts its suffixes by multikey quicksort, eight bytes a
   key, all partitions of one depth in one call; what precedes the anchors is
   sorted the same way, backwards. Common prefix lengths of neighbours give the
   classes of suffixes equal over any length; a string at distance d before
   its anchor is a repeat if another agrees with it over ``length - d`` bytes
   forwards and d bytes backwards.
4. Across boundaries. A string whose suffix shares its forward part with one of
   the bucket's splitters may have its equal in a neighbouring bucket. These
   strings alone are compared again by hash, over all buckets.

Defined cases: null text is empty; shorter documents are never changed; matches
do not cross documents; rows that share a doc_id are separate documents (an
exact repeat of a row is a copy); a null doc_id is kept; very long texts are
one row of their batch; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, written
from .rolling import BYTE_HASH, Anchors, gram_hashes, merged_spans, mix, text_bytes
from .substring_dedup import SEED_SCHEMA, SPREAD_SCHEMA, _spread, field, flat_lists, keyed, merged_by_key, repeated_seeds, seed_rows, slices

LENGTH = 200
K = 64
SAMPLE_PER_BUCKET = 64
#: suffixes per bucket; a bucket is one task's memory, so its size is fixed and the number of buckets follows the data
BUCKET_SUFFIXES = 8192


def _suffix_seeds(length: int, k: int):
    def run(batches):
        for batch in slices(batches, 256):
            data, rows = text_bytes(batch.column("text"))
            if len(data) < length:
                continue
            a = Anchors(BYTE_HASH[data], rows, length, k)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            out = seed_rows(a.gram(), a.context(), keys[a.row], a, rows[a.row])
            if out is not None:
                yield out
    return run


SUFFIX_SCHEMA = "gram long, key long, first long, more int, to_anchor int, context binary"
_SUFFIXES = pa.schema([("gram", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("more", pa.int32()),
                       ("to_anchor", pa.int32()), ("context", pa.binary())])


def _contexts(length: int):
    """Texts with the anchors to sort, to one row per suffix with all bytes that its strings cover."""
    def run(batches):
        for batch in slices(batches, 64):
            data, rows = text_bytes(batch.column("text"))
            raw = data.tobytes()
            row, a = flat_lists(batch.column("asked"))
            first, more = field(a, "first"), field(a, "more")
            at = rows[row] + first
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(field(a, "gram")), pa.array(keys[row]), pa.array(first), pa.array(more), pa.array(field(a, "to_anchor")),
                 pa.array([raw[x:x + m + length] for x, m in zip(at.tolist(), more.tolist(), strict=True)], pa.binary())], schema=_SUFFIXES)
    return run


def _sort_key(context: bytes, to_anchor: int, key: int) -> bytes:
    return context[to_anchor:] + key.to_bytes(8, "big", signed=True)


def _dealt(splitters: list[bytes]):
    schema = _SUFFIXES.append(pa.field("bucket", pa.int32()))

    def run(batches):
        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in ("context", "to_anchor", "key")]
            bucket = [bisect_right(splitters, _sort_key(c, t, k)) for c, t, k in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket, pa.int32())], schema=schema)
    return run


def padded(parts: list[bytes], width: int) -> np.ndarray:
    """Byte rows of one width, filled with zeros."""
    return np.frombuffer(b"".join([p[:width].ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows and the common prefix length of each with the one before it in that order.

    Multikey quicksort: rows are sorted by their first eight bytes; each
    partition of equal keys is sorted by the next eight, and so on. All
    partitions of one depth are sorted in one call.
    """
    n, width = rows.shape
    keys = np.zeros((n, -(-width // 8) * 8), np.uint8)
    keys[:, :width] = rows
    keys = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    order = np.arange(n)
    part = np.zeros(n, np.int64)  # partition of each place in the order
    open_ = np.arange(n)
    for depth in range(keys.shape[1]):
        if not len(open_):
            break
        word = keys[order[open_], depth]
        by = np.lexsort((word, part[open_]))
        order[open_] = order[open_[by]]
        word, group = word[by], part[open_]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        head = np.maximum.accumulate(np.where(new, open_, 0))
        part[open_] = head
        size = np.diff(np.concatenate([np.flatnonzero(new), [len(open_)]]))
        open_ = open_[np.repeat(size, size) > 1]
    common = np.zeros(n, np.int64)
    for at in range(1, n, 1 << 14):
        same = rows[order[at:at + (1 << 14)]] == rows[order[at - 1:min(at + (1 << 14), n) - 1]]
        common[at:at + (1 << 14)] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, common


def _common_with(rows: np.ndarray, other: bytes | None) -> np.ndarray:
    """Length of each row's common prefix with ``other`` (0 without)."""
    if other is None:
        return np.zeros(len(rows), np.int64)
    width = min(rows.shape[1], len(other))
    same = rows[:, :width] == np.frombuffer(other, np.uint8)[:width]
    return np.where(same.all(axis=1), width, same.argmin(axis=1))


_FOUND = pa.schema([("key", pa.int64()), ("first", pa.int64()), ("end", pa.int64()), ("gram", pa.int64()), ("hash", pa.int64())])
FOUND_SCHEMA = "key long, first long, end long, gram long, hash long"


def _bucket(length: int, splitters: list[bytes]):
    def run(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_numpy() for n in ("gram", "key", "first", "more", "to_anchor", "bucket")}
        contexts = table.column("context").to_pylist()
        n, to_anchor, more = len(contexts), col["to_anchor"].astype(np.int64), col["more"].astype(np.int64)
        reach = int(to_anchor.max())
        ahead = padded([c[t:] for c, t in zip(contexts, to_anchor.tolist(), strict=True)], length)
        behind = padded([c[:t][::-1] for c, t in zip(contexts, to_anchor.tolist(), strict=True)], max(reach, 1))
        (a_order, a_common), (b_order, b_common) = multikey_sort(ahead), multikey_sort(behind)
        b = int(col["bucket"][0])
        low, high = (splitters[b - 1] if b else None), (splitters[b] if b < len(splitters) else None)
        edge = np.maximum(_common_with(ahead, low), _common_with(ahead, high))
        met, ask = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool)
        a_class, b_class = np.empty(n, np.int64), np.empty(n, np.int64)
        for d in range(reach + 1):
            owns = np.flatnonzero((to_anchor >= d) & (to_anchor - more <= d))
            if not len(owns):
                continue
            a_class[a_order] = np.cumsum(a_common < length - d)
            b_class[b_order] = np.cumsum(b_common < d)
            both = a_class[owns] * (n + 1) + b_class[owns]
            by = np.argsort(both, kind="stable")
            s = both[by]
            twin = np.zeros(len(s), bool)
            twin[1:] = s[1:] == s[:-1]
            twin[:-1] |= s[1:] == s[:-1]
            met[owns[by[twin]], d] = True
            # equal strings of this bucket ask once: all of them are known to repeat already
            lead = by[np.concatenate([[True], s[1:] != s[:-1]])]
            ask[owns[lead], d] = edge[owns[lead]] >= length - d
        row, d = np.nonzero(met)
        first = col["first"][row] + to_anchor[row] - d
        # the strings of one suffix follow each other: runs of d become one span
        key = col["key"][row]
        by = np.lexsort((first, row))
        row, first, key = row[by], first[by], key[by]
        head = np.concatenate([[True], (row[1:] != row[:-1]) | (first[1:] != first[:-1] + 1)]) if len(row) else np.zeros(0, bool)
        at = np.flatnonzero(head)
        last = first[np.concatenate([at[1:], [len(row)]]) - 1] if len(at) else first
        spans = [pa.array(key[at]), pa.array(first[at]), pa.array(last + length), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64())]
        out = [pa.Table.from_arrays(spans, schema=_FOUND)]
        row, d = np.nonzero(ask)
        if len(row):
            flat = np.frombuffer(b"".join(contexts), np.uint8)
            starts = np.concatenate([[0], np.cumsum([len(c) for c in contexts])[:-1]])
            hashes = mix(gram_hashes(BYTE_HASH[flat], length))
            into = to_anchor[row] - d
            out.append(pa.Table.from_arrays(
                [pa.array(col["key"][row]), pa.array(col["first"][row] + into), pa.nulls(len(row), pa.int64()), pa.array(col["gram"][row]),
                 pa.array(hashes[starts[row] + into].view(np.int64))], schema=_FOUND))
        return pa.concat_tables(out)
    return run


def _splitters(suffixes: DataFrame) -> list[bytes]:
    """Quantiles of a sample of about ``SAMPLE_PER_BUCKET`` suffixes per bucket."""
    total = suffixes.count()
    buckets = max(1, -(-total // BUCKET_SUFFIXES))
    every = max(1, total // (SAMPLE_PER_BUCKET * buckets))
    sample = suffixes.filter(F.pmod(F.xxhash64("key", "first", "to_anchor"), F.lit(every)) == 0)
    sample = sorted(_sort_key(r["context"], r["to_anchor"], r["key"]) for r in sample.select("context", "to_anchor", "key").toLocalIterator())
    if not sample:
        return []
    return sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)})


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """Columns key, first, end (byte places) of repeated strings, from keyed documents."""
    spark = docs.sparkSession
    seeds = docs.select("key", "text").mapInArrow(_suffix_seeds(length, k), SEED_SCHEMA)
    spread = written(spark, repeated_seeds(seeds).mapInArrow(_spread(length), SPREAD_SCHEMA), "suffix-seeds")
    asked = spread.filter("NOT whole").groupBy("key").agg(F.collect_list(F.struct("first", "more", "to_anchor", "gram")).alias("asked"))
    suffixes = written(spark, docs.select("key", "text").join(asked, "key").mapInArrow(_contexts(length), SUFFIX_SCHEMA), "suffixes")
    splitters = _splitters(suffixes)
    found = suffixes.mapInArrow(_dealt(splitters), SUFFIX_SCHEMA + ", bucket int").groupBy("bucket").applyInArrow(
        _bucket(length, splitters), FOUND_SCHEMA)
    found = written(spark, found, "suffix-spans")
    by = Window.partitionBy("gram", "hash").orderBy("key", "first")
    across = found.filter("end IS NULL").withColumns({"before": F.lag("key").over(by), "after": F.lead("key").over(by)}).filter(
        "before IS NOT NULL OR after IS NOT NULL")
    return spread.filter("whole").select("key", "first", (F.col("first") + F.col("more") + length).alias("end")).unionByName(
        found.filter("end IS NOT NULL").select("key", "first", "end")).unionByName(
        across.select("key", "first", (F.col("first") + length).alias("end")))


def _kept(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.large_binary())])
    for batch in slices(batches, 128):
        data, rows = text_bytes(batch.column("text"))
        raw = data.tobytes()
        row, s = flat_lists(batch.column("spans"))
        first, end = merged_spans(rows[row] + field(s, "first"), rows[row] + field(s, "end")) if len(row) else (np.empty(0, np.int64),) * 2
        # spans of neighbouring rows may touch; cut them at the rows
        if len(first):
            cuts = rows[1:-1][(np.searchsorted(first, rows[1:-1], side="left") > 0)]
            inside = cuts[(end[np.searchsorted(first, cuts, side="left") - 1] > cuts)]
            first = np.sort(np.concatenate([first, inside]))
            end = np.sort(np.concatenate([end, inside]))
        owner = np.searchsorted(rows, first, side="right") - 1
        removed, spans = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        np.add.at(removed, owner, end - first)
        np.add.at(spans, owner, 1)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        kept = []
        for i in range(batch.num_rows):
            at, parts = int(rows[i]), []
            for x, y in zip(first[bounds[i]:bounds[i + 1]].tolist(), end[bounds[i]:bounds[i + 1]].tolist(), strict=True):
                parts.append(raw[at:x])
                at = y
            parts.append(raw[at:int(rows[i + 1])])
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(rows)), pa.array(removed),
                                          pa.array(spans), pa.array(kept, pa.large_binary())], schema=schema)


def dedupe(docs: DataFrame, length: int = LENGTH, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    ship_code(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    spans = merged_by_key(repeated_spans(rows, length, k))
    empty = F.expr("cast(array() AS ARRAY<STRUCT<first: BIGINT, end: BIGINT>>)")
    joined = rows.join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", empty).alias("spans"))
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
