"""Substring dedup by seed and extend (operator 2).

Repeats of ``window`` words or more, anywhere in the corpus, are removed.

1. Seed. Every window of ``window`` words owns one winnowed anchor: its least
   ``k``-word gram, so equal windows have equal anchors at equal distances.
   Anchors are joined on their gram by one shuffle: two longs for gram and
   context, the row's key and a packed place.
2. Extend. Anchors that share a gram extend to both sides. If all that an
   anchor's windows cover (its context) is met twice, each of its windows is
   repeated. Where contexts differ, the match ends somewhere inside: each
   distinct context sends the hashes of its single windows to be compared.
3. Keep maximal repeats. Spans of repeated windows merge to maximal runs per
   document; their words go.

Comparisons use 128 bits of hash (gram and context, or gram and window).
Neighbour comparisons in sorted order (lag and lead) need no group in memory.
Equal contexts within a batch leave their task as one row with all its places.

Defined cases: null text has no words; a document shorter than the window is
never changed; rows that share a doc_id are separate documents (an exact
repeat of a row is a copy of it); a null doc_id is kept; very long texts are
one row of the batch that holds them; an empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code
from .rolling import Anchors, gram_hashes, merged_spans, mix, text_bytes, word_bounds, word_hashes

WINDOW = 35
K = 12
SEED_SCHEMA = "gram long, ctx long, places binary"
_SEEDS = pa.schema([("gram", pa.int64()), ("ctx", pa.int64()), ("places", pa.binary())])
#: key, first window, windows after it, distance of the anchor
PLACE = np.dtype([("key", "<i8"), ("first", "<i8"), ("more", "<u2"), ("to_anchor", "<u2")])
_BATCH_TEXTS = 512


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Columns doc_id, text and key: one per distinct (doc_id, text)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return docs.withColumn("key", F.xxhash64("doc_id", "text"))


def slices(batches, n: int = _BATCH_TEXTS):
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def seed_rows(grams, contexts, keys, anchors, starts_at):
    """One row per distinct (gram, context) with all its places."""
    if not len(grams):
        return None
    place = np.empty(len(grams), PLACE)
    place["key"], place["first"] = keys, anchors.first - starts_at
    place["more"], place["to_anchor"] = anchors.last - anchors.first, anchors.at - anchors.first
    order = np.lexsort((contexts, grams))
    g, c, place = grams[order], contexts[order], place[order]
    head = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]))
    offsets = (np.concatenate([head, [len(g)]]) * PLACE.itemsize).astype(np.int32)
    places = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(place.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(g[head].view(np.int64)), pa.array(c[head].view(np.int64)), places], schema=_SEEDS)


def _seeds(window: int, k: int):
    def run(batches):
        for batch in slices(batches):
            data, rows = text_bytes(batch.column("text"))
            starts, ends, first_word = word_bounds(data, rows)
            if len(starts) < window:
                continue
            a = Anchors(word_hashes(data, starts, ends), first_word, window, k)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            out = seed_rows(a.gram(), a.context(), keys[a.row], a, first_word[a.row])
            if out is not None:
                yield out
    return run


def repeated_seeds(seeds: DataFrame) -> DataFrame:
    """The seeds whose gram is met twice, with ``whole`` (its context is met twice) and ``differs`` (so is another one)."""
    by = Window.partitionBy("gram").orderBy("ctx")
    full = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    many = F.octet_length("places") > PLACE.itemsize
    out = seeds.withColumns({"before": F.lag("ctx").over(by), "after": F.lead("ctx").over(by),
                             "low": F.first("ctx").over(full), "high": F.last("ctx").over(full), "many": many})
    return out.filter("many OR before IS NOT NULL OR after IS NOT NULL").select(
        "gram", "ctx", "places",
        F.expr("many OR coalesce(before = ctx, false) OR coalesce(after = ctx, false)").alias("whole"),
        F.expr("low <> high").alias("differs"), F.expr("NOT coalesce(before = ctx, false)").alias("leads"))


def _spread(window: int):
    """Rows of repeated seeds to (key, first, more, to_anchor, gram): spans that are whole repeats (gram 0) and windows to compare."""
    schema = pa.schema([("key", pa.int64()), ("first", pa.int64()), ("more", pa.int32()), ("to_anchor", pa.int32()),
                        ("gram", pa.int64()), ("whole", pa.bool_())])

    def run(batches):
        for batch in batches:
            n = np.diff(np.frombuffer(batch.column("places").buffers()[1], np.int32, batch.num_rows + 1, batch.column("places").offset * 4)) // PLACE.itemsize
            place = np.frombuffer(b"".join(batch.column("places").to_pylist()), PLACE)
            whole = batch.column("whole").to_numpy(zero_copy_only=False).astype(bool)
            ask = (batch.column("differs").to_numpy(zero_copy_only=False) & batch.column("leads").to_numpy(zero_copy_only=False)).astype(bool)
            gram = batch.column("gram").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)
            head = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
            spans = np.flatnonzero(whole[row])
            asks = head[ask]
            for pick, is_whole in ((spans, True), (asks, False)):
                if len(pick):
                    p = place[pick]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p["key"]), pa.array(p["first"]), pa.array(p["more"].astype(np.int32)),
                         pa.array(p["to_anchor"].astype(np.int32)), pa.array(gram[row[pick]]),
                         pa.array(np.full(len(p), is_whole))], schema=schema)
    return run


SPREAD_SCHEMA = "key long, first long, more int, to_anchor int, gram long, whole boolean"


def flat_lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Row number and values of a list<struct> column, flattened."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = np.diff(np.asarray(column.offsets))
    return np.repeat(np.arange(len(column)), n), column.flatten()


def field(structs, name: str) -> np.ndarray:
    return structs.field(name).to_numpy(zero_copy_only=False)


def _windows(window: int):
    """Texts with the anchors to extend, to one row per window: (gram, hash, key, first)."""
    schema = pa.schema([("gram", pa.int64()), ("hash", pa.int64()), ("key", pa.int64()), ("first", pa.int64())])

    def run(batches):
        for batch in slices(batches, 64):
            data, rows = text_bytes(batch.column("text"))
            starts, ends, first_word = word_bounds(data, rows)
            hashes = mix(gram_hashes(word_hashes(data, starts, ends), window))
            row, a = flat_lists(batch.column("asked"))
            more = field(a, "more").astype(np.int64) + 1
            each = np.repeat(np.arange(len(row)), more)
            step = np.arange(len(each)) - np.repeat(np.cumsum(more) - more, more)
            first = field(a, "first")[each] + step
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(field(a, "gram")[each]), pa.array(hashes[first_word[row[each]] + first].view(np.int64)),
                 pa.array(keys[row[each]]), pa.array(first)], schema=schema)
    return run


def _kept(batches):
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                            ("kept_text", pa.large_binary())])
    for batch in slices(batches, 128):
        data, rows = text_bytes(batch.column("text"))
        starts, ends, first_word = word_bounds(data, rows)
        n = np.diff(first_word)
        gone = np.zeros(len(starts) + 1, np.int64)
        row, s = flat_lists(batch.column("spans"))
        if len(row):
            np.add.at(gone, first_word[row] + field(s, "first"), 1)
            np.add.at(gone, first_word[row] + field(s, "end"), -1)
        gone = np.cumsum(gone[:-1]) > 0
        raw, kept = data.tobytes(), []
        for i in range(len(n)):
            at = np.flatnonzero(~gone[first_word[i]:first_word[i + 1]]) + first_word[i]
            kept.append(b" ".join([raw[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]))
        sums = np.concatenate([[0], np.cumsum(gone)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(sums[first_word[1:]] - sums[first_word[:-1]]),
             pa.array(kept, pa.large_binary())], schema=out_schema)


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Columns key, first, end (word numbers) of repeated windows, from keyed documents."""
    seeds = docs.select("key", "text").mapInArrow(_seeds(window, k), SEED_SCHEMA)
    spread = repeated_seeds(seeds).mapInArrow(_spread(window), SPREAD_SCHEMA)
    return extend(docs, spread, window, _windows(window))


def extend(docs: DataFrame, spread: DataFrame, window: int, windows_of) -> DataFrame:
    """Spans of whole repeats and of the single windows that are met twice among the asked ones."""
    from .common import written
    spread = written(docs.sparkSession, spread, "seeds")
    asked = spread.filter("NOT whole").groupBy("key").agg(F.collect_list(F.struct("first", "more", "gram")).alias("asked"))
    single = docs.select("key", "text").join(asked, "key").mapInArrow(
        windows_of, "gram long, hash long, key long, first long")
    by = Window.partitionBy("gram", "hash").orderBy("key", "first")
    met = single.withColumns({"before": F.lag("key").over(by), "after": F.lead("key").over(by)}).filter(
        "before IS NOT NULL OR after IS NOT NULL")
    return spread.filter("whole").select("key", "first", (F.col("first") + F.col("more") + window).alias("end")).unionByName(
        met.select("key", "first", (F.col("first") + window).alias("end")))


def merged_by_key(spans: DataFrame) -> DataFrame:
    """Maximal runs per key: gaps and islands over the spans in order."""
    order = Window.partitionBy("key").orderBy("first", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(F.col("first") <= reach, 0).otherwise(1))
    marked = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("key", "run").agg(F.min("first").alias("first"), F.max("end").alias("end")).groupBy("key").agg(
        F.collect_list(F.struct("first", "end")).alias("spans"))


def dedupe(docs: DataFrame, window: int = WINDOW, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text (UTF-8; kept words joined by one space)."""
    ship_code(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    spans = merged_by_key(repeated_spans(rows, window, k))
    empty = F.expr("cast(array() AS ARRAY<STRUCT<first: BIGINT, end: BIGINT>>)")
    joined = rows.join(spans, "key", "left").select("doc_id", "text", F.coalesce("spans", empty).alias("spans"))
    return joined.mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text binary")
