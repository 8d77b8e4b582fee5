"""Benchmark decontamination by greedy string tiling (operator 8).

1. Seeds. Benchmark texts and documents are words (lower case, cut at anything
   but letters and digits). Every run of ``match`` benchmark words is a seed;
   each document's running Karp-Rabin hashes are looked up among the seeds.
2. Tiling, per document and item that share a seed. Seeds that follow each
   other on a diagonal are one match. The longest match is marked first; what
   marked words leave of another match stays a candidate while it has
   ``match`` words, so tiles never overlap in either text. Passages in another
   order, or cut into pieces, still add up.
3. A document is contaminated by an item whose tiles cover ``coverage`` of its
   words.

The benchmark is a stated query set: it is held against all documents in blocks
of at most ``BLOCK_WORDS`` words, each sent to the tasks with the code, so the
documents are read in place and never shuffled.

Defined cases: null and empty texts share nothing; items of fewer than
``match`` words are passed over; repeated items count one by one; null doc_id
and item_id are kept; very long texts are whole; an empty benchmark leaves all
documents clean; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code
from .rolling import gram_hashes, mix, text_bytes, word_bounds, word_hashes
from .substring_dedup import slices

MATCH = 5
COVERAGE = 0.6
BLOCK_WORDS = 2_000_000

_APART = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])


def words_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts and the number of words before each text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, rows = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, first = word_bounds(data, rows, _APART)
    return word_hashes(data, starts, ends), first


class Block:
    """Seeds of some benchmark items: sorted gram hashes with item and place, and a bitmap before them."""

    def __init__(self, item_ids: list, texts: list, match: int):
        words, first = words_of(pa.array(texts, pa.large_string()))
        self.item_ids, self.match, self.sizes = item_ids, match, np.diff(first)
        grams = mix(gram_hashes(words, match))
        at = np.arange(len(grams))
        item = np.searchsorted(first, at, side="right") - 1
        inside = at + match <= first[item + 1]
        grams, at, item = grams[inside], at[inside], item[inside]
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.place = grams[order], item[order], (at - first[item])[order]
        self.bits = max(16, int(len(grams) * 16).bit_length())
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[(self.grams >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position, item and place in the item of every shared seed."""
        at = np.flatnonzero(self.bitmap[(grams >> np.uint64(64 - self.bits)).astype(np.int64)])
        low, high = np.searchsorted(self.grams, grams[at], "left"), np.searchsorted(self.grams, grams[at], "right")
        n = high - low
        each = np.repeat(np.arange(len(at)), n)
        k = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + low[each]
        return at[each], self.item[k], self.place[k]


def tiles(at: np.ndarray, place: np.ndarray, match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the document, start in the item, words) from the shared seeds of one pair."""
    order = np.lexsort((at, at - place))
    at, place = at[order], place[order]
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1] + 1)])
    head = np.flatnonzero(new)
    size = np.diff(np.concatenate([head, [len(at)]])) + match - 1
    heap = [(-n, a, p) for n, a, p in zip(size.tolist(), at[head].tolist(), place[head].tolist(), strict=True)]
    heapq.heapify(heap)
    in_doc, in_item, out = set(), set(), []
    while heap:
        n, a, p = heapq.heappop(heap)
        free = [i for i in range(-n) if a + i not in in_doc and p + i not in in_item]
        if len(free) == -n:
            out.append((a, p, -n))
            in_doc.update(range(a, a - n))
            in_item.update(range(p, p - n))
            continue
        start = 0  # what is left of a match that tiles cut
        for j in range(1, len(free) + 1):
            if j == len(free) or free[j] != free[j - 1] + 1:
                if j - start >= match:
                    heapq.heappush(heap, (-(j - start), a + free[start], p + free[start]))
                start = j
    return out


def covered(block: Block, column, coverage: float) -> list[list[tuple]]:
    """Per text the items (item_id, share of its words) that tiles cover enough."""
    words, first = words_of(column)
    out: list[list[tuple]] = [[] for _ in range(len(first) - 1)]
    if len(words) < block.match or not len(block.grams):
        return out
    at, item, place = block.hits(mix(gram_hashes(words, block.match)))
    row = np.searchsorted(first, at, side="right") - 1
    inside = at + block.match <= first[row + 1]
    at, item, place, row = at[inside], item[inside], place[inside], row[inside]
    order = np.lexsort((item, row))
    at, item, place, row = at[order], item[order], place[order], row[order]
    if not len(at):
        return out
    head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1])]))
    for a, b in zip(head.tolist(), [*head[1:].tolist(), len(at)], strict=True):
        size = int(block.sizes[item[a]])
        # the seeds bound what any tiling can cover
        if len(np.unique(place[a:b])) + (block.match - 1) * min(b - a, -(-size // block.match)) < coverage * size:
            continue
        share = sum(n for _, _, n in tiles(at[a:b] - first[row[a]], place[a:b], block.match)) / size
        if share >= coverage:
            out[row[a]].append((block.item_ids[item[a]], share))
    return out


def benchmark_blocks(benchmark: DataFrame, match: int, item_id: str, text: str, block_words: int = BLOCK_WORDS) -> list[Block]:
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a word takes two characters at least
    total = rows.agg(F.sum(F.char_length("text") / 2 + 1)).first()[0] or 0
    n = max(1, int(-(-total // block_words)))
    out = []
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect()
        out.append(Block([r["item_id"] for r in part], [r["text"] for r in part], match))
    return out


_ITEMS = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64())]))


def scan(docs: DataFrame, benchmark: DataFrame, match: int = MATCH, coverage: float = COVERAGE, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, items (item_id, coverage) that contaminate it, contaminated."""
    ship_code(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string()), ("items", _ITEMS)])

    def step(block: Block):
        def run(batches):
            for batch in slices(batches):
                found = covered(block, batch.column("text"), coverage)
                items = [(have or []) + [{"item_id": i, "coverage": c} for i, c in new]
                         for have, new in zip(batch.column("items").to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), batch.column("text").cast(pa.large_string()), pa.array(items, _ITEMS)], schema=schema)
        return run

    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                      F.expr("cast(array() AS ARRAY<STRUCT<item_id: BIGINT, coverage: DOUBLE>>)").alias("items"))
    for block in benchmark_blocks(benchmark, match, item_id, item_text):
        out = out.mapInArrow(step(block), "doc_id long, text string, items array<struct<item_id: bigint, coverage: double>>")
    return out.select("doc_id", F.array_sort("items").alias("items"), (F.size("items") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, match: int = MATCH, coverage: float = COVERAGE, text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with the columns of ``docs``."""
    ship_code(docs.sparkSession)

    def step(block: Block):
        def run(batches):
            for batch in slices(batches):
                yield batch.filter(pa.array([not x for x in covered(block, batch.column(text), coverage)], pa.bool_()))
        return run

    for block in benchmark_blocks(benchmark, match, item_id, item_text):
        docs = docs.mapInArrow(step(block), docs.schema)
    return docs
