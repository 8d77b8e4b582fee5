"""Token-id output in fixed-width bit packing (operator 1).

Documents are range-partitioned by id, tokenized in place and written as
Parquet rows, one per block of whole documents:

``part, block, start`` (ids before the block within its part), ``n_ids, bits``,
``doc_ids``, ``offsets`` (first id of each document within the block) and
``payload``: each id in the fewest bits that the vocabulary needs, packed
little-endian, so eight ids fill ``bits`` bytes. Any id is found from its block
and offset; a block is unpacked by eight vectorised lanes.

Parts ascend with doc_id, so global positions follow from one sum per part.

Tokenizing costs most. Where the tokenizer is byte-level BPE with its usual
pattern, a text whose white space is single spaces and line ends may be cut
before each space, around each line end and before a mark that ends a word,
without changing its ids. The cuts, the look-up of all pieces by their bytes
and the gathering of their ids are array operations over many texts at once;
only a piece that the worker's bounded cache lacks meets the library. Other
texts, and other tokenizers, are encoded whole.

Defined cases: null and empty texts give the end id alone; a null doc_id sorts
first; rows that share a doc_id keep one entry each, ordered by text; very long
texts make a block of their own; an empty table gives an empty file set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import n_partitions, scratch_path, ship_code
from .rolling import mix, text_bytes

BLOCK_IDS = 1 << 16
#: pieces that a worker's cache holds, and the bytes of the longest
MAX_CACHED = 1_000_000
SHORT = 16
#: bytes of text that are encoded at a time (or one text)
HANDFUL = 4_000_000
MARKS = ".,;:"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

SCHEMA = ("part int, block int, start long, n_ids long, bits int, doc_ids array<long>, "
          "offsets array<long>, payload binary")
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                    ("bits", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                    ("payload", pa.binary())])


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, little-endian."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    n = -(-len(ids) // 8) * 8
    lanes = np.zeros(n, np.uint64)
    lanes[:len(ids)] = ids
    lanes = lanes.reshape(-1, 8)
    out = np.zeros((len(lanes), bits + 8), np.uint8)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        word = lanes[:, j] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, at + k] |= ((word >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack(payload: bytes, n_ids: int, bits: int) -> np.ndarray:
    """The ids of a block as unsigned 32-bit integers."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", n_ids).astype("<u4")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, bits)
    out = np.empty((len(rows), 8), np.uint64)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        word = np.zeros(len(rows), np.uint64)
        for k in range(min((shift + bits + 7) // 8, bits - at)):
            word |= rows[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (word >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:n_ids].astype("<u4")


def unpack_between(payload: bytes, bits: int, first: int, end: int) -> np.ndarray:
    """The ids of a block from ``first`` up to ``end``: reads only the groups of eight that hold them."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", end - first, 2 * first).astype("<u4")
    group = first // 8
    return unpack(memoryview(payload)[group * bits:-(-end // 8) * bits], end - 8 * group, bits)[first - 8 * group:]


def vocabulary_bits(size: int) -> int:
    return max(1, (size - 1).bit_length())


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for the characters from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in keep]
    return {b: 256 + i for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
_MARK, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(MARKS.encode())] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: masks of the first 0 to 8 bytes of a little-endian word
_LOW_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def is_one_piece(word: str) -> bool:
    """Latin letters only: the pattern keeps them together, with the space before them."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class _Pieces:
    """Ids of short pieces, found by their bytes: an open-addressing table of numpy arrays.

    A piece of at most ``SHORT`` bytes is its own key (two unsigned 64-bit
    integers), so equal keys are equal pieces. When ``MAX_CACHED`` pieces are
    held, the half used longest ago goes.
    """

    def __init__(self, dtype: np.dtype):
        self.slots = np.full(1 << (2 * MAX_CACHED).bit_length(), -1, np.int32)
        self.keys = np.zeros((2, MAX_CACHED), np.uint64)
        self.at, self.n, self.used = (np.zeros(MAX_CACHED, np.int64) for _ in range(3))
        self.ids, self.size, self.clock = np.empty(0, dtype), 0, 0

    def _home(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where there is none."""
        self.clock += 1
        slot = self._home(low, high)
        found = self.slots[slot]
        todo = np.flatnonzero((found >= 0) & ((self.keys[0][found] != low) | (self.keys[1][found] != high)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.slots) - 1)
            found[todo] = entry = self.slots[slot[todo]]
            todo = todo[(entry >= 0) & ((self.keys[0][entry] != low[todo]) | (self.keys[1][entry] != high[todo]))]
        self.used[found[found >= 0]] = self.clock
        return found

    def _place(self, entries: np.ndarray) -> None:
        slot = self._home(self.keys[0][entries], self.keys[1][entries])
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]
            lost = self.slots[slot] != entries
            entries, slot = entries[lost], (slot[lost] + 1) & (len(self.slots) - 1)

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Keep new pieces (``n`` ids of ``ids`` each, in order); of more than half the room only the first."""
        if len(low) > MAX_CACHED // 2:
            low, high, n = low[:MAX_CACHED // 2], high[:MAX_CACHED // 2], n[:MAX_CACHED // 2]
            ids = ids[:n.sum()]
        if self.size + len(low) > MAX_CACHED:
            keep = np.sort(np.argsort(-self.used[:self.size], kind="stable")[:MAX_CACHED // 2])
            self.ids = _gathered(self.ids, self.at[keep], self.n[keep])
            self.size = len(keep)
            for column in (*self.keys, self.n, self.used):
                column[:self.size] = column[keep]
            self.at[:self.size] = np.cumsum(self.n[:self.size]) - self.n[:self.size]
            self.slots[:] = -1
            self._place(np.arange(self.size, dtype=np.int32))
        new = slice(self.size, self.size + len(low))
        self.keys[0][new], self.keys[1][new], self.n[new], self.used[new] = low, high, n, self.clock
        self.at[new] = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, ids])
        self.size += len(low)
        self._place(np.arange(new.start, new.stop, dtype=np.int32))


def _gathered(ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``n`` ids from ``at`` on, one after the other."""
    before = np.cumsum(n) - n
    return ids[np.repeat(at - before, n) + np.arange(n.sum())]


def _spaces_beyond_ascii(data: np.ndarray) -> np.ndarray:
    """Places of characters beyond ASCII that may be white space (UTF-8 lead and second bytes, with some neighbours)."""
    at = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    at = at[at + 2 < len(data) + (data[at] == 0xC2)]
    one, two, three = data[at], data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    return at[((one == 0xC2) & ((two == 0x85) | (two == 0xA0)))
              | ((one == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
              | ((one == 0xE2) & (((two == 0x80) & ((three <= 0x8F) | (three >= 0xA8))) & (three <= 0xAF) | (two == 0x81)))
              | ((one == 0xE3) & (two == 0x80))]


class _Encoder:
    """Texts to ids, with a bounded cache of pieces."""

    def __init__(self, path: str | None, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.bits = vocabulary_bits(max(self.tokenizer.get_vocab_size(), end_id + 1))
        self.dtype = np.dtype("<u2" if self.bits <= 16 else "<u4")
        self.end_id = end_id
        how = json.loads(self.tokenizer.to_str())
        pre = how.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                         and how.get("normalizer") is None and how["model"]["type"] == "BPE" and sys.byteorder == "little"
                         and not any(re.search(r"[\s.,;:]", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                                     for t in how["added_tokens"]))
        self.pieces = _Pieces(self.dtype)

    def raw(self, texts: list[str]) -> list[list[int]]:
        if not texts:
            return []
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def new_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece. Pieces of letters go to the library's model without its pre-tokenizer."""
        texts = [x.decode() for x in pieces]
        letters = [is_one_piece(t[1:] if t[0] == " " else t) for t in texts]
        others = iter(self.raw([t for t, plain in zip(texts, letters) if not plain]))
        tokenize = self.tokenizer.model.tokenize
        space = " ".translate(_LETTERS)

        def mapped(text: str, piece: bytes) -> str:
            if not text.isascii():
                return piece.decode("latin-1").translate(_LETTERS)
            return space + text[1:] if text[0] == " " else text
        return [[t.id for t in tokenize(mapped(text, piece))] if plain else next(others)
                for text, piece, plain in zip(texts, pieces, letters)]

    def _cut(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first byte of each piece, and of those which are whole texts that cannot be cut."""
        full = rows[1:] > rows[:-1]
        heads, tails = rows[:-1][full], rows[1:][full] - 1
        if not self.by_piece:
            return heads, heads
        line_end = data == 10
        apart = line_end | (data == 32)
        follows = np.empty(len(data), bool)  # stands at the front of a text or behind a space or line end
        follows[0], follows[1:] = True, apart[:-1]
        follows[heads] = True
        odd = apart & follows
        odd[tails] |= apart[tails]
        odd |= ((data < 32) & ~line_end) | (data == 127)
        places = np.concatenate([np.flatnonzero(odd), _spaces_beyond_ascii(data)])
        whole = np.unique(np.searchsorted(heads, places, side="right") - 1)
        # a mark behind a letter or digit and before a space, a line end or the end of its text
        last = np.empty(len(data), bool)
        last[-1], last[:-1] = True, apart[1:]
        last[tails] = True
        mark = np.flatnonzero(_MARK[data] & last & ~follows)
        begins = apart
        begins[1:] |= line_end[:-1]
        begins[heads] = True
        begins[mark[_ALNUM[data[mark - 1]]]] = True
        for i in whole:
            begins[heads[i] + 1:tails[i] + 1] = False
        return np.flatnonzero(begins), heads[whole]

    def encode(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts ``data[rows[i]:rows[i + 1]]`` with the end id behind each, and each text's end among them."""
        begin, whole = self._cut(data, rows) if len(data) else (np.empty(0, np.int64),) * 2
        size = np.diff(np.append(begin, len(data)))
        short = size <= SHORT
        short[np.searchsorted(begin, whole)] = False
        padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        few, n_few = begin[short], size[short]
        low = eight[few] & _LOW_BYTES[np.minimum(n_few, 8)]
        high = eight[few + 8] & _LOW_BYTES[np.maximum(n_few - 8, 0)]
        entry = self.pieces.find(low, high)
        at, n = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
        at[short], n[short] = self.pieces.at[entry], self.pieces.n[entry]
        parts = [self.pieces.ids]
        # new short pieces once each, then the long ones and the whole texts
        new = np.flatnonzero(entry < 0)
        order = new[np.lexsort((high[new], low[new]))]
        if len(order):
            first = np.ones(len(order), bool)
            first[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
            one = order[first]
            got = self.new_pieces([data[a:b].tobytes() for a, b in zip(few[one].tolist(), (few[one] + n_few[one]).tolist())])
            counts = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter(chain.from_iterable(got), self.dtype, int(counts.sum()))
            which, where = np.cumsum(first) - 1, np.flatnonzero(short)[order]
            at[where], n[where] = (len(parts[0]) + np.cumsum(counts) - counts)[which], counts[which]
            parts.append(ids)
            self.pieces.add(low[one], high[one], ids, counts)
        long = np.flatnonzero(~short)
        if len(long):
            texts = [data[a:b].tobytes() for a, b in zip(begin[long].tolist(), (begin[long] + size[long]).tolist())]
            different = list(dict.fromkeys(texts))
            got = self.raw([x.decode() for x in different])
            counts = np.fromiter(map(len, got), np.int64, len(got))
            place = dict(zip(different, range(len(different))))
            which = np.fromiter(map(place.__getitem__, texts), np.int64, len(texts))
            at[long], n[long] = (sum(map(len, parts)) + np.cumsum(counts) - counts)[which], counts[which]
            parts.append(np.fromiter(chain.from_iterable(got), self.dtype, int(counts.sum())))
        ids = _gathered(np.concatenate(parts), at, n)
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(begin, rows[1:])]
        return np.insert(ids, ends, self.end_id), ends + np.arange(1, len(ends) + 1)


def _block_rows(part, block, start, docs, ids, bits):
    flat = np.concatenate(ids)
    offsets = np.cumsum([0, *map(len, ids[:-1])])
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
         pa.array([len(flat)], pa.int64()), pa.array([bits], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
         pa.array([offsets], pa.list_(pa.int64())), pa.array([pack(flat, bits)], pa.binary())], schema=_ARROW), len(flat)


def _handfuls(batch, size: int = HANDFUL):
    """Lists of doc_ids with the bytes of their texts and each text's start in them, of about ``size`` bytes or one text."""
    doc_ids, (data, rows) = batch.column(0).to_pylist(), text_bytes(batch.column(1))
    i = 0
    while i < len(doc_ids):
        j = max(i + 1, int(np.searchsorted(rows, rows[i] + size, side="right")) - 1)
        yield doc_ids[i:j], data[rows[i]:rows[j]], rows[i:j + 1] - rows[i]
        i = j


_ENCODERS: dict = {}


def _encoder(path: str | None, end_id: int) -> _Encoder:
    """The worker's tokenizer and cache, kept between tasks (a module's function travels by name, so it finds them again)."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = _Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def _encode_part(path: str | None, end_id: int, block_ids: int):
    def run(batches):
        enc = _encoder(path, end_id)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs, ids, held = [], [], 0
        for batch in batches:
            for doc_ids, data, rows in _handfuls(batch):
                got, ends = enc.encode(data, rows)
                for doc, a, b in zip(doc_ids, [0, *ends.tolist()], ends.tolist()):
                    docs.append(doc)
                    ids.append(got[a:b])
                    held += b - a
                    if held >= block_ids:
                        row, n = _block_rows(part, block, start, docs, ids, enc.bits)
                        yield row
                        block, start, docs, ids, held = block + 1, start + n, [], [], 0
        if docs:
            yield _block_rows(part, block, start, docs, ids, enc.bits)[0]
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenize ``docs`` and write the block files under ``path`` in ascending doc_id order."""
    n = n_partitions(ship_code(docs.sparkSession))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # the hash spreads rows that share a doc_id
    rows = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    rows.mapInArrow(_encode_part(tokenizer_path, end_id, block_ids), SCHEMA).write.parquet(path, compression="zstd")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``part_start``: ids of all parts before."""
    blocks = ship_code(spark).read.schema(SCHEMA).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    # one row per written part, as many as the write had tasks
    return blocks.join(F.broadcast(parts), "part")


def _digest_blocks(batches):
    for batch in batches:
        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        col = {n: batch.column(n) for n in batch.schema.names}
        for i in range(batch.num_rows):
            n = col["n_ids"][i].as_py()
            ids = unpack(col["payload"][i].as_py(), n, col["bits"][i].as_py())
            offsets = col["offsets"][i].as_py()
            base = col["part_start"][i].as_py() + col["start"][i].as_py()
            for doc, a, b in zip(col["doc_ids"][i].as_py(), offsets, [*offsets[1:], n], strict=True):
                out["doc_id"].append(doc)
                out["start"].append(base + a)
                out["n_tokens"].append(b - a)
                out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(k, pa.int64()) for k in out]))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    return read_blocks(spark, path).select("part_start", "start", "n_ids", "bits", "doc_ids", "offsets", "payload").mapInArrow(
        _digest_blocks, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _cut_blocks(first: int, end: int):
    def run(batches):
        for batch in batches:
            for base, n, bits, payload in zip(*(batch.column(c).to_pylist() for c in ("base", "n_ids", "bits", "payload"))):
                a, b = max(first - base, 0), min(end - base, n)
                ids = unpack_between(payload, bits, a, b)
                yield pa.RecordBatch.from_arrays([pa.array([base + a], pa.int64()), pa.array([ids], pa.list_(pa.int64()))], ["start", "ids"])
    return run


def read_ids(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """The ids at positions ``first`` up to ``end`` of the whole output: one row (start, ids) per block that holds some."""
    blocks = read_blocks(spark, path).withColumn("base", F.col("part_start") + F.col("start"))
    blocks = blocks.filter(F.lit(first) < F.lit(end)).filter((F.col("base") < end) & (F.col("base") + F.col("n_ids") > first))
    return blocks.select("base", "n_ids", "bits", "payload").mapInArrow(_cut_blocks(first, end), "start long, ids array<long>")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (with the end id) of the given documents; only blocks that hold one of them are unpacked."""
    wanted = F.array(*[F.lit(d).cast("long") for d in doc_ids])
    blocks = read_blocks(spark, path).filter(F.arrays_overlap("doc_ids", wanted)) if doc_ids else read_blocks(spark, path).limit(0)
    held = set(doc_ids)

    def run(batches):
        for batch in batches:
            for n, bits, docs, offsets, payload in zip(*(batch.column(c).to_pylist() for c in ("n_ids", "bits", "doc_ids", "offsets", "payload"))):
                at = [(d, a, b) for d, a, b in zip(docs, offsets, [*offsets[1:], n]) if d in held]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _, _ in at], pa.int64()), pa.array(
                    [unpack_between(payload, bits, a, b) for _, a, b in at], pa.list_(pa.int64()))], ["doc_id", "ids"])
    return blocks.select("n_ids", "bits", "doc_ids", "offsets", "payload").mapInArrow(run, "doc_id long, ids array<long>")


def encode_and_read(docs: DataFrame, **params) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, **params)
    return digests(spark, path)
