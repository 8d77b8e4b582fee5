"""Conversation prefix trie with double arrays (operator 13).

Every prefix of a conversation's turns is a node; conversations that start with
it are its members. What members share can be stored or computed once.

1. A conversation becomes one row: its turns in order as 128-bit digests of
   (role, text) and their lengths. Equal conversations are one sequence from
   then on; their ids are joined per sequence and block of 1024 ids, then
   digested as a stream, so no group is held in memory.
2. Sequences are range-partitioned in lexicographic order, which splits any
   popular prefix evenly. A shard is a slice of that order of bounded size.
3. In a shard turns get dense ids, numbered by depth and place, so that
   siblings are neighbours. The trie is packed into BASE and CHECK arrays:
   ``t = BASE[s] + id`` is the child of ``s`` if ``CHECK[t] = s``. All sequences walk
   through the arrays, depth by depth, and leave their members in the nodes.
4. Only prefixes of a shard's first and last sequence can be in other shards
   too. Nodes below them are finished in the shard. The shared upper nodes are
   merged by one aggregate on the prefix's digest, and what a subtree sums is
   carried up them by doubling: after ``r`` rounds a node has its descendants
   within ``2**r`` levels, so depth costs a logarithm of joins.

Defined cases: null role or text is empty; a null turn comes first, turns that
tie are ordered by their digest; rows that repeat are turns of their own; null
conv_ids are one conversation, whose id is null and comes first; a conversation's
turns meet in one row (as digests: 36 bytes a turn); other columns are ignored,
whatever their names; an empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, ship_code, written

#: hex digits of a turn's digest
WIDTH = 32
#: sequences and turns of a shard (one longer sequence alone)
SHARD_SEQUENCES = 20_000
SHARD_TURNS = 200_000
ID_BLOCK = 1024
#: free slots that a node with several children tries before it goes behind all used ones
TRIES = 64
ROOT = hashlib.md5(b"root").hexdigest()


def conversations_as_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id and turns, an array of (turn, token, chars) in order."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    token = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       token.alias("token"), F.char_length(text).alias("chars"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "token", "chars"))).alias("turns"))


# ---------------------------------------------------------------- equal conversations
_SEQUENCES = pa.schema([("tokens", pa.string()), ("chars", pa.list_(pa.int32())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])
_SEQUENCES_SQL = "tokens string, chars array<int>, n long, least long, ends string"


def _digest_ids(batches):
    """Rows of one sequence follow one another, by block: count, least id and the digest of all ids, as a stream."""
    now, out = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or row["seq"] != now["seq"]:
                if now is not None:
                    out.append(now)
                now = row | {"hash": hashlib.sha256(row["ids"].encode())}
            else:  # only the first block may be that of the null id, which writes nothing
                now["hash"].update((b"" if now["least"] is None else b",") + row["ids"].encode())
                now["n"] += row["n"]
                now["least"] = row["least"] if now["least"] is None else now["least"]
        if out:
            yield _sequence_batch(out)
            out = []
    if now is not None:
        yield _sequence_batch([now])


def _sequence_batch(rows):
    return pa.RecordBatch.from_pylist([{"tokens": r["tokens"], "chars": r["chars"], "n": r["n"], "least": r["least"],
                                        "ends": r["hash"].hexdigest()} for r in rows], schema=_SEQUENCES)


def distinct_sequences(turns: DataFrame) -> DataFrame:
    """One row per distinct sequence: tokens (joined digests), chars, n and least of its conv_ids, ends (their digest)."""
    ship_code(turns.sparkSession)
    rows = turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t.token), "").alias("tokens"),
                        F.transform("turns", lambda t: t.chars.cast("int")).alias("chars"))
    rows = rows.withColumns({"seq": F.md5("tokens"), "block": F.floor(F.col("conv_id") / ID_BLOCK)})
    blocks = rows.groupBy("seq", "block").agg(
        F.first("tokens").alias("tokens"), F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    return blocks.repartition("seq").sortWithinPartitions("seq", "block").mapInArrow(_digest_ids, _SEQUENCES_SQL)


# ---------------------------------------------------------------- double arrays
class DoubleArray:
    """A trie over distinct sequences of dense ids in lexicographic order of their turns, packed into BASE and CHECK.

    ``ids`` holds the sequences one after another; ``starts`` and ``sizes`` say where and how long they are.
    """

    def __init__(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.used = np.zeros(1024, bool)
        self.used[0] = True  # the root
        self.top, self.free = 1, 1
        queue = [(0, 0, len(sizes), 0)]
        while queue:
            upper = []
            for state, lo, hi, depth in queue:
                lo += int(np.searchsorted(sizes[lo:hi] > depth, True))  # those that end here come first
                if lo == hi:
                    continue
                if hi - lo == 1:
                    child = int(ids[starts[lo] + depth])
                    at = self._next_free()
                    self.base[state], self.used[at], self.check[at] = at - child, True, state
                    self.top = max(self.top, at + 1)
                    upper.append((at, lo, hi, depth + 1))
                    continue
                column = ids[starts[lo:hi] + depth]
                heads = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
                children = column[heads]
                self.base[state] = base = self._place(children)
                at = base + children
                self.used[at], self.check[at] = True, state
                self.top = max(self.top, int(at.max()) + 1)
                ends = np.append(heads[1:], hi - lo)
                upper += [(int(t), lo + int(a), lo + int(b), depth + 1) for t, a, b in zip(at, heads, ends)]
            queue = upper

    def _room(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _next_free(self) -> int:
        while self.free < len(self.used) and self.used[self.free]:
            self.free += 1
        self._room(self.free + 1)
        return self.free

    def _place(self, children: np.ndarray) -> int:
        """A base at which all children fall on free slots; it may be negative."""
        least = int(children.min())
        offsets = children - least
        span = int(offsets.max()) + 1
        at = self._next_free()
        for _ in range(TRIES):
            self._room(at + span)
            if not self.used[at + offsets].any():
                return at - least
            at += 1
            while at < self.top and self.used[at]:
                at += 1
        self._room(self.top + span)
        return self.top - least

    def child(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The child of each state by each id, or -1."""
        at = self.base[states] + ids
        inside = (at > 0) & (at < len(self.check))
        return np.where(inside & (self.check[np.where(inside, at, 0)] == states), at, -1)


_NODES = pa.schema([("node", pa.string()), ("parent", pa.string()), ("depth", pa.int64()), ("shared", pa.bool_()), ("parent_shared", pa.bool_()),
                    ("parent_least", pa.int64()), ("least", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("ends", pa.string()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64())])
_NODES_SQL = ("node string, parent string, depth long, shared boolean, parent_shared boolean, parent_least long, least long, n long, "
              "chars long, ends string, n_children long, n_leaves long, saved long")
_NO_ID = np.iinfo(np.int64).max


def shard_nodes(tokens: list, chars: list, n: list, least: list, ends: list) -> pa.RecordBatch:
    """The nodes of one shard; ``shared`` ones (prefixes of the first and last sequence) sum only their unshared children."""
    sizes = np.array([len(t) // WIDTH for t in tokens])
    deep = int(sizes.max())
    flat = np.array([t[i:i + WIDTH] for t in tokens for i in range(0, len(t), WIDTH)], f"S{WIDTH}")
    row = np.repeat(np.arange(len(sizes)), sizes)
    level = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((row, level))
    names, first, inverse = np.unique(flat[order], return_index=True, return_inverse=True)
    dense = np.empty(len(names), np.int64)
    dense[np.argsort(first, kind="stable")] = np.arange(1, len(names) + 1)
    by_id = np.empty(len(names) + 1, flat.dtype)
    by_id[dense] = names
    ids = np.empty(len(flat), np.int64)
    ids[order] = dense[inverse]
    starts = np.cumsum(sizes) - sizes
    lengths = np.array([x for part in chars for x in part], np.int64)

    trie = DoubleArray(ids, starts, sizes)
    total = trie.top
    count, low, size = np.zeros(total, np.int64), np.full(total, _NO_ID), np.zeros(total, np.int64)
    depth, token, shared, stops = np.full(total, -1), np.zeros(total, np.int64), np.zeros(total, bool), {}
    n, least = np.array(n, np.int64), np.array([_NO_ID if x is None else x for x in least], np.int64)
    states, alive = np.zeros(len(sizes), np.int64), np.arange(len(sizes))
    for d in range(deep + 1):
        if d:
            alive = alive[sizes[alive] >= d]
            here = starts[alive] + d - 1
            states[alive] = at = trie.child(states[alive], ids[here])
            token[at], size[at] = ids[here], lengths[here]
        at = states[alive]
        depth[at] = d
        np.add.at(count, at, n[alive])
        np.minimum.at(low, at, least[alive])
        shared[states[[i for i in (0, len(sizes) - 1) if sizes[i] >= d]]] = True
        stops.update((int(states[i]), ends[i]) for i in alive[sizes[alive] == d])

    nodes = np.flatnonzero(depth >= 0)
    nodes = nodes[np.argsort(depth[nodes], kind="stable")]
    digest = {0: ROOT}
    for s in nodes[1:].tolist():
        digest[s] = hashlib.md5(digest[int(trie.check[s])].encode() + by_id[token[s]]).hexdigest()
    children, leaves, saved = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, np.int64)
    by_depth = np.searchsorted(depth[nodes], np.arange(deep + 2))
    for d in range(deep, -1, -1):
        at = nodes[by_depth[d]:by_depth[d + 1]]
        own = at[~shared[at]]
        leaves[own] += children[own] == 0
        saved[own] += (count[own] - 1) * size[own]
        if d:
            up = trie.check[own]
            for sums, part in ((children, 1), (leaves, leaves[own]), (saved, saved[own])):
                np.add.at(sums, up, part)
    up = np.where(nodes == 0, 0, trie.check[nodes])
    no_parent = nodes == 0

    def ints(values, absent=None):
        return pa.array(values, pa.int64(), mask=absent) if absent is not None else pa.array(values, pa.int64())

    return pa.RecordBatch.from_arrays([
        pa.array([digest[s] for s in nodes.tolist()]), pa.array([None if s == 0 else digest[int(trie.check[s])] for s in nodes.tolist()], pa.string()),
        ints(depth[nodes]), pa.array(shared[nodes]), pa.array(shared[up] & ~no_parent),
        ints(low[up], no_parent | shared[up] | (low[up] == _NO_ID)), ints(low[nodes], low[nodes] == _NO_ID), ints(count[nodes]), ints(size[nodes]),
        pa.array([stops.get(s) for s in nodes.tolist()], pa.string()), ints(children[nodes]), ints(leaves[nodes]), ints(saved[nodes])], schema=_NODES)


def _build(sequences: int, turns: int):
    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                size = len(row["tokens"]) // WIDTH
                if rows and (len(rows) >= sequences or held + size > turns):
                    yield _shard(rows)
                    rows, held = [], 0
                rows.append(row)
                held += size
        if rows:
            yield _shard(rows)

    def _shard(rows):
        return shard_nodes(*([r[k] for r in rows] for k in ("tokens", "chars", "n", "least", "ends")))
    return run


# ---------------------------------------------------------------- shared upper nodes
def merged_upper(nodes: DataFrame) -> DataFrame:
    """The shared nodes, each once, with sums over their whole subtrees."""
    spark = nodes.sparkSession
    upper = nodes.filter("shared").groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("least").alias("least"), F.sum("n").alias("n"),
        F.first("chars").alias("chars"), F.max("ends").alias("ends"), F.sum("n_children").alias("below"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    upper = written(spark, upper, "trie-upper")
    kids = upper.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    upper = upper.join(kids.filter("node IS NOT NULL"), "node", "left").withColumn("n_children", F.col("below") + F.coalesce("kids", F.lit(0)))
    sums = upper.select("node", F.col("parent").alias("jump"),
                        (F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
                        (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"))
    deepest = upper.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        sums = written(spark, sums, "trie-sums")
        gained = sums.filter("jump IS NOT NULL").groupBy(F.col("jump").alias("node")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = sums.select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        sums = sums.join(gained, "node", "left").join(further, "jump", "left").select(
            "node", F.col("next").alias("jump"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
    sums = sums.select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_all"))
    return upper.join(sums, "node").select("node", "parent", "depth", "least", "n", "ends", "n_children", "n_leaves", F.col("saved_all").alias("saved"))


def trie(turns: DataFrame, sequences: int = SHARD_SEQUENCES, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: node and parent (digests of the prefix), conv_id and parent_conv_id (least members), depth, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 (null: no conversation ends here)."""
    spark = turns.sparkSession
    rows = distinct_sequences(turns).repartitionByRange(n_partitions(spark), "tokens").sortWithinPartitions("tokens")
    nodes = written(spark, rows.mapInArrow(_build(sequences, shard_turns), _NODES_SQL), "trie-nodes")
    upper = written(spark, merged_upper(nodes), "trie-upper-sums")
    parents = upper.select(F.col("node").alias("parent"), F.col("least").alias("upper_least"))
    own = nodes.filter("NOT shared")
    under = own.filter("parent_shared").drop("parent_least").join(parents, "parent", "left").withColumnRenamed("upper_least", "parent_least")
    tops = upper.join(parents, "parent", "left").withColumnRenamed("upper_least", "parent_least")
    columns = ["node", "parent", "least", "parent_least", "depth", "n", "n_children", "n_leaves", "saved", "ends"]
    every = own.filter("NOT parent_shared").select(*columns).unionByName(under.select(*columns)).unionByName(tops.select(*columns))
    return every.select("node", "parent", F.col("least").alias("conv_id"), F.col("parent_least").alias("parent_conv_id"), "depth",
                        F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
