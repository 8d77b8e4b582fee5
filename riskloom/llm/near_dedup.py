"""Near-duplicate detection by chosen-path set similarity join (operator 9).

A document's set holds its distinct ``shingle``-word shingles (A-Z lowered).
Documents are linked if their sets' Jaccard similarity reaches ``percent``;
the result is the connected components of all links.

1. Equal sets become one node (two 64-bit digests and partial aggregates), so
   exact copies, however many, cost one row from here on.
2. Chosen paths. Each node has ``COORDINATES`` minwise tokens. ``TREES``
   independent trees split the nodes: at a tree node ``BRANCH`` coordinates are
   drawn from its path, and a document goes to the child that its token there
   names. Tree nodes of more than ``SMALL`` documents branch again, down to
   ``DEPTH``. A pair of similarity s stays together along one drawn coordinate
   with probability s, so at 0.8 a tree of any depth loses it with probability
   0.0625 at most (q = (0.2 + 0.8 q)^2) and four trees with 1.6e-5.
3. Tree nodes are compared exhaustively on ``BRIEF`` one-byte minwise tokens of
   their own, which the trees do not use. Pairs that agree in ``ROUGH`` of them
   (a pair at 0.8 fails with 1.3e-6) form blocks: a star per connected part of
   a tree node, then components over all trees.
4. Links are confirmed on full sets within each block, as stars again; their
   components are the result.

Steps 3 and 4 compare what is small in one task. A larger group (``CHUNK``
documents, ``SET_CHUNK`` shingles) is dealt into chunks: all its members are
held against a few drawn centres, and the centre with most links becomes a
star. Members of the star need no comparison among themselves; the rest meets
in pairs of chunks, with itself and with those star members that the triangle
inequality of the distance (Hamming, Jaccard) leaves within reach. So a hub's
copies, however many, cost one comparison each, no pair is left out at any
size, and no task holds more than two chunks.

Each step shuffles keys and short signatures; texts move to fetch the sets of
documents in blocks, and once more in ``keep_one``.

Defined cases: null, empty or word-free texts have no set and are linked with
nothing; a text of fewer than ``shingle`` words has its whole sequence as one
shingle; a component's first row is the one with the least doc_id (null after
all numbers), then the least ``key``: its doc_id is the component_id, null only
where all doc_ids are; ``keep_one`` keeps one row of each component, also where
rows repeat, share a doc_id or have none; very long texts are whole; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_CLASS, ship_code, written
from .rolling import gram_hashes, lowered, mix, text_bytes, word_bounds, word_hashes
from .substring_dedup import keyed, slices

SHINGLE, PERCENT = 2, 80
COORDINATES, TREES, BRANCH, DEPTH = 64, 4, 2, 3
SMALL, CHUNK, SET_CHUNK, CENTRES = 256, 20_000, 4_000_000, 16
BRIEF, ROUGH = 128, 0.62

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(77))
#: one hash function per token, first those of the trees, then those of the comparison
_A = _RNG.integers(1, 1 << 62, COORDINATES + BRIEF, dtype=np.uint64) * U(4) + U(1)
_B = _RNG.integers(1, 1 << 62, COORDINATES + BRIEF, dtype=np.uint64)


def shingle_sets(column, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, rows = text_bytes(column)
    data = lowered(data)
    starts, ends, first = word_bounds(data, rows)
    words = word_hashes(data, starts, ends)
    grams = mix(gram_hashes(words, shingle))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(grams[a:b - shingle + 1]))
        elif b > a:
            out.append(mix(gram_hashes(words[a:b], b - a)) ^ U(b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set (0, 0 where it is empty)."""
    size = np.array([len(x) for x in sets], np.int64)
    full = np.flatnonzero(size)
    out = np.zeros((2, len(sets)), np.uint64)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        for j in range(2):
            out[j, full] = mix(np.add.reduceat(mix(flat ^ _B[j]), starts) * _A[j] + size[full].astype(np.uint64))
    return out[0].view(np.int64), out[1].view(np.int64)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                     ("tokens", pa.list_(pa.int32())), ("brief", pa.binary())])
SKETCH_SCHEMA = "doc_id long, key long, n_shingles long, d1 long, d2 long, tokens array<int>, brief binary"


def _sketches(shingle: int):
    def run(batches):
        for batch in slices(batches, 256):
            sets = shingle_sets(batch.column("text"), shingle)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            least = np.zeros((len(sets), COORDINATES + BRIEF), np.uint32)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                for j in range(COORDINATES + BRIEF):
                    least[full, j] = np.minimum.reduceat(((flat * _A[j] + _B[j]) >> U(32)).astype(np.uint32), starts)
            tokens = np.ascontiguousarray(least[:, :COORDINATES])
            brief = (least[:, COORDINATES:] * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
            offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("key"), pa.array(size), *map(pa.array, digests(sets)),
                 pa.ListArray.from_arrays(offsets, pa.array(tokens.reshape(-1).view(np.int32))),
                 pa.array([x.tobytes() for x in brief], pa.binary())], schema=_SKETCH)
    return run


def grouped(batches, key: str):
    """Consecutive tables of whole groups of ``key`` from batches sorted by it."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        keys = held.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if len(keys) and keys[0] != keys[-1] else 0
        if cut >= 4096:
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def parts(n: int, near, start: int) -> np.ndarray:
    """Connected parts 0.. of ``n`` items; ``near(x, others)`` says which of ``others`` are linked with x."""
    part, left, c = np.full(n, -1), np.arange(n), 0
    while len(left):
        first = start if part[start] < 0 else int(left[0])
        part[first] = c
        left = left[left != first]
        queue = [first]
        while queue and len(left):
            hit = near(queue.pop(), left)
            if hit.any():
                new = left[hit]
                part[new] = c
                queue.extend(new.tolist())
                left = left[~hit]
        c += 1
    return part


def _middle(brief: np.ndarray) -> int:
    """The item that agrees most with the most common token of each coordinate (over a prefix of 512 items)."""
    few = brief[:512]
    common = np.array([np.bincount(few[:, j], minlength=256).argmax() for j in range(few.shape[1])])
    return int((few == common).sum(axis=1).argmax())


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class Briefs:
    """Loads are ``BRIEF`` bytes; the distance of two is the number that differ (a metric)."""

    def __init__(self, rough: float):
        self.limit = float(int(BRIEF * (1 - rough)))

    def read(self, loads: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(loads), np.uint8).reshape(-1, BRIEF)

    def near(self, own: np.ndarray):
        return lambda x, others: (own[others] != own[x]).sum(axis=1) <= self.limit

    def part(self, own: np.ndarray) -> np.ndarray:
        if len(own) > 64:
            return parts(len(own), self.near(own), _middle(own))
        alike = (own[:, None, :] != own[None, :, :]).sum(axis=2) <= self.limit
        return parts(len(own), lambda x, o: alike[x, o], 0) if alike.sum() > len(own) else np.arange(len(own))

    def distances(self, own: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
        return (own[others] != own[x]).sum(axis=1).astype(float)


class Sets:
    """Loads are sorted shingle hashes; the distance of two sets is one minus their Jaccard similarity (a metric)."""

    def __init__(self, percent: int):
        self.percent, self.limit = percent, 1 - percent / 100

    def read(self, loads: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint64) for x in loads]

    def near(self, sets: list[np.ndarray]):
        size, shared = _shared(sets)

        def near(x, others):
            # only sizes that can reach the similarity
            fit = 100 * np.minimum(size[others], size[x]) >= self.percent * np.maximum(size[others], size[x])
            hit = np.zeros(len(others), bool)
            both = shared(x, others[fit])
            hit[fit] = 100 * both >= self.percent * (size[x] + size[others[fit]] - both)
            return hit
        return near

    def part(self, sets: list[np.ndarray]) -> np.ndarray:
        return parts(len(sets), self.near(sets), int(np.argsort([len(s) for s in sets])[len(sets) // 2]))

    def distances(self, sets: list[np.ndarray], x: int, others: np.ndarray) -> np.ndarray:
        size, shared = _shared([sets[x], *(sets[o] for o in others)])
        both = shared(0, np.arange(1, len(size)))
        either = size[0] + size[1:] - both
        # whether a pair is linked is decided in integers
        return np.where(100 * both >= self.percent * either, np.minimum(1 - both / either, self.limit),
                        np.maximum(1 - both / either, self.limit + 1e-9))


def _shared(sets: list[np.ndarray]):
    """The sizes of the sets, and a function of x and others: how many shingles each of the others shares with x."""
    size = np.array([len(s) for s in sets], np.int64)
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    has = np.zeros(len(names), bool)

    def shared(x, others):
        if not len(others):
            return np.zeros(0, np.int64)
        has[ids[starts[x]:starts[x + 1]]] = True
        n = size[others]
        at = np.cumsum(n) - n
        flat = np.arange(int(n.sum())) + np.repeat(starts[others] - at, n)
        both = np.add.reduceat(has[ids[flat]], at, dtype=np.int64)
        has[ids[starts[x]:starts[x + 1]]] = False
        return both
    return size, shared


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _each(table, key: str):
    keys = table.column(key).to_numpy()
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return zip(head.tolist(), [*head[1:].tolist(), len(keys)], strict=True)


def _stars(measure):
    """Rows (part, node, load) sorted by part, to a star of edges for each connected set of a part."""
    def run(batches):
        for table in grouped(batches, "part"):
            node, own = table.column("node").to_numpy(), measure.read(table.column("load").to_pylist())
            a, b = [], []
            for at, end in _each(table, "part"):
                if end - at < 2:
                    continue
                part, names = measure.part(own[at:end]), node[at:end]
                low = np.full(part.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(low, part, names)
                rest = names != low[part]
                a.append(low[part][rest])
                b.append(names[rest])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=_EDGES)
    return run


def _across(measure):
    """Rows (part, node, load, star) sorted by part, to one edge for each row beside the star that is linked with a row of it."""
    def run(batches):
        for table in grouped(batches, "part"):
            node, loads, star = table.column("node").to_numpy(), table.column("load"), table.column("star").to_numpy()
            a, b = [], []
            for at, end in _each(table, "part"):
                inside, beside = np.flatnonzero(star[at:end] == 1), np.flatnonzero(star[at:end] == 0)
                if not len(inside) or not len(beside):
                    continue
                near = measure.near(measure.read(loads.slice(at, end - at).to_pylist()))
                for x in beside.tolist():
                    hit = near(x, inside)
                    if hit.any():
                        a.append(node[at + x])
                        b.append(node[at + inside[hit.argmax()]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a)), pa.array(np.array(b))], schema=_EDGES)
    return run


_DISTANCES = pa.schema([("group", pa.int64()), ("node", pa.int64()), ("distances", pa.list_(pa.float64()))])


def _to_centres(measure):
    """Rows (part, group, node, load, slot) sorted by part; slot is -1 for members, else a centre's place: members' distances."""
    def run(batches):
        for table in grouped(batches, "part"):
            for at, end in _each(table, "part"):
                one = table.slice(at, end - at)
                slot, own = one.column("slot").to_numpy(), measure.read(one.column("load").to_pylist())
                members = np.flatnonzero(slot < 0)
                out = np.full((len(members), CENTRES), np.inf)
                for x in np.flatnonzero(slot >= 0).tolist():
                    out[:, slot[x]] = measure.distances(own, x, members)
                offsets = pa.array(np.arange(len(members) + 1, dtype=np.int32) * CENTRES)
                yield pa.RecordBatch.from_arrays(
                    [one.column("group").combine_chunks().take(pa.array(members)), one.column("node").combine_chunks().take(pa.array(members)),
                     pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1)))], schema=_DISTANCES)
    return run


def _by_part(rows: DataFrame, run, schema: str) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def _chunked(rows: DataFrame, name: str, limit: int) -> DataFrame:
    """``rows`` with ``chunks``, the number that hold about ``limit`` of weight in each group, and the ``chunk`` of each row."""
    sums = written(rows.sparkSession, rows.groupBy("group").agg(F.ceil(F.sum("weight") / limit).cast("int").alias("chunks")), name)
    return rows.join(sums, "group").withColumn("chunk", F.expr("cast(pmod(xxhash64(node, group), chunks) AS INT)"))


def star_edges(members: DataFrame, loads: DataFrame, measure, limit: int) -> DataFrame:
    """Edges a, b, in stars, that connect whatever ``measure`` links within a group, directly or by other members.

    ``members`` (group, node, weight) are light rows, ``loads`` (node, load) what is compared; no task holds more than
    about two times ``limit`` of weight (or one load). Loads grow with the input, so they are shuffled at every size.
    """
    spark = members.sparkSession
    loads = loads.hint("merge")
    members = written(spark, members, "members")
    sums = members.groupBy("group").agg(F.sum("weight").alias("total"))
    large = written(spark, sums.filter(F.col("total") > limit).select("group", F.ceil(F.col("total") / limit).cast("int").alias("chunks")), "large")
    small = members.join(large, "group", "left_anti").join(loads, "node").select(F.col("group").alias("part"), "node", "load")
    edges = _by_part(small, _stars(measure), "a long, b long")
    if large.isEmpty():
        return edges
    dealt = written(spark, members.join(large, "group").withColumn("chunk", F.expr("cast(pmod(xxhash64(node, group), chunks) AS INT)")), "dealt")
    centres = written(spark, dealt.withColumn("slot", F.expr(f"cast(pmod(xxhash64(node, 'slot'), {CENTRES}) AS INT)")).groupBy(
        "group", "chunks", "slot").agg(F.min_by("node", F.xxhash64("node", F.lit("centre"))).alias("node")), "centres")
    part = F.xxhash64("group", "chunk").alias("part")
    held = dealt.join(loads, "node").select(part, "group", "node", "load", F.lit(-1).alias("slot")).unionByName(
        centres.join(loads, "node").withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).select(part, "group", "node", "load", "slot"))
    distances = written(spark, _by_part(held, _to_centres(measure), "group long, node long, distances array<double>"), "distances")
    # the centre with most links in its group is the star's
    links = distances.select("group", F.posexplode("distances").alias("slot", "d")).groupBy("group", "slot").agg(
        F.count_if(F.col("d") <= measure.limit).alias("n"))
    star = links.groupBy("group").agg(F.max_by("slot", F.struct("n", "slot")).alias("slot")).join(
        centres.select("group", "slot", F.col("node").alias("centre")), ["group", "slot"])
    star = written(spark, star, "star")
    found = written(spark, distances.join(star, "group").select("group", "node", "centre", F.expr("get(distances, slot)").alias("d")).join(
        dealt, ["group", "node"]), "found")
    inside, rest = found.filter(F.col("d") <= measure.limit), found.filter(F.col("d") > measure.limit)
    edges = edges.unionByName(inside.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")))
    if rest.isEmpty():
        return edges
    light = rest.select("group", "node", "weight", "d")
    # the rest with itself: every pair of its chunks
    among = _chunked(light, "among", limit).withColumn("other", F.explode(F.expr(
        "if(chunks = 1, array(0), filter(sequence(0, chunks - 1), c -> c <> chunk))")))
    among = among.select(F.expr("xxhash64(group, 'among', least(chunk, other), greatest(chunk, other))").alias("part"), "node")
    edges = edges.unionByName(_by_part(among.join(loads, "node").select("part", "node", "load"), _stars(measure), "a long, b long"))
    # the rest with the star, where the distances to the centre allow a link
    close = light.filter(F.col("d") <= 2 * measure.limit + 1e-6)
    close = written(spark, _chunked(close, "close", limit), "close")
    least = written(spark, close.groupBy("group").agg(F.min("d").alias("least"), F.any_value("chunks").alias("others")), "least")
    one = inside.join(least, "group").filter(F.col("d") >= F.col("least") - measure.limit - 1e-6).withColumn(
        "other", F.explode(F.expr("sequence(0, others - 1)"))).select(
        F.expr("xxhash64(group, 'across', chunk, other)").alias("part"), "node", F.lit(1).alias("star"))
    two = close.join(large.select("group", F.col("chunks").alias("others")), "group").withColumn(
        "other", F.explode(F.expr("sequence(0, others - 1)"))).select(
        F.expr("xxhash64(group, 'across', other, chunk)").alias("part"), "node", F.lit(0).alias("star"))
    across = one.unionByName(two).join(loads, "node").select("part", "node", "load", "star")
    return edges.unionByName(_by_part(across, _across(measure), "a long, b long"))


def tree_leaves(nodes: DataFrame, trees: int = TREES, branch: int = BRANCH, depth: int = DEPTH, small: int = SMALL) -> DataFrame:
    """Columns path, node: the tree nodes of two documents or more that are small or lie at ``depth``."""
    spark = nodes.sparkSession
    step = f"explode(transform(sequence(1, {branch}), i -> xxhash64(%s, i, get(tokens, cast(pmod(xxhash64(%s, i), {COORDINATES}) AS INT)))))"
    rows = nodes.select("node", F.explode(F.expr(f"sequence(1, {trees})")).alias("tree"), "tokens").select(
        "node", F.expr(step % ("tree", "tree")).alias("path"))
    done = None
    for level in range(1, depth + 1):
        rows = written(spark, rows, f"paths-{level}")
        counts = rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        sized = rows.join(counts, "path")
        if level == depth:
            return done.unionByName(sized.select("path", "node")) if done is not None else sized.select("path", "node")
        sized = written(spark, sized, f"sized-{level}")
        found = sized.filter(f"n <= {small}").select("path", "node")
        done = found if done is None else done.unionByName(found)
        large = sized.filter(f"n > {small}").select("path", "node")
        if large.isEmpty():
            return done
        rows = large.join(nodes.select("node", "tokens").hint("merge"), "node").select("node", F.expr(step % ("path", "path")).alias("path"))


def components(edges: DataFrame) -> DataFrame:
    """Columns node, label: the least node that each node of an edge (a, b) reaches.

    Least labels of neighbours, then of labels (pointer jumping), written at
    each round; the edges are stars, so a handful of rounds suffices.
    """
    spark = edges.sparkSession
    both = written(spark, edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, "a").select("a", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("a").alias("label"), F.col("label").alias("further"))
        new = written(spark, new.join(jump, "label").select("a", F.least("label", "further").alias("label"), "old"), "labels")
        changed = not new.filter("label <> old").isEmpty()
        labels = new.select("a", "label")
        if not changed:
            return labels.withColumnRenamed("a", "node")


_SETS = pa.schema([("node", pa.int64()), ("load", pa.binary())])
#: what orders the rows of a component: no doc_id (1), doc_id (0 if none), key; never null
_FIRST = ("none", "low", "key")


def _full_sets(shingle: int):
    """The sets of the texts whose digests are their node's."""
    def run(batches):
        for batch in slices(batches, 128):
            sets = shingle_sets(batch.column("text"), shingle)
            own = np.ones(len(sets), bool)
            for name, found in zip(("d1", "d2"), digests(sets), strict=True):
                own &= batch.column(name).to_numpy(zero_copy_only=False) == found
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             schema=_SETS).filter(pa.array(own))
    return run


def link(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, trees: int = TREES,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, key, n_shingles, component_id (least doc_id reachable), first_key (key of its first row)."""
    spark = ship_code(docs.sparkSession)
    rows = keyed(docs, doc_id, text)
    sketches = written(spark, rows.mapInArrow(_sketches(shingle), SKETCH_SCHEMA), "sketches")
    first = F.struct(F.col("doc_id").isNull().cast("long").alias("none"), F.coalesce("doc_id", F.lit(0)).alias("low"), F.col("key"))
    nodes = sketches.filter("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min(first).alias("first"), F.any_value("tokens").alias("tokens"), F.any_value("brief").alias("load"), F.max("n_shingles").alias("weight"))
    # written once, so a node keeps its number
    nodes = written(spark, nodes.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "first.*", "tokens", "load", "weight"), "nodes")
    leaves = tree_leaves(nodes, trees).select(F.col("path").alias("group"), "node", F.lit(1).alias("weight"))
    edges = star_edges(leaves, nodes.select("node", "load"), Briefs(ROUGH), CHUNK)
    blocks = components(edges.distinct())
    members = written(spark, blocks.join(nodes.select("node", "weight", "d1", "d2", "key"), "node").withColumnRenamed("label", "group"), "blocks")
    sets = rows.select("key", "text").join(members.select("key", "node", "d1", "d2").hint("merge"), "key").mapInArrow(_full_sets(shingle), "node long, load binary")
    # repeated rows share a key: one set of a node is enough
    sets = written(spark, sets.groupBy("node").agg(F.first("load").alias("load")), "sets")
    linked = components(star_edges(members.select("group", "node", "weight"), sets, Sets(percent), SET_CHUNK).distinct())
    least = nodes.select("node", F.struct(*_FIRST).alias("first")).join(linked, "node").groupBy("label").agg(F.min("first").alias("linked"))
    least = linked.join(least, "label").select("node", "linked")
    # copies of one set: their node's first row stands for those without links
    own = nodes.select("node", "d1", "d2", F.struct(*_FIRST).alias("alone")).join(least, "node", "left").select(
        "d1", "d2", F.coalesce("linked", "alone").alias("first"))
    found = sketches.select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("d1")).alias("d1"), "d2").join(own.hint("merge"), ["d1", "d2"], "left")
    return found.select("doc_id", "key", "n_shingles",
                        F.when(F.col("first").isNull(), F.col("doc_id")).when(F.col("first.none") == 0, F.col("first.low")).alias("component_id"),
                        F.coalesce("first.key", "key").alias("first_key"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row of each component, its first, with the columns of ``docs``; rows without a word all stay.

    Rows equal in doc_id and text share a key: the one with the least hash of its columns (but for maps) stays.
    """
    kept = link(docs, doc_id=doc_id, text=text, **params).filter("key = first_key AND n_shingles > 0").select("key").distinct()
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    worded = own.rlike(WORD_CLASS)
    order = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    rows = docs.filter(worded).select(F.struct("*").alias("row"), F.xxhash64(F.col(doc_id), own).alias("key"),
                                      F.xxhash64(own, F.lit("text")).alias("again"), order.alias("order"))
    one = rows.join(kept, "key").groupBy("key", "again").agg(F.min_by("row", "order").alias("row")).select("row.*")
    return one.unionByName(docs.filter(~worded))
