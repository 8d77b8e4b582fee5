"""Mixing sources to target weights by a hypergeometric splitting tree (operator 6).

Each source's documents fall into ``BLOCKS`` blocks by a hash of id and text, in
hash order, which is a random order. A source is taken whole as often as its
target allows (an epoch each); the rest of the target is a prefix of the hash
order, closed by the one further document whose size is nearest to what is
still missing. So totals per source need sums of at most ``BLOCKS`` rows each
and one block of single documents, however large the source.

The blocks that the mix takes are quotas: integers per source. A tree over the
output shards splits them exactly: at each node the left half's share is a
multivariate hypergeometric draw. A shard then owns a range of each source's
permuted block numbers, disjoint from all others (an affine permutation, so no
table of blocks is kept), and its rows are put in random order by range
partitioning on (shard, random key), which no single task has to hold.

Only one row per source (at most ``MAX_SOURCES``) reaches the driver.

Defined cases: null text has size 0; null source is a source of its own, last
in order; documents without words are never taken more than the source's whole
epochs; rows of a source that share doc_id and text (null ids and null or empty
texts are equal) move together; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_partitions, written

BLOCK_DIGITS = 3
BLOCKS = 16 ** BLOCK_DIGITS
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SHARDS = 16
SEED = 17
MAX_SOURCES = 100_000

_PARAMS = ("p_source string, source_size long, target double, epochs int, cut string, extra string, missing long, "
           "n_blocks long, stride long, shift long, shard_ends array<long>, partial_block long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Columns row (all of ``docs``), _source, _key (hash order) and size in words."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return docs.select(F.struct("*").alias("row"), F.col(source).alias("_source"),
                       F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"),
                                      F.md5(F.coalesce(F.col(text), F.lit(""))))).alias("_key"),
                       F.size(words).cast("long").alias("size"))


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> dict:
    """Words to take per source: shares by weight, repeated in code point order, none above ``max_repeats`` sizes."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, left, out = dict(order), float(sum(n for _, n in order)), {}
    active = [s for s, _ in order]
    while active:
        total = sum(weight[s] for s in active)
        share = {s: left * weight[s] / total for s in active}
        over = [s for s in active if share[s] > max_repeats * size[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = float(max_repeats * size[s])
            left -= out[s]
        active = [s for s in active if s not in out]
    return out


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Exact block counts per (shard, source); ``quotas`` are the sources' block counts."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    share = int(round(int(quotas.sum()) * left / shards))
    drawn = rng.multivariate_hypergeometric(quotas, share, method="marginals") if quotas.sum() else quotas
    return np.vstack([splitting_tree(drawn, left, rng), splitting_tree(quotas - drawn, shards - left, rng)])


def _partial_epochs(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source with a partial epoch: cut (largest key of the prefix), extra (key of the closing document), blocks."""
    units = rows.join(goal, F.col("_source").eqNullSafe(F.col("g_source"))).filter("missing > 0").withColumn(
        "_block", F.substring("_key", 1, BLOCK_DIGITS))
    blocks = units.groupBy("_source", "missing", "_block").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    # the first block that the prefix does not hold whole
    edge = blocks.filter("before + words > missing").groupBy("_source").agg(
        F.min(F.struct("_block", "before")).alias("e")).select(F.col("_source").alias("e_source"), "e.*").withColumnRenamed("_block", "e_block")
    near = units.join(F.broadcast(edge), F.col("_source").eqNullSafe(F.col("e_source")))  # one row per source
    inside = near.filter("_block = e_block").groupBy("_source", "missing", "before", "_key").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("_source").orderBy("_key")
    inside = inside.withColumn("sum", F.col("before") + F.sum("words").over(upto))
    prefix = inside.groupBy("_source").agg(
        F.max(F.when(F.col("sum") <= F.col("missing"), F.col("_key"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("sum") <= F.col("missing"), F.col("sum"))), F.first("before")).alias("taken"))
    found = edge.join(F.broadcast(prefix), F.col("_source").eqNullSafe(F.col("e_source"))).select(
        "e_source", "taken", F.coalesce("cut", "e_block").alias("cut"), F.conv("e_block", 16, 10).cast("long").alias("partial_block"))
    # the unit outside the prefix that comes nearest to the rest
    outside = units.join(F.broadcast(found), F.col("_source").eqNullSafe(F.col("e_source"))).filter("_key > cut")
    outside = outside.groupBy("_source", "missing", "taken", "_key").agg(F.sum("size").alias("words"))
    outside = outside.withColumn("off", F.abs(F.col("missing") - F.col("taken") - F.col("words"))).filter("off < missing - taken")
    closing = outside.groupBy("_source").agg(F.min(F.struct("off", "_key")).alias("x")).select(
        F.col("_source").alias("x_source"), F.col("x._key").alias("extra"))
    return found.join(F.broadcast(closing), F.col("e_source").eqNullSafe(F.col("x_source")), "left").select("e_source", "cut", "extra", "partial_block")


def allot(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, shards: int = SHARDS, seed: int = SEED,
          doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs`` (struct ``row``) with size, source_size, target and takes: array of (epoch, shard, at).

    ``at`` is a random key: the order of the copy within its shard.
    """
    spark = docs.sparkSession
    rows = sized(docs, doc_id, text, source)
    counted = written(spark, rows.select("_source", "_key", "size"), "mix-sizes")
    found = counted.groupBy("_source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["_source"]: int(r["n"]) for r in found}
    wanted = targets(list(sizes.items()), weights, max_repeats)
    whole = {s: min(max_repeats, int(wanted[s] // n)) if n else 0 for s, n in sizes.items()}
    missing = {s: int(round(wanted[s])) - whole[s] * n if whole[s] < max_repeats else 0 for s, n in sizes.items()}
    # a rest that rounds up to the whole source is one more epoch: no block would hold the end of its prefix
    for s, n in sizes.items():
        if 0 < n <= missing[s]:
            whole[s], missing[s] = whole[s] + 1, 0
    goal = spark.createDataFrame([(s, max(0, missing[s])) for s in sizes], "g_source string, missing long")
    edges = {r["e_source"]: r for r in _partial_epochs(counted, F.broadcast(goal)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    touched = {s: (edges[s]["partial_block"] + 1) if s in edges else 0 for s in order}
    blocks = {s: BLOCKS * whole[s] + touched[s] for s in order}
    rng = np.random.default_rng(seed)
    tree = splitting_tree(np.array([blocks[s] for s in order], np.int64), shards, rng)
    ends = np.cumsum(tree, axis=0)
    params = []
    for i, s in enumerate(order):
        n = max(1, blocks[s])
        stride = next(a for a in iter(lambda n=n: int(rng.integers(1, n + 1)), None) if math.gcd(a, n) == 1)
        e = edges.get(s)
        params.append((s, sizes[s], float(wanted[s]), whole[s], e["cut"] if e else None, e["extra"] if e else None,
                       max(0, missing[s]), n, stride, int(rng.integers(0, n)), [int(x) for x in ends[:, i]],
                       e["partial_block"] if e else None))
    side = F.broadcast(spark.createDataFrame(params, _PARAMS))  # one row per source, at most MAX_SOURCES
    joined = rows.join(side, F.col("_source").eqNullSafe(F.col("p_source")), "left")
    joined = joined.withColumns({
        "_block": F.conv(F.substring("_key", 1, BLOCK_DIGITS), 16, 10).cast("long"),
        "_more": F.expr("coalesce(_key <= cut OR _key = extra, false)"),
    }).withColumn("takes", F.expr(f"""transform(
        filter(sequence(0, epochs), e -> e < epochs OR _more),
        e -> named_struct('epoch', e, 'block', e * {BLOCKS}L + CASE WHEN e < epochs THEN _block ELSE least(_block, partial_block) END))"""))
    return joined.withColumn("takes", F.expr(f"""transform(takes, t -> named_struct(
        'epoch', t.epoch,
        'shard', size(filter(shard_ends, x -> x <= (t.block * stride + shift) % n_blocks)),
        'at', md5(concat('{seed}:', t.epoch, ':', _key))))"""))
    # a copy is part of the mix where the range of a shard holds its block
    joined = joined.withColumn("takes", F.expr(f"filter(takes, t -> t.shard < {shards})"))
    return joined.select("row", "size", "source_size", "target", "takes")


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed rows: columns of ``docs``, one row per copy, range-partitioned by shard and shuffled within it."""
    copies = allot(docs, **params).select("row", F.explode("takes").alias("take"))
    copies = copies.select("row", F.col("take.shard").alias("_shard"), F.col("take.at").alias("_at"))
    n = n_partitions(docs.sparkSession)
    return copies.repartitionByRange(n, "_shard", "_at").sortWithinPartitions("_shard", "_at").select("row.*")
