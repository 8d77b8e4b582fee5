"""Exact global ranks and running sums without a single-task window.

``Window.orderBy(x)`` with no partition moves every row into one task; a
window partitioned by a class label moves a whole class into one task. Both
break at scale. ``global_cumsum`` gives the same exact running sums with the
work spread out:

1. cut rows into ordered buckets: either a deterministic monotone ``bucket``
   column given by the caller (e.g. a prefix of a hash the rows are ordered
   by), or a range partitioning by ``(keys, order)`` (Spark samples the
   bounds, so a hot key is split across partitions by its order columns);
2. a running sum inside each bucket;
3. per ``(bucket, key)`` totals — at most ``#buckets × #keys`` rows — turned
   into offsets with a window over that small frame and joined back.

Steps 2 and 3 read the bucketed rows twice, and both reads must see the same
buckets. A caller-given bucket is a pure function of the row, so that holds
on any recomputation. A sampled range partitioning is not, so its partition
number is stored as a column and the frame is checkpointed once into
``spark.checkpoint.dir``: both reads take the stored number, whatever Spark
samples elsewhere. There is one path for all sizes.

Callers that rank values with heavy repetition first collapse them with a
``groupBy(value).count()`` (map-side combined) and pass the count as weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The offset frame (#buckets x #keys rows) is broadcast only up to this many rows, counted first.
MAX_BROADCAST_OFFSETS = 200_000


def global_cumsum(df: DataFrame, keys: Sequence[str], order: Sequence, weight=None,
                  num_partitions: int | None = None, bucket: Column | None = None) -> DataFrame:
    """Add ``_cum_incl`` (running total including the row), ``_cum_excl`` and ``_key_total``.

    Rows are ordered by ``order`` within each ``keys`` group; ``order`` must make the order total
    (add a unique tie-breaker) for the result to be deterministic. ``weight`` is a column name
    (default: 1 per row) or a list of names, in which case every weight ``w`` gets its own
    ``_cum_incl_<w>``, ``_cum_excl_<w>`` and ``_key_total_<w>``; sums keep the weight's own type.
    ``bucket``: an integer column that never decreases along ``order`` (within a key) and depends
    only on the row; when given, it replaces the sampled range partitioning and its checkpoint.
    """
    spark = df.sparkSession
    p = num_partitions or shuffle_partitions(spark)
    multi = isinstance(weight, (list, tuple))
    names = list(weight) if multi else [weight]
    wcols = {f"_w{i}": F.col(n) if n else F.lit(1).cast("long") for i, n in enumerate(names)}
    keys = list(keys)
    order_cols = [_c(o) for o in order]
    by_key = Window.partitionBy(*keys) if keys else Window.partitionBy()

    def finish(out, lc, off, tot):
        new = {}
        for w, n in zip(wcols, names):
            suffix = f"_{n}" if multi else ""
            incl = off(w) + F.col(lc(w))
            new[f"_cum_incl{suffix}"] = incl
            new[f"_cum_excl{suffix}"] = incl - F.col(w)
            new[f"_key_total{suffix}"] = F.col(tot(w))
        return out.withColumns(new)

    ensure_checkpoint_dir(spark)
    if bucket is None:
        ranged = (df.withColumns(wcols).repartitionByRange(p, *[F.col(k) for k in keys], *order_cols)
                  .withColumn("_pid", F.spark_partition_id().cast("long")).checkpoint(eager=True))
    else:
        ranged = df.withColumns(wcols).withColumn("_pid", bucket.cast("long"))
    part = ranged.groupBy("_pid", *keys).agg(*[F.sum(w).alias(f"_p{w}") for w in wcols]).checkpoint(eager=True)
    few = part.count() <= MAX_BROADCAST_OFFSETS
    offsets = part.select("_pid", *keys,
                          *[(F.sum(f"_p{w}").over(by_key.orderBy("_pid")) - F.col(f"_p{w}")).alias(f"_off{w}")
                            for w in wcols],
                          *[F.sum(f"_p{w}").over(by_key).alias(f"_tot{w}") for w in wcols])
    local = Window.partitionBy("_pid", *keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({f"_lc{w}": F.sum(w).over(local) for w in wcols})
    # null-safe join: a null key (e.g. a missing label) is a group of its own, never dropped
    offs = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in ["_pid", *keys]],
                          *[c for c in offsets.columns if c not in ["_pid", *keys]])
    offs = F.broadcast(offs) if few else offs
    cond = [running[c].eqNullSafe(offs[f"_o_{c}"]) for c in ["_pid", *keys]]
    joined = running.join(offs, cond).drop(*[f"_o_{c}" for c in ["_pid", *keys]])
    out = finish(joined, lambda w: f"_lc{w}", lambda w: F.col(f"_off{w}"), lambda w: f"_tot{w}")
    drop = ["_pid", *wcols, *[f"_off{w}" for w in wcols], *[f"_lc{w}" for w in wcols],
            *[f"_tot{w}" for w in wcols]]
    return out.drop(*drop)


def global_row_number(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "row_number",
                      num_partitions: int | None = None,
                      bucket: Column | None = None) -> DataFrame:
    """Exact ``row_number()`` over ``partitionBy(keys).orderBy(order)`` (1-based) plus ``_key_total``."""
    r = global_cumsum(df, keys, order, None, num_partitions, bucket)
    return r.withColumnRenamed("_cum_incl", out).drop("_cum_excl")
