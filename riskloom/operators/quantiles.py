"""Exact quantiles with linear interpolation (pandas/numpy default, DuckDB ``quantile_cont``).

Spark's ``percentile`` is exact but keeps every distinct value of a group in
one aggregation buffer and finishes a global quantile in one task. Here the
wanted ranks are found by narrowing ranges, all columns and groups at once:

1. one aggregate of mergeable sketches (``percentile_approx``, a fixed size)
   gives two values around each wanted rank;
2. one aggregate counts, exactly, the values below, at and between the two.
   A rank that falls on one of them is found, so a hot value costs nothing;
   where only few values lie between, they come back with the counts.
3. A rank still open keeps the range it fell into and takes another round over
   the values of that range only; its exact counts make up for any error of the
   sketch, so the result never depends on it.

Nothing is exploded, shuffled or written but the aggregates. Each round leaves a
few thousandths of the values, so two rounds serve millions of rows and four
serve trillions. With more groups than the driver should hold, the values are
counted and ranked by ``global_cumsum`` instead. Null and NaN are skipped, as in
pandas.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import global_cumsum

#: sketch accuracy: its ranks are off by at most this part of the values
SKETCH_ACCURACY = 10_000
#: distance from a wanted quantile, as a part of the values, of the two values around it
MARGIN = 0.001
#: quantiles of the sketch from the second round on
GRID = 1000
#: values between two sketch values that come back with their counts
MAX_BETWEEN = 20_000
#: groups with fewer values send them all
SMALL_GROUP = 2_000
#: groups x columns x quantiles that are narrowed from the driver
MAX_RANKS = 4_000
MAX_LOCAL_ROWS = 10_000


def _long(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols]
    return (df.select(*group_cols, F.inline(F.array(*structs)))
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


@dataclass
class _Range:
    """An open range (None: unbounded) of a column in a group that holds wanted ranks (0-based, of all its values).

    ``below``: how many values come before it; ``size``: how many lie in it; ``near``: the two values to count at next.
    """

    group: int
    col: int
    ranks: list
    size: int
    near: tuple | None = None
    low: float | None = None
    high: float | None = None
    below: int = 0

    def few(self) -> bool:
        """Whether the values between the two of ``near`` may come back with their counts."""
        return self.size <= SMALL_GROUP or 6 * MARGIN * self.size <= MAX_BETWEEN

    def split(self, counts, between, found: dict) -> list:
        """From the exact ``counts`` below near[0], at it, between, at near[1]: ranks found, and the ranges of the others."""
        a, b = self.near
        middle = (self.low if a == -math.inf and self.low is not None else a, self.high if b == math.inf and self.high is not None else b)
        above = self.size - sum(counts)
        parts = [(counts[0], (self.low, a)), (counts[1], a), (counts[2], middle), (counts[3], b), (above, (b, self.high))]
        out = {}
        for rank in self.ranks:
            below = self.below
            for n, part in parts:
                if rank - below < n:
                    break
                below += n
            if not isinstance(part, tuple):
                found[self.group, self.col, rank] = part
            elif part is middle and between is not None:
                found[self.group, self.col, rank] = between[rank - below]
            else:
                out.setdefault(part, _Range(self.group, self.col, [], n, None, *part, below)).ranks.append(rank)
        return list(out.values())


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = ()) -> DataFrame:
    """Long frame ``(group_cols..., column, prob, value)``; one row per column × prob × group.

    A group's column without values has no row. The result is a small local table, which Spark broadcasts by its known
    size, so that callers read it as often as they like.
    """
    group_cols, spark, probs = list(group_cols), df.sparkSession, [float(q) for q in probs]
    groups = [f"_g{i}" for i in range(len(group_cols))]
    values = df.select(*[F.col(f"`{c}`").alias(g) for c, g in zip(group_cols, groups)],
                       *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"_v{i}") for i, c in enumerate(cols)])
    near = [x for q in probs for x in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))]
    sketches = values.groupBy(*groups).agg(
        *[F.count(f"_v{i}").alias(f"n{i}") for i in range(len(cols))],
        *[F.percentile_approx(f"_v{i}", near, SKETCH_ACCURACY).alias(f"s{i}") for i in range(len(cols))])
    most = max(1, MAX_RANKS // max(1, len(cols) * len(probs)))
    rows = sketches.limit(most + 1).collect()
    if len(rows) > most:
        return ranked_quantiles(df, cols, probs, group_cols)

    keys = [tuple(row[c] for c in groups) for row in rows]
    wanted, ranges, found = [], {}, {}
    for g, row in enumerate(rows):
        for i in range(len(cols)):
            n = row[f"n{i}"]
            for k, q in enumerate(probs if n else ()):
                h = (n - 1) * q
                low, high = math.floor(h), min(math.floor(h) + 1, n - 1)
                wanted.append((g, i, q, low, high, h - low))
                around = (-math.inf, math.inf) if n <= SMALL_GROUP else tuple(row[f"s{i}"][2 * k:2 * k + 2])
                ranges.setdefault((g, i, around), _Range(g, i, [], n, around)).ranks += [low, high]
    open_ranges = list(ranges.values())
    while open_ranges:
        open_ranges = _round(spark, values, groups, keys, open_ranges, found)
    out = [(*keys[g], cols[i], q, found[g, i, a] + (found[g, i, b] - found[g, i, a]) * t) for g, i, q, a, b, t in wanted]
    types = [f"`{c}` {values.schema[g].dataType.simpleString()}" for c, g in zip(group_cols, groups)]
    return spark.createDataFrame(out, ", ".join([*types, "`column` string", "prob double", "value double"]))


def _round(spark, values: DataFrame, groups, keys, ranges, found: dict) -> list:
    """One round over all open ranges; returns those that are still open."""
    slots, counter = {}, {}  # slot (column, number): its ranges, one a group at most
    for r in ranges:
        j = counter[r.group, r.col] = counter.get((r.group, r.col), -1) + 1
        slots.setdefault((r.col, j), {})[r.group] = r
    slots = {f"{i}_{j}": (F.col(f"_v{i}"), by_group) for (i, j), by_group in slots.items()}

    def bounded(fields):
        """``values`` with the number of the row's group and its bounds, columns <field><slot>."""
        names = [(f, s) for s in slots for f in fields]
        if not groups:
            return values.withColumns({"_b": F.lit(0), **{f"{f}{s}": F.lit(fields[f](slots[s][1][0])).cast("double") for f, s in names}})
        table = spark.createDataFrame(
            [(*key, g, *[fields[f](slots[s][1][g]) if g in slots[s][1] else None for f, s in names]) for g, key in enumerate(keys)],
            ", ".join([f"_b{c} {values.schema[c].dataType.simpleString()}" for c in groups] + ["_b int"] + [f"{f}{s} double" for f, s in names]))
        same = reduce(lambda x, y: x & y, [values[c].eqNullSafe(table[f"_b{c}"]) for c in groups])
        return values.join(F.broadcast(table), same)  # MAX_RANKS bounds its size

    def inside(v, s):
        return (F.col(f"low{s}").isNull() | (v > F.col(f"low{s}"))) & (F.col(f"high{s}").isNull() | (v < F.col(f"high{s}")))

    ends = {"low": lambda r: r.low, "high": lambda r: r.high}
    blank = [s for s, (_, got) in slots.items() if any(r.near is None for r in got.values())]
    if blank:
        grid = [x / GRID for x in range(GRID + 1)]
        for row in bounded(ends).groupBy("_b").agg(*[
                F.percentile_approx(F.when(inside(slots[s][0], s), slots[s][0]), grid, SKETCH_ACCURACY).alias(s) for s in blank]).collect():
            for s in blank:
                r = slots[s][1].get(row["_b"])
                if r is not None and r.size <= SMALL_GROUP:
                    r.near = (-math.inf, math.inf)
                elif r is not None:  # two steps of the grid to both sides, more than the sketch's error
                    at = [(rank - r.below) / r.size * GRID for rank in r.ranks]
                    r.near = (row[s][max(0, math.floor(min(at)) - 2)], row[s][min(GRID, math.ceil(max(at)) + 2)])
    rows, aggs, lists = bounded({**ends, "a": lambda r: r.near[0], "b": lambda r: r.near[1], "few": lambda r: float(r.few())}), [], {}
    for s, (v, _) in slots.items():
        a, b, here = F.col(f"a{s}"), F.col(f"b{s}"), inside(v, s)
        between = here & (v > a) & (v < b)
        aggs += [F.count_if(here & (v < a)).alias(f"c{s}_0"), F.count_if(here & (v == a)).alias(f"c{s}_1"),
                 F.count_if(between).alias(f"c{s}_2"), F.count_if(here & (v == b) & (b > a)).alias(f"c{s}_3")]
        lists[s] = F.when(between & (F.col(f"few{s}") == 1), v)
    # the counts are one compiled aggregate; the few values between come in a filtered scan of their own
    counts = {row["_b"]: row for row in rows.groupBy("_b").agg(*aggs).collect()}
    listed = rows.select("_b", *[x.alias(f"l{s}") for s, x in lists.items()])
    listed = listed.where(reduce(lambda x, y: x | y, [F.col(f"l{s}").isNotNull() for s in lists])).toPandas()
    still = []
    for s, (_, got) in slots.items():
        values_of = listed[["_b", f"l{s}"]].dropna().groupby("_b")[f"l{s}"].apply(sorted) if len(listed) else {}
        for g, r in got.items():
            still += r.split([counts[g][f"c{s}_{x}"] for x in range(4)], values_of.get(g, []) if r.few() else None, found)
    return still


def ranked_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` for any number of groups: the distinct values are ranked in order (``global_cumsum``).

    The result is computed once: up to ``MAX_LOCAL_ROWS`` rows become a small local table, which Spark broadcasts by
    its known size; a larger one stays distributed, in the checkpoint folder.
    """
    group_cols = list(group_cols)
    keys = group_cols + ["column"]
    counts = _long(df, cols, group_cols).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = global_cumsum(counts, keys, ["value"], "_cnt")
    n1 = F.col("_key_total") - F.lit(1)
    picks, outs = [], []
    for i, q in enumerate(probs):
        h = n1.cast("double") * F.lit(float(q))
        lo = F.floor(h)
        hi = F.least(lo + F.lit(1), n1)
        # rank r (0-based) lies in this value's block when cum_excl <= r < cum_incl
        hit_lo = (F.col("_cum_excl") <= lo) & (lo < F.col("_cum_incl"))
        hit_hi = (F.col("_cum_excl") <= hi) & (hi < F.col("_cum_incl"))
        picks += [F.when(hit_lo, F.col("value")).alias(f"_lo{i}"), F.when(hit_hi, F.col("value")).alias(f"_hi{i}"),
                  (h - lo).alias(f"_t{i}"), (hit_lo | hit_hi).alias(f"_any{i}")]
        outs.append(i)
    sel = ranked.select(*keys, *picks)
    anyhit = None
    for i in outs:
        anyhit = F.col(f"_any{i}") if anyhit is None else (anyhit | F.col(f"_any{i}"))
    agg = sel.where(anyhit).groupBy(*keys).agg(
        *[F.max(f"_lo{i}").alias(f"_lo{i}") for i in outs], *[F.max(f"_hi{i}").alias(f"_hi{i}") for i in outs],
        *[F.max(f"_t{i}").alias(f"_t{i}") for i in outs])
    rows = [F.struct(F.lit(float(q)).alias("prob"),
                     (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_t{i}")).alias("value"))
            for i, q in zip(outs, probs)]
    result = agg.select(*keys, F.inline(F.array(*rows)))
    spark = df.sparkSession
    result = result.checkpoint(eager=True)
    if result.count() <= MAX_LOCAL_ROWS:
        return spark.createDataFrame(result.collect(), result.schema)
    return result


def quantile_wide(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = (),
                  names: Sequence[str] | None = None) -> DataFrame:
    """``(group_cols..., column, <name per prob>)``: one row per column (and group)."""
    names = list(names or [f"q{int(round(q * 100))}" for q in probs])
    long = exact_quantiles(df, cols, probs, group_cols)
    return (long.groupBy(*group_cols, "column")
            .agg(*[F.max(F.when(F.col("prob") == F.lit(float(q)), F.col("value"))).alias(n)
                   for q, n in zip(probs, names)]))
