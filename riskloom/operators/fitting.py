"""The training table that all fits of all groups share, and sums over it.

A training table holds the rows of many groups (diseases) at once: ``grp``,
``rid`` (a row id, unique in its group), ``y`` (0 or 1), ``fold`` (null: a test
row) and ``x``, an array of the group's features before imputing and scaling,
NaN where missing. A ``Frame`` is one set of rows to fit on, a group's training
rows without one fold or with all of them, and the statistics of exactly those
rows: what replaces a missing value, means and scales. Frames are never
materialised: a row serves every frame of its group in the one pass.

``sums`` is that pass. Each task adds up a vector per fit over its rows, the
vectors of a fit meet in one small task each, and only what ``finish`` makes of
a sum (a fixed size) reaches the driver. A step over 80 fits is one job. Where a
group lies in one partition its task finishes alone, and a table of a few
partitions leaves their few vectors to the driver (``Layout``).

``by_group`` serves fits that need a group's rows again and again (trees): tasks
that each hold all rows of one group, of groups up to ``MAX_CELLS`` numbers, and
grow a share of its fits without further jobs. Larger groups go by ``sums``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code

ALL = -1  # the frame of all training rows
#: up to so many partitions the driver adds the tasks' vectors
DIRECT_PARTITIONS = 8
#: rows of a batch of a fit's step
BATCH_ROWS = 50_000
#: numbers of a group's training rows (rows x (features + 2)) that one task holds
MAX_CELLS = 8_000_000
#: tasks a core of fits that are grown in tasks of their own
TASKS_PER_CORE = 4


@dataclass
class Frame:
    group: str
    without: int           # the fold left out, or ALL
    fill: np.ndarray       # replaces missing values
    mean: np.ndarray
    scale: np.ndarray
    n_neg: int
    n_pos: int

    @property
    def key(self):
        return self.group, self.without

    def rows(self, fold: np.ndarray) -> np.ndarray:
        """Which rows the frame trains on; test rows have fold ``ALL``."""
        return (fold != ALL) & (fold != self.without)

    def held_out(self, fold: np.ndarray) -> np.ndarray:
        """Which rows its models are judged on: its fold, or the test rows."""
        return fold == self.without

    def filled(self, x: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(x), self.fill, x)

    def balanced(self, y: np.ndarray) -> np.ndarray:
        """X8 weights: both classes weigh the same, all rows together their number."""
        n = self.n_neg + self.n_pos
        return np.where(y == 1, n / (2.0 * max(1, self.n_pos)), n / (2.0 * max(1, self.n_neg)))

    def positive_weight(self) -> float:
        """How much more a positive row weighs."""
        return max(1.0, self.n_neg / max(1, self.n_pos))


def x_column(numeric, categories: dict):
    """The array column ``x``: numerics, then a column per category (of all training rows), all NaN where the value is missing."""
    nan = F.lit(float("nan"))
    parts = [F.coalesce(F.col(f"`{c}`").cast("double"), nan) for c in numeric]
    for c, names in categories.items():
        v = F.col(f"`{c}`").cast("string")
        parts += [F.when(v.isNull(), nan).otherwise((v == F.lit(k)).cast("double")) for k in names]
    return F.array(*parts) if parts else F.expr("cast(array() AS array<double>)")


def frame_of(group: str, without: int, pre, categories: dict, n_neg: int, n_pos: int) -> Frame:
    """The frame of a fitted preprocessor; a category that its rows lack keeps a column of zeros."""
    one_hot = [float(k == pre.modes[c]) for c, names in categories.items() for k in names]
    ones = [1.0] * len(one_hot)

    def numbers(values, absent):
        return [absent if values.get(c) is None else float(values[c]) for c in pre.numeric]
    return Frame(group, without, np.array(numbers(pre.medians, 0.0) + one_hot), np.array(numbers(pre.means, 0.0) + [0.0] * len(one_hot)),
                 np.array(numbers(pre.scales, 1.0) + ones), n_neg, n_pos)


def group_parts(batch: pa.RecordBatch, array: str = "x"):
    """(group, row numbers, y, rid, fold, matrix) of each group in a batch."""
    groups = batch.column("grp").dictionary_encode()
    codes = groups.indices.to_numpy()
    y, rid = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "rid"))
    fold = batch.column("fold").fill_null(ALL).to_numpy(zero_copy_only=False)
    column = batch.column(array)
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    for code, name in enumerate(groups.dictionary.to_pylist()):
        at = np.flatnonzero(codes == code)
        width = int(offsets[at[0] + 1] - offsets[at[0]])
        yield name, at, y[at], rid[at], fold[at], values[offsets[at][:, None] + np.arange(width)]


_SUMS = pa.schema([("fit", pa.int32()), ("vector", pa.binary())])


def quick_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for many small jobs of known shape: nothing to plan anew between their stages."""
    out = spark.newSession()
    out.conf.set("spark.sql.adaptive.enabled", "false")
    # a batch's sums are as large as its fits', however few its rows
    out.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        out.conf.set(k, spark.conf.get(k))
    return out


@dataclass(frozen=True)
class Layout:
    """What is known of a training table's partitions: how many, and whether each group lies in one of them."""
    partitions: int | None = None
    whole_groups: bool = False


def sums(rows: DataFrame, part: Callable, finish: Callable | None = None, layout: Layout = Layout()) -> dict:
    """{fit: finish(fit, sum of its vectors)}; ``part(batch)`` yields (fit, vector of floats) for the rows of a batch."""
    ship_code(rows.sparkSession)

    def partial(batches):
        totals: dict = {}
        for batch in batches:
            for fit, vector in part(batch):
                if fit in totals:
                    totals[fit] += vector
                else:
                    totals[fit] = vector.copy()
        if layout.whole_groups:  # nothing of these fits lies elsewhere
            totals = finished(totals)
        if totals:
            yield _packed(totals)

    def finished(totals: dict) -> dict:
        return totals if finish is None else {fit: finish(fit, v) for fit, v in totals.items()}

    def added(batches) -> dict:
        totals: dict = {}
        for batch in batches:
            for fit, vector in zip(batch.column("fit").to_pylist(), batch.column("vector")):
                got = np.frombuffer(vector.as_buffer(), float)
                totals[fit] = totals[fit] + got if fit in totals else got
        return totals if layout.whole_groups else finished(totals)

    def total(batches):
        totals = added(batches)
        if totals:
            yield _packed(totals)

    parts = rows.mapInArrow(partial, "fit int, vector binary")
    if layout.whole_groups or (layout.partitions is not None and layout.partitions <= DIRECT_PARTITIONS):
        return {fit: np.ravel(v) for fit, v in added(parts.toArrow().to_batches()).items()}
    got = parts.repartition("fit").mapInArrow(total, "fit int, vector binary").toArrow()
    return {fit: np.frombuffer(v, float) for fit, v in zip(got.column("fit").to_pylist(), got.column("vector").to_pylist())}


def _packed(vectors: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(vectors), pa.int32()), pa.array([np.ascontiguousarray(v, float).tobytes() for v in vectors.values()],
                                                                                   pa.binary())], schema=_SUMS)


# ---------------------------------------------------------------- whole groups in a task
def cells(frames: list) -> dict:
    """Numbers of the training rows of each group."""
    size: dict = {}
    for f in frames:
        size[f.group] = max(size.get(f.group, 0), (f.n_neg + f.n_pos) * (len(f.fill) + 2))
    return size


def by_group(rows: DataFrame, frames: list, units: dict, work: Callable, schema: str) -> pa.Table:
    """``work(units, y, rid, fold, x)`` for shares of each group's ``units`` ({group: list}), in tasks that hold all its training
    rows, ordered by ``rid``; it yields record batches of ``schema``. A group gets tasks by its size, the largest come first."""
    spark = rows.sparkSession
    ship_code(spark)
    size = cells(frames)
    order = sorted((g for g in units if units[g]), key=lambda g: (-size[g], g))
    wanted, every = TASKS_PER_CORE * spark.sparkContext.defaultParallelism, max(1, sum(size[g] for g in order))
    parts = {g: max(1, min(len(units[g]), round(wanted * size[g] / every))) for g in order}
    first = dict(zip(order, np.cumsum([0, *parts.values()]).tolist()))
    shares = [units[g][k::parts[g]] for g in order for k in range(parts[g])]

    def run(batches):
        place, held = None, []
        for batch in batches:
            for _, _, y, rid, fold, x in group_parts(batch):
                held.append((y, rid, fold, x))
            place = batch.column("place")[0].as_py() if batch.num_rows else place
        if held:
            held = [np.concatenate(c) for c in zip(*held)]
            yield from work(shares[place], *held)

    if not order:
        return pa.table([pa.array([])], names=["none"]).slice(0, 0)
    places = F.element_at(F.create_map(*[F.lit(v) for g in order for v in (g, F.sequence(F.lit(first[g]), F.lit(first[g] + parts[g] - 1)))]), F.col("grp"))
    dealt = rows.where(F.col("fold").isNotNull() & F.col("grp").isin(order)).select("grp", "rid", "y", "fold", "x", F.explode(places).alias("place"))
    # rows of one id follow the other columns, so that draws by place repeat
    return dealt.repartitionById(len(shares), F.col("place")).sortWithinPartitions("rid", "fold", "y", "x").mapInArrow(run, schema).toArrow()
