"""Exact stratified splits, folds, caps and fixed-size samples.

Rows are ordered inside each class by ``md5("<key>:<seed>")`` then the key:
the same text gives the same order in any engine and on every re-run, so a
split survives executor loss and re-execution unchanged. Ranks come from
``global_row_number`` (range partitioned), never from a window that holds a
whole class in one task. Class shares are exact: class ``c`` gets
``round(frac · n_c)`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .ranking import global_row_number


def hash_order(keys: Sequence[str], seed: int = 42) -> Column:
    """``md5("<k1>:<k2>:...:<seed>")`` (keys cast to text)."""
    parts = []
    for k in keys:
        parts += [F.col(k).cast("string"), F.lit(":")]
    return F.md5(F.concat(*parts, F.lit(str(seed))))


def _bucket_digits(df: DataFrame) -> int:
    """Leading hex digits of the order key that make a bucket: 16 buckets per shuffle partition at least.

    The prefix is a monotone bucket of the md5 order (fixed width, and '0'-'9' < 'a'-'f'), so ranks need no
    sampled range partitioning; its width follows the partition count, which is sized to the data."""
    digits = 3
    while 16 ** digits < 16 * shuffle_partitions(df.sparkSession):
        digits += 1
    return digits


def _ranked(df: DataFrame, label: str, keys: Sequence[str], seed: int) -> DataFrame:
    h = df.withColumn("_h", hash_order(keys, seed))
    bucket = F.conv(F.substring("_h", 1, _bucket_digits(df)), 16, 10).cast("long")
    return global_row_number(h, [label], ["_h", *keys], out="_rn", bucket=bucket)


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], test_frac: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` = 'test' for the first ``round(test_frac · n_c)`` rows of each class, else 'train'."""
    r = _ranked(df, label, keys, seed)
    n_test = F.round(F.col("_key_total") * F.lit(float(test_frac)))
    return r.withColumn("split", F.when(F.col("_rn") <= n_test, F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_h", "_rn", "_key_total")


def stratified_folds(df: DataFrame, label: str, keys: Sequence[str], k: int = 3, seed: int = 42) -> DataFrame:
    """Adds ``fold`` = (rank within class − 1) mod k: every fold keeps the class shares."""
    r = _ranked(df, label, keys, seed)
    return r.withColumn("fold", ((F.col("_rn") - F.lit(1)) % F.lit(k)).cast("int")).drop("_h", "_rn", "_key_total")


def stratified_cap(df: DataFrame, label: str, keys: Sequence[str], max_rows: int | None = None,
                   seed: int = 42) -> DataFrame:
    """About ``max_rows`` rows, each class keeping its share (``round(max_rows · n_c / n)`` rows, so the sum may
    differ from ``max_rows`` by the rounding of each class).

    ``max_rows=None``, the default, keeps everything; a bound is a documented choice of the caller."""
    if max_rows is None:
        return df
    r = _ranked(df, label, keys, seed)
    n = df.agg(F.count(F.lit(1))).scalar()  # table size as a scalar subquery
    cap = F.when(n <= F.lit(max_rows), F.col("_key_total")).otherwise(
        F.round(F.col("_key_total") * F.lit(float(max_rows)) / n))
    return r.where(F.col("_rn") <= cap).drop("_h", "_rn", "_key_total")


def train_test_folds(df: DataFrame, label: str, keys: Sequence[str], test_frac: float = 0.2, k: int = 3,
                     max_train_rows: int | None = None, seed: int = 42) -> DataFrame:
    """W4 + T6 + W5 from one ranking per class: ``fold`` is null for test rows and 0..k−1 for training rows; training
    rows above the class's cap are left out. The same rows as split, cap and folds applied one after another, since
    all three follow the same order."""
    part, rest = train_test_parts(df, label, keys, test_frac, k, max_train_rows, seed)
    return part if rest is None else part.unionByName(rest)


#: classes x buckets of the order whose counts the driver holds
MAX_COUNTS = 200_000
#: classes that are told apart by an expression
MAX_CLASSES = 100


def train_test_parts(df: DataFrame, label: str, keys: Sequence[str], test_frac: float = 0.2, k: int = 3,
                     max_train_rows: int | None = None, seed: int = 42) -> tuple:
    """``train_test_folds`` as two frames: one with all its training rows, one with test rows only, or ``None``.

    Under a cap that leaves rows out only the rows of few buckets of the order need ranks, those around the end of the
    test rows and up to the cap: the counts per class and bucket tell which. The test rows before them are a filter over
    ``df``: not ranked, not shuffled."""
    def ranked(rows, before=None, n=None):
        """Folds of rows; ``before`` {class: (rows that precede, rows of the class)}, ``n``: training rows, if they are capped."""
        r = _ranked(rows, label, keys, seed)
        if before is not None:
            first, total = (_by_class(label, {c: v[i] for c, v in before.items()}) for i in (0, 1))
            r = r.withColumns({"_rn": F.col("_rn") + first, "_key_total": total})
        n_test = F.round(F.col("_key_total") * F.lit(float(test_frac)))
        r = r.withColumn("_train_rn", F.col("_rn") - n_test.cast("long"))
        if n is not None:
            n_train = F.col("_key_total") - n_test.cast("long")
            r = r.where(F.col("_train_rn") <= F.round(n_train * F.lit(float(max_train_rows)) / F.lit(n)))
        fold = F.when(F.col("_train_rn") > 0, ((F.col("_train_rn") - F.lit(1)) % F.lit(k)).cast("int"))
        return r.withColumn("fold", fold).drop("_h", "_rn", "_key_total", "_train_rn")

    if max_train_rows is None:
        return ranked(df), None
    bucket = F.conv(F.substring(hash_order(keys, seed), 1, _bucket_digits(df)), 16, 10).cast("long")
    counts = df.groupBy(F.col(label).alias("c"), F.coalesce(bucket, F.lit(-1)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    found, size = counts.limit(MAX_COUNTS + 1).collect(), {}
    if len(found) > MAX_COUNTS or len({r["c"] for r in found}) > MAX_CLASSES or any(r["c"] != r["c"] for r in found):
        per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        n = per_class.agg(F.sum(F.col("n") - F.round(F.col("n") * F.lit(float(test_frac))).cast("long"))).first()[0] or 0
        return ranked(df, None, n if n > max_train_rows else None), None
    for r in found:
        size[r["c"]] = size.get(r["c"], 0) + r["n"]
    n_test = {c: _rounded(v * float(test_frac)) for c, v in size.items()}
    n = sum(v - n_test[c] for c, v in size.items())
    if n <= max_train_rows:
        return ranked(df), None
    before, first, last = {}, {}, {}
    for c, total in size.items():
        end = n_test[c] + _rounded((total - n_test[c]) * float(max_train_rows) / n)
        seen, before[c] = 0, (total, total)
        for b, rows in sorted((r["b"], r["n"]) for r in found if r["c"] == c):
            if seen < end and seen + rows > n_test[c]:
                if c not in first:
                    first[c], before[c] = b, (seen, total)
                last[c] = b
            elif c not in first and seen + rows > n_test[c]:  # nothing to rank: the test rows end with the bucket before
                first[c], last[c] = b, b - 1
            seen += rows
        first.setdefault(c, 1 << 62)
        last.setdefault(c, -2)
    place = F.coalesce(bucket, F.lit(-1))
    tested = df.where(place < _by_class(label, first)).withColumn("fold", F.lit(None).cast("int"))
    return ranked(df.where((place >= _by_class(label, first)) & (place <= _by_class(label, last))), before, n), tested


def _by_class(label: str, values: dict) -> Column:
    """The value of the row's class (null: a class of its own)."""
    out = F.lit(None).cast("long")
    for c, v in values.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(c)), F.lit(v).cast("long")).otherwise(out)
    return out


def _rounded(x: float) -> int:
    """As Spark's ``round``: half up, by the decimal digits."""
    return int(Decimal(repr(x)).quantize(Decimal(1), ROUND_HALF_UP))


def fixed_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """T4: ``n`` rows in hash order (a sort-limit: each task keeps its own best ``n``)."""
    return df.withColumn("_h", hash_order(keys, seed)).orderBy("_h", *keys).limit(n).drop("_h")


def full_shuffle(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """T5: adds ``position``, each row's place (from 1) in a random order of all rows.

    The order is that of ``md5("<keys>:<seed>")``, a function of the row: the same for any number of partitions and after
    a lost executor. ``keys`` name a row; rows that share them are placed in any order among themselves."""
    h = df.withColumn("_h", hash_order(keys, seed))
    bucket = F.conv(F.substring("_h", 1, _bucket_digits(df)), 16, 10).cast("long")
    return global_row_number(h, [], ["_h", *keys], out="position", bucket=bucket).drop("_h", "_key_total")
