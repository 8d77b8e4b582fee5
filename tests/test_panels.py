"""Panels projected from orders: deterministic, nulls only in the first two columns, value ranges kept."""

from pyspark.sql import functions as F

from riskloom.sources.panels import PANELS, load_intake, load_panel, panel_columns


def test_panel_nulls_and_ranges(spark, sf):
    for d in ["fever", "liver", "thyroid"]:
        p = load_panel(spark, sf, d)
        cols = panel_columns(d)
        nulls = p.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols]).first().asDict()
        assert nulls[cols[0]] > 0 and nulls[cols[1]] > 0
        assert all(v == 0 for c, v in nulls.items() if c not in cols[:2])
        for c, spec in PANELS[d]:
            if spec[0] in ("num", "int"):
                lo, hi = spec[1], spec[2]
                r = p.agg(F.min(f"`{c}`").alias("a"), F.max(f"`{c}`").alias("b")).first()
                assert lo - 1e-9 <= r.a and r.b <= hi + 1e-9, (d, c)
        assert p.where(F.col("Outcome").isNull()).count() == 0


def test_panel_is_deterministic(spark, sf):
    a = load_panel(spark, sf, "gastro").orderBy("patient_id").collect()
    b = load_panel(spark, sf, "gastro").orderBy("patient_id").collect()
    assert a == b


def test_intake_tables_have_one_row_per_order(spark, sf):
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    for kind in ("a", "b"):
        t = load_intake(spark, sf, kind)
        assert t.count() == n and t.select("patient_id").distinct().count() == n
