"""The stateless triage path on a stream gives the batch result."""

import os
import tempfile

from riskloom.operators import triage
from riskloom.sources.panels import load_intake
from riskloom.streaming import triage_stream as ts
from riskloom import config


def test_stream_matches_batch(spark, sf):
    d = tempfile.mkdtemp(prefix="riskloom-stream-")
    q = ts.start(spark, sf, os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(d, "out"))
    batch = triage.triage_report(triage.score_rules_wide(load_intake(spark, sf, "a"), "a"), config.RULE_DISEASES)
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
