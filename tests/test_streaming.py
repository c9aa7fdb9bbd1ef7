"""The streaming processing stage equals the batch processed fact."""

import os
import tempfile

from conftest import SF001
from riskweave.operators import clean, features
from riskweave.sources.fact import load_fact
from riskweave.sources.tables import write_csv
from riskweave.streaming.features import start_feature_stream


def test_feature_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="riskweave-stream-", dir="/tmp")
    raw = load_fact(spark, SF001)
    write_csv(raw, os.path.join(base, "source"))
    q = start_feature_stream(spark, os.path.join(base, "source"), os.path.join(base, "sink"),
                             checkpoint_location=os.path.join(base, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(base, "sink"))
    batch = features.add_risk_features(clean.clean_fact(raw))
    assert streamed.columns == batch.columns
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
