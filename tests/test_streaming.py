import os
import tempfile

from cabmeter.operators import features as FT
from cabmeter.operators import rules as R
from cabmeter.sources.trips import fixture_trips
from cabmeter.streaming import trips_stream as ST
from conftest import SF001


def test_stream_clean_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="cabmeter-stream-")
    stream = ST.clean_stream(ST.trips_stream(spark, SF001))
    assert stream.isStreaming
    out = ST.run_available(stream, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    batch = FT.model_frame(R.clean_trips(fixture_trips(spark, SF001)))
    assert out.count() == batch.count()
    assert out.select(*batch.columns).exceptAll(batch).count() == 0
    # Restart from the checkpoint: nothing new arrives, nothing is written twice.
    again = ST.run_available(ST.clean_stream(ST.trips_stream(spark, SF001)),
                             os.path.join(base, "out"), os.path.join(base, "ckpt"))
    assert again.count() == batch.count()


def test_score_stream(spark):
    from pyspark.sql import functions as F

    from cabmeter.operators import model as M
    from cabmeter.operators import rules as R2
    from cabmeter.sources.trips import requests_from_trips

    base = tempfile.mkdtemp(prefix="cabmeter-score-")
    train = FT.model_frame(R.clean_trips(fixture_trips(spark, SF001)))
    model = M.fit_ols(train)
    scored = ST.run_available(ST.score_stream(model, ST.validate_stream(ST.trips_stream(spark, SF001))),
                              os.path.join(base, "out"), os.path.join(base, "ckpt"))
    batch = R2.validate_requests(requests_from_trips(fixture_trips(spark, SF001)))
    assert scored.count() == batch.where("is_valid").count()
    assert scored.where(F.col("prediction") < 0).count() == 0
