import datetime
import random

from pyspark.sql import functions as F

from meterlake.operators import readmodels

INFO = [("20240104_000000", 1.25, "2024-01-04 00:10:00"), ("20240102_000000", 2.5, "2024-01-05 09:00:00"),
        ("20240104_000000", 1.0, "2024-01-04 00:20:00"), ("20240102_000000", 2.75, "2024-01-02 00:05:00")]
ARTIFACTS = [("pipeline", "20240102_000000", "a/2"), ("pipeline", "20240104_000000", "a/4"),
             ("pipeline", "20240104_000000", "b/4"), ("regressor", "20240102_000000", "r/2"),
             ("regressor", "20240103_000000", "r/3")]


def test_artifacts_with_repeated_info_rows(spark):
    info = spark.createDataFrame(INFO, "model_timestamp string, rmse double, created_at string")
    artifacts = spark.createDataFrame(ARTIFACTS, "kind string, model_timestamp string, path string")
    assert readmodels.latest(info, "created_at").first().created_at == "2024-01-05 09:00:00"
    got = {r.kind: (r.path, r.rmse) for r in readmodels.artifact_info(artifacts, info).collect()}
    assert got == {"pipeline": ("b/4", 1.0), "regressor": ("r/3", None)}


def test_as_of_equals_brute_force(spark):
    rng = random.Random(4)
    start = datetime.datetime(2024, 1, 1)
    when = lambda: None if rng.random() < 0.05 else start + datetime.timedelta(hours=rng.randint(0, 60))
    events = [(i, rng.choice(("hot", "hot", "a", "b", None)), when()) for i in range(300)]
    states = [(rng.choice(("hot", "a", "c", None)), when(), rng.randint(0, 9)) for _ in range(60)]
    e = spark.createDataFrame(events, "id int, k string, at timestamp_ntz")
    s = spark.createDataFrame(states, "k string, since timestamp_ntz, v int")
    got = {r["id"]: r["known"] and (r["known"]["since"], r["known"]["v"])
           for r in readmodels.as_of(e, s, ("k",), "at", "since").collect()}
    want = {}
    for i, k, at in events:
        known = [(t, v) for kk, t, v in states if kk == k and t is not None and at is not None and t <= at]
        want[i] = max(known) if known else None
    assert got == want
    assert readmodels.as_of(e, s.limit(0), ("k",), "at", "since").filter(F.col("known").isNotNull()).isEmpty()
