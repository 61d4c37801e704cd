"""Batches and events that come again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.streaming import intake

P = Params()


class Killed(Exception):
    pass


def _batch(spark, rows):
    raw = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, event_time string")
    return intake.to_fact_events(intake.normalise(raw))


def _ids(spark, sink):
    return sorted(r.event_id for r in intake.read_sink(spark, sink).collect() if not r.event_id.startswith("EVT_"))


def test_a_batch_run_twice_leaves_the_same_rows(spark, tmp_path):
    sink = str(tmp_path / "sink")
    rows = [("a", "1", "search", "2001-01-01 10:00:00"), ("a", "1", "search", "2001-01-01 10:00:00"), ("b", "2", "page_view", None), (None, "2", "page_view", None)]
    for _ in range(2):
        intake.write_batch(_batch(spark, rows), 0, sink)
        assert _ids(spark, sink) == ["a", "b"] and intake.read_sink(spark, sink).count() == 3
    days = {(r.user_id, str(r.day)): r for r in intake.live_user_days(spark, sink).collect()}
    assert days["1", "2001-01-01"].searches == 1 and sum(r.page_views for r in days.values()) == 2


@pytest.mark.parametrize("step", ["rows", "states", "ledger"])
def test_a_batch_killed_anywhere_is_made_good(spark, tmp_path, step):
    sink = str(tmp_path / "sink")
    intake.write_batch(_batch(spark, [("a", "1", "search", None)]), 0, sink)
    rows = [("b", "1", "search", None), ("a", "1", "search", None), (None, "1", "login", None)]

    def die(name):
        if name == step:
            raise Killed

    with pytest.raises(Killed):
        intake.write_batch(_batch(spark, rows), 1, sink, then=die)
    if step != "ledger":  # not seen before it is whole
        assert _ids(spark, sink) == ["a"] and intake.ledger(spark, sink) == [0]
    intake.write_batch(_batch(spark, rows), 1, sink)
    assert _ids(spark, sink) == ["a", "b"] and intake.read_sink(spark, sink).count() == 3 and intake.ledger(spark, sink) == [0, 1]


def test_a_late_replay_is_dropped_however_late(spark, tmp_path):
    sink = str(tmp_path / "sink")
    intake.write_batch(_batch(spark, [("old", "1", "search", "2001-01-01 00:00:00")]), 0, sink)
    # the batch of three days ago
    ids = f"{sink}/_ids/batch_id=0"
    aged = spark.createDataFrame(spark.read.parquet(ids).collect(), "event_id string, day date").withColumn("day", F.date_sub("day", 3))
    aged.write.mode("overwrite").parquet(ids)
    again = [("old", "1", "search", "2001-01-01 00:00:00"), ("new", "1", "search", None)]
    intake.write_batch(_batch(spark, again), 1, sink)
    assert _ids(spark, sink) == ["new", "old"]
    intake.write_batch(_batch(spark, again), 2, sink, replay_days=1)  # a bound that is too near lets it in, by choice
    assert _ids(spark, sink) == ["new", "old", "old"]


def test_stream_restart_after_a_crash_before_commit(spark, tmp_path):
    landing, sink, ckpt = (str(tmp_path / x) for x in ("landing", "sink", "ckpt"))
    os.makedirs(landing)

    def put(name, *events):
        with open(f"{landing}/{name}.json", "w") as fh:
            fh.writelines(json.dumps(e) + "\n" for e in events)

    put("a", {"event_id": "x", "user_id": "1", "event_type": "search"}, {"user_id": "1", "event_type": "login"})
    crash = {"now": True}

    def write(df, i):
        intake.write_batch(df, i, sink, then=lambda s: (_ for _ in ()).throw(Killed()) if crash["now"] and s == "ledger" else None)

    def drain():
        q = intake.intake(spark, landing).writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception):
        drain()
    crash["now"] = False
    drain()
    assert intake.read_sink(spark, sink).count() == 2
    put("b", {"event_id": "x", "user_id": "1", "event_type": "search"}, {"event_id": "y", "user_id": "1", "event_type": "search"})
    drain()
    assert _ids(spark, sink) == ["x", "y"] and intake.read_sink(spark, sink).count() == 3
    assert intake.live_user_days(spark, sink).agg(F.sum("searches")).first()[0] == 2
