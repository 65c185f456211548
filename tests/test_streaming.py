"""Streaming incremental load: files arriving in slices are upserted once;
rerunning with the same checkpoint changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from strata.sources.store import TableStore
from strata.sources.tables import Tables
from strata.streaming.incremental import read_source_stream, stream_upsert

from .conftest import SF_SMALL


@pytest.mark.parametrize("buckets", [None, 4])
def test_stream_upsert_slices(spark, scratch, buckets):
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "user_id", "value")
    src = os.path.join(scratch, "incoming")
    ckpt = os.path.join(scratch, "ckpt")
    store = TableStore(spark, os.path.join(scratch, "lake"))
    ev.filter(F.col("ts") < "2024-01-15").write.parquet(src, mode="append")

    def run():
        stream = read_source_stream(spark, src, ev.schema)
        q = stream_upsert(store, stream, "latest_by_user", keys=["user_id"], order_by=["ts", "event_id"],
                          checkpoint=ckpt, query_name="users", event_time="ts",
                          row_keys=["event_id"], buckets=buckets)
        q.awaitTermination(120)

    run()
    first = store.read("latest_by_user").count()
    assert first == ev.filter(F.col("ts") < "2024-01-15").select("user_id").distinct().count()

    # the next slice re-delivers the last hour of the first one (the overlap)
    ev.filter(F.col("ts") >= "2024-01-14 23:00:00").write.parquet(src, mode="append")
    run()
    out = store.read("latest_by_user")
    expected = ev.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")) \
        .select("user_id", F.col("m.event_id").alias("event_id"))
    assert out.count() == expected.count()
    assert out.join(expected, ["user_id", "event_id"], "left_anti").count() == 0

    version = store.version("latest_by_user")
    run()   # nothing new: no new version
    assert store.version("latest_by_user") == version
