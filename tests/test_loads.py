"""Properties of the load semantics and the hand-written rewrites."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import clean, loads, windows
from strata.operators.joins import left_join_any_key
from strata.operators.rowindex import row_index
from strata.sources.tables import Tables

from .conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def test_window_bounds_are_strict_and_null_keys_never_match(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)],
                               "id int, k timestamp_ntz")
    w = windows.incremental_window("k", "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert df.filter(w).count() == 0
    w = windows.incremental_window("k", "2023-12-31 00:00:00", "2024-01-03 00:00:00")
    assert rows(df.filter(w).select("id")) == [(1,), (2,)]


def test_window_append_is_idempotent_and_keeps_null_keys(spark):
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "value")
    nulls = spark.createDataFrame([(-1, None, 1.0)], "event_id long, ts timestamp_ntz, value double")
    target = loads.full_replace(None, ev.filter(windows.upper_bound_window("ts", "2024-01-20")).unionByName(nulls))
    w = windows.incremental_window("ts", "2024-01-15 00:00:00", "2024-01-25 00:00:00")
    once = loads.window_append(target, ev.filter(w), w)
    twice = loads.window_append(once, ev.filter(w), w)
    assert rows(once) == rows(twice)
    assert once.filter(F.col("event_id") == -1).count() == 1


def test_full_equals_first_delta(spark):
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "value")
    full_w = windows.choose_window("bronze", "FULL", "append", "ts", None, "2024-01-20 00:00:00")
    first_delta_w = windows.choose_window("bronze", "DELTA", "append", "ts", None, "2024-01-20 00:00:00")
    assert rows(ev.filter(full_w)) == rows(ev.filter(first_delta_w))


def test_upsert_unique_keys_last_wins_with_hot_key(spark):
    # one key holds a third of the delivery
    data = [(0, i, float(i)) for i in range(300)] + [(k, 1, float(k)) for k in range(1, 601)]
    inc = spark.createDataFrame(data, "k int, seq int, v double")
    old = spark.createDataFrame([(0, -1, -1.0), (9999, 0, 0.0)], "k int, seq int, v double")
    out = loads.upsert(old, inc, ["k"], order_by=["seq"])
    assert out.count() == out.select("k").distinct().count() == 602
    assert out.filter(F.col("k") == 0).first()["seq"] == 299
    assert out.filter(F.col("k") == 9999).count() == 1


def test_or_join_rewrite_equals_naive(spark):
    base = spark.createDataFrame([(1, 10, 20), (2, 10, 10), (3, None, 30), (4, None, None), (5, 99, 98), (6, 20, 99)],
                                 "id int, a int, b int")
    dim = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "tid int, name string")
    naive = base.join(dim, (base.a == dim.tid) | (base.b == dim.tid), "left").select("id", "tid", "name")
    rewritten = left_join_any_key(base, dim, "tid", ["a", "b"], "T_").select("id", "T_tid", "T_name")
    assert rows(naive) == rows(rewritten)
    plan = rewritten._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_row_index_equals_global_row_number(spark):
    o = Tables(spark, SF_SMALL).orders.select("o_orderkey")
    ours = row_index(o, ["o_orderkey"], num_partitions=4)
    ref = o.withColumn("partition_index", F.row_number().over(Window.orderBy("o_orderkey")))
    assert rows(ours) == rows(ref)


def test_clamp_sentinel_moves_column_last(spark):
    df = spark.createDataFrame([(dt.datetime(9999, 12, 31, 23, 59, 59), 1), (dt.datetime(2024, 1, 1), 2)],
                               "EndDate timestamp_ntz, id int")
    out = loads.clamp_sentinel(df, "EndDate")
    assert out.columns == ["id", "EndDate"]
    assert [r["EndDate"] for r in out.orderBy("id").collect()] == [dt.datetime(9999, 12, 31, 22, 59, 59),
                                                                    dt.datetime(2024, 1, 1)]


def test_business_cutoff(spark):
    df = spark.createDataFrame([("2016-05-01", None), ("2010-01-01", "junk"), (None, "2015-01-01")],
                               "a string, b string")
    assert df.transform(lambda d: windows.business_cutoff_filter(d, ["a", "b"])).count() == 2
    assert df.transform(lambda d: windows.business_cutoff_filter(d, ["zzz"])).count() == 0


def test_join_enrichment_fills_placeholders(spark):
    from strata.operators.clean import add_placeholders, join_enrichment
    base = spark.createDataFrame([(1, 10), (2, 99)], "id int, nk int")
    cfg = {"joins": [{"table": "nation", "on": [["nk", "n_nationkey"]],
                      "selected_columns": [{"column": "n_name", "alias": "nation_name"}]}]}
    placeholders = add_placeholders(base, cfg)
    assert placeholders.filter("nation_name IS NOT NULL").count() == 0
    nation = spark.createDataFrame([(10, "TEN")], "n_nationkey int, n_name string")
    out = join_enrichment(placeholders, cfg, {"nation": nation})
    assert sorted(tuple(r) for r in out.select("id", "nation_name").collect()) == [(1, "TEN"), (2, None)]


def test_store_versions_and_tags(spark, scratch):
    from strata.sources.store import TableStore
    store = TableStore(spark, scratch)
    assert store.read("t") is None
    df = spark.range(10).withColumnRenamed("id", "k")
    assert store.write("t", df, sort_within=["k"]) == 0
    assert store.write("t", df.filter("k < 5"), tag="run:1") == 1
    assert store.read("t").count() == 5 and store.has_tag("t", "run:1") and not store.has_tag("t", "run:2")


def test_row_index_splits_a_hot_key(spark):
    # a third of the rows share one order key
    data = [(0, i) for i in range(300)] + [(k, k) for k in range(1, 601)]
    df = spark.createDataFrame(data, "k int, v int")
    out = row_index(df, ["k"], num_partitions=6)
    idx = sorted(r["partition_index"] for r in out.collect())
    assert idx == list(range(1, 901))
    first = out.filter("k = 0").agg(F.max("partition_index")).first()[0]
    assert first == 300   # the hot key's rows come first, numbered 1..300


def parts_of_last_version(table):
    log = table.store.commits(table.name)
    last = log.agg(F.max("version")).first()[0]
    return sorted(r["part"] for r in log.filter(F.col("version") == last).select("part").collect())


def test_partitioned_window_append_rewrites_only_touched_days(spark, scratch):
    import os

    from strata.sources.store import PartitionedTable
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "value").withColumn("day", F.to_date("ts"))
    table = PartitionedTable(spark, os.path.join(scratch, "events_by_day"), "day")
    first = ev.filter(windows.upper_bound_window("ts", "2024-01-20"))
    table.replace_window(first, None)

    w = windows.incremental_window("ts", "2024-01-15 12:00:00", "2024-01-22 00:00:00")
    incoming = ev.filter(w).withColumn("value", F.col("value") + 1)
    table.replace_window(incoming, w)
    assert parts_of_last_version(table) == [f"p2024-01-{d:02d}" for d in range(15, 22)]

    expected = loads.window_append(first, incoming, w)
    assert rows(table.read().select(*expected.columns)) == rows(expected)
    # rerunning the same window changes nothing
    table.replace_window(incoming, w)
    assert rows(table.read().select(*expected.columns)) == rows(expected)


def test_partitioned_and_plain_sinks_agree(spark, scratch):
    import os
    import random

    from strata.sources.store import BUCKET_COLUMN, PartitionedTable, bucketed
    rng = random.Random(6)
    schema = "id int, updated int, day string"

    def delivery(n, low, high):  # hot day d0, NULL days, moved days, NULL window keys
        return [(rng.randrange(60), rng.choice([None, *range(low, high)]),
                 rng.choice(["d0"] * 6 + [f"d{k}" for k in range(9)] + [None])) for _ in range(n)]

    days = PartitionedTable(spark, os.path.join(scratch, "days"), "day")
    buckets = PartitionedTable(spark, os.path.join(scratch, "buckets"), BUCKET_COLUMN)
    plain = spark.createDataFrame(delivery(80, 0, 30), schema)
    keyed = loads.upsert(None, plain, ["id"], ["updated"])
    days.replace_all(plain)
    buckets.upsert(bucketed(plain, ["id"], 7), ["id"], ["updated"])
    assert rows(days.read().select("id", "updated", "day")) == rows(plain)
    for low, high in ((20, 40), (0, 50), (10, 12)):
        w = windows.incremental_window("updated", str(low), str(high))
        # the second delivery is empty: everything in its window vanishes
        incoming = spark.createDataFrame(delivery(0 if low == 0 else 12, low + 1, high), schema)
        plain = spark.createDataFrame(loads.window_append(plain, incoming, w).collect(), schema)
        days.replace_window(incoming, w)
        assert rows(days.read().select("id", "updated", "day")) == rows(plain)
        keyed = spark.createDataFrame(loads.upsert(keyed, incoming, ["id"], ["updated"]).collect(), schema)
        buckets.upsert(bucketed(incoming, ["id"], 7), ["id"], ["updated"])
        assert rows(buckets.read().select("id", "updated", "day")) == rows(keyed)
    assert len(parts_of_last_version(buckets)) <= 7


def test_upsert_without_a_key_is_an_error(spark):
    import pytest
    df = spark.range(3)
    with pytest.raises(ValueError):
        loads.upsert(None, df, [])


def test_uncommitted_files_are_not_read(spark, scratch):
    import os

    from strata.sources.store import TableStore
    spark.range(10).write.parquet(os.path.join(scratch, "t", "v=000000-x"))
    assert TableStore(spark, scratch).read("t") is None
    spark.range(10).withColumn("_part", F.lit("p")).write.parquet(os.path.join(scratch, "u", "data", "_folder=v"))
    assert TableStore(spark, scratch).read("u") is None


def test_checkpoint_folder_is_required_off_local_masters():
    import pytest

    from strata.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_compact_append_only_rows(spark, scratch):
    import glob
    import os

    from strata.sources.store import TableStore
    store = TableStore(spark, scratch)
    for i in range(5):
        store.append_rows("audit", spark.range(i * 10, i * 10 + 10).coalesce(1))
    assert len(glob.glob(os.path.join(scratch, "audit", "g=000000", "*.parquet"))) == 5
    store.compact_rows("audit", files=2)
    assert len(glob.glob(os.path.join(scratch, "audit", "g=000001", "*.parquet"))) == 2
    store.append_rows("audit", spark.range(50, 60))
    assert sorted(r[0] for r in store.read_rows("audit").collect()) == list(range(60))


def test_silver_transform_fills_enrichment_only_with_lookups(spark):
    from strata.operators.clean import SilverSteps, silver_transform
    base = spark.createDataFrame([(1, 10)], "id int, nk int")
    cfg = {"joins": [{"table": "nation", "on": [["nk", "n_nationkey"]],
                      "selected_columns": [{"column": "n_name", "alias": "nation_name"}]}]}
    steps = SilverSteps(is_join_enrichment=cfg)
    assert silver_transform(base, steps).first()["nation_name"] is None
    nation = spark.createDataFrame([(10, "TEN")], "n_nationkey int, n_name string")
    assert silver_transform(base, steps, lookups={"nation": nation}).first()["nation_name"] == "TEN"


def test_composite_fare_service_join(spark):
    from strata.plans.pnl import join_fare_service
    fare = spark.createDataFrame([(1, 13, 100.0), (1, 14, 50.0), (2, 13, 70.0)],
                                 "fare_id long, service_type_id int, customer_price double")
    service = spark.createDataFrame([(1, 13, 1), (1, 15, 2), (2, 13, 2)],
                                    "cus_base_fare_id long, service_type_id int, record_type int")
    out = join_fare_service(fare, service).select("fare_id", "service_type_id", "record_type")
    assert rows(out) == [(1, 13, 1), (2, 13, 2)]       # both key parts must match


def test_an_update_in_another_layout_is_refused(spark, scratch):
    import os

    import pytest

    from strata.sources.store import BUCKET_COLUMN, PartitionedTable, TableStore, bucketed
    df = spark.range(20).withColumnRenamed("id", "k")
    TableStore(spark, scratch).write("t", df)
    four, seven = (PartitionedTable(spark, os.path.join(scratch, "t"), BUCKET_COLUMN, n) for n in (4, 7))
    with pytest.raises(ValueError, match="laid out by whole"):
        four.upsert(bucketed(df, ["k"], 4), ["k"])
    four.replace_all(bucketed(df, ["k"], 4))
    with pytest.raises(ValueError, match="load_bucket/4"):
        seven.upsert(bucketed(df, ["k"], 7), ["k"])
    four.upsert(bucketed(df.filter("k < 3"), ["k"], 4), ["k"])
    assert sorted(r["k"] for r in four.read().collect()) == list(range(20))


def test_a_read_opens_the_folders_in_force_only(spark, scratch):
    import os

    from strata.sources.store import BUCKET_COLUMN, PartitionedTable, bucketed
    table = PartitionedTable(spark, os.path.join(scratch, "t"), BUCKET_COLUMN, 4)
    df = spark.range(40).withColumnRenamed("id", "k")
    for i in range(6):
        table.upsert(bucketed(df.withColumn("v", F.lit(i)), ["k"], 4), ["k"])
    files = table.read().inputFiles()
    assert {f.split("/v=")[1][:6] for f in files} == {"000005"} and table.read().count() == 40
    # a column that only later rows have, and one that they lack
    table.upsert(bucketed(df.filter("k = 1").withColumn("w", F.lit("new")), ["k"], 4), ["k"])
    got = {r["k"]: (r["v"], r["w"]) for r in table.read().collect()}
    assert got[1] == (None, "new") and got[2] == (5, None) and len(got) == 40


def test_rows_appended_while_compacting_stay(spark, scratch):
    from strata.sources.store import TableStore
    store = TableStore(spark, scratch)
    store.append_rows("audit", spark.range(0, 10).coalesce(1))
    late = f"{scratch}/audit/g=000000"
    store.compact_rows("audit", files=1)
    spark.range(10, 15).write.mode("append").parquet(late)   # a writer that had looked up the old generation
    store.append_rows("audit", spark.range(15, 20))
    assert sorted(r[0] for r in store.read_rows("audit").collect()) == list(range(20))


def test_place_of_rows_survives_the_sink(spark, scratch):
    from strata.sources.store import TableStore
    store = TableStore(spark, scratch)
    store.write("t", spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(6).orderBy(F.desc("k")))
    placed = store.read_placed("t").collect()
    assert sorted((r["place"], r["k"]) for r in placed) == [(i + 1, 999 - i) for i in range(1000)]


def test_only_repeated_rows_are_compared(spark):
    data = [(i, None if i % 3 else "a", float(i % 5)) for i in range(50)]
    df = spark.createDataFrame(data, "k int, s string, v double")
    out = clean.remove_duplicates(df)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString() and rows(out) == rows(df)
    # a hot row, rows that differ in which column is NULL, signed zeros and NaN
    odd = [(None, "x", 0.0), (None, "x", -0.0), (1, None, float("nan")), (1, None, float("nan")), (None, None, None)]
    twice = spark.createDataFrame(data + data[:7] * 30 + odd + [(1, "x", None), (None, "x", 1.0)], df.schema)
    got, expected = (sorted(f"{r['k']} {r['s']} {None if r['v'] is None else r['v'] + 0.0}" for r in d.collect())
                     for d in (clean.remove_duplicates(twice), twice.dropDuplicates()))
    assert got == expected
