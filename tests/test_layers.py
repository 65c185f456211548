"""Bronze -> silver -> gold runs on a table store: idempotent DELTA reruns,
audit trail, watermark, run summary."""

from pyspark.sql import functions as F

from strata.layers.bronze import BronzeTable, load_bronze_table
from strata.layers.common import RunContext
from strata.layers.gold import GoldTable, load_gold_table
from strata.layers.runner import open_batch, run_tables, watermarks
from strata.layers.silver import SilverTable, load_silver_table
from strata.operators.clean import SilverSteps
from strata.sources.store import TableStore
from strata.sources.tables import Tables

from .conftest import SF_SMALL

GOLD_SQL = """SELECT event_type, CAST(COUNT(*) AS DOUBLE) AS n FROM clean_events
WHERE ts > {lower_bound_time} AND ts < {upper_bound_time} GROUP BY event_type"""


def _run(store, source, batch, run_type, upper):
    ctx = RunContext(batch_run_id=batch, run_type=run_type, upper_bound=upper, run_ts=upper)
    open_batch(store, "batches", ctx)
    bronze = BronzeTable("events", "raw_events", extract_key="ts", load_key="event_id", load_type="incremental")
    silver = SilverTable("raw_events", "clean_events", "event_id, ts, event_type, value, props",
                         extract_key="ts", load_key="event_id", load_type="incremental",
                         steps=SilverSteps(case_unification={"event_type": "UPPER"}, is_null_handling=True,
                                           is_duplicate_check=True))
    gold = GoldTable("dm_events", GOLD_SQL, "MERGE", load_key="event_type")
    jobs = [("events", "raw_events", "incremental", lambda last: load_bronze_table(store, source, bronze, ctx, last)),
            ("raw_events", "clean_events", "incremental", lambda last: load_silver_table(store, silver, ctx, last)),
            ("clean_events", "dm_events", "incremental",
             lambda last: load_gold_table(store, gold, ctx, {"clean_events": store.read("clean_events")}, last))]
    return run_tables(store, ctx, jobs, audit_name="audit", batch_name="batches", source="fixture")


def test_layers_end_to_end(spark, scratch):
    store = TableStore(spark, scratch)
    ev = Tables(spark, SF_SMALL).events
    s1 = _run(store, ev, 1, "FULL", "2024-01-20 00:00:00").first()
    assert s1["tables_total"] == 3 and s1["tables_failed"] == 0, s1
    n_full = store.read("raw_events").count()
    assert n_full == ev.filter(F.col("ts") < "2024-01-20").count()

    s2 = _run(store, ev, 2, "DELTA", "2024-01-31 00:00:00").first()
    assert s2["tables_failed"] == 0, s2
    raw2 = sorted(tuple(r) for r in store.read("raw_events").drop("insertion_date").collect())
    assert len(raw2) == ev.count()
    clean2 = store.read("clean_events")
    assert clean2.filter(F.col("event_type") != F.upper("event_type")).count() == 0
    assert clean2.select("event_id").distinct().count() == clean2.count()

    # the watermark is the upper bound of the last successful DELTA minus 5 minutes
    marks = watermarks(store, "audit", "batches")
    assert str(marks["raw_events"]) == "2024-01-30 23:55:00"

    # rerunning the same DELTA window changes nothing
    s3 = _run(store, ev, 3, "DELTA", "2024-01-31 00:00:00").first()
    assert s3["tables_failed"] == 0
    raw3 = sorted(tuple(r) for r in store.read("raw_events").drop("insertion_date").collect())
    assert raw3 == raw2
    gold = {r["event_type"]: r["n"] for r in store.read("dm_events").collect()}
    assert dict(store.read("dm_events").dtypes)["n"] == "bigint"
    assert sum(gold.values()) == ev.count()


def test_failed_table_does_not_stop_the_run(spark, scratch):
    store = TableStore(spark, scratch)
    ctx = RunContext(batch_run_id=7, run_type="FULL", upper_bound="2024-01-20 00:00:00")
    open_batch(store, "batches", ctx)
    ev = Tables(spark, SF_SMALL).events

    def boom(last):
        raise RuntimeError("source unreachable")

    ok = BronzeTable("events", "raw_ok", extract_key="ts", load_type="full")
    jobs = [("broken", "raw_broken", "full", boom),
            ("events", "raw_ok", "full", lambda last: load_bronze_table(store, ev, ok, ctx, last))]
    s = run_tables(store, ctx, jobs, audit_name="audit", batch_name="batches").first()
    assert (s["tables_total"], s["tables_successful"], s["tables_failed"]) == (2, 1, 1)
    run = store.read_rows("audit_runs").first()
    assert (run["batch_run_id"], run["tables_processed"], run["tables_failed"], run["run_status"]) == (
        7, 2, 1, "Partial Success")
    assert run["run_end"] >= run["run_start"]
    assert s["failed_tables"] == "raw_broken"
    assert store.read("raw_ok").count() > 0


def test_multi_database_scoped_replace(spark, scratch):
    store = TableStore(spark, scratch)
    o = Tables(spark, SF_SMALL).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    ctx = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2002-01-01 00:00:00", run_ts="2024-01-01 00:00:00")
    cfg = BronzeTable("orders", "raw_orders", extract_key="o_orderdate", load_type="full")
    for db, status in enumerate(["F", "O", "P"], start=1):
        load_bronze_table(store, o.filter(F.col("o_orderstatus") == status), cfg, ctx, None, source_db=(db, 1))
    # a second FULL run of database 2 replaces only database 2's rows
    load_bronze_table(store, o.filter(F.col("o_orderstatus") == "O"), cfg, ctx, None, source_db=(2, 1))
    out = store.read("raw_orders")
    assert out.count() == o.count()
    assert out.groupBy("source_db_id").count().count() == 3


def test_config_driven_multi_database_run_in_parallel(spark, scratch):
    from strata.layers.runner import bronze_jobs

    store = TableStore(spark, scratch)
    t = Tables(spark, SF_SMALL)
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    config = [
        {"source_table_name": "orders", "target_table_name": "raw_orders", "extract_key": "o_orderdate",
         "load_key": "o_orderkey", "load_type": "incremental", "hierarchy_number": 1, "is_multi_db": 1,
         "source_db_id": db, "source_db_code": f"DB{db}", "market_profile_id": 1, "status": status}
        for db, status in [(1, "F"), (2, "O"), (3, "P")]
    ] + [{"source_table_name": "events", "target_table_name": "raw_events", "extract_key": "ts",
          "load_key": "event_id", "load_type": "append", "hierarchy_number": 1, "is_multi_db": 0}]

    def read_source(row):
        if row["source_table_name"] == "events":
            return t.events
        return orders.filter(F.col("o_orderstatus") == row["status"])

    for batch, run_type, upper in [(1, "FULL", "2001-12-31 00:00:00"), (2, "DELTA", "2030-01-01 00:00:00")]:
        ctx = RunContext(batch_run_id=batch, run_type=run_type, upper_bound=upper, run_ts=upper)
        open_batch(store, "batches", ctx)
        s = run_tables(store, ctx, bronze_jobs(store, ctx, config, read_source), audit_name="audit",
                       batch_name="batches", max_parallel=4).first()
        assert s["tables_total"] == 4 and s["tables_failed"] == 0, s
    out = store.read("raw_orders")
    assert out.count() == orders.count()
    assert out.select("o_orderkey", "source_db_id").distinct().count() == orders.count()
    assert store.read("raw_events").count() == t.events.count()
    # the second run was a DELTA per database: the watermark is kept per (table, db)
    assert set(watermarks(store, "audit", "batches")) >= {("raw_orders", "DB1"), ("raw_orders", "DB3")}


def test_config_rows_drive_silver_and_gold(spark, scratch):
    import json

    from strata.layers.runner import gold_jobs, silver_jobs

    store = TableStore(spark, scratch)
    t = Tables(spark, SF_SMALL)
    ctx = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2030-01-01 00:00:00", run_ts="2024-02-01 00:00:00")
    open_batch(store, "batches", ctx)
    raw = t.customer.select("c_custkey", F.concat(F.lit("  "), F.col("c_name"), F.lit("  ")).alias("c_name"),
                            F.col("c_mktsegment").alias("segment"), "c_acctbal")
    store.write("raw_customer", raw)
    silver_cfg = [{
        "raw_table_name": "raw_customer", "clean_table_name": "clean_customer",
        "column_name": "c_custkey, c_name, segment, c_acctbal, partition_index, vip",
        "extract_key": None, "load_key": "c_custkey", "load_type": "full", "hierarchy_number": 1,
        "case_unification": json.dumps({"segment": "LOWER"}),
        "value_mapping_unification": json.dumps({"segment": {"industry": ["machinery", "building"]}}),
        "is_add_indicator": json.dumps({"v": {"new_column_name": "vip"}}),
        "is_string_trimming": "0", "is_null_handling": "1", "is_index_partition": 1, "is_duplicate_check": True,
    }]
    gold_cfg = [{"target_table_name": "dm_segments", "ingestion_strategy": "TRUNCATE_INSERT", "execution_order": 1,
                 "data_load_sql_template": "SELECT segment, CAST(COUNT(*) AS DOUBLE) AS n FROM clean_customer "
                                           "GROUP BY segment"}]
    jobs = silver_jobs(store, ctx, silver_cfg)
    jobs += [j for j in gold_jobs(store, ctx, gold_cfg, lambda: {"clean_customer": store.read("clean_customer")})]
    for j in jobs[1:]:
        j.level = 2
    s = run_tables(store, ctx, jobs, audit_name="audit", batch_name="batches").first()
    assert s["tables_failed"] == 0, s
    clean = store.read("clean_customer")
    assert set(clean.columns) >= {"c_custkey", "c_name", "segment", "partition_index", "vip", "insertion_date"}
    assert clean.filter(F.col("c_name") != F.trim("c_name")).count() > 0    # trimming flag '0' is off
    assert {r[0] for r in clean.select("segment").distinct().collect()} == {"industry", "household", "automobile",
                                                                            "furniture"}
    assert sorted(r[0] for r in clean.select("partition_index").collect()) == list(range(1, raw.count() + 1))
    gold = {r["segment"]: r["n"] for r in store.read("dm_segments").collect()}
    assert sum(gold.values()) == raw.count() and dict(store.read("dm_segments").dtypes)["n"] == "bigint"


def test_partitioned_bronze_window_append(spark, scratch):
    store = TableStore(spark, scratch)
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "value")
    cfg = BronzeTable("events", "raw_events_by_day", extract_key="ts", load_key="event_id", load_type="append",
                      partition_date_of="ts")
    ctx1 = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2024-01-20 00:00:00", run_ts="2024-01-20 00:00:00")
    load_bronze_table(store, ev, cfg, ctx1, None)
    ctx2 = RunContext(batch_run_id=2, run_type="DELTA", upper_bound="2024-01-31 00:00:00", run_ts="2024-01-31 00:00:00")
    r = load_bronze_table(store, ev, cfg, ctx2, "2024-01-18 00:00:00")
    assert r.status == "Success"
    last = store.commits("raw_events_by_day").filter("version = 1")
    assert min(r["part"] for r in last.collect()) >= "p2024-01-18"     # an old day is not rewritten
    out = store.read("raw_events_by_day")
    assert out.count() == ev.count() and out.select("event_id").distinct().count() == ev.count()
    # rerunning the same DELTA window changes nothing
    load_bronze_table(store, ev, cfg, ctx2, "2024-01-18 00:00:00")
    assert store.read("raw_events_by_day").count() == ev.count()


def test_gold_append_strategy_replaces_its_window(spark, scratch):
    store = TableStore(spark, scratch)
    ev = Tables(spark, SF_SMALL).events
    sql = ("SELECT event_id, ts, value FROM silver_events "
           "WHERE ts > {lower_bound_time} AND ts < {upper_bound_time}")
    cfg = GoldTable("dm_event_facts", sql, "APPEND", incremental_extract_key="ts")
    views = {"silver_events": ev}
    full = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2024-01-20 00:00:00")
    load_gold_table(store, cfg, full, views)
    delta = RunContext(batch_run_id=2, run_type="DELTA", upper_bound="2024-01-25 00:00:00")
    load_gold_table(store, cfg, delta, views, last_processed="2024-01-18 00:00:00")
    load_gold_table(store, cfg, delta, views, last_processed="2024-01-18 00:00:00")   # rerun: no duplicates
    out = store.read("dm_event_facts")
    expected = ev.filter((F.col("ts") > "2000-01-01") & (F.col("ts") < "2024-01-25 00:00:00"))
    assert out.count() == expected.count() == out.select("event_id").distinct().count()


def test_partitioned_silver_and_gold_windows(spark, scratch):
    store = TableStore(spark, scratch)
    ev = Tables(spark, SF_SMALL).events.select("event_id", "ts", "event_type", "value")
    store.write("raw_ev", ev)
    silver = SilverTable("raw_ev", "clean_ev", "event_id, ts, event_type, value", extract_key="ts",
                         load_key="event_id", load_type="append", partition_date_of="ts",
                         steps=SilverSteps(case_unification={"event_type": "UPPER"}))
    gold_sql = ("SELECT event_id, ts, value FROM clean_ev WHERE ts > {lower_bound_time} AND ts < {upper_bound_time}")
    gold = GoldTable("dm_ev", gold_sql, "APPEND", incremental_extract_key="ts", partition_date_of="ts")
    c1 = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2024-01-20 00:00:00")
    load_silver_table(store, silver, c1)
    load_gold_table(store, gold, c1, {"clean_ev": store.read("clean_ev")})
    c2 = RunContext(batch_run_id=2, run_type="DELTA", upper_bound="2024-01-31 00:00:00")
    for _ in range(2):   # idempotent rerun
        load_silver_table(store, silver, c2, "2024-01-19 00:00:00")
        load_gold_table(store, gold, c2, {"clean_ev": store.read("clean_ev")}, "2024-01-19 00:00:00")
    last = store.commits("clean_ev").filter("version > 0")
    assert min(r["part"] for r in last.collect()) >= "p2024-01-19"     # an old day is not rewritten
    clean = store.read("clean_ev")
    assert clean.count() == ev.count() == clean.select("event_id").distinct().count()
    assert store.read("dm_ev").count() == ev.count()


def test_a_broken_database_fails_alone(spark, scratch):
    from strata.layers.runner import audit_state, bronze_jobs

    store = TableStore(spark, scratch)
    orders = Tables(spark, SF_SMALL).orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    config = [{"source_table_name": "orders", "target_table_name": "raw_orders", "extract_key": "o_orderdate",
               "load_key": "o_orderkey", "load_type": "append", "is_multi_db": 1, "source_db_id": db,
               "source_db_code": f"DB{db}", "status": status} for db, status in [(1, "F"), (2, "O"), (3, "P")]]

    def read_source(row):
        if row["status"] == "O":
            raise RuntimeError("cannot connect")
        bad = F.when(F.lit(row["status"] == "P"), F.raise_error(F.lit("broken while read"))).otherwise(F.col("o_orderkey"))
        return orders.filter(F.col("o_orderstatus") == row["status"]).withColumn("o_orderkey", bad)

    ctx = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2030-01-01 00:00:00")
    s = run_tables(store, ctx, bronze_jobs(store, ctx, config, read_source), audit_name="audit", batch_name="b").first()
    assert (s["tables_successful"], s["tables_failed"]) == (1, 2)
    state = {r["db_code"]: (r["operation_result"], r["output_row"]) for r in audit_state(store, "audit").collect()}
    n = orders.filter("o_orderstatus = 'F'").count()
    assert state["DB1"] == ("Success", n) and {state["DB2"][0], state["DB3"][0]} == {"Failed"}
    assert store.read("raw_orders").count() == n


def test_config_rows_name_a_layout(spark, scratch):
    from strata.layers.runner import bronze_jobs, gold_jobs, silver_jobs

    store = TableStore(spark, scratch)
    ev = Tables(spark, SF_SMALL).events
    ctx = RunContext(batch_run_id=1, run_type="FULL", upper_bound="2030-01-01 00:00:00")
    jobs = bronze_jobs(store, ctx, [{"source_table_name": "events", "target_table_name": "raw", "extract_key": "ts",
                                     "load_key": "event_id", "load_type": "append", "partition_date_of": "ts"}], lambda r: ev)
    jobs += silver_jobs(store, ctx, [{"raw_table_name": "raw", "clean_table_name": "clean", "column_name": "event_id, ts",
                                      "load_key": "event_id", "load_type": "incremental", "load_buckets": 4}])
    jobs += gold_jobs(store, ctx, [{"target_table_name": "dm", "ingestion_strategy": "MERGE", "load_key": "event_id",
                                    "data_load_sql_template": "SELECT event_id FROM clean", "load_buckets": "2"}],
                      lambda: {"clean": store.read("clean")})
    for job in jobs:
        job.loader(None)
    assert [store.snapshot(t).layout for t in ("raw", "clean", "dm")] == ["load_day", "load_bucket/4", "load_bucket/2"]
