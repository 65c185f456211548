"""Catalogue of the registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole fixture tables and runs one operator family of the
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import codes
from strata.operators import clean, control, loads, schema, windows
from strata.operators.rowindex import row_index
from strata.plans import emission, listing, pnl
from strata.plans import fixtures as fx
from strata.sources import templates
from strata.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- P&L (PJ-09) ----------------------------------------------------------

def _finance(spark, sf_dir, params=fx.FIXTURE_PNL):
    m = Tables.for_session(spark, sf_dir).memo("finance_model", fx.finance_model)
    sp = pnl.sales_purchase(m.service_fare, m.supp_doc, m.service_dim, m.service_type_dim, params)
    ledger = pnl.ledger_summary(m.transactions, m.chart, m.documents, m.glcode, params)
    return m, sp, ledger


@register("pnl_gmv")
def pnl_gmv(spark, sf_dir):
    _, sp, _ = _finance(spark, sf_dir)
    return pnl.gmv_statement(sp)


@register("pnl_gmv_from_two_facts")
def pnl_gmv_from_two_facts(spark, sf_dir):
    """The GMV statement over separate fare and service facts, joined on both key parts (JN-03)."""
    t = Tables.for_session(spark, sf_dir)
    m = t.memo("finance_model", fx.finance_model)
    # each fare line has an id of its own; a decoy service of another type must not match
    keyed = fx.finance_lines(t)
    fare = keyed.select("fare_id", "service_type_id", "customer_price", "deal_discount", "customer_tax",
                        "rounding_amount")
    own = keyed.select(F.col("fare_id").alias("cus_base_fare_id"), "service_type_id", "ta_supp_doc_no_id",
                       "record_type", "last_action", "supplier_amount", "supplier_tax")
    decoy = own.withColumn("service_type_id", F.col("service_type_id") + 1)
    joined = pnl.join_fare_service(fare, own.unionByName(decoy))
    return pnl.gmv_statement(pnl.sales_purchase(joined, m.supp_doc, m.service_dim, m.service_type_dim, fx.FIXTURE_PNL))


@register("pnl_incentive_by_code")
def pnl_incentive_by_code(spark, sf_dir):
    m = Tables.for_session(spark, sf_dir).memo("finance_model", fx.finance_model)
    return pnl.as_double_cols(
        pnl.incentive_by_code(m.transactions, m.chart, m.documents, m.glcode, fx.FIXTURE_PNL),
        ["incentive_amount"])


@register("pnl_total_revenue")
def pnl_total_revenue(spark, sf_dir):
    _, sp, ledger = _finance(spark, sf_dir)
    return pnl.total_revenue_statement(pnl.summary(sp, ledger))


@register("pnl_total_expense")
def pnl_total_expense(spark, sf_dir):
    _, _, ledger = _finance(spark, sf_dir)
    return pnl.expense_statement(ledger)


@register("pnl_net_profit")
def pnl_net_profit(spark, sf_dir):
    _, sp, ledger = _finance(spark, sf_dir)
    return pnl.net_profit_statement(pnl.summary(sp, ledger))


@register("pnl_ebitda")
def pnl_ebitda(spark, sf_dir):
    _, sp, ledger = _finance(spark, sf_dir)
    return pnl.ebitda_statement(pnl.summary(sp, ledger))


# --- windows and loads (FP-01..04, IO-04..11, WN-02) -----------------------


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
RUN1_TS = "2024-01-20 00:00:00"
RUN2_TS = "2024-01-25 06:00:00"


def _events_with_keys(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events.select(*EVENT_COLS)
    # second extract key: a modification time three days after creation
    return ev.withColumn("updated_at", F.col("ts") + F.expr("INTERVAL 3 DAYS"))


@register("window_delta")
def window_delta(spark, sf_dir):
    ev = _events_with_keys(spark, sf_dir)
    w = windows.choose_window("bronze", "DELTA", "incremental", "ts, updated_at",
                              "2024-01-10 00:00:00", "2024-01-20 12:00:00")
    return ev.filter(w)


@register("window_full")
def window_full(spark, sf_dir):
    ev = _events_with_keys(spark, sf_dir)
    w = windows.choose_window("bronze", "FULL", "incremental", "ts, updated_at",
                              None, "2024-01-12 00:00:00")
    return ev.filter(w)


@register("cutoff_any_date")
def cutoff_any_date(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders
    shipped_text = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
                    .otherwise(F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS"), "yyyy-MM-dd")))
    df = o.select("o_orderkey", "o_orderdate", shipped_text.alias("ship_text"))
    out = windows.business_cutoff_filter(df, ["o_orderdate", "ship_text", "no_such_column"],
                                         cutoff="1999-06-01")
    return out.select("o_orderkey", "o_orderdate", "ship_text")


def _first_load(ev):
    w1 = windows.choose_window("bronze", "FULL", "full", "ts", None, RUN1_TS)
    return loads.stamp(loads.full_replace(None, ev.filter(w1)), RUN1_TS)


@register("load_full")
def load_full(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events.select(*EVENT_COLS)
    return _first_load(ev)


@register("load_window_append")
def load_window_append(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events.select(*EVENT_COLS)
    target = _first_load(ev)
    lower = "2024-01-15 00:00:00"
    w2 = windows.choose_window("bronze", "DELTA", "append", "ts", lower, RUN2_TS)
    # the second extract re-delivers the window with corrected values
    incoming = loads.stamp(ev.filter(w2).withColumn("value", F.col("value") + 1), RUN2_TS)
    return loads.window_append(target, incoming, w2)


@register("load_upsert")
def load_upsert(spark, sf_dir):
    # target keyed by user: each user's latest event; two deliveries
    ev = Tables.for_session(spark, sf_dir).events.select(*EVENT_COLS)
    keys, order = ["user_id"], ["ts", "event_id"]
    d1 = ev.filter(windows.upper_bound_window("ts", RUN1_TS))
    d2 = ev.filter(windows.incremental_window("ts", "2024-01-15 00:00:00", RUN2_TS))
    state = loads.upsert(None, d1, keys, order)
    return loads.upsert(state, d2, keys, order)


@register("load_multi_db")
def load_multi_db(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders
    # three source databases, one per order status, each tagged and unioned
    dbs = [("F", 1, 1), ("O", 2, 2), ("P", 3, 1)]
    upper = windows.upper_bound_window("o_orderdate", "2000-01-01")
    frames = [loads.tag_source(o.filter((F.col("o_orderstatus") == s) & upper), db, mp)
              for s, db, mp in dbs]
    return loads.union_sources(frames)


@register("sentinel_clamp")
def sentinel_clamp(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders
    end = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(loads.SENTINEL_END).cast("timestamp_ntz"))
           .otherwise(F.col("o_orderdate")))
    df = loads.clamp_sentinel(o.withColumn("EndDate", end), "EndDate")
    return df.withColumn("EndDate", F.date_format("EndDate", "yyyy-MM-dd HH:mm:ss"))


# --- control: config, batch, audit (FP-05, JN-10/11, SL-02..04, AG-09/11..13)

@register("watermark")
def watermark(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events
    return control.high_water_marks(fx.table_audit_from_events(ev), fx.batches_from_events(ev))


@register("latest_batch")
def latest_batch(spark, sf_dir):
    b = fx.batches_from_events(Tables.for_session(spark, sf_dir).events)
    return control.running_batch(b).select("batch_run_id", "run_start_datetime", "load_type")


@register("audit_state")
def audit_state(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events
    log = ev.select(F.col("user_id").alias("process_id"),
                    F.dayofmonth("ts").alias("batch_run_id"),
                    F.col("event_type").alias("source_table_name"),
                    F.col("ts").alias("event_time"),
                    F.col("value").alias("output_row"))
    return control.latest_audit_state(log)


@register("run_summary")
def run_summary(spark, sf_dir):
    return control.run_summary(fx.table_audit_from_events(Tables.for_session(spark, sf_dir).events))


@register("config_plan")
def config_plan(spark, sf_dir):
    m = fx.config_model(Tables.for_session(spark, sf_dir))
    tables = control.select_config(m.tables, type_col="table_type", table_type="transaction",
                                   frequency_col="run_frequency", frequency="DAILY", run_type="DELTA")
    systems = m.systems.filter(F.col("system_is_active") == 1)
    dbs = control.select_config(m.databases, active_col=None, db_col="source_db_code",
                                db_codes=[f"NATION_{i}" for i in range(0, 25, 2)])
    plan = control.expand_config(systems, dbs, tables)
    return (plan.orderBy(*control.processing_order(plan, "bronze"))
            .select("source_system_name", "is_multi_db", "source_db_code", "source_table_name",
                    "load_sequence", "hierarchy_number"))


# --- silver cleaning steps (F-01..F-16, FP-14, IO-12..16, AG-10, WN-01) ----


CASE_CONFIG = {"name_upper": "UPPER", "name_lower": "lower", "name_title": "TITLE",
               "name_cap": "CAPITALIZE", "name_strip": "STRIP", "name_sentence": "SENTENCE",
               "name_keep": "WEIRD", "absent_column": "UPPER"}


@register("case_unify")
def case_unify(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir))
    wide = d.select("c_custkey", *[F.col("raw_name").alias(c) for c in CASE_CONFIG if c != "absent_column"])
    return clean.case_unification(wide, CASE_CONFIG)


@register("title_trim")
def title_trim(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select("c_custkey", "raw_name", "segment", "country")
    return clean.string_trimming(d)


@register("null_blank")
def null_blank(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select("c_custkey", "raw_name", "segment", "balance")
    bronze = clean.bronze_clean(d)
    silver = clean.null_handling(d.select("c_custkey", F.col("raw_name").alias("raw_name_silver")))
    return bronze.join(silver, "c_custkey")


@register("uuid_upper")
def uuid_upper(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select("c_custkey", "uuid_text")
    return clean.bronze_clean(d)


@register("datetime_format")
def datetime_format(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders
    d = o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "M/d/yyyy").alias("d_us"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("31-02-1997"))
         .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")).alias("d_eu"),
        F.col("o_orderdate").alias("d_ts"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("d_other"))
    return clean.datetime_formatting(d, {"d_us": "MM/DD/YYYY", "d_eu": "DD-MM-YYYY",
                                         "d_ts": "YYYY-MM-DD HH:mm:ss", "d_other": "weird"})


@register("country_unify")
def country_unify(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select("c_custkey", "country")
    return clean.country_code_unification(d, "country")


@register("value_map")
def value_map(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select("c_custkey", "segment")
    return clean.value_mapping(d, {"segment": {"CONSUMER": ["HOUSEHOLD", "AUTOMOBILE"],
                                               "INDUSTRIAL": ["MACHINERY", "BUILDING"]}})


@register("currency_std")
def currency_std(spark, sf_dir):
    d = fx.dirty_customers(Tables.for_session(spark, sf_dir)).select(
        "c_custkey", "balance", "balance_currency", "latitude", "longitude")
    out = (d.transform(lambda x: clean.currency_standardization(x, "balance"))
            .transform(clean.geographic_enrichment)
            .transform(lambda x: clean.base_currency(x, "balance")))
    return out.select("c_custkey", "balance", "latitude", "longitude")


@register("json_flatten")
def json_flatten(spark, sf_dir):
    d = fx.json_parts(Tables.for_session(spark, sf_dir))
    cfg = {"j": {"keys_to_extract": ["brand", "dims/size", {"path": "dims.size", "alias": "size2"},
                                     "missing"]}}
    return clean.flatten_semistructured(d, cfg).drop("j")


@register("json_extract_all")
def json_extract_all(spark, sf_dir):
    d = fx.json_parts(Tables.for_session(spark, sf_dir))
    return clean.flatten_semistructured(d, {"j": {"extract_all": True}}).drop("j")


@register("xml_flatten")
def xml_flatten(spark, sf_dir):
    d = fx.xml_parts(Tables.for_session(spark, sf_dir)).select("p_partkey", "x")
    cfg = {"x": {"keys_to_extract": ["SN", "IL/@LOC", "IL/@ED",
                                     {"path": "ServiceDetailsInfo/@SC", "alias": "sc"}]}}
    return clean.flatten_semistructured(d, cfg).drop("x")


@register("xml_repair")
def xml_repair(spark, sf_dir):
    d = fx.xml_parts(Tables.for_session(spark, sf_dir)).select("p_partkey", "x2")
    return schema.serialise_for_target(d, xml_cols=["x2"])


@register("json_array_serialise")
def json_array_serialise(spark, sf_dir):
    li = Tables.for_session(spark, sf_dir).lineitem
    arr = (F.when(F.col("l_returnflag") == "A", F.lit(None).cast("array<bigint>"))
           .when(F.col("l_returnflag") == "R",
                 F.array(F.col("l_partkey"), F.col("l_suppkey"), F.lit(None).cast("bigint")))
           .otherwise(F.array(F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("bigint"))))
    d = li.select("l_orderkey", "l_linenumber", "l_partkey", arr.alias("arr"),
                  F.struct(F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("f")).alias("js"))
    js, arrays = schema.special_columns(d.schema)
    return schema.serialise_for_target(d, json_cols=js, array_cols=arrays)


@register("dedup_rows")
def dedup_rows(spark, sf_dir):
    li = Tables.for_session(spark, sf_dir).lineitem
    return clean.remove_duplicates(li.unionByName(li.filter("l_linenumber = 1")))


@register("row_index")
def row_index_q(spark, sf_dir):
    return row_index(Tables.for_session(spark, sf_dir).orders, ["o_orderkey"])


@register("schema_align")
def schema_align(spark, sf_dir):
    o = loads.stamp(Tables.for_session(spark, sf_dir).orders, RUN1_TS)
    target = schema.target_schema(o.schema, ["o_orderkey", "o_totalprice", "missing_col"])
    aligned = schema.align_to_target(o, [f.name for f in target.fields])
    return clean.add_placeholders(
        aligned, {"vip": {"new_column_name": "is_vip"}},
        {"joins": [{"selected_columns": [{"column": "r_name", "alias": "region"}, {"column": "n_name"}]}]})


# --- emission mart (PJ-10: D-01..D-05, JN-05, SO-02, SL-01) -----------------


def _bookings(spark, sf_dir):
    return Tables.for_session(spark, sf_dir).memo("booking_model", fx.booking_model)


def _round_km(df):
    return df.withColumn("KM", F.round("KM", 6))


@register("emission_booking")
def emission_booking(spark, sf_dir):
    b = emission.booking_source(_bookings(spark, sf_dir))
    return _round_km(b.select("BookingID", "OrganizationId", "Trip", "Start_Date", "Airline", "TripType",
                              "Cabin_Class", "E_Ticket", "Route", "KM", "Ticket_status"))


@register("emission_multileg")
def emission_multileg(spark, sf_dir):
    s = emission.service_source(_bookings(spark, sf_dir))
    return _round_km(s.select("BookingID", "OrganizationId", "Trip", "Start_Date", "End_Date", "TravelerId",
                              "Airline", "TripType", "Cabin_Class", "E_Ticket", "Route", "KM"))


@register("emission_mart")
def emission_mart(spark, sf_dir):
    return emission.emission_mart(_bookings(spark, sf_dir))


# --- booking / service listing (PJ-08: JN-02/03/04/06/07, AG-08, SO-01, D-06..D-11)


WHOLE_PERIOD = listing.ListingParams(remit_from="1995-01-01 00:00:00", remit_to="2001-12-31 23:59:59",
                                     market_profile_id=1, organization_ids=None)


def _listing_model(spark, sf_dir):
    return Tables.for_session(spark, sf_dir).memo("listing_model", fx.listing_model)


@register("or_join_traveler")
def or_join_traveler(spark, sf_dir):
    m = _listing_model(spark, sf_dir)
    b = m.booking.select(F.col("ID").alias("B_ID"))
    j = listing.traveler_via_air_or_hotel(b, m)
    return j.select("B_ID", "at_traveler", "ht_traveler", F.col("T_ID").alias("traveler_id"),
                    F.col("T_FullName").alias("traveler_name"))


@register("itinerary_rollup")
def itinerary_rollup(spark, sf_dir):
    return listing.itinerary_rollup(_listing_model(spark, sf_dir))


@register("city_code_country")
def city_code_country(spark, sf_dir):
    return listing.service_country(_listing_model(spark, sf_dir))


@register("listing_union")
def listing_union(spark, sf_dir):
    return listing.listing(_listing_model(spark, sf_dir), WHOLE_PERIOD)


# --- gold template source (IO-03, F-05) ---------------------------------------


GOLD_TEMPLATE = """
SELECT event_type, user_id, CAST(COUNT(*) AS DOUBLE) AS n_events, ROUND(SUM(value), 2) AS total_value
FROM silver_events
WHERE ts > {lower_bound_time} AND ts < {upper_bound_date}
GROUP BY event_type, user_id;
"""


@register("gold_template")
def gold_template(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events
    df = templates.run_template(spark, GOLD_TEMPLATE, "DELTA", "2024-01-10 00:00:00", "2024-01-20 00:00:00",
                                views={"silver_events": ev})
    return codes.cast_integral_floats(df)


@register("xml_extract_all")
def xml_extract_all(spark, sf_dir):
    d = fx.xml_parts(Tables.for_session(spark, sf_dir)).select("p_partkey", "x")
    return clean.flatten_semistructured(d, {"x": {"extract_all": True, "format": "xml"}}).drop("x")


@register("latest_success")
def latest_success(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events
    return control.latest_successful_run(fx.table_audit_from_events(ev), fx.batches_from_events(ev),
                                         "clean_purchase").select(
        "process_id", "destination_table_name", "time_to", "input_row")


@register("source_systems")
def source_systems(spark, sf_dir):
    m = fx.config_model(Tables.for_session(spark, sf_dir))
    plan = control.expand_config(m.systems.filter(F.col("system_is_active") == 1), m.databases,
                                 control.select_config(m.tables))
    return control.distinct_sources(plan, ("source_system_name", "is_multi_db"))


# --- sinks: a state read back after two deliveries (IO-06, IO-08, IO-10), first silver DELTA (FP-17)

def _sink(spark, label):
    import uuid

    from strata.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/sink-{label}-{uuid.uuid4().hex}"


@register("sink_window_by_day")
def sink_window_by_day(spark, sf_dir):
    from strata.sources.store import PartitionedTable
    ev = Tables.for_session(spark, sf_dir).events.withColumn("day", F.to_date("ts"))
    # NULL days, and days that the second delivery empties
    ev = ev.withColumn("day", F.when(F.col("event_id") % 50 != 0, F.col("day")))
    table = PartitionedTable(spark, _sink(spark, "days"), "day")
    table.replace_window(ev.filter(windows.upper_bound_window("ts", "2024-01-20")), None)
    w = windows.incremental_window("ts", "2024-01-15 12:00:00", "2024-01-25 00:00:00")
    table.replace_window(ev.filter(w).filter(F.dayofmonth("ts") != 18).withColumn("value", F.col("value") + 1), w)
    return table.read()


@register("sink_upsert_by_bucket")
def sink_upsert_by_bucket(spark, sf_dir):
    from strata.sources.store import BUCKET_COLUMN, PartitionedTable, bucketed
    ev = Tables.for_session(spark, sf_dir).events
    table = PartitionedTable(spark, _sink(spark, "buckets"), BUCKET_COLUMN)
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-10", "2024-01-14")):
        part = ev.filter(windows.incremental_window("ts", low, high))
        table.upsert(bucketed(part, ["user_id"], 16), ["user_id"], ["ts", "event_id"])
    return table.read().drop(BUCKET_COLUMN)


@register("first_silver_delta")
def first_silver_delta(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders.withColumn("seen", F.expr("o_orderdate + INTERVAL 18 YEARS"))
    w = windows.choose_window("silver", "DELTA", "append", "seen", None, "2018-01-01 00:00:00")
    return o.filter(w).drop("seen")


@register("ordered_plan")
def ordered_plan(spark, sf_dir):
    """SL-04: the place of each table in the run order, as a column."""
    m = fx.config_model(Tables.for_session(spark, sf_dir))
    return row_index(m.tables, control.processing_order(m.tables, "bronze"), column="place").select(
        "source_table_name", "load_sequence", "hierarchy_number", "place")


@register("processing_orders")
def processing_orders(spark, sf_dir):
    """SL-04: the place of each table in the run order of every layer."""
    t = fx.config_model(Tables.for_session(spark, sf_dir)).tables.withColumn("execution_order", -F.col("hierarchy_number"))
    placed = [row_index(t, control.processing_order(t, layer), column="place").select(
        F.lit(layer).alias("layer"), "source_table_name", "place") for layer in ("bronze", "silver", "gold")]
    return loads.union_sources(placed)


@register("emission_order")
def emission_order(spark, sf_dir):
    """SL-01, SL-05: places of each report key in the emission mart, read back from the files of its sink."""
    from strata.sources.store import TableStore
    store = TableStore(spark, _sink(spark, "emission"))
    store.write("dm_emission", emission.emitted(_bookings(spark, sf_dir)))
    placed = store.read_placed("dm_emission")
    return placed.groupBy(F.date_format("RemitDate", "yyyy-MM-dd HH:mm:ss").alias("RemitDate"), "OrganizationId").agg(
        F.min("place").alias("first_place"), F.max("place").alias("last_place"), F.count("*").alias("n_rows"))


# --- the layer jobs: layouts that change, several databases, configuration, target synchronisation

def _context(batch, run, upper):
    from strata.layers.common import RunContext
    return RunContext(batch_run_id=batch, run_type=run, upper_bound=upper, run_ts=upper)


def _loaded(spark, sf_dir, label, loads_of):
    """Bronze ``events`` after the given (config options, run type, upper bound, watermark) loads."""
    from strata.layers.bronze import BronzeTable, load_bronze_table
    from strata.sources.store import TableStore
    store = TableStore(spark, _sink(spark, label))
    ev = Tables.for_session(spark, sf_dir).events
    for batch, (options, run, upper, last) in enumerate(loads_of):
        cfg = BronzeTable("events", "raw_events", extract_key="ts", load_key="event_id", **options)
        load_bronze_table(store, ev, cfg, _context(batch, run, upper), last)
    return store.read("raw_events").drop("load_day", "load_bucket")


@register("layout_whole_to_days")
def layout_whole_to_days(spark, sf_dir):
    """A table first written whole, then by load day, then a window of it again (IO-08)."""
    days = {"load_type": "append", "partition_date_of": "ts"}
    return _loaded(spark, sf_dir, "to-days", [
        ({"load_type": "append"}, "FULL", "2024-01-15 00:00:00", None),
        (days, "DELTA", RUN1_TS, "2024-01-14 00:00:00"), (days, "DELTA", RUN2_TS, "2024-01-19 00:00:00")])


@register("layout_whole_to_buckets")
def layout_whole_to_buckets(spark, sf_dir):
    """A table first written whole, then in 4 buckets, then in 7, each with a delivery (IO-10)."""
    return _loaded(spark, sf_dir, "to-buckets", [
        ({"load_type": "incremental"}, "FULL", "2024-01-15 00:00:00", None),
        ({"load_type": "incremental", "load_buckets": 4}, "DELTA", RUN1_TS, "2024-01-14 00:00:00"),
        ({"load_type": "incremental", "load_buckets": 7}, "DELTA", RUN2_TS, "2024-01-18 00:00:00"),
        ({"load_type": "incremental", "load_buckets": 7}, "DELTA", RUN2_TS, "2024-01-22 00:00:00")])


@register("first_delta_append")
def first_delta_append(spark, sf_dir):
    """IO-09: the first DELTA append, without a watermark, replaces what a FULL run left."""
    return _loaded(spark, sf_dir, "first-delta", [
        ({"load_type": "append"}, "FULL", RUN2_TS, None), ({"load_type": "append"}, "DELTA", RUN1_TS, None)])


def _databases_config():
    return [{"source_table_name": "orders", "target_table_name": "raw_orders", "extract_key": "o_orderdate",
             "load_key": "o_orderkey", "load_type": "incremental", "is_multi_db": 1, "source_db_id": db,
             "source_db_code": f"DB{db}", "market_profile_id": profile, "status": status, "load_buckets": "8"}
            for db, profile, status in ((1, 1, "F"), (2, 2, "O"), (3, 1, "P"))]


def _config_run(spark, sf_dir, label):
    """A FULL and a DELTA batch from config rows: three databases of ``orders`` in one write, and ``events`` by day."""
    from strata.layers.runner import bronze_jobs, open_batch, run_tables
    from strata.sources.store import TableStore
    t = Tables.for_session(spark, sf_dir)
    store = TableStore(spark, _sink(spark, label))
    config = _databases_config() + [{
        "source_table_name": "events", "target_table_name": "raw_events", "extract_key": "ts", "load_key": "event_id",
        "load_type": "append", "hierarchy_number": 1, "partition_date_of": "ts"}]

    def read_source(row):
        return t.events if row["source_table_name"] == "events" else t.orders.filter(F.col("o_orderstatus") == row["status"])

    for batch, (run, upper) in enumerate((("FULL", "1996-01-01 00:00:00"), ("DELTA", "2024-01-20 00:00:00"))):
        ctx = _context(batch, run, upper)
        open_batch(store, "batches", ctx)
        run_tables(store, ctx, bronze_jobs(store, ctx, config, read_source), audit_name="audit", batch_name="batches",
                   source="fixture")
    return store


@register("load_databases_one_write")
def load_databases_one_write(spark, sf_dir):
    """IO-04, SO-03, PJ-06: the target of three databases after two batches, one version each."""
    store = _config_run(spark, sf_dir, "databases")
    return store.read("raw_orders").drop("load_bucket", "insertion_date").withColumn(
        "versions", F.lit(store.version("raw_orders") + 1))


@register("config_audit")
def config_audit(spark, sf_dir):
    """PJ-06, PJ-07: one final audit row for each batch, table and database, with the rows fetched and written."""
    from strata.layers.runner import audit_state
    return audit_state(_config_run(spark, sf_dir, "audit"), "audit").select(
        "batch_run_id", "destination_table_name", "db_code", "operation", "input_row", "output_row", "operation_result")


@register("silver_target_sync")
def silver_target_sync(spark, sf_dir):
    """PJ-03, IO-15, IO-16: a FULL silver load whose config loses two columns and gains two, which are text."""
    from strata.layers.silver import SilverTable, load_silver_table
    from strata.sources.store import TableStore
    store = TableStore(spark, _sink(spark, "sync"))
    store.write("raw_events", Tables.for_session(spark, sf_dir).events)
    for batch, columns in enumerate(("event_id, ts, event_type, value", "event_id, event_type, user_id, props")):
        cfg = SilverTable("raw_events", "clean_events", columns, extract_key="ts", load_key="event_id")
        load_silver_table(store, cfg, _context(batch, "FULL", RUN2_TS))
    out = store.read("clean_events")
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in out.schema.fields)
    return out.withColumns({"kinds": F.lit(kinds), "insertion_date": F.col("insertion_date").cast("string")})


@register("join_enrichment")
def join_enrichment(spark, sf_dir):
    """JN-12: the columns of an enrichment config, filled from two lookups; unknown tables leave placeholders."""
    t = Tables.for_session(spark, sf_dir)
    config = {"joins": [
        {"table": "nation", "on": [["c_nationkey", "n_nationkey"]],
         "selected_columns": [{"column": "n_name", "alias": "nation_name"}, {"column": "n_regionkey"}]},
        {"table": "region", "on": [["n_regionkey", "r_regionkey"]],
         "selected_columns": [{"column": "r_name", "alias": "region_name"}]},
        {"table": "missing", "on": [["c_custkey", "id"]], "selected_columns": [{"column": "x", "alias": "unknown"}]}]}
    placed = clean.add_placeholders(t.customer, config)
    return clean.join_enrichment(placed, config, {"nation": t.nation.filter("n_nationkey <> 7"), "region": t.region})


@register("window_bounds")
def window_bounds(spark, sf_dir):
    """FP-16: windows of many bounds; a lower bound after the upper one is refused and loads nothing."""
    ev = Tables.for_session(spark, sf_dir).events
    frames = []
    for low, high in (("2024-01-05 00:00:00", "2024-01-10 00:00:00"), ("2024-01-10 00:00:00", "2024-01-05 00:00:00"),
                      ("2024-01-12 00:00:00", "2024-01-12 00:00:00"), (None, "2024-01-03 00:00:00")):
        try:
            windows.check_bounds(low, high)
        except ValueError:
            continue
        frames.append(ev.filter(windows.incremental_window("ts", low, high) if low else windows.upper_bound_window("ts", high))
                      .withColumn("upper_bound", F.lit(high)))
    return loads.union_sources(frames)


# --- loads and rules that had no query: IO-02, IO-07, FP-03, F-03, JN-12, PJ-01..PJ-05

@register("silver_full_scan")
def silver_full_scan(spark, sf_dir):
    from strata.sources.tables import scan_window
    ev = Tables.for_session(spark, sf_dir).events
    return scan_window(ev, windows.choose_window("silver", "FULL", "full", "ts", None, RUN1_TS))


@register("load_append")
def load_append(spark, sf_dir):
    o = Tables.for_session(spark, sf_dir).orders
    return loads.append(o, o.filter("o_orderstatus = 'F'").drop("o_orderpriority"))


@register("gold_unbounded_delete")
def gold_unbounded_delete(spark, sf_dir):
    ev = Tables.for_session(spark, sf_dir).events
    w = windows.lower_bound_window("ts", "2024-01-15 00:00:00")
    delivered = ev.filter(windows.incremental_window("ts", "2024-01-15 00:00:00", RUN1_TS))
    return loads.window_append(ev, delivered, w)


@register("nan_clean")
def nan_clean(spark, sf_dir):
    li = Tables.for_session(spark, sf_dir).lineitem
    broken = F.when(F.col("l_quantity") < 5, F.lit(float("nan"))).otherwise(F.col("l_extendedprice").cast("double"))
    return codes.nan_to_null_all(li.select("l_orderkey", "l_linenumber", broken.alias("price")))


@register("layers_end_to_end")
def layers_end_to_end(spark, sf_dir):
    """Bronze, silver and gold jobs of a FULL and a DELTA batch; the gold table read back."""
    from strata.layers.bronze import BronzeTable, load_bronze_table
    from strata.layers.common import RunContext
    from strata.layers.gold import GoldTable, load_gold_table
    from strata.layers.silver import SilverTable, load_silver_table
    from strata.sources.store import TableStore
    ev = Tables.for_session(spark, sf_dir).events
    store = TableStore(spark, _sink(spark, "layers"))
    bronze = BronzeTable("events", "raw_events", extract_key="ts", load_key="event_id", load_type="append",
                         partition_date_of="ts")
    silver = SilverTable("raw_events", "clean_events", "event_id, ts, event_type, value", extract_key="ts",
                         load_key="event_id", load_type="incremental", load_buckets=8,
                         steps=clean.SilverSteps(case_unification={"event_type": "UPPER"}))
    gold = GoldTable("dm_events", "SELECT event_type, COUNT(*) AS n, MAX(ts) AS last_ts FROM clean_events "
                                  "GROUP BY event_type", "MERGE", load_key="event_type")
    for batch, (run, upper, last) in enumerate((("FULL", RUN1_TS, None), ("DELTA", RUN2_TS, "2024-01-15 00:00:00"))):
        ctx = RunContext(batch_run_id=batch, run_type=run, upper_bound=upper, run_ts=upper)
        load_bronze_table(store, ev, bronze, ctx, last)
        load_silver_table(store, silver, ctx, last)
        load_gold_table(store, gold, ctx, {"clean_events": store.read("clean_events")}, last)
    return store.read("dm_events")
