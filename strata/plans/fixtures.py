"""Reference-shaped tables built from the driver's fixture tables.

The reference's marts read a travel-finance star schema that the fixtures do
not have; these functions play each reference role with a fixture table by
projection only (see FIXTURES.md, part C).  All derived money is exact
DECIMAL arithmetic so results are bit-identical to the SQL oracle.

Everything is a lazy projection or join of whole fixture tables: the marts'
work grows with the data.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.plans.pnl import PnlParams
from strata.sources.tables import lookup_table

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"
QTY = "decimal(6,2)"

# Fixed values of the fixture mapping for the P&L: a one-month period inside
# the order dates, and codes present in the fixture dimensions.
FIXTURE_PNL = PnlParams(
    period_start="1997-07-01",
    period_end="1997-07-31",
    incentive_code="BUILDING",
    expense_code="AUTOMOBILE",
    excluded_doc_codes=("1-URGENT", "2-HIGH"),
)


def _money(c: str) -> Column:
    return F.col(c).cast(MONEY)


def finance_lines(t) -> DataFrame:
    """One fare-and-service row per lineitem, each with a fare id of its own."""
    price = _money("l_extendedprice")
    disc = F.col("l_discount").cast(RATE)
    tax = F.col("l_tax").cast(RATE)
    supplier_amount = price * (F.lit(1) - disc)
    return t.lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("fare_id"),
        F.col("l_partkey").alias("service_type_id"),
        F.col("l_orderkey").alias("ta_supp_doc_no_id"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("record_type"),
        F.col("l_linenumber").alias("last_action"),
        price.alias("customer_price"),
        (price * disc).alias("deal_discount"),
        (price * tax).alias("customer_tax"),
        (F.col("l_quantity").cast(QTY) * F.lit(0.01).cast("decimal(3,2)")).alias("rounding_amount"),
        supplier_amount.alias("supplier_amount"),
        (supplier_amount * tax).alias("supplier_tax"),
    )


def finance_model(t) -> SimpleNamespace:
    """Finance star from lineitem/orders/customer/part/nation."""
    o = t.orders
    service_fare = finance_lines(t)
    status = F.col("o_orderstatus")
    supp_doc = o.select(
        F.col("o_orderkey").alias("supp_doc_no_id"),
        F.col("o_custkey").alias("service_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias("last_action"),
        F.when(status.isin("F", "O"), 2).otherwise(1).alias("sys_sale_side_status"),
        F.when(status == "F", 4).otherwise(3).alias("sys_refund_side_status"),
        F.col("o_orderdate").alias("sale_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 45 DAYS")).alias("refund_date"),
    )
    service_dim = t.customer.select(F.col("c_custkey").alias("service_id"))
    service_type_dim = t.part.select(F.col("p_partkey").alias("service_type_id"))

    transactions = o.select(
        _money("o_totalprice").alias("base_cur_amount"),
        F.when(status == "O", -1).otherwise(1).alias("dr_or_cr"),
        F.col("o_custkey").alias("ac_main_ledger_id"),
        F.col("o_orderkey").alias("ba_documents_id"),
        F.col("o_orderdate").alias("transaction_date"),
    )
    chart = t.customer.select(F.col("c_custkey").alias("ac_chart_of_ac_id"),
                              F.col("c_mktsegment").alias("code"))
    documents = o.select(F.col("o_orderkey").alias("ba_documents_id"),
                         F.col("o_orderpriority").alias("doc_no_code_part"))
    glcode = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("c_custkey").alias("ac_chart_of_ac_id"),
                      F.col("n_nationkey").alias("category")))
    return SimpleNamespace(service_fare=service_fare, supp_doc=supp_doc,
                           service_dim=service_dim, service_type_dim=service_type_dim,
                           transactions=transactions, chart=chart, documents=documents,
                           glcode=glcode)


# --- control tables derived from events / region / nation / supplier -------

def batches_from_events(events: DataFrame) -> DataFrame:
    """One batch per user: start/end = first/last event, FULL when any value < 1."""
    return events.groupBy(F.col("user_id").alias("batch_run_id")).agg(
        F.min("ts").alias("run_start_datetime"),
        F.max("ts").alias("run_end_datetime"),
        F.when(F.min("value") < 1, "FULL").otherwise("DELTA").alias("load_type"),
        F.when(F.max("ts") >= F.lit("2024-01-30 12:00:00"), "RUNNING").otherwise("COMPLETED").alias("run_status"),
    )


def table_audit_from_events(events: DataFrame) -> DataFrame:
    """One table-level audit row per event; status by reconciliation (AG-12)."""
    from strata.operators.control import reconcile
    fetched = F.floor(F.col("value") * 10).cast("bigint")
    processed = (F.when(F.col("value") < 2, F.lit(0))
                 .when(F.col("value") < 4, fetched - 1)
                 .otherwise(fetched))
    base = events.select(
        F.col("event_id").alias("process_id"),
        F.col("user_id").alias("batch_run_id"),
        F.col("event_type").alias("source_table_name"),
        F.concat(F.lit("clean_"), F.col("event_type")).alias("destination_table_name"),
        F.when(F.col("value") > 90, "Post-Clean_Update").otherwise("append").alias("operation"),
        F.col("ts").alias("etl_start_time"),
        F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts")).alias("etl_end_time"),
        F.col("ts").alias("time_to"),
        fetched.alias("input_row"),
        processed.cast("bigint").alias("output_row"),
    )
    return base.withColumn("operation_result", reconcile(F.col("input_row"), F.col("output_row")))


def config_model(t) -> SimpleNamespace:
    """System (region) x database (nation) x table (supplier) configuration."""
    systems = t.region.select(
        F.col("r_regionkey").alias("source_system_id"),
        F.col("r_name").alias("source_system_name"),
        F.when(F.col("r_regionkey").isin(1, 2), 1).otherwise(0).alias("is_multi_db"),
        F.when(F.col("r_regionkey") == 4, 0).otherwise(1).alias("system_is_active"))
    databases = t.nation.select(
        F.col("n_nationkey").alias("source_db_id"),
        F.col("n_name").alias("source_db_code"),
        F.col("n_regionkey").alias("source_system_id"))
    tables = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
              .select(F.col("n_regionkey").alias("source_system_id"),
                      F.col("s_name").alias("source_table_name"),
                      F.floor(F.col("s_acctbal") / 1000).cast("bigint").alias("load_sequence"),
                      F.col("s_suppkey").alias("hierarchy_number"),
                      F.when(F.col("s_acctbal") < 0, "master").otherwise("transaction").alias("table_type"),
                      F.when(F.col("s_nationkey") < 12, "DAILY").otherwise("HOURLY").alias("run_frequency"),
                      F.when(F.col("s_acctbal") > -500, 1).otherwise(0).alias("is_active")))
    return SimpleNamespace(systems=systems, databases=databases, tables=tables)


# --- dirty inputs for the silver steps (built by projection, same in SQL) ---

def dirty_customers(t) -> DataFrame:
    """Customers with injected case / space / blank noise, codes, currencies
    and missing coordinates."""
    c, n = t.customer, t.nation
    seg = F.col("c_mktsegment")
    raw = (F.when(seg == "BUILDING", F.concat(F.lit("  "), F.upper("c_name"), F.lit("   o'neil 3rd  ")))
           .when(seg == "MACHINERY", F.lower("c_name"))
           .when(seg == "AUTOMOBILE", F.lit(""))
           .when(seg == "FURNITURE", F.lit("   "))
           .otherwise(F.col("c_name")))
    nk = F.col("c_nationkey")
    country = (F.when(nk == 0, "US").when(nk == 1, "GB").when(nk == 2, "IN")
               .when(nk == 3, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("N"), nk.cast("string"))))
    rk = F.col("n_regionkey")
    currency = (F.when(rk == 0, "USD").when(rk == 1, "INR").when(rk == 2, "EUR").when(rk == 3, "GBP")
                .otherwise(F.lit(None).cast("string")))
    lat = F.when(F.col("n_nationkey") == 5, F.lit(None).cast("double")).otherwise(F.col("n_nationkey") * 3.5 - 40)
    lon = F.when(F.col("n_nationkey") == 7, F.lit(None).cast("double")).otherwise(F.col("n_nationkey") * 7.0 - 80)
    h = F.md5(F.col("c_name"))
    version = F.when(seg == "BUILDING", F.lit("7")).otherwise(F.lit("4"))
    uuid_text = F.concat(F.lit("  "), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                         version, F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3), F.lit("-"),
                         F.substring(h, 21, 12), F.lit(" "))
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", raw.alias("raw_name"), seg.alias("segment"), country.alias("country"),
                    F.col("c_acctbal").alias("balance"), currency.alias("balance_currency"),
                    lat.alias("latitude"), lon.alias("longitude"), uuid_text.alias("uuid_text")))


def json_parts(t) -> DataFrame:
    """Parts with a JSON cell (some malformed)."""
    p = t.part
    j = (F.when(F.col("p_size") < 3, F.lit("{bad"))
         .otherwise(F.concat(F.lit('{"brand": "'), F.col("p_brand"), F.lit('", "dims": {"size": '),
                             F.col("p_size").cast("string"), F.lit('}, "name": "'), F.col("p_name"),
                             F.lit('"}'))))
    return p.select("p_partkey", j.alias("j"))


def xml_parts(t) -> DataFrame:
    """Parts with a service-details XML cell."""
    p = t.part
    sd = F.concat(F.lit(' SD="2024-01-'), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit('"'))
    ed = F.when(F.col("p_size") > 40, F.lit("")).otherwise(
        F.concat(F.lit(' ED="'), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lit('/01/24"')))
    x = F.concat(F.lit('<ServiceDetailsInfo SC="'), F.col("p_type"), F.lit('"><SN>'), F.col("p_name"),
                 F.lit(" ("), F.col("p_brand"), F.lit(')</SN><IL LOC="City ('),
                 F.upper(F.substring("p_name", 1, 3)), F.lit(')"'), sd, ed, F.lit("/></ServiceDetailsInfo>"))
    size = F.col("p_size")
    broken = (F.when(size < 10, F.concat(F.lit("<a><b>"), F.col("p_name"), F.lit(" & co</b></a>")))
              .when(size < 20, F.concat(F.lit("<a><b>"), F.col("p_name"), F.lit(" &Lt;1&Gt;</b></a>")))
              .when(size < 25, F.concat(F.lit("<a><b>"), F.col("p_name"), F.lit("</a>")))
              .otherwise(F.concat(F.lit("<a><b>"), F.col("p_name"), F.lit("</b></a>"))))
    return p.select("p_partkey", "p_size", x.alias("x"), broken.alias("x2"))


# --- booking model (emission mart and listing) -----------------------------

# Fixed lookup values of the fixture mapping (small reference lists).
TRIP_TYPES = [(0, "One Way"), (1, "Round Trip"), (2, "Multi City"), (3, "Open Jaw"), (4, "Open Return")]
CABIN_CLASSES = [(1, "Economy"), (2, "Business"), (3, "First")]


def _code(c: Column) -> Column:
    """Airport code from a nation key: N00..N24."""
    return F.concat(F.lit("N"), F.lpad(c.cast("string"), 2, "0"))


def service_details(size: Column) -> Column:
    """Service details XML built from part columns (construct-then-parse)."""
    sd = (F.when(size < 15, F.concat(F.lit(' SD="1997-'), F.lpad(size.cast("string"), 2, "0"), F.lit('-20"')))
          .when(size < 35, F.concat(F.lit(' SD="20/'), F.lpad((F.floor(size / 3)).cast("string"), 2, "0"),
                                    F.lit('/24"')))
          .otherwise(F.lit("")))
    ed = F.when(size > 30, F.lit(' ED="2024-12-31"')).otherwise(F.lit(""))
    sc = (F.when(size < 8, "STANDARD").when(size < 16, "premium suite").when(size < 24, "Executive")
          .when(size < 32, "deluxe").when(size < 40, "eco").otherwise("Business"))
    sn = F.when(size > 45, F.lit("")).otherwise(
        F.concat(F.lit("<SN>"), F.col("p_brand"), F.when(size > 20, F.concat(F.lit(" ("), F.col("p_type"), F.lit(")")))
                 .otherwise(F.lit("")), F.lit("</SN>")))
    loc = F.when(size > 42, F.lit("")).otherwise(
        F.concat(F.lit(' LOC="Town ('), F.lower(_code(F.floor(size / 2).cast("int"))), F.lit(')"')))
    return F.concat(F.lit('<ServiceDetailsInfo SC="'), sc, F.lit('">'), sn, F.lit("<IL"), loc, sd, ed,
                       F.lit("/></ServiceDetailsInfo>"))


def booking_model(t) -> SimpleNamespace:
    """Bookings (orders), segments (lineitem), services (part), airports and
    organisations (nation), airlines (supplier), booking files (customer)."""
    spark = t.spark
    o, li, p, n = t.orders, t.lineitem, t.part, t.nation
    booking = o.select(
        F.col("o_orderkey").alias("ID"), F.col("o_custkey").alias("BookingFileID"),
        (F.left(F.col("o_orderpriority"), F.lit(1)).cast("int") - 1).alias("AirTripTypeID"),
        F.when(F.col("o_orderstatus") == "P", 3).otherwise(1).alias("TravelSectorID"),
        (F.col("o_totalprice") - 20000).alias("Amount"),
        F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM").alias("IsDomestic"),
        (F.col("o_orderdate") < F.lit("2001-01-01")).alias("IsActive"),
        F.when(F.col("o_orderstatus") == "F", 16).otherwise(17).alias("BookingStatusID"),
        F.col("o_orderdate").alias("RemitDate"),
        F.col("o_totalprice").alias("AmountNetRemit"))
    booking_file = t.customer.select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("SystemReference"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey"))
         .alias("BookedForOrganizationID"),
        F.when(F.col("c_mktsegment") == "FURNITURE", 15).otherwise(16).alias("BookingFileStatusID"),
        F.col("c_name").alias("CustomerFullName"))
    organization = n.select(F.col("n_nationkey").alias("ID"), (F.col("n_regionkey") != 4).alias("IsActive"),
                            F.col("n_name").alias("Name"))
    trip_type = lookup_table(spark, TRIP_TYPES, "ID int, NameEN string")
    cabin_class = lookup_table(spark, CABIN_CLASSES, "ID int, NameEN string")
    air_traveler = o.select((F.col("o_custkey") + 500000).alias("ID"), F.col("o_orderkey").alias("BookingID"),
                            F.concat(F.lit("ET"), F.col("o_orderkey").cast("string")).alias("ETicketNumber"))
    origin_destination = o.select(F.col("o_orderkey").alias("ID"), F.col("o_orderkey").alias("BookingID"))
    segment = li.select(
        F.col("l_orderkey").alias("AirOriginDestinationID"),
        F.col("l_shipdate").alias("Departure"),
        F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")).alias("Arrival"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
         .alias("BookedAirCabinClassID"),
        F.col("l_suppkey").alias("MarketingAirlineID"),
        (F.col("l_linenumber") - 1 + F.when(F.col("l_linestatus") == "O", 7).otherwise(0)).alias("DepartureAirportID"),
        F.floor(F.col("l_quantity") / 2).cast("int").alias("ArrivalAirportID"))
    airline = t.supplier.select(F.col("s_suppkey").alias("ID"), F.col("s_name").alias("NameEN"))
    airport = n.select(
        F.col("n_nationkey").alias("ID"), _code(F.col("n_nationkey")).alias("IATACode"),
        F.when(F.col("n_nationkey") == 5, F.lit(None).cast("double")).otherwise(F.col("n_nationkey") * 3.5 - 40)
         .alias("Latitude"),
        F.when(F.col("n_nationkey") == 7, F.lit(None).cast("double")).otherwise(F.col("n_nationkey") * 14.0 - 170)
         .alias("Longitude"))
    size, ptype = F.col("p_size"), F.col("p_type")
    a0 = _code(F.floor(size / 2).cast("int"))
    a1 = _code(F.length("p_name") + 10)
    a2 = _code(F.floor((F.col("p_retailprice") - 900) / 4).cast("int"))
    location = F.when(size == 50, F.lit(None).cast("string")).otherwise(
        F.concat(a0, F.lit("-"), a1, F.when(F.col("p_retailprice") >= 950, F.concat(F.lit("-"), a2))
                 .otherwise(F.lit(""))))
    service = p.select(
        F.col("p_partkey").alias("ID"), F.col("p_partkey").alias("BookingFileID"),
        F.when(ptype == "ECONOMY", 13).when(ptype.isin("STANDARD", "SMALL"), 15).when(ptype == "LARGE", 14)
         .when(ptype == "MEDIUM", 20).when(F.col("p_retailprice") < 995, 27).otherwise(31)
         .alias("ServiceTypeID"),
        F.when(size > 45, 20).otherwise(16).alias("BookingStatusID"),
        (F.col("p_retailprice") < 995).alias("IsActive"),
        F.date_add(F.lit("1997-01-01").cast("date"), size).cast("timestamp_ntz").alias("RemitDate"),
        F.when(size > 25, F.concat(F.col("p_brand"), F.lit(" ("), F.upper(F.substring("p_name", 1, 2)), F.lit(")")))
         .otherwise(F.col("p_brand")).alias("NameEN"),
        F.col("p_name").alias("Service"),
        F.when(size < 10, "eco plus").when(size < 20, "Business").when(size < 30, "first row")
         .when(size < 40, "PREMIUM economy").otherwise("std").alias("Service_Class"),
        location.alias("Service_Location"),
        F.concat(F.lit("1997-"), F.lpad((F.floor(size / 5) + 1).cast("string"), 2, "0"), F.lit("-15"))
         .alias("Service_Start_Date"),
        F.lit("1997-12-31").alias("Service_End_Date"),
        F.when(size < 5, F.lit(None).cast("string")).otherwise(F.concat(F.lit("PNR"), F.col("p_partkey").cast("string")))
         .alias("ProviderConfirmationReference"),
        F.col("p_retailprice").alias("AmountNetRemit"),
        service_details(size).alias("Details"))
    service_traveler = p.select((F.col("p_partkey") + 100000).alias("ID"), F.col("p_partkey").alias("ServiceID"))
    return SimpleNamespace(booking=booking, booking_file=booking_file, organization=organization,
                           trip_type=trip_type, cabin_class=cabin_class, air_traveler=air_traveler,
                           origin_destination=origin_destination, segment=segment, airline=airline,
                           airport=airport, service=service, service_traveler=service_traveler)


# Fixed lookup values of the fixture mapping for the listing.
BOOKING_STATUSES = [(16, "Confirmed"), (17, "On Hold"), (20, "Cancelled"), (23, "Refunded")]
SERVICE_TYPES = [(13, "Flight DOM"), (14, "Hotel INT"), (15, "Flight INT"), (20, "Hotel DOM"),
                 (27, "Visa"), (31, "Transfer")]


def listing_model(t) -> SimpleNamespace:
    """Booking model plus the entities only the listing reads."""
    m = SimpleNamespace(**vars(t.memo("booking_model", booking_model) if hasattr(t, "memo") else booking_model(t)))
    spark = t.spark
    o, c, n, r, p = t.orders, t.customer, t.nation, t.region, t.part
    hotel = F.col("o_orderstatus") == "P"
    m.booking = m.booking.withColumns({
        "ValidatingAirlineID": F.floor(F.col("Amount") / 5000).cast("int"),
        "HotelPropertyItemID": F.when(F.col("TravelSectorID") == 3, F.col("BookingFileID")),
        "CheckIn": F.col("RemitDate"),
        "CheckOut": F.col("RemitDate") + F.expr("INTERVAL 3 DAYS"),
        "ProviderConfirmationReference": F.when(F.col("TravelSectorID") == 3,
                                                F.concat(F.lit("HC"), F.col("ID").cast("string"))),
    })
    seg = F.col("c_mktsegment")
    m.booking_file = c.select(
        F.col("c_custkey").alias("ID"), F.col("c_name").alias("SystemReference"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey"))
         .alias("BookedForOrganizationID"),
        F.when(seg == "FURNITURE", 15).otherwise(16).alias("BookingFileStatusID"),
        F.col("c_name").alias("CustomerFullName"),
        F.when(seg.isin("BUILDING", "HOUSEHOLD"), 1).when(seg == "MACHINERY", 2)
         .when(seg == "AUTOMOBILE", 3).otherwise(4).alias("MarketProfileID"))
    m.organization = n.select(
        F.col("n_nationkey").alias("ID"), (F.col("n_regionkey") != 4).alias("IsActive"),
        F.col("n_name").alias("Name"),
        F.when(F.col("n_nationkey") < 10, F.concat(F.lit("Group "), F.col("n_regionkey").cast("string")))
         .alias("OrganizationGroup"),
        F.col("n_regionkey").alias("RelationshipManagerUserID"))
    m.user = r.select(F.col("r_regionkey").alias("ID"), F.col("r_name").alias("FirstName"),
                      F.when(F.col("r_regionkey") == 0, F.lit(None).cast("string")).otherwise(F.lit("Manager"))
                       .alias("LastName"))
    m.air_traveler = o.filter(~hotel).select(
        F.col("o_orderkey").alias("BookingID"), F.col("o_custkey").alias("TravelerID"),
        F.concat(F.lit("ET"), F.col("o_orderkey").cast("string")).alias("ETicketNumber"),
        (F.col("o_totalprice") / 2).alias("AmountNetRemit"))
    m.hotel_traveler = o.filter(hotel | (F.col("o_orderpriority") == "1-URGENT")).select(
        F.col("o_orderkey").alias("BookingID"), (F.col("o_custkey") + 7).alias("TravelerID"))
    m.traveler = c.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("FullName"),
                          F.col("c_custkey").alias("TravelerProfileID"))
    m.traveler_profile = c.select(F.col("c_custkey").alias("ID"), F.col("c_nationkey").alias("OrganizationID"))
    m.booking_status = lookup_table(spark, BOOKING_STATUSES, "ID int, NameEN string")
    m.service_type = lookup_table(spark, SERVICE_TYPES, "ID int, NameEN string")
    m.airport = m.airport.withColumn("CityID", F.col("ID"))
    m.city = n.select(F.col("n_nationkey").alias("ID"),
                      F.concat(F.lit("City_"), F.col("n_nationkey").cast("string")).alias("NameEN"),
                      _code(F.col("n_nationkey")).alias("IATACode"),
                      F.col("n_regionkey").alias("CountryID"),
                      (F.col("n_regionkey").cast("double")
                       + F.when(F.col("n_nationkey") > 20, F.lit(0.5)).otherwise(F.lit(0.0))).alias("UTCDifference"))
    m.country = r.select(F.col("r_regionkey").alias("ID"), F.col("r_name").alias("NameEN"))
    m.hotel_property_item = c.select(F.col("c_custkey").alias("ID"),
                                     F.concat(F.lit("Room "), F.col("c_mktsegment")).alias("NameEN"),
                                     F.col("c_nationkey").alias("HotelPropertyID"))
    m.hotel_property = n.select(F.col("n_nationkey").alias("ID"),
                                F.concat(F.lit("Hotel "), F.col("n_name")).alias("NameEN"),
                                F.col("n_regionkey").alias("DestinationID"))
    m.destination = r.select(F.col("r_regionkey").alias("ID"), F.col("r_regionkey").alias("CountryID"))
    m.city_destination = r.select(F.col("r_regionkey").alias("DestinationID"),
                                  (F.col("r_regionkey") * 5).alias("CityID"))
    m.service_traveler = p.select(F.col("p_partkey").alias("ServiceID"),
                                  (F.col("p_partkey") + 3).alias("TravelerID"))
    return m
