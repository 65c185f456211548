"""Organisation flight-emission mart (PJ-10).

Two branches -- air bookings with their segments, and flight services with a
multi-leg ``A-B-C`` route -- are unioned, priced in km and kg CO2 and sorted.
Inputs are the reference's entities (see ``fixtures.booking_model``).  Every
join is an equi-join; the airport dimension is joined in up to seven roles and
the planner (with adaptive execution's measured sizes) broadcasts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import geo, text


def _airport(airports: DataFrame, role: str) -> DataFrame:
    return airports.select(F.col("ID").alias(f"{role}_id"), F.col("IATACode").alias(f"{role}_code"),
                           F.col("Latitude").alias(f"{role}_lat"), F.col("Longitude").alias(f"{role}_lon"))


def booking_source(m) -> DataFrame:
    """BookingSource + BookingKM."""
    b = m.booking.select(F.col("ID").alias("BookingID"), F.col("BookingFileID").alias("b_bf"),
                         "AirTripTypeID", "TravelSectorID", "Amount", "IsDomestic", "IsActive",
                         "BookingStatusID", "RemitDate")
    bf = m.booking_file.select(F.col("ID").alias("BookingFileID"), F.col("SystemReference").alias("Trip"),
                               F.col("BookedForOrganizationID").alias("org_ref"), "BookingFileStatusID")
    ata = m.trip_type.select(F.col("ID").alias("ata_id"), F.col("NameEN").alias("TripType"))
    at = m.air_traveler.select(F.col("ID").alias("TravelerId"), F.col("BookingID").alias("at_booking"),
                               F.col("ETicketNumber").alias("E_Ticket"))
    org = m.organization.select(F.col("ID").alias("OrganizationId"))
    aod = m.origin_destination.select(F.col("ID").alias("aod_id"), F.col("BookingID").alias("aod_booking"))
    seg = m.segment.select(F.col("AirOriginDestinationID").alias("seg_aod"),
                           F.col("Departure").alias("Start_Date"), F.col("Arrival").alias("End_Date"),
                           "BookedAirCabinClassID", "MarketingAirlineID", "DepartureAirportID",
                           "ArrivalAirportID")
    acc = m.cabin_class.select(F.col("ID").alias("acc_id"), F.col("NameEN").alias("Cabin_Class"))
    aa = m.airline.select(F.col("ID").alias("aa_id"), F.col("NameEN").alias("Airline"))
    dep, arr = _airport(m.airport, "dep"), _airport(m.airport, "arr")

    j = (b.filter((F.col("TravelSectorID") == 1) & (F.col("IsActive") == F.lit(True)))
         .join(bf.filter((F.col("BookingFileStatusID") == 16) & F.col("org_ref").isNotNull()),
               F.col("b_bf") == F.col("BookingFileID"))
         .join(ata, F.col("ata_id") == F.col("AirTripTypeID"))
         .join(at, F.col("at_booking") == F.col("BookingID"))
         .join(org, F.col("org_ref") == F.col("OrganizationId"), "left")
         .join(aod, F.col("aod_booking") == F.col("BookingID"))
         .join(seg, F.col("seg_aod") == F.col("aod_id"))
         .join(acc, F.col("BookedAirCabinClassID") == F.col("acc_id"))
         .join(aa, F.col("aa_id") == F.col("MarketingAirlineID"))
         .join(dep, F.col("DepartureAirportID") == F.col("dep_id"))
         .join(arr, F.col("ArrivalAirportID") == F.col("arr_id")))
    tt = F.col("AirTripTypeID")
    route = (F.when(tt.isin(0, 1), F.concat(F.col("dep_code"), F.lit("-"), F.col("arr_code")))
             .when(tt == 4, F.concat(F.col("dep_code"), F.lit("-"), F.col("arr_code"), F.lit("-*"))))
    km = geo.segment_km(F.col("dep_lat"), F.col("dep_lon"), F.col("arr_lat"), F.col("arr_lon"), tt)
    return j.select(
        "BookingFileID", F.lit("Booking").alias("booking_service_type"), "OrganizationId", "Trip",
        "BookingID", F.col("Start_Date").cast("timestamp_ntz").alias("Start_Date"),
        F.col("End_Date").cast("timestamp_ntz").alias("End_Date"), "TravelerId", "Airline", "TripType",
        "Cabin_Class", "E_Ticket", "RemitDate", route.alias("Route"), km.alias("KM"),
        geo.ticket_status(F.col("Amount"), F.col("IsDomestic"), F.col("BookingStatusID")).alias("Ticket_status"))


def service_source(m) -> DataFrame:
    """ServiceSource + ServiceKM (up to four legs, five airport roles)."""
    s = m.service
    bf = m.booking_file.select(F.col("ID").alias("bf_id"), F.col("SystemReference").alias("Trip"),
                               F.col("BookedForOrganizationID").alias("org_ref"))
    org = m.organization.select(F.col("ID").alias("OrganizationId"), F.col("IsActive").alias("org_active"))
    st = m.service_traveler.select(F.col("ID").alias("TravelerId"), F.col("ServiceID").alias("st_service"))
    loc = F.col("Service_Location")
    j = (s.filter(F.col("ServiceTypeID").isin(*geo.FLIGHT_SERVICE_TYPES) & (F.col("BookingStatusID") == 16)
                  & (F.col("IsActive") == F.lit(True)))
         .join(bf.filter(F.col("org_ref").isNotNull()), F.col("BookingFileID") == F.col("bf_id"))
         .join(org.filter(F.col("org_active") == F.lit(True)), F.col("org_ref") == F.col("OrganizationId"))
         .join(st, F.col("st_service") == F.col("ID"))
         .select(F.col("bf_id").alias("BookingFileID"), "OrganizationId", "Trip",
                 F.col("ID").alias("BookingID"),
                 F.col("Service_Start_Date").cast("date").alias("Start_Date"),
                 F.col("Service_End_Date").cast("date").alias("End_Date"),
                 "TravelerId",
                 text.text_before(F.col("NameEN"), " (", whole_if_absent=True).alias("Airline"),
                 F.col("Service").alias("TripType"),
                 geo.service_cabin(F.col("ServiceTypeID"), F.col("Service_Class")).alias("Cabin_Class"),
                 F.coalesce(F.col("ProviderConfirmationReference"), F.lit("-")).alias("E_Ticket"),
                 "RemitDate", F.coalesce(loc, F.lit("-")).alias("Route"),
                 *[F.split_part(loc, F.lit("-"), F.lit(i + 1)).alias(f"A{i}Code") for i in range(5)]))
    for i in range(5):
        a = _airport(m.airport, f"a{i}").drop(f"a{i}_id")
        j = j.join(a, F.col(f"A{i}Code") == F.col(f"a{i}_code"), "left")
    km = None
    for i in range(4):
        leg = geo.leg_km(F.col(f"a{i}_lat"), F.col(f"a{i}_lon"), F.col(f"a{i + 1}_lat"), F.col(f"a{i + 1}_lon"))
        km = leg if km is None else km + leg
    return j.select("BookingFileID", F.lit("Service").alias("booking_service_type"), "OrganizationId", "Trip",
                    "BookingID", "Start_Date", "End_Date", "TravelerId", "Airline", "TripType", "Cabin_Class",
                    "E_Ticket", "RemitDate", "Route", km.alias("KM"))


def unified(m) -> DataFrame:
    """UNION ALL of both branches; the service dates widen to timestamps (SO-02)."""
    b = booking_source(m).drop("Ticket_status")
    return b.unionByName(service_source(m))


def emitted(m) -> DataFrame:
    """All service rows with their emission, ``ORDER BY RemitDate DESC, OrganizationId`` with
    PostgreSQL null placement (SL-01)."""
    u = unified(m)
    e = u.withColumn("TotalEmission", geo.emission_kg(F.col("KM"), F.col("Cabin_Class")))
    # the ids after the report's order split equal keys over the ranges of the sort
    return e.orderBy(F.col("RemitDate").desc_nulls_first(), F.col("OrganizationId").asc_nulls_last(),
                     "BookingID", "booking_service_type", "TravelerId")


def emission_mart(m, digits: int | None = 6) -> DataFrame:
    """Final projection of the ordered rows.  ``digits`` rounds km and kg."""
    e = emitted(m)
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return (e
            .select(F.col("Trip").alias("trip_id"), F.col("BookingID").alias("booking_service_id"),
                    "booking_service_type", F.col("OrganizationId").alias("organization_id"),
                    F.col("TravelerId").alias("traveler_id"), F.col("TripType").alias("trip_type"),
                    F.col("Airline").alias("airline_name"), F.col("Route").alias("flight_route"),
                    F.col("Cabin_Class").alias("booking_class"), rnd(F.col("KM")).alias("distance"),
                    rnd(F.col("TotalEmission")).alias("emission"),
                    F.col("Start_Date").alias("start_date"), F.col("End_Date").alias("end_date")))
