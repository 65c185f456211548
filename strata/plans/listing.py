"""Booking and service listing for one market (PJ-08).

Two branches with 22 columns each, combined with ``UNION`` (distinct, SO-01):

* bookings: traveler found through the air *or* the hotel traveler (JN-04,
  rewritten as two equi-joins), an itinerary rollup per booking (AG-08,
  joined as a pre-aggregated sub-query, JN-06), hotel chain lookups;
* services: labels cut from the ``Details`` XML (D-06, D-08, D-10) and the
  hotel country found from a city code cut out of that XML (JN-07, D-09).

Left joins to entities whose columns the output never reads (hotel room stay,
room type, traveler profile) are left out: at most they repeat a row, and the
final UNION is distinct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import dates, semistructured, text
from strata.operators.joins import left_join_any_key, left_join_spread, ordered_string_agg

# Fixed values of the reference.
MARKETS = {1: "UAE", 2: "India", 3: "Qatar", 4: "Saudi Arabia"}
NET_REMIT_STATUSES = (16, 20, 23)
FLIGHT_TYPES = (13, 15)
HOTEL_TYPES = (14, 20, 27, 31)
DOMESTIC_LABEL_SERVICE = "Domastic"  # spelled as the reference prints it
ROOM_RULES = (("%STAND%", "Standard room"), ("%PREMI%", "Deluxe room"), ("%exec%", "Executive room"),
              ("%lux%", "Deluxe room"), ("%ECO%", "Standard room"))
CABIN_RULES = (("%STAND%", "Economy class"), ("%eco%", "Economy class"), ("%Busi%", "Business class"),
               ("%First%", "First class"), ("%PREMIUM%", "Premium economy class"))

# Fixed values of the reference: the service details paths.
SC = "/ServiceDetailsInfo/@SC"
SN = "/ServiceDetailsInfo/SN"
LOC = "/ServiceDetailsInfo/IL/@LOC"
SD = "/ServiceDetailsInfo/IL/@SD"
ED = "/ServiceDetailsInfo/IL/@ED"

COLUMNS = ["dom_int", "trip_reference", "id", "market", "organization_id", "organization", "rm", "approved",
           "category", "e_ticket_number", "ticket_status", "for_name", "in_label", "on_at", "route_city",
           "hotel_country", "from_date", "to_date", "flight_time", "amount", "estimated_traveler", "org_group"]


# Fixed values of the reference: market offsets passed to TODATETIMEOFFSET.
MARKET_OFFSETS_HOURS = {1: 4, 2: 5.5, 3: 3, 4: 3}


@dataclass(frozen=True)
class ListingParams:
    remit_from: str = "2025-11-17 20:00:00"
    remit_to: str = "2025-12-17 20:00:00"
    market_profile_id: int = 1
    organization_ids: tuple | None = (14688,)
    # options beyond the reference (survey quirks 21, 22); defaults keep parity
    shift_approved_by_market: bool = False     # print the remit date in the market's local time
    utc_offset_in_minutes: bool = False        # apply UTC+5:30 as 330 minutes, not 5 hours


def _market_label(mp: Column) -> Column:
    e = None
    for k, v in MARKETS.items():
        e = F.when(mp == k, F.lit(v)) if e is None else e.when(mp == k, F.lit(v))
    return e


def _approved(mp: Column, remit: Column, p: "ListingParams | None" = None) -> Column:
    # TODATETIMEOFFSET attaches an offset without moving the clock, so the
    # printed date is the stored one for every market (quirk 21); the option
    # moves the clock by the market's offset first.
    if p is not None and p.shift_approved_by_market:
        offset = None
        for k, h in MARKET_OFFSETS_HOURS.items():
            e = F.lit(int(round(h * 60)))
            offset = F.when(mp == k, e) if offset is None else offset.when(mp == k, e)
        remit = F.timestamp_add("MINUTE", offset, remit)
    return F.when(mp.isin(*MARKETS.keys()), dates.format_dmy(remit))


def itinerary_rollup(m, bookings: DataFrame | None = None, utc_offset_in_minutes: bool = False) -> DataFrame:
    """Per booking: flight minutes (halved for round trips), first departure,
    last arrival, lowest cabin name, route list (AG-08).

    ``bookings`` (rows of the booking table) restricts the rollup to those a
    report selects: the result is then left-joined on the booking id, so the
    rows are the same, but a one-month report no longer aggregates every
    segment ever booked.
    """
    aod = m.origin_destination.select(F.col("ID").alias("aod_id"), F.col("BookingID").alias("bid"))
    seg = m.segment.select("AirOriginDestinationID", "Departure", "Arrival", "BookedAirCabinClassID",
                           "DepartureAirportID", "ArrivalAirportID")
    cab = m.cabin_class.select(F.col("ID").alias("cab_id"), F.col("NameEN").alias("cabin"))
    a1 = m.airport.select(F.col("ID").alias("a1_id"), F.col("IATACode").alias("a1_code"), F.col("CityID").alias("a1_city"))
    a2 = m.airport.select(F.col("ID").alias("a2_id"), F.col("IATACode").alias("a2_code"), F.col("CityID").alias("a2_city"))
    c1 = m.city.select(F.col("ID").alias("c1_id"), F.col("UTCDifference").alias("utc1"))
    c2 = m.city.select(F.col("ID").alias("c2_id"), F.col("UTCDifference").alias("utc2"))
    b = (m.booking if bookings is None else bookings).select(F.col("ID").alias("b_id"), "AirTripTypeID")
    j = (b.join(aod, F.col("b_id") == F.col("bid"))
         .join(seg, F.col("AirOriginDestinationID") == F.col("aod_id"))
         .join(cab, F.col("BookedAirCabinClassID") == F.col("cab_id"))
         .join(a1, F.col("DepartureAirportID") == F.col("a1_id"))
         .join(c1, F.col("a1_city") == F.col("c1_id"))
         .join(a2, F.col("ArrivalAirportID") == F.col("a2_id"))
         .join(c2, F.col("a2_city") == F.col("c2_id")))
    shift = dates.shift_minutes if utc_offset_in_minutes else dates.shift_hours
    minutes = dates.minute_boundaries(shift(F.col("Departure"), -F.col("utc1")),
                                      shift(F.col("Arrival"), -F.col("utc2")))
    leg = F.concat_ws("-", F.col("a1_code"), F.col("a2_code"))
    g = j.groupBy("b_id", "AirTripTypeID").agg(
        F.sum(minutes).alias("_minutes"),
        F.min("Departure").alias("_first"), F.max("Arrival").alias("_last"),
        F.min("cabin").alias("In"),
        ordered_string_agg(leg, [F.col("Departure"), F.col("a1_code"), F.col("a2_code")], ", ").alias("Route"))
    flight_time = F.when(F.col("AirTripTypeID") == 1, F.expr("_minutes div 2")).otherwise(F.col("_minutes"))
    return g.select(F.col("b_id").alias("ID"), flight_time.cast("bigint").alias("Flight_Time"),
                    dates.format_dmy(F.col("_first")).alias("From"), dates.format_dmy(F.col("_last")).alias("To"),
                    "In", "Route")


def traveler_via_air_or_hotel(bookings: DataFrame, m) -> DataFrame:
    """Bookings with air and hotel travelers, then the traveler matched by
    either (JN-04)."""
    at = m.air_traveler.select(F.col("BookingID").alias("at_booking"), F.col("TravelerID").alias("at_traveler"),
                               F.col("ETicketNumber").alias("at_eticket"),
                               F.col("AmountNetRemit").alias("at_amount"))
    ht = m.hotel_traveler.select(F.col("BookingID").alias("ht_booking"), F.col("TravelerID").alias("ht_traveler"))
    base = (bookings.join(at, F.col("at_booking") == F.col("B_ID"), "left")
            .join(ht, F.col("ht_booking") == F.col("B_ID"), "left"))
    trav = m.traveler.select("ID", "FullName", "TravelerProfileID")
    return left_join_any_key(base, trav, "ID", ["at_traveler", "ht_traveler"], "T_")


def _own_conditions(p: ListingParams) -> Column:
    """The report's predicates on the booking / service row itself."""
    return (F.col("RemitDate").between(F.lit(p.remit_from), F.lit(p.remit_to))
            & (F.col("BookingStatusID") > 0) & (F.col("IsActive") == F.lit(True)) & F.col("RemitDate").isNotNull())


def booking_branch(m, p: ListingParams) -> DataFrame:
    b = m.booking.select(
        F.col("ID").alias("B_ID"), F.col("BookingFileID").alias("b_bf"), "IsDomestic", "TravelSectorID",
        "RemitDate", "BookingStatusID", "IsActive", "AmountNetRemit", "ValidatingAirlineID",
        "HotelPropertyItemID", "CheckIn", "CheckOut", "ProviderConfirmationReference")
    bf = m.booking_file.select(F.col("ID").alias("BF_ID"), "SystemReference", "BookedForOrganizationID",
                               "MarketProfileID", "CustomerFullName")
    org = m.organization.select(F.col("ID").alias("Org_ID"), F.col("Name").alias("Org_Name"),
                                "OrganizationGroup", "RelationshipManagerUserID")
    usr = m.user.select(F.col("ID").alias("U_ID"), "FirstName", "LastName")
    cond = (F.col("RemitDate").between(F.lit(p.remit_from), F.lit(p.remit_to))
            & F.col("BookedForOrganizationID").isNotNull() & (F.col("MarketProfileID") == p.market_profile_id)
            & (F.col("BookingStatusID") > 0) & (F.col("IsActive") == F.lit(True)) & F.col("RemitDate").isNotNull())
    if p.organization_ids:
        cond = cond & F.col("Org_ID").isin(*p.organization_ids)
    j = (bf.join(b, F.col("BF_ID") == F.col("b_bf"))
         .join(org, F.col("BookedForOrganizationID") == F.col("Org_ID"))
         .join(usr, F.col("RelationshipManagerUserID") == F.col("U_ID"), "left")
         .filter(cond))
    j = traveler_via_air_or_hotel(j, m)
    airline = m.airline.select(F.col("ID").alias("AL_ID"), F.col("NameEN").alias("AL_Name"))
    status = m.booking_status.select(F.col("ID").alias("BS_ID"), F.col("NameEN").alias("BS_Name"))
    # bookings the report can select, from booking-level predicates only (one
    # filtered scan, no join): the rollup then covers the report period only
    selected = m.booking.filter(_own_conditions(p) & (F.col("TravelSectorID") == 1))
    route = itinerary_rollup(m, selected, p.utc_offset_in_minutes).select(F.col("ID").alias("ARI_ID"), *[F.col(c).alias(f"ARI_{c}") for c in
                                                                      ("Flight_Time", "From", "To", "In", "Route")])
    hpi = m.hotel_property_item.select(F.col("ID").alias("HPI_ID"), F.col("NameEN").alias("HPI_Name"),
                                       "HotelPropertyID")
    hp = m.hotel_property.select(F.col("ID").alias("HP_ID"), F.col("NameEN").alias("HP_Name"), "DestinationID")
    dst = m.destination.select(F.col("ID").alias("D_ID"), F.col("CountryID").alias("D_Country"))
    cd = m.city_destination.select(F.col("DestinationID").alias("CD_Dest"), F.col("CityID").alias("CD_City"))
    city = m.city.select(F.col("ID").alias("C_ID"), F.col("NameEN").alias("C_Name"))
    ctry = m.country.select(F.col("ID").alias("K_ID"), F.col("NameEN").alias("K_Name"))
    j = (j.join(airline, F.col("ValidatingAirlineID") == F.col("AL_ID"), "left")
         .join(status, F.col("BS_ID") == F.col("BookingStatusID"))
         .join(route, F.col("ARI_ID") == F.col("B_ID"), "left"))
    # only hotel bookings have a room: most keys are NULL
    j = left_join_spread(j, hpi, "HotelPropertyItemID", "HPI_ID", F.xxhash64("B_ID"))
    j = (j.join(hp, F.col("HP_ID") == F.col("HotelPropertyID"), "left")
         .join(dst, F.col("D_ID") == F.col("DestinationID"), "left")
         .join(cd, F.col("D_ID") == F.col("CD_Dest"), "left")
         .join(city, F.col("CD_City") == F.col("C_ID"), "left")
         .join(ctry, F.col("K_ID") == F.col("D_Country"), "left"))
    sector = F.col("TravelSectorID")
    air, htl = sector == 1, sector == 3
    mp = F.col("MarketProfileID")
    return j.select(
        F.when(F.col("IsDomestic") == F.lit(True), "Domestic").otherwise("International").alias("dom_int"),
        F.col("SystemReference").alias("trip_reference"),
        F.concat_ws("-", F.lit("B"), F.col("B_ID").cast("string")).alias("id"),
        _market_label(mp).alias("market"),
        F.col("Org_ID").cast("bigint").alias("organization_id"), F.col("Org_Name").alias("organization"),
        F.concat_ws(" ", F.col("FirstName"), F.col("LastName")).alias("rm"),
        _approved(mp, F.col("RemitDate"), p).alias("approved"),
        F.when(air, "Flight").when(htl, "Hotel").alias("category"),
        F.coalesce(F.when(htl, F.col("ProviderConfirmationReference")).otherwise(F.col("at_eticket")),
                   F.lit("-")).alias("e_ticket_number"),
        F.col("BS_Name").alias("ticket_status"),
        F.upper(F.col("CustomerFullName")).alias("for_name"),
        F.when(air, F.col("ARI_In")).when(htl, F.col("HPI_Name")).alias("in_label"),
        F.when(air, F.coalesce(F.col("AL_Name"), F.lit("-"))).when(htl, F.coalesce(F.col("HP_Name"), F.lit("-")))
         .alias("on_at"),
        F.when(air, F.col("ARI_Route")).when(htl, F.col("C_Name")).alias("route_city"),
        F.when(air, F.lit("-")).when(htl, F.col("K_Name")).alias("hotel_country"),
        F.when(air, F.col("ARI_From")).when(htl, dates.format_dmy(F.col("CheckIn"))).alias("from_date"),
        F.when(air, F.col("ARI_To")).when(htl, dates.format_dmy(F.col("CheckOut"))).alias("to_date"),
        F.when(air, F.col("ARI_Flight_Time")).when(htl, F.lit(0).cast("bigint")).alias("flight_time"),
        F.when(air & F.col("BookingStatusID").isin(*NET_REMIT_STATUSES), F.coalesce(F.col("at_amount"), F.lit(0.0)))
         .otherwise(F.coalesce(F.col("AmountNetRemit"), F.lit(0.0))).alias("amount"),
        F.upper(F.col("T_FullName")).alias("estimated_traveler"),
        F.coalesce(F.col("OrganizationGroup"), F.lit("-")).alias("org_group"))


def city_code(loc: Column) -> Column:
    """``UPPER(RIGHT(SUBSTRING(loc, PATINDEX('%(%', loc), 4), 3))`` (D-09).

    With no ``(`` T-SQL's ``SUBSTRING(x, 0, 4)`` keeps 3 characters, so the
    result is the first three; Spark's ``substring(x, 0, 4)`` would keep 4.
    """
    pos = F.instr(loc, "(")
    return F.upper(F.when(pos == 0, F.left(loc, F.lit(3)))
                   .otherwise(F.right(F.substring(loc, pos, 4), F.lit(3))))


def code_country(m) -> DataFrame:
    """City code -> country."""
    city = m.city.select(F.col("IATACode"), F.col("CountryID"))
    ctry = m.country.select(F.col("ID").alias("K_ID"), F.col("NameEN").alias("Country"))
    return city.join(ctry, F.col("K_ID") == F.col("CountryID")).select("IATACode", "Country")


def service_country(m) -> DataFrame:
    """Hotel services -> city code from the XML location -> city -> country (JN-07)."""
    s = m.service.filter(F.col("ServiceTypeID").isin(*HOTEL_TYPES))
    loc = semistructured.XmlDoc(F.col("Details"), [LOC]).value(LOC)
    w = s.select(F.col("ID").alias("ServiceID"), city_code(loc).alias("CityIATA"))
    return (w.join(code_country(m), F.col("IATACode") == F.col("CityIATA"))
            .select(F.col("ServiceID").alias("CI_ID"), "Country"))


def _label(rules, attr: Column) -> list:
    return [(attr.ilike(pat), lab) for pat, lab in rules]


def repaired_date(attr_exists: Column, value: Column, remit: Column) -> Column:
    """Service date text (D-10): ``yyyy-mm-dd`` -> ``dd/mm/yyyy``; ``../yy`` ->
    ``../20yy`` (every occurrence of the last three characters, as the
    reference's REPLACE does); attribute missing -> remit date."""
    v = F.left(value, F.lit(20))
    iso = F.concat(F.right(v, F.lit(2)), F.lit("/"), F.substring(v, F.instr(v, "-") + 1, F.lit(2)),
                   F.lit("/"), F.left(v, F.lit(4)))
    tail = F.right(value, F.lit(3))
    short = F.replace(value, tail, F.replace(tail, F.lit("/"), F.lit("/20")))
    return (F.when(attr_exists & v.like("____-%"), iso)
            .when(attr_exists, short)
            .otherwise(dates.format_dmy(remit)))


def service_branch(m, p: ListingParams) -> DataFrame:
    s = m.service.select(F.col("ID").alias("S_ID"), F.col("BookingFileID").alias("s_bf"), "ServiceTypeID",
                         "BookingStatusID", "IsActive", "RemitDate", "ProviderConfirmationReference",
                         "Details", "AmountNetRemit")
    bf = m.booking_file.select(F.col("ID").alias("BF_ID"), "SystemReference", "BookedForOrganizationID",
                               "MarketProfileID", "CustomerFullName")
    org = m.organization.select(F.col("ID").alias("Org_ID"), F.col("Name").alias("Org_Name"),
                                "OrganizationGroup", "RelationshipManagerUserID")
    usr = m.user.select(F.col("ID").alias("U_ID"), "FirstName", "LastName")
    st = m.service_traveler.select(F.col("ServiceID").alias("ST_Service"), F.col("TravelerID").alias("ST_Traveler"))
    trav = m.traveler.select(F.col("ID").alias("T_ID"), F.col("FullName").alias("T_FullName"))
    status = m.booking_status.select(F.col("ID").alias("BS_ID"), F.col("NameEN").alias("BS_Name"))
    stype = m.service_type.select(F.col("ID").alias("STY_ID"), F.col("NameEN").alias("STY_Name"))
    cond = (F.col("RemitDate").between(F.lit(p.remit_from), F.lit(p.remit_to))
            & F.col("BookedForOrganizationID").isNotNull() & (F.col("MarketProfileID") == p.market_profile_id)
            & (F.col("BookingStatusID") > 0) & (F.col("IsActive") == F.lit(True)) & F.col("RemitDate").isNotNull())
    if p.organization_ids:
        cond = cond & F.col("Org_ID").isin(*p.organization_ids)
    j = (bf.join(s, F.col("BF_ID") == F.col("s_bf"))
         .join(org, F.col("BookedForOrganizationID") == F.col("Org_ID"))
         .join(usr, F.col("RelationshipManagerUserID") == F.col("U_ID"), "left")
         .filter(cond)
         .join(st, F.col("S_ID") == F.col("ST_Service"), "left")
         .join(trav, F.col("ST_Traveler") == F.col("T_ID"), "left")
         .join(status, F.col("BS_ID") == F.col("BookingStatusID"))
         .join(stype, F.col("ServiceTypeID") == F.col("STY_ID"), "left")
         )
    # one parse of the Details XML per row serves all seven reads
    doc = semistructured.XmlDoc(F.col("Details"), [SC, SN, LOC, SD, ED])
    j = doc.bind(j, "_doc")
    sc, sn, loc, sd, ed = (doc.value(p_) for p_ in (SC, SN, LOC, SD, ED))
    # the country comes from the same parse: no second scan of the services
    j = j.withColumn("_code", F.when(F.col("ServiceTypeID").isin(*HOTEL_TYPES), city_code(loc)))
    j = j.join(code_country(m), F.col("_code") == F.col("IATACode"), "left")
    t = F.col("ServiceTypeID")
    hotel, flight = t.isin(*HOTEL_TYPES), t.isin(*FLIGHT_TYPES)
    in_label = None
    for cond_, lab in [(hotel & c, l) for c, l in _label(ROOM_RULES, sc)] + \
                      [(flight & c, l) for c, l in _label(CABIN_RULES, sc)]:
        in_label = F.when(cond_, F.lit(lab)) if in_label is None else in_label.when(cond_, F.lit(lab))
    in_label = in_label.otherwise(F.lit("Other"))
    on_at = (F.when(flight, F.coalesce(F.trim(text.text_before(sn, " (", whole_if_absent=False)), F.lit("-")))
             .when(hotel, F.trim(sn)).otherwise(F.lit("-")))
    name = F.col("STY_Name")
    mp = F.col("MarketProfileID")
    return j.select(
        F.when(name.ilike("%DOM%"), DOMESTIC_LABEL_SERVICE).when(name.ilike("%INT%"), "International")
         .otherwise("-").alias("dom_int"),
        F.col("SystemReference").alias("trip_reference"),
        F.concat_ws("-", F.lit("S"), F.col("S_ID").cast("string")).alias("id"),
        _market_label(mp).alias("market"),
        F.col("Org_ID").cast("bigint").alias("organization_id"), F.col("Org_Name").alias("organization"),
        F.concat_ws(" ", F.col("FirstName"), F.col("LastName")).alias("rm"),
        _approved(mp, F.col("RemitDate"), p).alias("approved"),
        F.when(flight, "Flight").when(hotel, "Hotel").otherwise(name).alias("category"),
        F.coalesce(F.col("ProviderConfirmationReference"), F.lit("-")).alias("e_ticket_number"),
        F.col("BS_Name").alias("ticket_status"),
        F.col("CustomerFullName").alias("for_name"),
        in_label.alias("in_label"), on_at.alias("on_at"),
        F.coalesce(loc, F.lit("-")).alias("route_city"),
        F.coalesce(F.col("Country"), F.lit("-")).alias("hotel_country"),
        repaired_date(doc.exists(SD), sd, F.col("RemitDate")).alias("from_date"),
        repaired_date(doc.exists(ED), ed, F.col("RemitDate")).alias("to_date"),
        F.lit(0).cast("bigint").alias("flight_time"),
        F.coalesce(F.col("AmountNetRemit"), F.lit(0.0)).alias("amount"),
        F.coalesce(F.upper(F.col("T_FullName")), F.lit("-")).alias("estimated_traveler"),
        F.coalesce(F.col("OrganizationGroup"), F.lit("-")).alias("org_group"))


def listing(m, p: ListingParams = ListingParams()) -> DataFrame:
    """``booking branch UNION service branch`` (distinct, by position)."""
    return booking_branch(m, p).select(*COLUMNS).union(service_branch(m, p).select(*COLUMNS)).distinct()
