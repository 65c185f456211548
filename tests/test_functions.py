"""Truth tables for the scalar expressions (F-, S-, D- rows of the inventory)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import codes, dates, geo, semistructured, text
from strata.plans.listing import city_code, repaired_date


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("value,expected", [
    ("o'neil 3rd", "O'Neil 3Rd"), ("HELLO wORLD", "Hello World"), ("", ""), (None, None),
    ("école été", "École Été"), ("a-b_c", "A-B_C"),
])
def test_py_title(spark, value, expected):
    assert one(spark, text.py_title, value) == expected
    if value is not None:
        assert value.title() == expected


@pytest.mark.parametrize("value", ["  hELLO World", "x", "", "ÉCOLE"])
def test_capitalize_and_strip(spark, value):
    assert one(spark, text.py_capitalize, value) == value.capitalize()
    assert one(spark, text.py_strip, " \t\n" + value + " \r\n") == value.strip()


@pytest.mark.parametrize("value,expected", [("", None), ("   ", None), ("a\u0000b", None), (" a ", " a "),
                                            (None, None)])
def test_null_if_blank_or_nul(spark, value, expected):
    assert one(spark, text.null_if_blank_or_nul, value) == expected


@pytest.mark.parametrize("value,expected", [
    ("  123e4567-e89b-42d3-a456-426614174000 ", "123E4567-E89B-42D3-A456-426614174000"),
    ("123e4567-e89b-72d3-a456-426614174000", "123e4567-e89b-72d3-a456-426614174000"),   # version 7
    ("123e4567-e89b-42d3-c456-426614174000", "123e4567-e89b-42d3-c456-426614174000"),   # bad variant
    ("\tplain ", "plain"),
])
def test_uuid_upper(spark, value, expected):
    assert one(spark, text.uuid_upper, value) == expected


@pytest.mark.parametrize("fmt,value,expected", [
    ("MM/DD/YYYY", "1/2/2024", "01/02/2024"), ("MM/DD/YYYY", "13/40/2024", None),
    ("DD-MM-YYYY", "02-01-2024", "02-01-2024"), ("YYYY-MM-DD", "2024-1-2", "2024-01-02"),
    ("YYYY-MM-DD HH:mm:ss", "2024-01-02 3:04:05", "2024-01-02 03:04:05"),
    ("nonsense", "2024-01-02", "2024-01-02"), ("YYYY-MM-DD", "garbage", None),
])
def test_reformat_datetime(spark, fmt, value, expected):
    assert one(spark, lambda c: dates.reformat_datetime(c, fmt), value) == expected


def test_country_currency_value_map(spark):
    assert one(spark, codes.unify_country, "US") == "USA"
    assert one(spark, codes.unify_country, "GB") == "UK"
    assert one(spark, codes.unify_country, "FR") == "FR"
    assert one(spark, codes.unify_country, None) is None
    df = spark.createDataFrame([(100.0, "INR"), (100.0, "EUR"), (100.0, None), (100.0, "XXX")], "v double, c string")
    got = [r[0] for r in df.select(codes.to_base_currency(F.col("v"), F.col("c"))).collect()]
    assert got == [100.0 * 0.012, 100.0 * 1.1, 100.0, 100.0]
    m = {"CONSUMER": ["HOUSEHOLD", "AUTOMOBILE"]}
    assert one(spark, lambda c: codes.unify_values(c, m), "HOUSEHOLD") == "CONSUMER"
    assert one(spark, lambda c: codes.unify_values(c, m), "OTHER") == "OTHER"


def test_integral_floats(spark):
    df = spark.createDataFrame([(1.0, 1.5, None), (2.0, 2.0, None)], "a double, b double, c double")
    out = codes.cast_integral_floats(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "double"}


@pytest.mark.parametrize("value,expected", [
    ("<a><b>x</b></a>", "<a><b>x</b></a>"),
    ("<a><b>x & y</b></a>", "<a><b>x &amp; y</b></a>"),
    ("<a><b>&Lt;1&Gt;</b></a>", "<a><b>&lt;1&gt;</b></a>"),
    ("<a><b>x</a>", None), ("not xml", None), (None, None),
])
def test_repair_xml(spark, value, expected):
    assert one(spark, semistructured.repair_xml, value) == expected


def test_xml_value_and_exists(spark):
    x = '<S SC="eco"><SN>Air (X)</SN><IL LOC="A (dxb)"/></S>'
    assert one(spark, lambda c: semistructured.xml_value(c, "/S/@SC"), x) == "eco"
    assert one(spark, lambda c: semistructured.xml_value(c, "/S/SN"), x) == "Air (X)"
    assert one(spark, lambda c: semistructured.xml_value(c, "/S/IL/@SD"), x) is None
    assert one(spark, lambda c: semistructured.xml_exists(c, "/S/IL/@LOC"), x) is True
    assert one(spark, lambda c: semistructured.xml_exists(c, "/S/IL/@SD"), x) is False
    assert one(spark, lambda c: semistructured.xml_value(c, "/S/@SC"), "<broken") is None


def test_pg_array_and_json(spark):
    df = spark.createDataFrame([([1, None, 3], {"k": 1})], "a array<int>, m map<string,int>")
    r = df.select(semistructured.pg_array_text(F.col("a"), df.schema["a"].dataType).alias("a"),
                  semistructured.json_cell(F.col("m"), df.schema["m"].dataType).alias("m")).first()
    assert r["a"] == "{1,None,3}" and r["m"] == '{"k":1}'


def test_minute_boundaries_and_hours(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0), -5.5)],
                               "a timestamp_ntz, b timestamp_ntz, u double")
    r = df.select(dates.minute_boundaries(F.col("a"), F.col("b")).alias("m"),
                  dates.shift_hours(F.col("a"), F.col("u")).alias("s")).first()
    assert r["m"] == 1                              # T-SQL counts the boundary
    assert r["s"] == dt.datetime(2024, 1, 1, 5, 0, 59)  # fraction dropped


@pytest.mark.parametrize("loc,expected", [("Dubai (dxb)", "DXB"), ("abcdef", "ABC"), ("x (ab", "(AB")])
def test_city_code(spark, loc, expected):
    assert one(spark, city_code, loc) == expected


def test_text_before(spark):
    assert one(spark, lambda c: text.text_before(c, " (", whole_if_absent=True), "Emirates (EK)") == "Emirates"
    assert one(spark, lambda c: text.text_before(c, " (", whole_if_absent=True), "Emirates") == "Emirates"
    assert one(spark, lambda c: text.text_before(c, " (", whole_if_absent=False), "Emirates") == ""
    assert one(spark, lambda c: text.text_before(c, " (", whole_if_absent=False), None) is None
    assert one(spark, lambda c: text.text_before(c, " (", whole_if_absent=True), None) is None


def test_repaired_date(spark):
    df = spark.createDataFrame([(True, "2024-03-15"), (True, "15/03/24"), (False, None)], "e boolean, v string")
    remit = F.lit(dt.datetime(2024, 1, 2))
    got = [r[0] for r in df.select(repaired_date(F.col("e"), F.col("v"), remit)).collect()]
    assert got == ["15/03/2024", "15/03/2024", "02/01/2024"]


def test_great_circle_and_emission(spark):
    df = spark.createDataFrame([(25.0, 55.0, 25.0, 55.0, 1), (0.0, 0.0, 0.0, 90.0, 1), (None, 1.0, 2.0, 3.0, 0)],
                               "a double, b double, c double, d double, t int")
    km = [r[0] for r in df.select(geo.segment_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("t"))).collect()]
    assert km[0] == 0.0                             # identical points: clamp, not NaN
    assert km[1] == pytest.approx(2 * 6371 * 3.141592653589793 / 2)
    assert km[2] == 0.0
    bands = spark.createDataFrame([(785.0, "Economy"), (3700.0, "Economy"), (3700.0, "Business"),
                                   (3700.1, "First class"), (5000.0, "Business")], "k double, c string")
    e = [r[0] for r in bands.select(geo.emission_kg(F.col("k"), F.col("c"))).collect()]
    assert e == pytest.approx([785 * 1.09 * 0.16685, 3700 * 1.09 * 0.09074, 3700 * 1.09 * 0.13612,
                               3700.1 * 1.09 * 0.31816, 5000 * 1.09 * 0.23066])


def test_service_cabin_and_ticket_status(spark):
    df = spark.createDataFrame([(13, "Premium Economy"), (15, "BUSINESS"), (14, "eco"), (13, None)], "t int, c string")
    got = [r[0] for r in df.select(geo.service_cabin(F.col("t"), F.col("c"))).collect()]
    assert got == ["Economy class", "Business class", "Other", "Other"]
    st = spark.createDataFrame([(-1.0, True, 16), (50.0, True, 16), (200.0, False, 16), (300.0, False, 16)],
                               "a double, d boolean, s int")
    got = [r[0] for r in st.select(geo.ticket_status(F.col("a"), F.col("d"), F.col("s"))).collect()]
    assert got == ["Cancelled", "Changed", "Changed", "16"]


def test_wall_clock_functions_ignore_session_zone(spark):
    # 2001-04-01 02:00-03:00 does not exist in Los Angeles; timestamp_ntz
    # arithmetic must not notice
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2001, 3, 31, 23, 0), dt.datetime(2001, 4, 1, 2, 0), 1.0)],
                                   "a timestamp_ntz, b timestamp_ntz, h double")
        r = df.select(dates.minute_boundaries(F.col("a"), F.col("b")).alias("m"),
                      dates.shift_hours(F.col("b"), F.col("h")).alias("s"),
                      dates.format_dmy(F.col("b")).alias("d")).first()
        assert r["m"] == 180
        assert r["s"] == dt.datetime(2001, 4, 1, 3, 0)
        assert r["d"] == "01/04/2001"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_tsql_concat_treats_null_as_empty(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(text.tsql_concat(F.col("x"), F.col("y"), F.col("z"))).first()[0] == "a3"
    assert df.select(F.concat(F.col("x"), F.col("y"))).first()[0] is None      # Pg || propagates NULL


def test_listing_options_beyond_parity(spark):
    from strata.plans.listing import ListingParams, _approved
    df = spark.createDataFrame([(2, dt.datetime(2024, 1, 1, 20, 0), 5.5)], "mp int, r timestamp_ntz, u double")
    parity = df.select(_approved(F.col("mp"), F.col("r"))).first()[0]
    shifted = df.select(_approved(F.col("mp"), F.col("r"), ListingParams(shift_approved_by_market=True))).first()[0]
    assert (parity, shifted) == ("01/01/2024", "02/01/2024")    # 20:00 + 5:30 crosses midnight
    r = df.select(dates.shift_minutes(F.col("r"), -F.col("u")).alias("m"),
                  dates.shift_hours(F.col("r"), -F.col("u")).alias("h")).first()
    assert r["m"] == dt.datetime(2024, 1, 1, 14, 30) and r["h"] == dt.datetime(2024, 1, 1, 15, 0)


def test_nan_to_null_all(spark):
    df = spark.createDataFrame([(float("nan"), 1.5, "x")], "a double, b double, c string")
    r = codes.nan_to_null_all(df).first()
    assert r["a"] is None and r["b"] == 1.5 and r["c"] == "x"


def test_xml_extract_all_reads_leading_text(spark):
    df = spark.createDataFrame([(1, "<a><b>x<c/>tail</b><d k='v'>y</d></a>")], "id int, x string")
    r = semistructured.xml_extract_all(df, "x").first()
    assert r["b"] == "x" and r["d"] == "y" and r["d_attr_k"] == "v"


def test_extract_all_by_cell_with_any_key(spark):
    from strata.operators import clean
    df = spark.createDataFrame([(1, '{"a.b": 1, "c/d": {"x": [1]}, "it\'s": null, "n": "t"}'), (2, "<r><n at='q'> v </n></r>"),
                                (3, None), (4, "{broken"), (5, "[1]")], "id int, v string")
    out = clean.flatten_semistructured(df, {"v": {"extract_all": True}})
    got = {r["id"]: r for r in out.collect()}
    assert got[1]["a.b"] == "1" and got[1]["c/d"] == '{"x":[1]}' and got[1]["it's"] is None and got[1]["n"] == "t"
    assert got[2]["n"] == "v" and got[2]["n_attr_at"] == "q" and got[2]["a.b"] is None
    assert all(got[i]["n"] is None for i in (3, 4, 5))


CELLS = [
    '<r a="1" b=\'x>"y\'><s>one &amp; two</s><s> </s><t z=""/>tail<u><s c="&lt;">three</s>more</u></r>',
    "<?xml version='1.0'?>\n<r>lead<s/>after\r\n<v>x</v></r>\n", "<r><u><s>deep</s></u><s q='2'>flat</s></r>",
    "<r><!-- c --><s>comment</s></r>", "<r><s><![CDATA[<raw>]]></s></r>", "<r><s>&#65;</s></r>",
    "<n:r xmlns:n='u'><n:s n:q='1'>ns</n:s></n:r>", "<r><s>broken</r>", "plain", "", None, "<r/>",
    "<r><s\ta = '1'\n b=\"a\nb\">  padded  </s></r>"]


@pytest.mark.parametrize("key", ["s", "u/s", "r/s", "s/@c", "s/@q", "r/@b", "t/@z", "v", "r", "s/@b", "none"])
def test_tree_reads_what_xpath_reads(spark, key):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(CELLS)], "i int, x string")
    ok = semistructured.is_wellformed_xml(F.col("x"))
    tree = F.when(ok, semistructured.xml_tree(F.col("x")))
    rows = df.select("i", semistructured.flatten_cell(F.col("x"), key).alias("by_xpath"),
                     semistructured.flatten_cell(F.col("x"), key, ok, tree).alias("by_tree")).collect()
    assert [r["by_tree"] for r in rows] == [r["by_xpath"] for r in rows]


def test_unusual_cells_have_no_tree(spark):
    df = spark.createDataFrame([(x,) for x in CELLS[:7]], "x string")
    got = [r[0] for r in df.select(semistructured.xml_tree(F.col("x")).isNull()).collect()]
    assert got == [False, False, False, True, True, True, True]


def test_extract_all_over_mixed_cells(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(CELLS)], "i int, x string")
    got = {r["i"]: r.asDict() for r in semistructured.extract_all(df, "x").collect()}
    assert got[0]["s"] == "three" and got[0]["s_attr_c"] == "<" and got[0]["r_attr_b"] == 'x>"y' and got[0]["t_attr_z"] == ""
    assert got[1]["r"] == "lead" and got[2]["s"] == "flat" and got[5]["s"] == "A" and got[6]["s"] == "ns"
    assert got[12]["s"] == "padded" and got[12]["s_attr_b"] == "a b" and got[7]["s"] is None


def test_extract_all_spreads_the_rows_of_one_split(spark):
    cells = spark.range(0, 400, 1, 1).selectExpr("id", "concat('<r><s>', id, '</s></r>') AS x")
    rows = semistructured.extract_all(cells, "x").withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["id"], r["s"]) for r in rows) == [(i, str(i)) for i in range(400)]
    counts = [sum(r["task"] == t for r in rows) for t in {r["task"] for r in rows}]
    assert len(counts) > 1 and max(counts) <= 100


def test_extract_all_refuses_ids_as_keys_and_taken_names(spark):
    ids = spark.createDataFrame([(f'{{"id{i}": 1}}',) for i in range(30)], "x string")
    with pytest.raises(ValueError, match="more than 20 names"):
        semistructured.flatten(ids, {"x": {"extract_all": True, "max_columns": 20}})
    with pytest.raises(ValueError, match="already has"):
        semistructured.extract_all(spark.createDataFrame([('{"a": 1}', 2)], "x string, a int"), "x")
