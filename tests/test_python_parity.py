"""The string and date rules against Python's own behaviour (the reference
runs them as Python callables), on seeded random samples in one DataFrame."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from strata.functions import dates, text

ALPHABET = "abcXYZ éÉüß'-3 \t_.oN"


def _strings(n=500, seed=7):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14))),) for _ in range(n)]


def test_case_rules_match_python(spark):
    data = _strings()
    df = spark.createDataFrame(data, "s string")
    got = df.select("s", text.py_title(F.col("s")).alias("t"), text.py_capitalize(F.col("s")).alias("c"),
                    text.py_strip(F.col("s")).alias("p"), text.trim_title(F.col("s")).alias("tt")).collect()
    for r in got:
        s = r["s"]
        assert r["t"] == s.title(), s
        assert r["p"] == s.strip(), s
        assert r["tt"] == re.sub(r"\s+", " ", s.strip()).title(), s
        assert r["c"] == s.capitalize(), s


UUID = re.compile(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-5][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$")


def test_uuid_rule_matches_python(spark):
    rnd = random.Random(11)
    hexd = "0123456789abcdefABCDEF"
    data = []
    for _ in range(300):
        parts = ["".join(rnd.choice(hexd) for _ in range(k)) for k in (8, 4, 4, 4, 12)]
        parts[2] = rnd.choice("12345679") + parts[2][1:]
        parts[3] = rnd.choice("89abABcf") + parts[3][1:]
        data.append((rnd.choice(["", " ", "\t"]) + "-".join(parts) + rnd.choice(["", " ", "\n"]),))
    got = spark.createDataFrame(data, "s string").select("s", text.uuid_upper(F.col("s")).alias("u")).collect()
    for r in got:
        v = r["s"].strip()
        assert r["u"] == (v.upper() if UUID.match(v) else v), r["s"]


FORMATS = {"YYYY-MM-DD": "%Y-%m-%d", "YYYY-MM-DD HH:mm:ss": "%Y-%m-%d %H:%M:%S",
           "MM/DD/YYYY": "%m/%d/%Y", "DD-MM-YYYY": "%d-%m-%Y"}


def test_datetime_formats_match_strptime(spark):
    rnd = random.Random(5)
    rows = []
    for name, fmt in FORMATS.items():
        for _ in range(60):
            d = dt.datetime(2000, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 25 * 365 * 86400))
            text_value = d.strftime(fmt)
            if rnd.random() < 0.2:
                text_value = text_value.replace("1", "x", 1)        # broken value
            rows.append((name, text_value))
    df = spark.createDataFrame(rows, "f string, v string")
    for name, fmt in FORMATS.items():
        sub = df.filter(F.col("f") == name).select("v", dates.reformat_datetime(F.col("v"), name).alias("r"))
        for r in sub.collect():
            try:
                expected = dt.datetime.strptime(r["v"], fmt).strftime(fmt)
            except ValueError:
                expected = None
            assert r["r"] == expected, (name, r["v"])


# Worked by hand: text in, what repair gives (None: not to be repaired).
REPAIRS = [
    ("<a>x</a>", "<a>x</a>"), ("<a x='1'/>", "<a x='1'/>"), ("<a>&amp;&lt;</a>", "<a>&amp;&lt;</a>"),
    ("<a>&#38;</a>", "<a>&#38;</a>"), ("<?xml version='1.0'?><a>b</a>", "<?xml version='1.0'?><a>b</a>"),
    ("<a>x & y</a>", "<a>x &amp; y</a>"), ("<a>&Lt;b&Gt;</a>", "<a>&lt;b&gt;</a>"), ("<a>&&amp;</a>", "<a>&amp;&amp;</a>"),
    ("<a>&#38; & z</a>", "<a>&amp;#38; &amp; z</a>"), ('<a x="1&2"/>', '<a x="1&amp;2"/>'), ("<a>&nbsp;</a>", "<a>&amp;nbsp;</a>"),
    ("<a>&</a><b/>", None), ("<a><b></a>", None), ("<a/><b/>", None), ("plain", None), ("", None), ("<a>< b</a>", None),
    ("<a>&</b>", None), ("<a x=1/>", None)]


def test_xml_repair_table(spark):
    from strata.functions import semistructured
    df = spark.createDataFrame(REPAIRS, "s string, wanted string")
    for r in df.select("s", "wanted", semistructured.repair_xml(F.col("s")).alias("r")).collect():
        assert r["r"] == r["wanted"], r["s"]
