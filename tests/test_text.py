"""Text cleaning: location parsing cases, platform prefixes, Python-style strip."""

import pytest
from pyspark.sql import functions as F

from postmart.functions import text as X


@pytest.mark.parametrize("loc, city, state", [
    ("Russia", "Russia", None),
    ("San Francisco, CA", "San Francisco", "CA"),
    ("Rio de Janeiro, State of Rio de Janeiro, Brazil", "Rio de Janeiro", "State of Rio de Janeiro"),
    ("", None, None), (None, None, None),
    ("a, b, c, d", "a", "b"), (" , x", None, "x"), ("   ", None, None), ("a,", "a", None),
])
def test_parse_location(spark, loc, city, state):
    df = spark.createDataFrame([(loc,)], "loc string")
    c, s = X.parse_location("loc")
    row = df.select(c.alias("c"), s.alias("s")).first()
    assert (row["c"], row["s"]) == (city, state)


@pytest.mark.parametrize("raw, clean", [
    ("via LinkedIn", "LinkedIn"), ("VIA Indeed", "Indeed"), ("Melalui  Jobstreet", "Jobstreet"),
    ("melalui\tX", "X"), (" via LinkedIn", "via LinkedIn"), ("via ", ""), ("viaduct", "viaduct"),
    ("LinkedIn ", "LinkedIn"), ("via via X", "via X"),
])
def test_clean_platform(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(X.clean_platform("v")).first()[0] == clean


def test_py_strip_matches_python(spark):
    samples = ["  a ", "\ta\n", "\x1cx\x1f", " y　", "z ", "​q", "", "mid dle"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r[0] for r in df.select(X.py_strip("v")).collect()]
    assert got == [s.strip() for s in samples]


def test_sql_trim_is_spaces_only(spark):
    df = spark.createDataFrame([("\tpython ",)], "v string")
    row = df.select(X.skill_name("v").alias("dim"), X.skill_match_key("v").alias("match")).first()
    assert row["dim"] == "python" and row["match"] == "\tpython"
