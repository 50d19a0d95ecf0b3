"""Property tests: strict conversions agree with plain-Python definitions.

Each hypothesis example is a batch of strings evaluated by Spark in one job,
so a few examples cover thousands of inputs.
"""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeworks.functions import strict as S

ALPHABET = "0123456789-,.:+ /aO\n\t٣"
texts = st.lists(st.one_of(st.text(alphabet=ALPHABET, max_size=22),
                           st.from_regex(r"[0-9]{1,21}", fullmatch=True),
                           st.from_regex(r"-?[0-9]{1,4}(,[0-9]{1,3})?", fullmatch=True),
                           st.from_regex(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", fullmatch=True),
                           st.from_regex(r"[0-2][0-9][0-6][0-9][0-6][0-9][0-9]{3}", fullmatch=True)),
                 min_size=50, max_size=300)
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def uint_ok(s, mx):
    return re.fullmatch(r"[0-9]{1,%d}" % len(str(mx)), s) is not None and int(s) <= mx


def price_ok(s):
    return re.fullmatch(r"-?[0-9]+(?:\.[0-9]+)?", s.replace(",", ".")) is not None


def iso_ok(s):
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", s) is None:
        return False
    try:
        dt.date.fromisoformat(s)
    except ValueError:
        return False
    return True


def time_ok(s):
    if re.fullmatch(r"[0-9]{9}", s) is None:
        return False
    h, m, sec = int(s[:2]), int(s[2:4]), int(s[4:6])
    return h < 24 and m < 60 and sec < 60


@SETTINGS
@given(values=texts)
def test_strict_checks_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(
        "v",
        S.uint_pattern_ok("v", 255).alias("p8"), S.uint_range_ok("v", 255).alias("r8"),
        S.uint_pattern_ok("v", 4294967295).alias("p32"), S.uint_range_ok("v", 4294967295).alias("r32"),
        S.uint_pattern_ok("v", 9223372036854775807).alias("p64"),
        S.uint_range_ok("v", 9223372036854775807).alias("r64"),
        S.price_ok("v").alias("price"), S.iso_date_ok("v").alias("iso"), S.time_ok("v").alias("time"),
        S.price_value("v").alias("price_v"),
    ).collect()
    for r in got:
        v = r.v
        assert (r.p8 and r.r8) == uint_ok(v, 255), v
        assert (r.p32 and r.r32) == uint_ok(v, 4294967295), v
        assert (r.p64 and r.r64) == uint_ok(v, 9223372036854775807), v
        assert r.price == price_ok(v), v
        if r.price:
            assert r.price_v == float(v.replace(",", "."))
        assert r.iso == iso_ok(v), v
        assert r.time == time_ok(v), v


def test_empty_to_null_keeps_zero(spark):
    got = spark.createDataFrame([("",), ("0",), ("12",)], "v string").select(
        S.empty_to_null("v").alias("x")).collect()
    assert [r.x for r in got] == [None, "0", "12"]


def test_percent_and_comma(spark):
    got = spark.createDataFrame([("2,92%",), ("2,92",), (None,)], "v string").select(
        S.percent_fraction("v").alias("p"), S.comma_double("v").alias("c")).collect()
    assert abs(got[0].p - 0.0292) < 1e-12 and abs(got[1].p - 0.0292) < 1e-12 and got[2].p is None
    assert got[0].c is None and got[1].c == 2.92
