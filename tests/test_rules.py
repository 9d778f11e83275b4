"""Column-expression rules: bands, safe casts, keys, calendar, exact rounding, dedupe."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.operators.uploads import upload_customer_type
from medistar.sources.calendar import generate_calendar


def test_stock_status_boundaries(spark):
    df = spark.createDataFrame([(u,) for u in [None, -5, 0, 1, 49, 50, 149, 150, 5000, 5001]], "u int")
    got = [r[0] for r in df.select(X.stock_status("u")).collect()]
    assert got == ["Out of Stock", "Out of Stock", "Out of Stock", "Critical", "Critical", "Low Stock", "Low Stock",
                   "In Stock", "In Stock", "Overstock"]


def test_safe_casts(spark):
    df = spark.createDataFrame([(" nan ",), ("None",), ("",), (None,), (" abc ",), ("12.9",), ("-3.7",), ("inf",)],
                               "s string")
    rows = df.select(X.safe_str("s", "D").alias("t"), X.safe_double("s", 0.0).alias("d"),
                     X.safe_int("s", -1).alias("i")).collect()
    assert [r.t for r in rows] == ["D", "D", "D", "D", "abc", "12.9", "-3.7", "inf"]
    assert [r.d for r in rows] == [0.0, 0.0, 0.0, 0.0, 0.0, 12.9, -3.7, 0.0]
    assert [r.i for r in rows] == [-1, -1, -1, -1, -1, 12, -3, -1]


def test_shift_key(spark):
    df = spark.createDataFrame([(20130322,), (20000229,), (0,), (-1,)], "k int")
    got = [r[0] for r in df.select(X.shift_key("k", 12)).collect()]
    # no calendar check: Feb 29 can become an invalid key (dropped later as date_not_found)
    assert got == [20250322, 20120229, 0, -1]


def test_calendar_matches_python(spark):
    cal = generate_calendar(spark, "2019-01-01", "2030-12-31").collect()
    assert len(cal) == (dt.date(2030, 12, 31) - dt.date(2019, 1, 1)).days + 1
    for r in cal:
        d = r.FullDateAlternateKey
        assert r.DateKey == int(d.strftime("%Y%m%d"))
        assert r.WeekNumberOfYear == int(d.strftime("%W"))
        assert r.DayNumberOfWeek == d.weekday() + 1
        assert r.EnglishDayNameOfWeek == d.strftime("%A")
        assert r.EnglishMonthName == d.strftime("%B")
        assert r.FiscalQuarter == ((d.month - 4) % 12) // 3 + 1
        assert r.FiscalYear == (d.year if d.month >= 4 else d.year - 1)
        assert r.IsWeekend == (d.weekday() >= 5)
        assert r.CalendarSemester == (1 if d.month <= 6 else 2)


def test_exact_pct_half_up(spark):
    pairs = [("-13231.2160", "4868.6240"), ("1.0000", "8.0000"), ("-1.0000", "8.0000"), ("77821.2150", "91449.3750"),
             ("0.0001", "3.0000")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in pairs], "p decimal(18,4), n decimal(18,4)")
    got = [r[0] for r in df.select(X.exact_pct("p", "n", 4)).collect()]
    for (a, b), g in zip(pairs, got):
        v = Decimal(a) / Decimal(b) * 100
        want = v.quantize(Decimal("0.0001"), rounding="ROUND_HALF_UP")
        assert Decimal(g) == want, (a, b, g, want)


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", 5, "w")], "k string, o int, v string")
    first = {r.k: r.v for r in X.dedupe(df, ["k"], [F.col("o")], "first").collect()}
    last = {r.k: r.v for r in X.dedupe(df, ["k"], [F.col("o")], "last").collect()}
    assert first == {"a": "y", "b": "w"} and last == {"a": "x", "b": "w"}
    counted = {r.k: r._dups for r in X.dedupe(df, ["k"], [F.col("o")], "first", count_col="_dups").collect()}
    assert counted == {"a": 2, "b": 0}


def test_upload_customer_type_first_match(spark):
    df = spark.createDataFrame([("Wholesale Distributor",), ("retail clinic",), ("GOVERNMENT",), ("unknown",),
                                (None,)], "t string")
    got = [r[0] for r in df.select(upload_customer_type("t")).collect()]
    assert got == ["Wholesale Distributor", "Clinic", "Government", "Hospital", "Hospital"]


def test_zone_is_case_sensitive(spark):
    df = spark.createDataFrame([("India",), ("india",), ("Brazil",)], "c string")
    assert [r[0] for r in df.select(X.zone("c")).collect()] == ["Asia Zone", "International Zone", "International Zone"]


def test_calendar_bound_is_checked(spark):
    import pytest
    with pytest.raises(ValueError, match="exceeds"):
        generate_calendar(spark, "1000-01-01", "2999-12-31")
    with pytest.raises(ValueError, match="empty"):
        generate_calendar(spark, "2030-01-02", "2030-01-01")
