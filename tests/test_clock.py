import datetime as dt

import pytest
from pyspark.sql import functions as F

from runway.functions.clock import (clock_timestamp, delay_minutes, hhmm_minutes,
                                    hhmm_minutes_text, parse_date, parse_hour, weekday_name)
from runway.plans.enrich import enrich_flights

VALID = [h * 100 + m for h in range(24) for m in range(60)] + [2400]


def study_minutes(t: int) -> int:
    """The study's decode: pad with '000', last two digits are minutes."""
    s = "000" + str(t)
    return int(s[:-2]) * 60 + int(s[-2:])


def test_all_clocks_decode(spark):
    df = spark.createDataFrame([(t,) for t in VALID], "t int")
    got = df.select("t", hhmm_minutes("t").alias("a"),
                    hhmm_minutes_text(F.col("t").cast("string")).alias("b")).collect()
    assert len(got) == 1441
    for r in got:
        assert r.a == study_minutes(r.t) == r.b


def test_text_clock_padding_and_junk(spark):
    df = spark.createDataFrame([("0005",), ("517",), (" 2400",), ("x1",), (None,)], "t string")
    got = [r[0] for r in df.select(hhmm_minutes_text("t")).collect()]
    assert got == [5, 317, 1440, None, None]


def _one(spark, date, hhmm, shift):
    df = spark.createDataFrame([(date, hhmm)], "d date, t int")
    return df.select(clock_timestamp("d", "t", shift)).first()[0]


def test_actual_2400_stays_on_date(spark):
    d = dt.date(2013, 8, 22)
    assert _one(spark, d, 2400, 1) == dt.datetime(2013, 8, 22, 23, 59, 59)
    assert _one(spark, d, 2400, 0) == dt.datetime(2013, 8, 23, 0, 0)
    assert _one(spark, d, 0, 1) == dt.datetime(2013, 8, 21, 23, 59, 59)


@pytest.mark.parametrize("shift,expected", [(1, [False, True, True]), (60, [False, False, True])])
def test_delayed_meaning_depends_on_shift(spark, shift, expected):
    rows = [("8/22/2013", 1000, 1000, 1100, 1100), ("8/22/2013", 1000, 1001, 1100, 1101),
            ("8/22/2013", 1000, 1002, 1100, 1102)]
    df = spark.createDataFrame(rows, "date string, sched_dep_time int, dep_time int, "
                                     "sched_arr_time int, arr_time int")
    out = enrich_flights(df, shift_seconds=shift).orderBy("dep_time").collect()
    assert [r.dep_delay > 0 for r in out] == expected
    assert [r.arr_delay > 0 for r in out] == expected


def test_midnight_wrap(spark):
    df = spark.createDataFrame([(dt.date(2013, 1, 1), 2350, 10)], "d date, p int, a int")
    p = clock_timestamp("d", "p")
    a = clock_timestamp("d", "a")
    r = df.select(delay_minutes(a, p).alias("none"),
                  delay_minutes(a, p, wrap="nearest").alias("near")).first()
    assert r.none == -1420.0 and r.near == 20.0


def test_round_half_up(spark):
    df = spark.createDataFrame([(dt.datetime(2013, 1, 1, 0, 0), dt.datetime(2013, 1, 1, 0, 2, 30))],
                               "p timestamp_ntz, a timestamp_ntz")
    assert df.select(delay_minutes("a", "p", round_result=True)).first()[0] == 3.0


def test_dates_and_weekday(spark):
    df = spark.createDataFrame([("8/22/2013",), ("8-22-2013",), ("x",)], "s string")
    got = df.select(parse_date("s", ("M/d/yyyy", "M-d-yyyy")).alias("d")) \
            .select("d", weekday_name("d").alias("w")).collect()
    assert [r.d for r in got] == [dt.date(2013, 8, 22), dt.date(2013, 8, 22), None]
    assert [r.w for r in got][:2] == ["Thursday", "Thursday"]


def test_hour_text_shapes(spark):
    df = spark.createDataFrame([("2013-01-01 05:00:00",), ("1/1/2013 7:00",), ("13:45",), ("?",),
                                ("2013-01-01T23:10",), ("1/1/2013 25:00",)], "s string")
    assert [r[0] for r in df.select(parse_hour("s")).collect()] == [5, 7, 13, None, 23, None]


def test_hour_text_in_dst_gap_keeps_its_hour(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(parse_hour("s")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_zone_does_not_change_results(spark):
    df = spark.createDataFrame([("8/22/2013", 517, 519, 700, 705)],
                               "date string, sched_dep_time int, dep_time int, "
                               "sched_arr_time int, arr_time int")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        a = enrich_flights(df).collect()
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        b = enrich_flights(df).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == b
    assert a[0].sched_dep_ts == dt.datetime(2013, 8, 22, 5, 17)


def test_enrich_accepts_typed_dates_and_text_clocks(spark):
    text = spark.createDataFrame([("8/22/2013", "517", "519", "700", "705")],
                                 "date string, sched_dep_time string, dep_time string, "
                                 "sched_arr_time string, arr_time string")
    typed = spark.createDataFrame([(dt.date(2013, 8, 22), 517, 519, 700, 705)],
                                  "date date, sched_dep_time int, dep_time int, "
                                  "sched_arr_time int, arr_time int")
    a, b = enrich_flights(text).first(), enrich_flights(typed).first()
    assert (a.date, a.dep_delay, a.hour) == (b.date, b.dep_delay, b.hour)
    assert a.date == dt.date(2013, 8, 22) and a.hour == 5


@pytest.mark.parametrize("shift", [1, 60])
def test_enrich_delays_equal_timestamp_differences(spark, shift):
    clocks = VALID[::7] + [0, 2359, 2400]
    rows = [("8/22/2013" if i % 5 else "bad", s, a, s, a)
            for i, (s, a) in enumerate(zip(clocks, reversed(clocks)))]
    df = spark.createDataFrame(rows, "date string, sched_dep_time int, dep_time int, "
                                     "sched_arr_time int, arr_time int")
    e = enrich_flights(df, shift_seconds=shift)
    check = e.select(
        (F.col("dep_delay").eqNullSafe(delay_minutes("dep_ts", "sched_dep_ts"))).alias("dd"),
        (F.col("arr_delay").eqNullSafe(delay_minutes("arr_ts", "sched_arr_ts"))).alias("ad"),
        (F.col("hour").eqNullSafe(F.hour("sched_dep_ts"))).alias("h"),
        F.col("date").isNull().alias("no_date"), F.col("dep_delay").isNull().alias("no_delay"))
    rows = check.collect()
    assert all(r.dd and r.ad and r.h for r in rows)
    assert all(r.no_date == r.no_delay for r in rows)
    assert any(r.no_date for r in rows) and not all(r.no_date for r in rows)
