"""Property tests: operators against brute-force pandas on small random frames."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from runway.functions.clock import hhmm_minutes_text
from runway.operators.aggregates import argmax_by_group, filtered_share, top_n
from runway.operators.quality import fill_group_mean
from pyspark.sql import functions as F

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.sampled_from(["AA", "UA", "US"]))
vals = st.one_of(st.none(), st.floats(min_value=-1e3, max_value=1e3, allow_nan=False))
rows = st.lists(st.tuples(keys, st.integers(0, 2), vals), min_size=1, max_size=40)


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@SETTINGS
@given(rows)
def test_fill_group_mean_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "carrier string, origin int, air_time double")
    got = sorted(((r.carrier or "", r.origin, r.air_time) for r in
                  fill_group_mean(df, ["carrier", "origin"], ["air_time"]).collect()),
                 key=lambda t: (t[0], t[1], t[2] is None, t[2] or 0))
    pdf = pd.DataFrame(data, columns=["carrier", "origin", "air_time"])
    pdf["air_time"] = pdf["air_time"].astype(float)
    means = pdf.groupby(["carrier", "origin"])["air_time"].transform("mean")
    pdf["air_time"] = pdf["air_time"].fillna(means)
    exp = sorted(((c or "", o, None if pd.isna(v) else v) for c, o, v in
                  pdf.itertuples(index=False)),
                 key=lambda t: (t[0], t[1], t[2] is None, t[2] or 0))
    assert len(got) == len(exp)
    assert all(g[:2] == e[:2] and _close(e[2], g[2]) for g, e in zip(got, exp))


routes = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=60)


@SETTINGS
@given(routes, st.integers(1, 6))
def test_top_n_matches_sorted_counts(spark, data, k):
    df = spark.createDataFrame(data, "origin int, dest int").groupBy("origin", "dest") \
        .agg(F.count(F.lit(1)).alias("n"))
    got = [(r.origin, r.dest, r.n) for r in top_n(df, "n", ["origin", "dest"], k).collect()]
    counts = pd.DataFrame(data, columns=["origin", "dest"]).value_counts().reset_index(name="n")
    exp = counts.sort_values(["n", "origin", "dest"], ascending=[False, True, True]).head(k)
    assert got == [tuple(int(x) for x in t) for t in exp.itertuples(index=False)]


hours = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 23)),
                 min_size=1, max_size=60)


@SETTINGS
@given(hours)
def test_argmax_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "g string, hour int").groupBy("g", "hour") \
        .agg(F.count(F.lit(1)).alias("count"))
    got = {r.g: (r.hour, r["count"]) for r in argmax_by_group(df, "g", "hour", "count").collect()}
    exp = {}
    for g in {g for g, _ in data}:
        c = pd.Series([h for gg, h in data if gg == g]).value_counts()
        best = max(c.items(), key=lambda kv: (kv[1], -kv[0]))
        exp[g] = (int(best[0]), int(best[1]))
    assert got == exp


shares = st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=0, max_size=50)


@SETTINGS
@given(shares, st.integers(0, 3))
def test_share_matches_brute_force(spark, data, origin):
    df = spark.createDataFrame(data, "origin int, dep_delay int")
    r = filtered_share(df, F.col("origin") == origin, F.col("dep_delay") > 0).first()
    total = sum(1 for o, _ in data if o == origin)
    late = sum(1 for o, d in data if o == origin and d > 0)
    assert (r.total, r.delayed) == (total, late)
    assert (r.delayed_pct is None) if total == 0 else _close(late * 100.0 / total, r.delayed_pct)


@SETTINGS
@given(st.lists(st.integers(0, 99999), min_size=1, max_size=30))
def test_text_clock_matches_study_decode(spark, clocks):
    df = spark.createDataFrame([(str(c),) for c in clocks], "t string")
    got = [r[0] for r in df.select(hhmm_minutes_text("t")).collect()]
    exp = []
    for c in clocks:
        s = "000" + str(c)
        exp.append(int(s[:-2]) * 60 + int(s[-2:]))
    assert got == exp
