from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casario.operators import distribution as D

PROBS = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}


def brute(values):
    x = np.array(values, dtype="float32").astype("float64")
    return {name: float(np.quantile(x, p)) for name, p in PROBS.items()}


def spread_quantiles(frame, keys):
    counts = D.value_counts(frame, keys, {"v": F.col("v")})
    return D.quantiles(counts, keys, {name: ("v", p) for name, p in PROBS.items()})


def close(row, expected):
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-30), name


@example([831289443745792.0, 2153597.0])
@settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(
    st.lists(
        st.one_of(
            st.floats(width=32, allow_nan=False, allow_infinity=False, min_value=-(2.0**90), max_value=2.0**90),
            st.sampled_from([0.0, 1.0, 2.0, 300000.0]),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_any_values(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "v float")
    [row] = spread_quantiles(frame, []).collect()
    close(row, brute(values))


def test_groups_with_null_key_and_repeats(spark):
    rng = np.random.default_rng(7)
    data = {
        "a": list(np.round(rng.lognormal(12, 1, 3000))),
        "b": [5.0] * 900 + [7.0] * 100,
        None: [1.5, 2.5],
        "c": [42.0],
    }
    rows = [(k, float(v)) for k, vs in data.items() for v in vs]
    rows += [("a", None), ("b", float("nan"))]
    frame = spark.createDataFrame(rows, "k string, v float")
    got = {r.k: r for r in spread_quantiles(frame, ["k"]).collect()}
    assert set(got) == set(data)
    for key, values in data.items():
        close(got[key], brute(values))


def test_no_values_at_all(spark):
    frame = spark.createDataFrame([("a", None)], "k string, v float")
    [row] = spread_quantiles(frame.drop("k"), []).collect()
    assert row.q50 is None
    counts = D.value_counts(frame, ["k"], {"v": F.col("v")})
    basic = counts.groupBy("k").agg(F.sum("n").alias("n"))
    [merged] = D.merge_groups(["k"], basic, spread_quantiles(frame, ["k"])).collect()
    assert (merged.n, merged.q50) == (1, None)


def test_infinite_price_does_not_break_the_bins(spark):
    frame = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,)], "v float")
    [row] = spread_quantiles(frame, []).collect()
    assert row.q50 == 2.0


def test_bins_rise_with_the_value_and_stay_small(spark):
    # Neighbouring single-precision values around powers of two and in one octave.
    start = np.array([1.0, 2.0, 1024.0, 65536.0, 3e5], dtype="float32")
    values = sorted({float(x) for s in start for x in s + np.spacing(s) * np.arange(-50, 50, dtype="float32")})
    frame = spark.createDataFrame([(v,) for v in values], "v float")
    bins = [r.b for r in frame.orderBy("v").select(D._bin(F.col("v")).alias("b")).collect()]
    assert bins == sorted(bins)
    octave = spark.range(1 << 15).select((1 + F.col("id") / (1 << 15)).cast("float").alias("v"))
    largest = octave.groupBy(D._bin(F.col("v"))).count().agg(F.max("count")).first()[0]
    assert largest * (1 << 8) < 24_000  # an octave has 2**23 values, 2**8 times those here


def test_mean_leaves_out_nulls(spark):
    frame = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (None,)], "v float")
    counts = D.value_counts(frame, [], {"v": F.col("v")})
    assert counts.agg(D.mean("v")).first()[0] == 2.0


def test_shares_sum_to_one_and_drop_nulls(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    rows = {r.k: (r.n, r.share) for r in D.shares(frame, "k").collect()}
    assert rows == {"a": (2, pytest.approx(2 / 3)), "b": (1, pytest.approx(1 / 3))}


def test_histogram_is_percent_within_a_series(spark):
    frame = spark.createDataFrame(
        [("a", 10.0), ("a", 49.0), ("a", 50.0), ("b", 120.0), (None, 1.0)], "s string, v float"
    )
    rows = {(r.s, r.bin_start): (r.n, round(r.pct, 3)) for r in D.histogram(frame, "v", 50, "s").collect()}
    assert rows == {("a", 0.0): (2, 66.667), ("a", 50.0): (1, 33.333), ("b", 100.0): (1, 100.0)}


def test_bars_add_up(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 9.0)], "x string, y float")
    assert {r.x: r.total for r in D.sum_by(frame, "x", "y").collect()} == {"a": 3.0, "b": 5.0}
