"""Scalar expressions: rounding, bins, flags, lenient casts (edge rows)."""

import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from towerlens.constants import (
    ENGAGEMENT_DASH_EDGES,
    ENGAGEMENT_DASH_LABELS,
    ENGAGEMENT_SQL_EDGES,
    ENGAGEMENT_SQL_LABELS,
    TENURE_EDGES,
    TENURE_LABELS,
)
from towerlens.functions import (
    avg_exact,
    bucketize,
    eq_flag,
    lenient_number,
    lenient_timestamp,
    round_half_even,
    round_half_up,
    sum_exact,
)


def one_col(spark, values, typ):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_rounding_half_even_and_half_up(spark):
    df = one_col(spark, [0.125, 1.005, 2.5, 0.135, -0.125, None], "double")
    rows = df.select(round_half_even("x", 2).alias("e"), round_half_up("x", 2).alias("u"),
                     round_half_even("x", 0).alias("e0")).collect()
    assert [r.e for r in rows] == [0.12, 1.0, 2.5, 0.14, -0.12, None]
    assert [r.u for r in rows] == [0.13, 1.0, 2.5, 0.14, -0.13, None]
    assert [r.e0 for r in rows][2] == 2.0


def test_tenure_bins_right_closed(spark):
    df = one_col(spark, [0, 6, 7, 12, 24, 48, 100, 101, -1, None], "int")
    got = [r[0] for r in df.select(bucketize("x", TENURE_EDGES, TENURE_LABELS)).collect()]
    assert got == ["0-6mo", "0-6mo", "6-12mo", "6-12mo", "1-2yr", "2-4yr", "4yr+", None, None, None]


def test_engagement_bands_left_vs_right(spark):
    df = one_col(spark, [25.0, 0.0, 74.99, 75.0, 100.5, None], "double")
    left = [r[0] for r in df.select(bucketize("x", ENGAGEMENT_SQL_EDGES, ENGAGEMENT_SQL_LABELS, closed="left")).collect()]
    right = [r[0] for r in df.select(bucketize("x", ENGAGEMENT_DASH_EDGES, ENGAGEMENT_DASH_LABELS)).collect()]
    assert left == ["2_Mid-Low (25-50)", "1_Low (0-25)", "3_Mid-High (50-75)", "4_High (75-100)",
                    "4_High (75-100)", "4_High (75-100)"]
    assert right == ["Low (0-25)", "Low (0-25)", "Mid-High (50-75)", "Mid-High (50-75)", "High (75-100)", None]


def test_bucketize_rejects_bad_edges():
    with pytest.raises(ValueError):
        bucketize("x", [1, 2], ["a", "b"], closed="right")
    with pytest.raises(ValueError):
        bucketize("x", [1, 2], ["a"], closed="left")


def test_eq_flag_null_is_zero(spark):
    df = one_col(spark, ["COMPLETED", "DROPPED", None], "string")
    assert [r[0] for r in df.select(eq_flag("x", "COMPLETED")).collect()] == [1, 0, 0]


def test_lenient_number(spark):
    df = one_col(spark, [" ", "n/a", "12.5", " 7 ", None, ""], "string")
    assert [r[0] for r in df.select(lenient_number("x")).collect()] == [None, None, 12.5, 7.0, None, None]


def test_lenient_timestamp_forms(spark):
    df = one_col(spark, ["2026-02-25 03:36:14.825973", "2026-02-25T03:36:14", "bad-ts", "2026-02-25"], "string")
    got = [r[0] for r in df.select(lenient_timestamp("x")).collect()]
    assert got[0] == dt.datetime(2026, 2, 25, 3, 36, 14, 825973)
    assert got[1] == dt.datetime(2026, 2, 25, 3, 36, 14)
    assert got[2] is None
    assert got[3] == dt.datetime(2026, 2, 25)


def test_exact_sum_is_order_free(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e6 + 0.3]
    df = one_col(spark, vals, "double")
    a = df.agg(sum_exact("x").alias("s"), avg_exact("x").alias("m")).first()
    b = df.repartition(7).agg(sum_exact("x").alias("s"), avg_exact("x").alias("m")).first()
    assert a.s == b.s == 1000003.3
    assert a.m == b.m


def test_exact_sum_keeps_all_digits(spark):
    df = one_col(spark, [0.005] + [0.004] * 10, "double")
    assert abs(df.agg(sum_exact("x")).first()[0] - 0.045) < 1e-15
    tiny = one_col(spark, [1e-12] * 1000, "double")
    assert abs(tiny.agg(sum_exact("x")).first()[0] - 1e-9) < 1e-20


def test_lenient_number_takes_plain_numbers_only(spark):
    df = one_col(spark, ["NaN", "1d", "Infinity", "-inf", "1e400", "0x1", "1.5", " -2 ", "+.5", "3.", "1e3", "", None], "string")
    assert [r[0] for r in df.select(lenient_number("x")).collect()] == [
        None, None, None, None, None, None, 1.5, -2.0, 0.5, 3.0, 1000.0, None, None]


INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("values,want", [
    ([1e30, 1.0], 1e30), ([INF, 1.0], INF), ([-INF, 5.0, None], -INF), ([INF, -INF], NAN), ([NAN, 1.0], NAN), ([None, None], None),
    ([1e20, 1.0, -1e20], 1.0), ([1e27, 3.0, -1e27, 0.25], 3.25), ([1e-12] * 1000, 1e-9), ([0.1] * 10, 1.0), ([1.7e308, 1.7e308], INF),
    ([1e18, 1e-9, -1e18], 1e-9), ([5e-324, 1.0], 1.0), ([-0.0], 0.0), ([1e29, -1e29], 0.0)])
def test_sum_exact_over_the_range_of_a_double(spark, values, want):
    from towerlens.functions import final_sum, merged_sums, partial_sums
    df = one_col(spark, values, "double")
    once = df.agg(sum_exact("x").alias("s")).first().s
    parts = df.withColumn("g", F.monotonically_increasing_id()).groupBy("g").agg(*partial_sums("x", "p"))
    twice = parts.groupBy((F.col("g") % 2).alias("h")).agg(*merged_sums("p")).agg(final_sum("p").alias("s")).first().s
    for got in (once, twice):
        assert got == want or (got != got and want is not None and want != want)


def test_sum_exact_does_not_depend_on_order(spark):
    import random
    r = random.Random(9)
    values = [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-20, 26) for _ in range(3000)]
    want = None
    for seed in range(4):
        random.Random(seed).shuffle(values)
        got = one_col(spark, values, "double").repartition(seed + 1).agg(sum_exact("x")).first()[0]
        want = got if want is None else want
        assert got == want
    exact = sum(map(Fraction, values))
    assert abs(Fraction(want) - exact) <= abs(exact) * Fraction(1, 10 ** 12)
