"""Sums of doubles are the same in every order and on every number of tasks."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercata.functions.exact import LARGEST, POWERS, from_limbs, limbs, outside
from mercata.operators.measures import average, distinct, largest, smallest, summarise, total


def exact_sum(spark, values, parts=4):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    sums = df.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(limbs("x"))], F.sum(outside("x")).alias("rest"))
    return sums.select(from_limbs([F.col(f"s{i}") for i in range(len(POWERS))], F.col("rest"))).first()[0]


def test_limbs_hold_a_double_exactly(spark):
    r = random.Random(1)
    values = [r.choice((-1, 1)) * r.random() * 2.0 ** r.randint(-18, 69) for _ in range(500)] + [0.0, -0.0, 0.5, 1.5, 2.5, 2.0 ** 24 + 0.5, -2.0 ** 69]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", *limbs("x")).collect():
        assert sum(Fraction(q) * Fraction(2) ** p for q, p in zip(row[1:], POWERS, strict=True)) == Fraction(row[0])
        assert all(abs(q) <= 2 ** 23 for q in row[2:])


def test_sum_is_right_and_ignores_order(spark):
    r = random.Random(2)
    values = [r.gauss(0, 1) * 10.0 ** r.randint(-3, 9) for _ in range(3000)]
    values += [1e16, 1.0, -1e16] * 20  # cancels badly in an ordinary sum
    got = set()
    for parts in (1, 3, 8):
        r.shuffle(values)
        got.add(exact_sum(spark, values, parts))
    assert len(got) == 1
    assert got.pop() == pytest.approx(math.fsum(values), rel=1e-15)


def test_values_without_limbs_and_missing_values(spark):
    assert exact_sum(spark, [None, None]) is None
    assert exact_sum(spark, [None, 1.5]) == 1.5
    assert exact_sum(spark, [LARGEST, 1.0]) == LARGEST
    assert exact_sum(spark, [float("inf"), 1.0]) == float("inf")
    assert math.isnan(exact_sum(spark, [float("nan"), 1.0]))
    assert math.isnan(exact_sum(spark, [float("inf"), float("-inf")]))
    assert exact_sum(spark, [1e-300, 2e-300]) == 0.0  # below the last unit


@given(st.lists(st.floats(-1e6, 1e6).filter(lambda x: x == 0 or abs(x) > 1e-4), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_any_small_group(spark, values):
    assert exact_sum(spark, values, 2) == pytest.approx(math.fsum(values), rel=1e-14, abs=1e-15)


def test_summarise_of_doubles_equals_fsum_in_any_layout(spark):
    r = random.Random(3)
    lines = [(r.choice("ab"), r.randint(1, 40), r.gauss(0, 10) if r.random() < 0.9 else None) for _ in range(2000)]
    measures = {"sum": total("x"), "mean": average("x"), "least": smallest("x"), "most": largest("x"), "orders": distinct("o")}
    found = set()
    for parts in (1, 7):
        r.shuffle(lines)
        df = spark.createDataFrame(lines, "g string, o int, x double").repartition(parts)
        found.add(tuple(sorted(map(tuple, summarise(df, ["g"], ["o"], measures).collect()))))
    assert len(found) == 1
    for g, s, mean, least, most, orders in found.pop():
        x = [v for k, _, v in lines if k == g and v is not None]
        assert s == pytest.approx(math.fsum(x), rel=1e-13) and mean == pytest.approx(math.fsum(x) / len(x), rel=1e-13)
        assert (least, most, orders) == (min(x), max(x), len({o for k, o, _ in lines if k == g}))


def test_plain_count_where_the_grain_is_the_counted_column(spark):
    """A grain of one column needs no distinct aggregate; NULL is not counted."""
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", None, 2), ("b", 2, 2)], "g string, o int, c int")
    one = summarise(df, ["g"], ["o"], {"n": distinct("o")})
    two = summarise(df, ["g"], ["o", "c"], {"n": distinct("o"), "m": distinct("c")})
    assert sorted(map(tuple, one.collect())) == [("a", 1), ("b", 1)]
    assert sorted(map(tuple, two.collect())) == [("a", 1, 2), ("b", 1, 1)]
    plan = summarise(df, ["g"], ["o"], {"n": distinct("o")})._jdf.queryExecution().executedPlan().toString()  # not run: the plan stands once
    assert plan.count("HashAggregate") == 4 and "Expand" not in plan


def test_groups_taken_apart_equal_two_levels_without_wide_rows_per_order(spark, monkeypatch):
    """Of groups with hardly more than one line an order: same rows and types, and no sum is grouped by order."""
    from mercata.operators import keys
    from mercata.operators.measures import summarise_apart

    r = random.Random(4)
    lines = [(r.choice(("a", "b", None)), r.choice((1, 2, 3, None)), r.choice((*range(30), None)), r.choice((r.gauss(0, 10), None))) for _ in range(600)]
    df = spark.createDataFrame(lines, "g string, h int, o int, x double").withColumn("d", F.col("x").cast("decimal(18,9)")).repartition(5)
    measures = {"sum": total("x"), "orders": distinct("o"), "mean": average("x"), "exact": total("d"), "least": smallest("d"), "most": largest("x")}
    plans = []
    real = keys.saved
    monkeypatch.setattr(keys, "saved", lambda rows, label: plans.append(label) or real(rows, label))
    apart, two = summarise_apart(df, ["g", "h"], measures), summarise(df, ["g", "h"], ["o"], measures)
    assert plans == ["lines"] and apart.schema == two.schema
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, two.collect()))
    grouped = [line for line in summarise_apart(df, ["g"], measures)._jdf.queryExecution().executedPlan().toString().splitlines() if "keys=" in line]
    assert not any("o#" in line.split("functions=")[0] or "orders#" in line.split("functions=")[0] for line in grouped if "sum(" in line)


def test_product_marts_shuffle_no_measures_by_order(spark):
    """One line an order and product: what is shuffled per line is a product and an order, never sums."""
    import toy
    from mercata.operators import marts
    from mercata.plans.star import build_star

    star = build_star(toy.orders(spark, [dict(order_id=f"O-{i}", product_id=f"P-{i % 2}") for i in range(8)]),
                      toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-1", "Yes")]))
    for spec in (marts.PRODUCT_SALES, marts.QUARTERS):
        plan = spec.groups(star)._jdf.queryExecution().executedPlan().toString()
        keys = [line.split("functions=")[0] for line in plan.splitlines() if "functions=" in line and "sum(" in line]
        assert keys and not any("order_id#" in k for k in keys)
