"""Edge semantics of the star and the marts on toy tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import toy
from mercata.operators import marts, quality
from mercata.plans.star import build_star


def star_of(spark, order_rows, people_rows=(("Mia", "West"),), return_rows=()):
    return build_star(toy.orders(spark, order_rows), toy.people(spark, list(people_rows)),
                      toy.returns(spark, list(return_rows)))


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_id_with_two_names_fans_fact_rows_out(spark):
    star = star_of(spark, [dict(customer_name="Ann"), dict(order_id="O-2", customer_name="Anne")])
    assert star.dim_customer.count() == 2
    # both order lines look up customer_id C-1, which has two members -> 4 fact rows
    assert star.fact_sales.count() == 4
    dup = quality.duplicate_lookup_keys(star).collect()
    assert [(r["dimension"], r["lookup_value"], r["member_rows"]) for r in dup] == [("dim_customer", "C-1", 2)]


def test_null_postal_code_member_exists_but_never_matches(spark):
    star = star_of(spark, [dict(postal_code=None), dict(order_id="O-2")])
    geo = star.dim_geography.collect()
    assert sorted(r["postal_code"] is None for r in geo) == [False, True]
    keys = rows(star.fact_sales, "order_id", "geography_key")
    assert keys[0][1] is None and keys[1][1] is not None
    un = {r["key_column"]: r["null_rows"] for r in quality.unmatched_lookups(star).collect() if r["fact"] == "fact_sales"}
    assert un["geography_key"] == 1 and un["customer_key"] == 0


def test_profit_margin_zero_and_null_sales(spark):
    star = star_of(spark, [dict(order_id="O-1", sales=0.0, profit=5.0), dict(order_id="O-2", sales=None, profit=5.0),
                           dict(order_id="O-3", sales=50.0, profit=10.0)])
    got = {r["order_id"]: (r["profit_margin"], r["cost"]) for r in star.fact_sales.collect()}
    assert got["O-1"] == (0.0, -5.0)
    assert got["O-2"] == (0.0, None)
    assert got["O-3"] == (0.2, 40.0)


def test_dense_keys_follow_natural_order_nulls_first(spark):
    star = star_of(spark, [dict(customer_id="C-2"), dict(customer_id=None), dict(customer_id="C-10")])
    got = rows(star.dim_customer, "customer_key", "customer_id")
    assert got == [(1, None), (2, "C-10"), (3, "C-2")]


def test_return_expands_to_distinct_order_lines_and_duplicates_multiply(spark):
    lines = [dict(order_id="O-1", product_id="P-1"), dict(order_id="O-1", product_id="P-1", quantity=9),
             dict(order_id="O-1", product_id="P-2")]
    star = star_of(spark, lines, return_rows=[("O-1", "Yes"), ("O-1", "Yes"), ("O-1", "No"), ("O-9", "Yes"),
                                              ("O-1", "yes")])
    fr = star.fact_returns
    # 2 distinct lines x 2 'Yes' events for O-1, plus one unmatched event; 'No' and 'yes' drop
    assert fr.where("order_id = 'O-1'").count() == 4
    unmatched = fr.where("order_id = 'O-9'").collect()
    assert len(unmatched) == 1 and unmatched[0]["customer_key"] is None and unmatched[0]["order_date_key"] is None
    assert sorted(r["return_key"] for r in fr.collect()) == [1, 2, 3, 4, 5]


def test_customer_returns_unmatched_group_does_not_leak(spark):
    star = star_of(spark, [dict(order_id="O-1")], return_rows=[("O-1", "Yes"), ("O-9", "Yes")])
    cr = rows(marts.customer_returns(star), "customer_key", "total_returns")
    assert cr == [(1, 1), (None, 1)]
    ltv = marts.agg_customer_lifetime_value(star).collect()
    assert len(ltv) == 1 and ltv[0]["total_returns"] == 1 and ltv[0]["return_rate"] == 1.0


def test_product_returns_count_rows_not_orders(spark):
    lines = [dict(order_id="O-1"), dict(order_id="O-2")]
    star = star_of(spark, lines, return_rows=[("O-1", "Yes"), ("O-1", "Yes"), ("O-2", "Yes")])
    pp = marts.agg_product_performance(star).collect()[0]
    assert pp["total_returns"] == 3 and pp["total_orders"] == 2 and pp["return_rate"] == 1.5


def test_two_managers_count_region_twice_and_missing_manager_is_null(spark):
    lines = [dict(order_id="O-1", region="West", sales=10.0), dict(order_id="O-2", region="East", sales=7.0,
                                                                  city="NY", **{"state/province": "NY"})]
    star = star_of(spark, lines, people_rows=[("Mia", "West"), ("Max", "West")])
    got = rows(marts.agg_regional_summary(star), "region", "manager_name", "total_revenue", "total_customers")
    assert got == [("East", None, 7.0, 1), ("West", "Max", 10.0, 1), ("West", "Mia", 10.0, 1)]


def _trend_lines():
    mk = lambda oid, d, s, p: dict(order_id=oid, order_date=d, ship_date=d, sales=s, profit=p)
    return [mk("O-1", dt.date(2019, 2, 1), 100.0, 10.0), mk("O-2", dt.date(2020, 2, 1), 150.0, 0.0),
            mk("O-3", dt.date(2022, 2, 1), 75.0, -5.0), mk("O-4", dt.date(2023, 2, 1), 75.0, 5.0)]


def test_lag_uses_previous_present_year_and_guards_zero(spark):
    star = star_of(spark, _trend_lines())
    got = {r["year"]: r for r in marts.agg_category_trends(star).collect()}
    assert got[2019]["prev_year_revenue"] is None and got[2019]["yoy_revenue_growth"] is None
    assert got[2020]["yoy_revenue_growth"] == pytest.approx(50.0)
    # 2021 is missing: 2022 compares with 2020
    assert got[2022]["prev_year_revenue"] == 150.0
    assert got[2022]["yoy_revenue_growth"] == pytest.approx(-50.0)
    # previous profit 0 -> NULL growth instead of a division error
    assert got[2022]["prev_year_profit"] == 0.0 and got[2022]["yoy_profit_growth"] is None
    # negative previous profit flips the sign: (5 - -5) / -5 * 100
    assert got[2023]["yoy_profit_growth"] == pytest.approx(-200.0)


def test_ranks_share_ties_and_leave_gaps(spark):
    lines = [dict(order_id=f"O-{i}", product_id=f"P-{i}", sales=s, profit=p)
             for i, (s, p) in enumerate([(50.0, 1.0), (50.0, 2.0), (20.0, 2.0), (None, None)])]
    star = star_of(spark, lines)
    got = rows(marts.agg_product_performance(star), "product_id", "revenue_rank", "profit_rank")
    assert got == [("P-0", 1, 3), ("P-1", 1, 1), ("P-2", 3, 1), ("P-3", 4, 4)]


def test_calendar_edges(spark):
    lines = [dict(order_id="O-1", order_date=dt.date(2021, 1, 3), ship_date=dt.date(2021, 1, 9)),
             dict(order_id="O-2", order_date=None, ship_date=dt.date(2021, 1, 4))]
    star = star_of(spark, lines)
    got = {r["date"]: r for r in star.dim_date.collect()}
    sun = got[dt.date(2021, 1, 3)]
    assert (sun["date_key"], sun["day_of_week"], sun["day_name"], sun["week_of_year"], sun["is_weekend"]) == \
        (20210103, 1, "Sunday", 53, True)
    assert got[dt.date(2021, 1, 9)]["day_of_week"] == 7 and got[dt.date(2021, 1, 9)]["is_weekend"] is True
    assert got[dt.date(2021, 1, 4)]["is_weekend"] is False and got[dt.date(2021, 1, 4)]["week_of_year"] == 1
    null = got[None]
    assert null["date_key"] is None and null["is_weekend"] is False
    assert star.fact_sales.where("order_id = 'O-2'").first()["order_date_key"] is None


def test_ltv_tier_boundaries(spark):
    lines = [dict(order_id=f"O-{i}", customer_id=f"C-{i}", sales=s) for i, s in
             enumerate([5000.0, 4999.99, 2000.0, 500.0, 499.0, None])]
    star = star_of(spark, lines)
    got = rows(marts.agg_customer_lifetime_value(star), "customer_id", "ltv_tier")
    assert got == [("C-0", "Platinum"), ("C-1", "Gold"), ("C-2", "Gold"), ("C-3", "Silver"), ("C-4", "Bronze"),
                   ("C-5", "Bronze")]


def test_shipping_shares_and_negative_delivery(spark):
    lines = [dict(order_id="O-1", ship_mode="First Class", sales=30.0, ship_date=dt.date(2021, 2, 27)),
             dict(order_id="O-2", ship_mode="Freight", sales=10.0),
             dict(order_id="O-3", ship_mode=None, sales=60.0)]
    star = star_of(spark, lines)
    got = {r["ship_mode"]: r for r in marts.agg_shipping_analysis(star).collect()}
    assert sum(r["revenue_share_pct"] for r in got.values()) == pytest.approx(100.0)
    assert got["First Class"]["min_delivery_days"] == -2
    assert got["Freight"]["ship_mode_description"] == "Unknown"
    # the dimension has a NULL member described as Unknown, but a NULL mode never matches it,
    # so the fact row keeps a NULL key and lands in an all-NULL group of the mart
    modes = {r["ship_mode"]: r["ship_mode_description"] for r in star.dim_ship_mode.collect()}
    assert modes[None] == "Unknown"
    assert got[None]["ship_mode_description"] is None and got[None]["total_revenue"] == 60.0


def test_state_ratios_guard_cost(spark):
    lines = [dict(order_id="O-1", sales=10.0, profit=10.0), dict(order_id="O-2", sales=5.0, profit=1.0, city="SF")]
    got = marts.agg_state_performance(star_of(spark, lines)).first()
    assert got["total_cost"] == 4.0 and got["profit_to_cost_ratio"] == pytest.approx(11.0 / 4.0)
    zero_cost = marts.agg_state_performance(star_of(spark, [dict(sales=10.0, profit=10.0)])).first()
    assert zero_cost["profit_to_cost_ratio"] == 0.0
    assert got["avg_order_value"] == pytest.approx(7.5) and got["state_revenue_rank"] == 1


def test_marts_ignore_input_order(spark):
    import random

    rnd = random.Random(7)
    lines = [dict(order_id=f"O-{rnd.randint(1, 30)}", customer_id=f"C-{rnd.randint(1, 5)}",
                  product_id=f"P-{rnd.randint(1, 6)}", sales=float(rnd.randint(1, 900)),
                  profit=float(rnd.randint(-50, 90)), discount=rnd.choice([0.0, 0.1, 0.2]),
                  order_date=dt.date(2020 + rnd.randint(0, 2), rnd.randint(1, 12), rnd.randint(1, 28)))
             for _ in range(120)]
    # exact money types (double sums depend on addition order in any engine)
    a = toy.orders(spark, lines).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("sales", "profit", "discount")})
    b = a.repartition(5, F.rand(3)).sortWithinPartitions(F.rand(4))
    p, r = toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-3", "Yes"), ("O-7", "Yes")])
    sa, sb = build_star(a, p, r), build_star(b, p, r)
    for name, fn in marts.MARTS.items():
        assert sorted(map(repr, fn(sa).collect())) == sorted(map(repr, fn(sb).collect())), name
    assert sorted(map(repr, sa.fact_sales.collect())) == sorted(map(repr, sb.fact_sales.collect()))


def test_revenue_totals_are_preserved(spark):
    lines = [dict(order_id=f"O-{i}", product_id=f"P-{i % 3}", sales=float(i)) for i in range(1, 20)]
    star = star_of(spark, lines)
    total = star.fact_sales.agg(F.sum("revenue")).first()[0]
    for name in ("agg_monthly_sales", "agg_customer_lifetime_value", "agg_product_performance",
                 "agg_category_trends", "agg_shipping_analysis", "agg_state_performance"):
        col = "lifetime_revenue" if name == "agg_customer_lifetime_value" else "total_revenue"
        assert marts.MARTS[name](star).agg(F.sum(col)).first()[0] == pytest.approx(total), name


def test_ranks_of_ties_and_missing_values(spark):
    lines = [dict(order_id=f"O-{i}", product_id=f"P-{i}", sales=s, profit=p)
             for i, (s, p) in enumerate([(50.0, 1.0), (50.0, 2.0), (20.0, 2.0), (None, None)])]
    star = star_of(spark, lines)
    assert rows(marts.agg_product_performance(star), "product_id", "revenue_rank", "profit_rank") == [("P-0", 1, 3), ("P-1", 1, 1), ("P-2", 3, 1), ("P-3", 4, 4)]


def test_shares_of_revenue(spark):
    lines = [dict(order_id="O-1", ship_mode="First Class", sales=30.0), dict(order_id="O-2", ship_mode="Freight", sales=10.0),
             dict(order_id="O-3", ship_mode="Freight", sales=60.0)]
    star = star_of(spark, lines)
    shares = rows(marts.agg_shipping_analysis(star), "ship_mode", "revenue_share_pct", "order_share_pct")
    assert [r[1] for r in shares] == [30.0, 70.0]


def test_us_style_dates_with_formats(spark):
    from mercata.functions.calendar import to_date_col

    df = spark.createDataFrame([("11/8/2023",), ("2023-11-09",), ("junk",), (None,)], "d string")
    got = [r[0] for r in df.select(to_date_col("d", ["M/d/yyyy", "yyyy-MM-dd"])).collect()]
    assert got == [dt.date(2023, 11, 8), dt.date(2023, 11, 9), None, None]


def test_on_duplicate_first_keeps_lowest_member(spark):
    lines = [dict(order_id="O-1", customer_name="Ann"), dict(order_id="O-2", customer_name="Anne")]
    star = build_star(toy.orders(spark, lines), toy.people(spark, [("Mia", "West")]), toy.returns(spark, []),
                      on_duplicate="first")
    assert star.dim_customer.count() == 2  # the dimension keeps both members
    got = rows(star.fact_sales, "order_id", "customer_key")
    assert got == [("O-1", 1), ("O-2", 1)]  # no fan-out; both lines use the lowest key of C-1


def test_nan_is_a_missing_value(spark):
    lines = [dict(order_id="O-1", sales=float("nan"), profit=1.0), dict(order_id="O-2", sales=10.0, profit=2.0)]
    df = toy.orders(spark, lines).withColumn("postal_code", F.when(F.col("order_id") == "O-1", F.lit(float("nan")))
                                              .otherwise(F.lit(90001.0)))
    star = build_star(df, toy.people(spark, [("Mia", "West")]), toy.returns(spark, []))
    got = {r["order_id"]: r for r in star.fact_sales.collect()}
    assert got["O-1"]["revenue"] is None and got["O-1"]["profit_margin"] == 0.0
    assert got["O-1"]["geography_key"] is None  # a missing postal code never matches, not even itself
    assert got["O-2"]["geography_key"] is not None


def test_manager_keys_follow_region_then_name(spark):
    star = star_of(spark, [dict()], people_rows=[("Zoe", "East"), ("Adam", "West"), ("Bea", "East"), ("Bea", "East")])
    got = rows(star.dim_regional_manager, "manager_key", "region", "manager_name")
    assert got == [(1, "East", "Bea"), (2, "East", "Bea"), (3, "East", "Zoe"), (4, "West", "Adam")]


def test_a_manager_listed_twice_doubles_sums_only(spark):
    lines = [dict(order_id="O-1", region="West", sales=30.0, profit=3.0), dict(order_id="O-2", region="West", sales=10.0, profit=1.0)]
    once, twice = (marts.agg_regional_summary(star_of(spark, lines, people_rows=[("Mia", "West")] * n)).first() for n in (1, 2))
    assert twice["total_revenue"] == 2 * once["total_revenue"] and twice["total_units_sold"] == 2 * once["total_units_sold"]
    assert (twice["total_orders"], twice["avg_profit_margin"]) == (once["total_orders"], once["avg_profit_margin"])
