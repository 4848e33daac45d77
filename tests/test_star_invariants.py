"""Invariants of the star built from the driver data (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from mercata.operators import marts
from mercata.plans.registry import star_for

SF = "/root/testdata/sf0.001"
KEYS = {"dim_customer": "customer_key", "dim_product": "product_key", "dim_geography": "geography_key",
        "dim_ship_mode": "ship_mode_key", "dim_regional_manager": "manager_key", "fact_sales": "sales_key",
        "fact_returns": "return_key"}


@pytest.mark.parametrize("table", sorted(KEYS))
def test_keys_are_one_to_n(spark, table):
    df = getattr(star_for(spark, SF), table)
    got = df.agg(F.min(KEYS[table]), F.max(KEYS[table]), F.count_distinct(KEYS[table]), F.count(F.lit(1))).first()
    assert got[0] == 1 and got[1] == got[2] == got[3]


def test_totals_and_shares(spark):
    star = star_for(spark, SF)
    total = star.fact_sales.agg(F.sum("revenue")).first()[0]
    for name in ("agg_monthly_sales", "agg_product_performance", "agg_category_trends", "agg_shipping_analysis",
                 "agg_state_performance"):
        assert marts.MARTS[name](star).agg(F.sum("total_revenue")).first()[0] == total, name
    assert marts.agg_customer_lifetime_value(star).agg(F.sum("lifetime_revenue")).first()[0] == total
    ship = marts.agg_shipping_analysis(star).agg(F.sum("revenue_share_pct"), F.sum("order_share_pct")).first()
    assert ship[0] == pytest.approx(100.0) and ship[1] == pytest.approx(100.0)
    # a region's sales count once per manager listed for it
    regions = marts.REGIONS.groups(star)
    listed = star.dim_regional_manager.groupBy("region").count()
    times = {r["region"]: r["count"] for r in listed.collect()}
    expected = sum(r["total_revenue"] * times.get(r["region"], 1) for r in regions.collect())
    assert marts.agg_regional_summary(star).agg(F.sum("total_revenue")).first()[0] == expected


def test_observed_counts_match_fixture_notes(spark):
    star = star_for(spark, SF)
    assert star.rows["fact_sales"] == 6128 and star.rows["fact_returns"] == 9845
    assert (star.rows["dim_customer"], star.rows["dim_product"], star.rows["dim_geography"]) == (150, 204, 131)
    tiers = {r["ltv_tier"]: r["count"] for r in marts.agg_customer_lifetime_value(star).groupBy("ltv_tier").count().collect()}
    assert tiers == {"Platinum": 38, "Gold": 31, "Silver": 47, "Bronze": 34}
