"""Plan shapes the design relies on: lookups by real size, column pruning, two-level measures."""

import contextlib
import io

import toy
from mercata.operators import marts
from mercata.operators.lookup import left_lookup
from mercata.plans.star import build_star


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _fact_and_dim(spark):
    fact = toy.orders(spark, [dict(order_id=f"O-{i}", customer_id=f"C-{i % 5}") for i in range(20)])
    dim = spark.createDataFrame([(f"C-{i}", i + 1) for i in range(5)], "customer_id string, customer_key long")
    return fact, dim


def test_lookup_follows_the_real_size_of_a_saved_dimension(spark, tmp_dir):
    fact, dim = _fact_and_dim(spark)
    wide = dim.selectExpr("customer_id", "customer_key", "repeat(customer_id, 200000) AS note")
    dim.write.parquet(f"{tmp_dir}/small")
    wide.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{tmp_dir}/wide")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        on = [("customer_id", "customer_id")]
        small = plan_of(left_lookup(fact, spark.read.parquet(f"{tmp_dir}/small"), on, ["customer_key"]))
        large = plan_of(left_lookup(fact, spark.read.parquet(f"{tmp_dir}/wide"), on, ["customer_key", "note"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in small and "LeftOuter" in small
    assert "BroadcastHashJoin" not in large  # five rows, but two megabytes of text


def test_state_mart_groups_orders_before_counting_distinct(spark, tmp_dir):
    star = build_star(toy.orders(spark, [dict(order_id="O-1"), dict(order_id="O-2", customer_id="C-2")]),
                      toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-1", "Yes")]))
    lines = plan_of(marts.STATES.groups(star)).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    by_order = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "order_id" in line.split("functions")[0]
                    and "customer_key" in line.split("functions")[0] and "__sum" not in line.split("functions")[0] and i > expand)
    assert expand < by_order  # copies are made of order rows, not of fact lines


def test_marts_prune_columns_and_aggregate_partially(spark, tmp_dir):
    star = build_star(toy.orders(spark, [dict(order_id="O-1"), dict(order_id="O-2", customer_id="C-2")]),
                      toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-1", "Yes")]))
    sales = star.fact_sales
    sales.write.parquet(f"{tmp_dir}/fact_sales")
    saved = star.__class__(**{**star.__dict__, "fact_sales": spark.read.parquet(f"{tmp_dir}/fact_sales")})
    plan = plan_of(marts.agg_monthly_sales(saved))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "fact_sales" in line)
    assert "customer_key" not in scan and "geography_key" not in scan  # only the columns the mart uses
    assert "partial_sum" in plan  # map-side partial aggregation before the shuffle
    lines = plan_of(marts.customer_sales(saved)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "[customer_key" in line)
    agg = next(i for i, line in enumerate(lines) if "HashAggregate(keys=[customer_key" in line)
    assert join < agg  # the aggregate is a child of the dimension join: the fact is grouped first


def test_shares_and_ranks_scan_the_fact_once(spark, tmp_dir, monkeypatch):
    from mercata.operators import keys

    star = build_star(toy.orders(spark, [dict(order_id=f"O-{i}", product_id=f"P-{i}", ship_mode=("First Class", "Same Day")[i % 2]) for i in range(6)]),
                      toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-1", "Yes")]))
    star.fact_sales.write.parquet(f"{tmp_dir}/fact_sales")
    star = star.__class__(**{**star.__dict__, "fact_sales": spark.read.parquet(f"{tmp_dir}/fact_sales")})
    plans = []
    real = keys.saved

    def saved(df, label):
        plans.append(plan_of(df))
        return real(df, label)

    monkeypatch.setattr(keys, "saved", saved)
    for mart in (marts.agg_shipping_analysis, marts.agg_product_performance, marts.agg_state_performance):
        plans.clear()
        out = mart(star)
        scans = [p.count(f"{tmp_dir}/fact_sales") for p in [*plans, plan_of(out)]]
        assert sum(scans) == scans[0] == 1, mart.__name__  # the first saved frame reads it, nothing after it
        assert out.count() > 0


def test_ranks_move_distinct_values_only(spark, tmp_dir, monkeypatch):
    """A value that a third of the rows share is one row of what is range-partitioned."""
    from mercata.operators import keys

    rows = spark.range(900).selectExpr("id", "if(id % 3 = 0, 5, id) AS v", "repeat('x', 50) AS wide")
    saved = {}
    real = keys.saved
    monkeypatch.setattr(keys, "saved", lambda df, label: saved.setdefault(label, real(df, label)))
    ranked = keys.with_ranks_desc(rows, {"r": "v"})
    assert saved["ranks"].columns[:2] == ["value", "__mercata_rows"] and saved["ranks"].count() == 600
    assert "Exchange" not in plan_of(saved["ranked"])
    assert ranked.where("v = 5").select("r").distinct().collect()[0][0] == 597  # 596 rows are larger
