"""What a build leaves on disk: no shuffle files of finished writes, no layouts that nothing reads, one fact's shuffles at a time."""

import datetime as dt
import os
import time

import toy
from mercata.config import ensure_checkpoint_dir, shuffles_released
from mercata.operators import keys
from mercata.plans import star as star_plan
from mercata.plans.layers import parquet_sink, write_parquet
from mercata.sources.catalog import ensure_namespace, overwrite_table

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> set[str]:
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def scratch(spark) -> set[str]:
    top = ensure_checkpoint_dir(spark).removeprefix("file:") + "/scratch"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def left_after(spark, write) -> set[str]:
    before = shuffle_files(spark)
    write()
    for _ in range(50):  # files go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_a_write_leaves_no_shuffle_files(spark, tmp_dir):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS g")
    dealt = rows.repartition(3, "g")
    ensure_namespace(spark, "t_disk")
    for write in (lambda: keys.saved(dealt, "x"), lambda: write_parquet(dealt, f"{tmp_dir}/x"), lambda: overwrite_table(dealt, "t_disk", "t")):
        assert not left_after(spark, write)
        assert spark.conf.get(CLEANUP, None) in (None, "false")  # the caller's own queries are as before
    assert keys.saved(dealt, "x").agg({"id": "sum"}).first()[0] == 499500


def test_shuffles_are_kept_again_when_the_last_thread_leaves(spark):
    before = spark.conf.get(CLEANUP, None)
    one, two = shuffles_released(spark), shuffles_released(spark)
    one.__enter__(), two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP, None) == before


def _orders(spark):
    return toy.orders(spark, [dict(order_id=f"O-{i // 2}", customer_id=f"C-{i % 5}", product_id=f"P-{i % 7}", sales=float(i), profit=i / 4,
                                   order_date=dt.date(2021, 1 + i % 12, 1)) for i in range(60)])


def test_a_saved_star_needs_no_scratch(spark, tmp_dir):
    before = scratch(spark)
    raw = (_orders(spark), toy.people(spark, [("Mia", "West")]), toy.returns(spark, [("O-1", "Yes"), ("O-1", "Yes"), ("O-77", "Yes")]))
    saved = star_plan.build_star(*raw, sink=parquet_sink(f"{tmp_dir}/star"))
    assert scratch(spark) == before
    plain = star_plan.build_star(*raw)
    for t in star_plan.STAR_TABLES:
        assert sorted(map(repr, getattr(saved, t).collect())) == sorted(map(repr, getattr(plain, t).collect())), t


def test_facts_are_built_one_after_the_other_from_saved_dimensions(spark, tmp_dir, monkeypatch):
    saved, real = [], star_plan.build_fact_sales

    def sink(name, df, write=parquet_sink(f"{tmp_dir}/star")):
        out = write(name, df)
        saved.append(name)
        return out

    def fact_sales(orders, dims, *rest):
        assert {"dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "fact_returns"} <= {*saved}
        assert all(f"/star/{name}/" in d.frame.inputFiles()[0] for name, d in dims.items())
        return real(orders, dims, *rest)

    monkeypatch.setattr(star_plan, "build_fact_sales", fact_sales)
    star = star_plan.build_star(_orders(spark), toy.people(spark, []), toy.returns(spark, []), sink=sink)
    assert star.rows["fact_sales"] == 60 and saved[-1] == "fact_sales"


def test_sales_lines_are_put_in_order_without_what_follows_from_them(spark, monkeypatch):
    from mercata.operators import facts

    ranged = []
    real = facts.with_dense_key
    monkeypatch.setattr(facts, "with_dense_key", lambda df, key, order, **more: ranged.append((key, df)) or real(df, key, order, **more))
    star = star_plan.build_star(_orders(spark), toy.people(spark, []), toy.returns(spark, []))
    lines = dict(ranged)["sales_key"]
    assert not {"cost", "profit_margin", "country/region", "city"} & {*lines.columns}
    assert "Join" not in lines._jdf.queryExecution().executedPlan().toString()  # the lookups are done: sampling bounds does not run them again
    assert star.fact_sales.where("cost = revenue - profit").count() == 60


def test_category_and_product_marts_leave_their_groups_only(spark, monkeypatch):
    from mercata.operators import marts

    star = star_plan.build_star(_orders(spark), toy.people(spark, []), toy.returns(spark, [("O-1", "Yes")]))
    lines = []
    real = keys.saved
    monkeypatch.setattr(keys, "saved", lambda df, label: lines.append(df.columns) or real(df, label) if label == "lines" else real(df, label))
    for mart, spec, unused in ((marts.agg_category_trends, marts.QUARTERS, {"product_key", "order_date_key"}), (marts.product_sales, marts.PRODUCT_SALES, set())):
        lazy = sorted(map(repr, spec.groups(star).collect()))
        lines.clear()
        before = scratch(spark)
        out = mart(star)
        assert {f.rpartition("-")[0] for f in scratch(spark) - before} == {"groups"}  # as many lines as the fact has are gone
        assert len(lines) == 1 and not unused & {*lines[0]}
        assert out.count() == len(lazy) and sorted(map(repr, spec.finished(star).collect())) == lazy
