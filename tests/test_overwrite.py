"""Overwrites are all or nothing, old versions and a run's scratch are deleted."""

import os

import pytest
from pyspark.sql import functions as F

from mercata.config import ensure_checkpoint_dir, run_scratch, scratch_path
from mercata.plans.layers import Layers, run_all
from mercata.sources.catalog import delete_folder, ensure_namespace, overwrite_table, table_location

DB = "t_overwrite"


@pytest.fixture(scope="module")
def db(spark):
    return ensure_namespace(spark, DB)


def versions(spark, table):
    return sorted(os.listdir(table_location(spark, DB, table).removeprefix("file:")))


def test_a_write_that_fails_half_way_leaves_the_old_table(spark, db):
    assert overwrite_table(spark.range(100).withColumn("v", F.lit("old")), db, "t") == 100
    before = versions(spark, "t")
    broken = spark.range(0, 1000, 1, 8).withColumn("v", F.when(F.col("id") > 900, F.raise_error(F.lit("lost half way"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="lost half way"):
        overwrite_table(broken, db, "t")
    assert [tuple(r) for r in spark.table(f"{DB}.t").groupBy("v").count().collect()] == [("old", 100)]
    assert set(before) <= set(versions(spark, "t"))
    assert overwrite_table(spark.range(7).withColumn("v", F.lit("new")), db, "t") == 7
    assert spark.table(f"{DB}.t").count() == 7
    assert len(versions(spark, "t")) == 1  # neither the old version nor the unfinished one is left


def test_columns_may_change_and_a_table_may_read_itself(spark, db):
    overwrite_table(spark.range(10), db, "u")
    overwrite_table(spark.table(f"{DB}.u").withColumn("twice", F.col("id") * 2), db, "u")
    overwrite_table(spark.table(f"{DB}.u").where("id < 4"), db, "u")
    assert sorted(tuple(r) for r in spark.table(f"{DB}.u").collect()) == [(i, 2 * i) for i in range(4)]


def test_a_forgotten_table_is_replaced(spark, db):
    overwrite_table(spark.range(5), db, "w")
    spark.sql(f"DROP TABLE {DB}.w")  # the catalog forgets it, the files stay
    assert len(versions(spark, "w")) == 1
    overwrite_table(spark.range(3), db, "w")
    assert spark.table(f"{DB}.w").count() == 3 and len(versions(spark, "w")) == 1


def _runs(spark):
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:") + "/scratch"
    return [f for f in (os.listdir(scratch) if os.path.isdir(scratch) else []) if f.startswith("run-")]


def test_scratch_of_a_run_is_deleted_after_success_and_failure(spark):
    with run_scratch(spark, delete_folder) as folder:
        path = scratch_path(spark, "x")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        assert _runs(spark)
    assert not _runs(spark) and "/scratch/x-" in scratch_path(spark, "x")
    with pytest.raises(ValueError, match="stop"), run_scratch(spark, delete_folder):
        spark.range(3).write.parquet(scratch_path(spark, "x"))
        raise ValueError("stop")
    assert not _runs(spark)


def test_run_all_leaves_tables_that_read_without_scratch(spark, tmp_dir):
    header = ("Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country/Region,City,State/Province,Postal Code,Region,"
              "Product ID,Category,Sub-Category,Product Name,Sales,Quantity,Discount,Profit")
    line = "O-{i},2021-05-0{i},2021-05-09,First Class,C-{i},Ann,Consumer,US,LA,CA,90001,West,P-1,Furniture,Chairs,Chair,{i}.5,2,0.1,1.5"
    files = {"Orders": [header, *(line.format(i=i) for i in range(1, 6))], "People": ["Regional Manager,Region", "Mia,West"], "Returns": ["Returned,Order ID", "Yes,O-2"]}
    for name, lines in files.items():
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    layers = Layers(raw="s_raw", star="s_star", reporting="s_rep")
    for _ in range(2):  # a second run replaces the first
        run_all(spark, tmp_dir, layers, overrides={"orders": {"Postal Code": "string"}})
        assert not _runs(spark)
        assert spark.table("s_star.fact_sales").count() == 5 and spark.table("s_raw.orders").count() == 5
        assert spark.table("s_rep.agg_product_performance").first()["revenue_rank"] == 1
