"""Dense keys and ranks: equal to row_number()/rank(), deterministic, and spread under skew."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercata.operators.keys import global_positions, with_dense_key, with_rank_desc


def test_dense_key_equals_row_number(spark):
    df = spark.range(500).select((F.col("id") % 37).cast("string").alias("a"),
                                 F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5).alias("b")).distinct()
    keyed = with_dense_key(df, "k", ["a", "b"], unique=True)
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    expected = df.withColumn("k", F.row_number().over(w))
    assert sorted(keyed.frame.collect(), key=repr) == sorted(expected.select("a", "b", "k").collect(), key=repr)
    assert keyed.rows == df.count()


def test_duplicates_get_distinct_keys_and_same_multiset(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("v"))
    a = with_dense_key(df, "k", ["v"], unique=False).frame
    b = with_dense_key(df.repartition(7), "k", ["v"], unique=False).frame
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(r["k"] for r in a.collect()) == list(range(1, 301))


def test_hot_duplicate_group_is_split_across_partitions(spark):
    # a third of the rows are one identical value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    pos = global_positions(df, [F.col("v").asc()], split_ties=True, partitions=6).frame
    sizes = [r["count"] for r in pos.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000  # the 1000 identical rows do not sit in one task
    got = sorted(r[0] for r in pos.select("__mercata_pos").collect())
    assert got == list(range(3000))


def test_rank_desc_equals_window_rank(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 13 == 0, None)
                                 .otherwise((F.col("id") * 7) % 50).alias("v"))
    got = with_rank_desc(df, "v", "r")
    exp = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(got.select("id", "v", "r").collect(), key=repr) == sorted(exp.collect(), key=repr)


def test_rank_with_hot_value(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("v"))
    got = with_rank_desc(df, "v", "r", partitions=5)
    exp = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(got.select("id", "v", "r").collect(), key=repr) == sorted(exp.collect(), key=repr)


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id").alias("v"))
    keyed = with_dense_key(df, "k", ["v"], unique=True)
    assert keyed.rows == 0 and keyed.frame.count() == 0
