"""Property: distributed dense keys and ranks equal Spark's own window functions on random input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercata.operators.keys import with_dense_key, with_rank_desc

values = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), values), min_size=0, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, parts=st.integers(min_value=1, max_value=5))
def test_dense_key_and_rank_match_windows(spark, data, parts):
    df = spark.createDataFrame(data, "s string, v int").repartition(parts)
    order = [F.col("s").asc_nulls_first(), F.col("v").asc_nulls_first()]
    keyed = with_dense_key(df, "k", ["s", "v"], unique=False).frame
    expected = df.withColumn("k", F.row_number().over(Window.orderBy(*order)))
    assert sorted(map(repr, keyed.collect())) == sorted(map(repr, expected.collect()))

    ranked = with_rank_desc(df, "v", "r", partitions=parts)
    exp_rank = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(map(repr, ranked.select("s", "v", "r").collect())) == sorted(map(repr, exp_rank.collect()))
