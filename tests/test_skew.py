"""Large-dimension path: lookups as shuffle joins (no broadcast) with a hot key give the same star."""

import datetime as dt

from pyspark.sql import functions as F

import toy
from mercata.operators import marts
from mercata.plans.star import build_star


def _lines():
    out = []
    for i in range(300):
        hot = i % 3 == 0  # a third of all lines belong to one customer and one product
        out.append(dict(order_id=f"O-{i // 2}", customer_id="C-HOT" if hot else f"C-{i % 17}",
                        product_id="P-HOT" if hot else f"P-{i % 23}", sales=float(i % 50 + 1),
                        profit=float(i % 7 - 2), order_date=dt.date(2021, 1 + i % 12, 1 + i % 28)))
    return out


def _snapshot(star):
    out = {t: sorted(map(repr, getattr(star, t).collect())) for t in ("fact_sales", "fact_returns")}
    for name, fn in marts.MARTS.items():
        out[name] = sorted(map(repr, fn(star).collect()))
    return out


def test_shuffle_lookups_equal_broadcast_lookups(spark):
    orders = toy.orders(spark, _lines()).withColumns(
        {c: F.col(c).cast("decimal(12,2)") for c in ("sales", "profit", "discount")})
    people = toy.people(spark, [("Mia", "West")])
    rets = toy.returns(spark, [("O-0", "Yes"), ("O-3", "Yes"), ("O-3", "Yes")])
    broadcast = _snapshot(build_star(orders, people, rets))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        star = build_star(orders, people, rets)
        shuffled = _snapshot(star)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert shuffled == broadcast


def test_hot_keys_are_split_by_salts_with_aqe_off(spark):
    """A third of the lines on one id, another part without any: no task of the join is far above the median."""
    from mercata.config import LOOKUP_SALTS
    from mercata.operators.lookup import hot_keys, left_lookup

    fact = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 9 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 600)).alias("c"))
    dim = spark.range(600).select(F.concat(F.lit("c"), F.col("id")).alias("cid"), F.col("id").alias("ck")) \
        .unionByName(spark.createDataFrame([("HOT", 9001), ("HOT", 9002)], "cid string, ck long"))
    assert [r[0] for r in hot_keys(fact, ["c"]).collect()] == ["HOT"]
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        largest = {}
        rows = {}
        for salts in ("0", "32"):
            spark.conf.set(LOOKUP_SALTS, salts)
            out = left_lookup(fact, dim, [("c", "cid")], ["ck"])
            assert out.columns == ["id", "c", "ck"]
            sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
            largest[salts] = sizes[-1] / sizes[len(sizes) // 2]
            rows[salts] = sorted(map(repr, out.collect()))
        assert rows["0"] == rows["32"] and len(rows["0"]) == 9000 + 3000
        assert largest["0"] > 8 and largest["32"] < 3
    finally:
        spark.conf.unset(LOOKUP_SALTS)
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_star_with_salted_lookups_is_the_same(spark):
    from mercata.config import LOOKUP_SALTS

    orders = toy.orders(spark, _lines()).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("sales", "profit", "discount")})
    rets = toy.returns(spark, [("O-0", "Yes"), ("O-3", "Yes"), ("O-3", "Yes")])

    def facts():
        star = build_star(orders, toy.people(spark, []), rets)
        return [sorted(map(repr, getattr(star, t).collect())) for t in ("fact_sales", "fact_returns")]

    plain = facts()
    try:
        spark.conf.set(LOOKUP_SALTS, "4")
        assert facts() == plain
    finally:
        spark.conf.unset(LOOKUP_SALTS)
