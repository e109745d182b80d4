"""Hot keys by a sketch: same result, even tasks, no job while planning."""

from statistics import median

from pyspark.sql import functions as F

from recaudo.operators.flags import multi_flags
from recaudo.operators.hot_keys import hot_keys, hot_left_join


def _accounts(spark, n=40_000):
    doc = F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("d"), (F.col("id") % 3000).cast("string")))
    return spark.range(n).select(F.col("id").alias("acc"), doc.alias("doc"), (F.col("id") % 7).cast("string").alias("v"))


def test_only_keys_of_that_share_are_hot(spark):
    assert [r.doc for r in hot_keys(_accounts(spark), "doc").collect()] == ["HOT"]
    assert hot_keys(_accounts(spark).where("doc != 'HOT'"), "doc").count() == 0
    assert hot_keys(_accounts(spark).limit(0), "doc").count() == 0


def test_salted_join_is_the_plain_join(spark):
    left = _accounts(spark)
    right = spark.createDataFrame([("HOT", 1), ("HOT", 2), ("d1", 3), ("none", 4), (None, 5)], "doc string, x int")
    want = left.join(right, "doc", "left").select("acc", "doc", "x")
    got = hot_left_join(left, right, "doc", "acc", salts=8).select("acc", "doc", "x")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_flags_with_a_hot_document_are_the_same_and_even(spark):
    a = _accounts(spark)
    plain = multi_flags(a, "doc", "acc", {"multiproducto": "v"})
    salted = multi_flags(a, "doc", "acc", {"multiproducto": "v"}, hot_share=0.01, salts=256)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert salted.exceptAll(plain.select(*salted.columns)).count() == 0 and salted.count() == a.count()
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "-1")):
            spark.conf.set(k, v)
        sizes = [r["count"] for r in multi_flags(a, "doc", "acc", {"multiproducto": "v"}, hot_share=0.01, salts=256)
                 .groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) <= 2 * median(sizes)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
