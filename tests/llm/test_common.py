from pyspark.sql import functions as F

from wattlake.llm import common


def test_join_groups_is_an_inner_join(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") % 7 * (F.col("id") % 3 > 0).cast("int")).alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("k <> 5")
    want = sorted(map(tuple, rows.join(groups, "k").collect()))
    for heavy in (1, 2, 5, 10_000):  # from every key shuffled to every key sent
        monkeypatch.setattr(common, "HEAVY_KEYS", heavy)
        found = common.join_groups(rows, groups, ["k"], "n", 1000)
        assert sorted(map(tuple, found.collect())) == want


def test_fewer_keys_are_sent_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY_KEYS", 10)
    rows = spark.range(1000).select(F.least(F.col("id") % 100, F.lit(80)).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert groups.where(F.col("n") * common.HEAVY_KEYS > 1000).count() == 1
