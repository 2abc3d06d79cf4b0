from pyspark.sql import functions as F

from wattle.operators.merge import consolidate, key_alignment, outer_merge


def test_outer_merge_left_preferred(spark):
    left = spark.createDataFrame([("2020-01-01", "daily", 2020, 1.0), ("2020-01-02", "daily", 2020, 2.0)],
                                 "date string, aggregation_level string, year long, a double")
    right = spark.createDataFrame([("2020-01-02", "daily", 1999, 5.0), ("2020-01-03", "daily", 2020, 6.0)],
                                  "date string, aggregation_level string, year long, b double")
    out = {r.date: r for r in outer_merge(left, right).collect()}
    assert sorted(out) == ["2020-01-01", "2020-01-02", "2020-01-03"]
    assert out["2020-01-02"].year == 2020 and out["2020-01-02"].b == 5.0      # left wins
    assert out["2020-01-03"].year == 2020 and out["2020-01-03"].a is None
    assert out["2020-01-01"].b is None


def test_duplicate_keys_multiply(spark):
    left = spark.createDataFrame([("2020-01-06", "weekly", 1.0), ("2020-01-06", "weekly", 2.0)],
                                 "date string, aggregation_level string, a double")
    right = spark.createDataFrame([("2020-01-06", "weekly", 7.0), ("2020-01-06", "weekly", 8.0)],
                                  "date string, aggregation_level string, b double")
    assert outer_merge(left, right).count() == 4


def test_join_free_consolidation_equals_join_chain_on_unique_keys(spark):
    base = "date string, aggregation_level string, year long"
    s1 = spark.createDataFrame([("d1", "daily", 1, 1.0), ("d2", "daily", 1, 2.0)], base + ", a double")
    s2 = spark.createDataFrame([("d2", "daily", 2, 3.0), ("d3", "daily", 2, 4.0)], base + ", b double")
    s3 = spark.createDataFrame([("d1", "monthly", 3, 5.0), ("d3", "daily", 3, 6.0)], base + ", c double")
    j = consolidate([s1, s2, s3], how="join")
    u = consolidate([s1, s2, s3], how="union").select(*j.columns)
    assert sorted(map(tuple, j.collect())) == sorted(map(tuple, u.collect()))


def test_key_alignment(spark):
    a = spark.createDataFrame([("m1",), ("m2",)], "date string")
    b = spark.createDataFrame([("m2",), ("m3",)], "date string")
    assert sorted(map(tuple, key_alignment(a, b).collect())) == [("m1", "left_only"), ("m3", "right_only")]


def test_family_type_check_and_column_sets(spark):
    from wattle.operators.quality import column_set_difference, family_type_check
    df = spark.createDataFrame([("d", 1.0, 2, "x")], "date string, price_a double, prod_b long, econ_c string")
    res = {c: ok for c, _, _, ok in family_type_check(df)}
    assert res == {"price_a": True, "prod_b": True, "econ_c": False}
    assert column_set_difference(df.columns, ["date", "price_a", "oegpi_x"]) == \
        {"missing": ["oegpi_x"], "unexpected": ["econ_c", "prod_b"]}


def test_consolidated_join_equals_union_on_standins(spark):
    from tests.conftest import SF_SMALL
    from wattle.plans.consolidate import consolidated
    j = consolidated(spark, SF_SMALL, how="join")
    u = consolidated(spark, SF_SMALL, how="union").select(*j.columns)
    assert j.count() == u.count()
    assert j.exceptAll(u).count() == 0 and u.exceptAll(j).count() == 0


def test_shuffle_sizing(spark):
    from wattle.session import size_shuffles
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * (1 << 40)) == 200_000   # capped
        assert size_shuffles(spark, 10 << 20) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
