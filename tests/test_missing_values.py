"""NaN is a missing value; mapped numbers keep the values that stay; keys of another kind don't fail."""

from featurekit.operators import OneHot, TargetEncode, ValueMapper


def test_onehot_nan_and_many_categories(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert len(OneHot("x").fit(df).transform(df).columns) == 1
    many = spark.range(1200).selectExpr("cast(id as string) AS c")
    assert len(OneHot("c").fit(many).categories) == 1200


def test_target_encode_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, float("nan")), (float("nan"), 0.0), (2.0, 0.0)], "x double, y double")
    got = [r.x for r in TargetEncode("x", "y", 1.0).fit(df).transform(df.select("x", "y")).collect()]
    assert all(v is None or v == v for v in got) and got[2] is None


def test_mapping_types(spark):
    df = spark.createDataFrame([(1.0,), (2.7,)], "x double")
    assert [r.x for r in ValueMapper("x", {1.0: 5}).transform(df).collect()] == [5.0, 2.7]
    text = spark.createDataFrame([("a",), ("1",)], "x string")
    assert [r.x for r in ValueMapper("x", {1: 5}).transform(text).collect()] == [None, 5]
